"""Further queries: metadata, settings, listings, reports and raster measures, with their SQL twins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import inputs, planning, report
from .registry import BLUR, CANDIDATES, CELLS, PART, RASTER, RECORDS, RESULTS, SIDE, _mirror, blurred, query, stencil

# ---- inputs and metadata


@query("""WITH l AS (SELECT item_id, unnest(string_split(replace(replace(text, '. ', chr(10)), 'the', chr(39)), chr(10))) line, generate_subscripts(string_split(replace(replace(text, '. ', chr(10)), 'the', chr(39)), chr(10)), 1) - 1 i FROM benchmark), t AS (SELECT item_id, i, trim(line) line FROM l), u AS (SELECT item_id, i, CASE WHEN length(line) >= 2 AND line[1] = line[-1] AND line[1] IN (chr(34), chr(39)) THEN line[2:-2] ELSE line END path FROM t) SELECT item_id, CAST(i AS INTEGER) AS ordinal, path FROM u WHERE path <> ''""")
def list_scan(spark, sf_dir):
    """Lines of a list: blanks and one pair of quotes are taken off, empty ones dropped, places kept."""
    text = F.replace(F.replace("text", F.lit(". "), F.lit("\n")), F.lit("the"), F.lit("'"))
    lines = fx.table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split(text, "\n")).alias("ordinal", "line"))
    return lines.select("item_id", "ordinal", inputs.unquoted(F.col("line")).alias("path")).where("path != ''")


@query("""WITH f AS (SELECT doc_id, source || '/' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.mrxs' WHEN 1 THEN '.SVS' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.tiff' END path, doc_id % 11 = 0 gone FROM documents) SELECT doc_id, path, CASE WHEN gone THEN 'missing' WHEN doc_id % 5 IN (2, 3) THEN 'kind' END AS error, CASE WHEN NOT gone AND doc_id % 5 = 0 AND l.doc IS NOT NULL THEN regexp_replace(path, '[.]mrxs$', '') END AS sidecar FROM f LEFT JOIN (SELECT DISTINCT doc_id doc FROM labels) l ON l.doc = doc_id""")
def input_errors(spark, sf_dir):
    """What does not resolve, and why; the folder beside an MRXS file goes with it."""
    k = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, (".mrxs", ".SVS", ".txt", "", ".tiff"))), (k % 5 + 1).cast("int"))
    f = fx.table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), k.cast("string"), kind).alias("path"), (k % 11 == 0).alias("gone"))
    folders = fx.table(spark, sf_dir, "labels").select(F.col("doc_id")).distinct().withColumn("beside", F.lit(True))
    x = f.join(folders, "doc_id", "left")
    ext = inputs.extension(F.col("path"))
    error = F.when(F.col("gone"), "missing").when(~ext.isin(*inputs.EXTENSIONS), "kind")
    beside = F.when(~F.col("gone") & (ext == "mrxs") & F.col("beside"), F.regexp_replace("path", "[.]mrxs$", ""))
    return x.select("doc_id", "path", error.alias("error"), beside.alias("sidecar"))


@query("""WITH p AS (SELECT p_partkey k, CASE WHEN p_partkey % 6 = 0 THEN '0.25,0.35' END direct, CASE WHEN p_partkey % 3 = 1 THEN '0.5' END x1, CASE WHEN p_partkey % 4 = 1 THEN 'bad 0.75' END x2, CASE WHEN p_partkey % 5 = 1 THEN '0.125' END y1, CASE WHEN p_partkey % 7 = 2 THEN '0.5;0.25' END a, CASE WHEN p_partkey % 2 = 0 THEN '0.0005' END mm FROM part) SELECT k AS slide_id, round(CASE WHEN direct IS NOT NULL THEN 0.3 WHEN coalesce(x1, x2, y1) IS NOT NULL THEN list_avg(list_filter([CASE WHEN x1 IS NOT NULL THEN 0.5 END, CASE WHEN x2 IS NOT NULL THEN 0.75 END, CASE WHEN y1 IS NOT NULL THEN 0.125 END]::DOUBLE[], lambda v: v IS NOT NULL)) WHEN a IS NOT NULL THEN 0.375 WHEN mm IS NOT NULL THEN 0.5 END, 9)::DOUBLE AS mpp FROM p""")
def mpp_spellings(spark, sf_dir):
    """The resolution from properties under any of its names, in any case."""
    k = F.col("p_partkey")
    entry = lambda name, cond, value: F.when(cond, F.struct(F.lit(name).alias("key"), F.lit(value).alias("value")))
    entries = F.array(entry("OpenSlide.mpp-x", k % 3 == 1, "0.5"), entry("MPP_X", k % 4 == 1, "bad 0.75"), entry("mpp-y", k % 5 == 1, "0.125"), entry("aperio.MPP", k % 7 == 2, "0.5;0.25"), entry("PixelSpacing", k % 2 == 0, "0.0005"))
    p = fx.table(spark, sf_dir, "part").select(k.alias("slide_id"), F.when(k % 6 == 0, "0.25,0.35").alias("direct"), F.map_from_entries(F.filter(entries, lambda e: e.isNotNull())).alias("properties"))
    return p.select("slide_id", F.round(inputs.resolution(F.col("properties"), F.col("direct")), 9).alias("mpp"))


@query(f"""WITH {PART}, t AS (SELECT *, greatest(1, CAST(round_even(512.0::DOUBLE * height / width, 0) AS BIGINT)) th FROM slides) SELECT slide_id, th AS thumbnail_height, CASE WHEN width <= 512 AND height <= th THEN 0 WHEN width // 4 <= 512 AND height // 4 <= th THEN 1 ELSE 2 END AS level FROM t""")
def thumbnail_level(spark, sf_dir):
    """Height of a thumbnail of 512 pixels' width, and the first level that fits into it, else the last."""
    h = F.greatest(F.lit(1).cast("long"), F.bround(F.lit(512.0) * F.col("height") / F.col("width")).cast("long"))
    s = fx.slides(spark, sf_dir).withColumn("thumbnail_height", h)
    sizes = F.transform("downsamples", lambda d: F.struct(F.floor(F.col("width") / d).alias("w"), F.floor(F.col("height") / d).alias("h")))
    level = F.array_position(F.transform(sizes, lambda z: (z["w"] <= 512) & (z["h"] <= F.col("thumbnail_height"))), True)
    return s.select("slide_id", "thumbnail_height", F.when(level > 0, level - 1).otherwise(F.size("downsamples") - 1).cast("int").alias("level"))


@query(f"""WITH {PART} SELECT slide_id, width * height AS pixels, slide_id % 3 = 0 AND width * height > 10000000 AS skipped FROM slides""")
def single_level_skip(spark, sf_dir):
    """Slides of one level that are too large for a preview."""
    one, pixels = F.col("slide_id") % 3 == 0, F.col("width") * F.col("height")
    return fx.slides(spark, sf_dir).select("slide_id", pixels.alias("pixels"), (one & (pixels > 10_000_000)).alias("skipped"))


@query(f"""WITH {PART}, g AS (SELECT slide_id, width // 4 lw, height // 4 lh, 4 * 0.25::DOUBLE * (1 + slide_id % 3) AS mpp FROM slides WHERE slide_id % 7 <> 0 AND slide_id % 40 = 1), e AS (SELECT *, CAST(greatest(1, round_even(64 * 2.0::DOUBLE / mpp, 0)) AS BIGINT) size, CAST(greatest(1, round_even(96 * 2.0::DOUBLE / mpp, 0)) AS BIGINT) stride FROM g), y AS (SELECT *, unnest(range(0, lh - size + 1, stride)) ly FROM e WHERE lw >= size AND lh >= size), x AS (SELECT *, unnest(range(0, lw - size + 1, stride)) lx FROM y) SELECT slide_id, CAST(4 * lx AS BIGINT) AS x0, CAST(4 * ly AS BIGINT) AS y0, size FROM x""")
def level_grid(spark, sf_dir):
    """Places of a grid at level 1, with the sizes that the slide's resolution asks for."""
    s = fx.slides(spark, sf_dir).where("mpp is not null and slide_id % 40 = 1").withColumn("d", F.element_at("downsamples", 2))
    s = s.withColumn("lw", F.floor(F.col("width") / F.col("d"))).withColumn("lh", F.floor(F.col("height") / F.col("d")))
    s = s.withColumn("size", planning.scaled(64, 2.0, F.col("mpp"), F.col("d"), 64)).withColumn("stride", planning.scaled(96, 2.0, F.col("mpp"), F.col("d"), 96))
    return planning.grid(s, "lw", "lh", F.col("size"), F.col("stride"), F.col("d")).select("slide_id", "x0", "y0", "size")


@query("""WITH r AS (SELECT c_custkey i, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN ' ' || c_nationkey || ' ' WHEN 4 THEN 'cpu' ELSE 'cuda:' || c_nationkey END request FROM customer) SELECT i, request, CASE WHEN request IS NULL OR request IN ('', 'null') THEN 'auto' WHEN regexp_full_match(trim(request), '[0-9]+') THEN 'cuda:' || trim(request) ELSE trim(request) END AS device FROM r""")
def device_request(spark, sf_dir):
    n = F.col("c_nationkey").cast("string")
    k = F.col("c_custkey") % 6
    request = F.when(k == 1, "").when(k == 2, "null").when(k == 3, F.concat(F.lit(" "), n, F.lit(" "))).when(k == 4, "cpu").when(k == 5, F.concat(F.lit("cuda:"), n))
    r = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("i"), request.alias("request"))
    return r.withColumn("device", inputs.device(F.col("request")))


@query("""WITH l AS (SELECT s_suppkey i, s_suppkey || ', GPU-' || s_suppkey || ', 0000:' || s_nationkey || ', ' || CAST(floor(abs(s_acctbal)) AS BIGINT) || CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE ', 24576' END line FROM supplier), f AS (SELECT i, list_transform(string_split(line, ','), lambda x: trim(x)) f FROM l) SELECT i, CASE WHEN len(f) = 5 THEN f[2] END AS uuid, CASE WHEN len(f) = 5 THEN CAST(f[4] AS BIGINT) * 1048576 ELSE 0 END AS free, CASE WHEN len(f) = 5 THEN CAST(f[5] AS BIGINT) * 1048576 ELSE 0 END AS total, len(f) <> 5 AS bad FROM f""")
def device_inventory(spark, sf_dir):
    """Devices from the lines of an inventory: five fields each, sizes in MiB; a line of other fields is bad and has sizes of 0."""
    s, k = fx.table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("string")
    free = F.floor(F.abs("s_acctbal")).cast("string")
    line = F.concat(k, F.lit(", GPU-"), k, F.lit(", 0000:"), F.col("s_nationkey").cast("string"), F.lit(", "), free, F.when(F.col("s_suppkey") % 9 == 0, "").otherwise(", 24576"))
    f = s.select(F.col("s_suppkey").alias("i"), F.transform(F.split(line, ","), lambda x: F.trim(x)).alias("f")).withColumn("bad", F.size("f") != 5)
    mib = lambda n: F.when(~F.col("bad"), F.get("f", F.lit(n)).cast("long") * 1048576).otherwise(0)
    return f.select("i", F.when(~F.col("bad"), F.get("f", F.lit(1))).alias("uuid"), mib(3).alias("free"), mib(4).alias("total"), "bad")


@query("""WITH m AS (SELECT p_partkey k, CASE p_partkey % 4 WHEN 0 THEN '0o' ELSE '' END || CAST((p_partkey * 37) % 1200 AS VARCHAR) mode FROM part), t AS (SELECT k, mode, regexp_replace(mode, '^0o', '') d FROM m) SELECT k, mode, CASE WHEN regexp_full_match(d, '[0-7]{1,3}') THEN CAST(list_sum(list_transform(range(1, length(d) + 1), lambda i: CAST(d[i] AS BIGINT) * CAST(pow(8, length(d) - i) AS BIGINT))) AS BIGINT) END AS bits FROM t""")
def permission_modes(spark, sf_dir):
    """Octal file modes as numbers; null where they are none."""
    k = F.col("p_partkey")
    m = fx.table(spark, sf_dir, "part").select(k.alias("k"), F.concat(F.when(k % 4 == 0, "0o").otherwise(""), (k * 37 % 1200).cast("string")).alias("mode"))
    d = F.regexp_replace(F.lower(F.trim("mode")), "^0o", "")
    return m.withColumn("bits", F.when(d.rlike("^[0-7]{1,3}$"), F.conv(d, 8, 10).cast("long")))


@query("""WITH b AS (SELECT c_custkey i, CASE c_custkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'openslide' ELSE 'aslide' END backend, CASE c_custkey % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'openslide' WHEN 2 THEN 'aslide' WHEN 3 THEN '' ELSE 'disabled' END fallback FROM customer) SELECT i, CASE WHEN backend <> 'auto' THEN backend WHEN fallback IN ('', 'none', 'disabled', 'aslide') THEN 'aslide' ELSE 'aslide,' || fallback END AS tried FROM b""")
def backend_order(spark, sf_dir):
    """Readers in the order of trial, each once."""
    k = F.col("c_custkey")
    pick = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (k % n + 1).cast("int"))
    b = fx.table(spark, sf_dir, "customer").select(k.alias("i"), pick(3, "auto", "openslide", "aslide").alias("backend"), pick(5, "none", "openslide", "aslide", "", "disabled").alias("fallback"))
    fall = F.when(F.col("fallback").isin("", "none", "disabled"), F.array().cast("array<string>")).otherwise(F.array("fallback"))
    return b.select("i", F.when(F.col("backend") != "auto", F.col("backend")).otherwise(F.array_join(F.array_distinct(F.concat(F.array(F.lit("aslide")), fall)), ",")).alias("tried"))


# ---- what runs leave


@query("""WITH f AS (SELECT user_id slide_id, event_id % 50 || '.jpeg' "name", event_id % 7 shard, CASE WHEN event_type = 'error' THEN 0 ELSE event_id END length FROM events) SELECT slide_id, "name", min(shard) AS shard FROM f WHERE length > 0 GROUP BY ALL""")
def completed_outputs(spark, sf_dir):
    """Files that are there and not empty; of a name that several shards have, the first shard."""
    e = fx.table(spark, sf_dir, "events")
    f = e.select(F.col("user_id").alias("slide_id"), F.concat((F.col("event_id") % 50).cast("string"), F.lit(".jpeg")).alias("name"), (F.col("event_id") % 7).alias("shard"), F.when(F.col("event_type") == "error", 0).otherwise(F.col("event_id")).alias("length"))
    return f.where("length > 0").groupBy("slide_id", "name").agg(F.min("shard").alias("shard"))


@query("""WITH s AS (SELECT user_id slide_id, count(*) FILTER (WHERE event_type = 'view') patches, count(*) FILTER (WHERE event_type = 'signup') samples, bool_or(event_type = 'click' AND value > 1) thumbnail, bool_or(event_type = 'purchase' AND value > 1) mask FROM events GROUP BY user_id) SELECT slide_id, thumbnail AND mask AND samples >= least(15, patches) AS complete FROM s""")
def preview_complete(spark, sf_dir):
    """Whether both previews of a slide are there, and as many samples as were asked for."""
    t = F.col("event_type")
    there = lambda kind: F.max(F.when((t == kind) & (F.col("value") > 1), 1).otherwise(0)) == 1
    s = fx.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("slide_id")).agg(F.count_if(t == "view").alias("patches"), F.count_if(t == "signup").alias("samples"), there("click").alias("a"), there("purchase").alias("b"))
    return s.select("slide_id", (F.col("a") & F.col("b") & (F.col("samples") >= F.least(F.lit(15), "patches"))).alias("complete"))


@query(f"""WITH {RECORDS}, last AS (SELECT slide_id, slide_id % 4 AS last FROM (SELECT DISTINCT slide_id FROM records)), n AS (SELECT slide_id, "index", last, row_number() OVER (PARTITION BY slide_id ORDER BY "index") - 1 rn FROM records JOIN last USING (slide_id) WHERE status = 'success') SELECT slide_id, "index", printf('%d_%04d.tar', slide_id, CAST(rn // 20 + 1 + last AS BIGINT)) AS file FROM n""")
def shard_continuation(spark, sf_dir):
    """Shards of a run that follow those of earlier ones."""
    r = fx.records(spark, sf_dir).where("status = 'success'").withColumn("last", F.col("slide_id") % 4)
    return planning.shards(r, 20, existing=F.col("last")).select("slide_id", "index", "file")


@query(f"""WITH {RESULTS} SELECT CAST(slide_id AS VARCHAR) || chr(9) || coalesce(error, 'unknown error') AS line FROM results WHERE status = 'failed'""")
def failure_lines(spark, sf_dir):
    x = report.slide_results(fx.records(spark, sf_dir), fx.MOST_FAILURES)
    return x.where("status = 'failed'").select(F.concat(F.col("slide_id").cast("string"), F.lit("\t"), F.coalesce("error", F.lit("unknown error"))).alias("line"))


@query(f"""WITH {RECORDS} SELECT slide_id, slide_id || ',' || "index" || ',' || status || ',' || CASE WHEN error IS NULL THEN '' ELSE '"' || replace(error, '"', '""') || '"' END AS line FROM records""")
def manifest_lines(spark, sf_dir):
    """Lines of the manifest: fields with quotes are quoted, and their quotes doubled."""
    quoted = F.coalesce(F.concat(F.lit('"'), F.replace("error", F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    return fx.records(spark, sf_dir).select("slide_id", F.concat_ws(",", F.col("slide_id").cast("string"), F.col("index").cast("string"), "status", quoted).alias("line"))


@query("""SELECT event_id, 'extract_' || strftime(ts, '%Y%m%dT%H%M%SZ') || '_' || user_id AS run_id, strftime(ts, '%Y%m%d %H:%M:%S') AS logged FROM events""")
def run_ids(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("extract_"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit("_"), F.col("user_id").cast("string")).alias("run_id"), F.date_format("ts", "yyyyMMdd HH:mm:ss").alias("logged"))


@query(f"""WITH {RESULTS}, o AS (SELECT doc_id ordinal, doc_id * 7 % 150 slide_id FROM documents WHERE doc_id < 150) SELECT ordinal, slide_id, status, patches FROM o JOIN results USING (slide_id)""")
def results_in_input_order(spark, sf_dir):
    """Results with the place of their slide in the input, by which they are ordered."""
    o = fx.table(spark, sf_dir, "documents").where("doc_id < 150").select(F.col("doc_id").alias("ordinal"), (F.col("doc_id") * 7 % 150).alias("slide_id"))
    x = report.slide_results(fx.records(spark, sf_dir), fx.MOST_FAILURES)
    return x.join(o, "slide_id").select("ordinal", "slide_id", "status", "patches").orderBy("ordinal")


@query(f"""WITH {CANDIDATES} SELECT slide_id, string_agg("name" || ':' || status || ':' || CAST(CAST(round(confidence * 100) AS BIGINT) AS VARCHAR), ' ' ORDER BY pos) AS attempts FROM cand GROUP BY slide_id""")
def attempt_log(spark, sf_dir):
    """All attempts of a slide in the order of the pipe."""
    one = F.concat_ws(":", "name", "status", F.round(F.col("confidence") * 100).cast("long").cast("string"))
    g = fx.candidates(spark, sf_dir).groupBy("slide_id").agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("t")))).alias("a"))
    return g.select("slide_id", F.array_join(F.transform("a", lambda x: x["t"]), " ").alias("attempts"))


@query("""WITH m AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, value FROM events) SELECT event_type, hour, count(*) AS requests, round(sum(value), 4) AS seconds, round(count(*) / 3600.0::DOUBLE, 9) AS per_second FROM m GROUP BY ALL""")
def interval_metrics(spark, sf_dir):
    """Sums of requests by intervals of an hour."""
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).alias("hour")
    g = fx.table(spark, sf_dir, "events").groupBy("event_type", hour).agg(F.count("*").alias("requests"), F.round(F.sum("value"), 4).alias("seconds"))
    return g.withColumn("per_second", F.round(F.col("requests") / 3600.0, 9))


@query(f"""WITH {PART} SELECT slide_id, CAST(floor(300 * 512.0::DOUBLE / width) AS BIGINT) AS x0, CAST(floor(200 * 400.0::DOUBLE / height) AS BIGINT) AS y0, CAST(floor((300 + 256) * 512.0::DOUBLE / width) AS BIGINT) AS x1, CAST(floor((200 + 256) * 400.0::DOUBLE / height) AS BIGINT) AS y1 FROM slides""")
def plan_frames(spark, sf_dir):
    """Frames of a plan in the pixels of the slides' thumbnails."""
    at = lambda v, n, side: F.floor(F.lit(v) * F.lit(float(n)) / F.col(side)).cast("long")
    return fx.slides(spark, sf_dir).select("slide_id", at(300, 512, "width").alias("x0"), at(200, 400, "height").alias("y0"), at(556, 512, "width").alias("x1"), at(456, 400, "height").alias("y1"))


# ---- rasters


def _product(name: str, source: str, rows: str, cols: str) -> str:
    """SQL of a stencil that is a product of weights for rows and columns, mirrored at the edges."""
    return f"""{name} AS (SELECT a.slide_id, a."row", a.col, sum(b.v * kr.w * kc.w) v FROM {source} a CROSS JOIN (VALUES {rows}) kr(d, w) CROSS JOIN (VALUES {cols}) kc(d, w) JOIN {source} b ON b.slide_id = a.slide_id AND b."row" = {_mirror('(a."row" + kr.d)')} AND b.col = {_mirror('(a.col + kc.d)')} GROUP BY ALL)"""


SMOOTH, SLOPE = "(-1, 1.0::DOUBLE), (0, 2.0), (1, 1.0)", "(-1, -1.0::DOUBLE), (1, 1.0)"


@query(f"""WITH {BLUR}, {_product('gx', 'blurred', SMOOTH, SLOPE)}, {_product('gy', 'blurred', SLOPE, SMOOTH)} SELECT slide_id, "row", col, round(sqrt(gx.v * gx.v + gy.v * gy.v), 5) AS magnitude FROM gx JOIN gy USING (slide_id, "row", col)""")
def sobel_magnitude(spark, sf_dir):
    """Length of the gradient by 3 x 3 kernels."""
    b, smooth, slope = blurred(spark, sf_dir), {-1: 1.0, 0: 2.0, 1: 1.0}, {-1: -1.0, 1: 1.0}
    gx, gy = stencil(stencil(b, "col", slope), "row", smooth), stencil(stencil(b, "col", smooth), "row", slope)
    g = gx.withColumn("k", F.lit(0)).union(gy.withColumn("k", F.lit(1))).groupBy("slide_id", "row", "col").agg(F.sum(F.col("v") * F.col("v")).alias("v"))
    return g.select("slide_id", "row", "col", F.round(F.sqrt("v"), 5).alias("magnitude"))


BINS = f"""{RASTER}, q AS (SELECT slide_id, CAST(least(15, greatest(0, floor(v * 16 + 8))) AS BIGINT) b FROM raster)"""


def _bins(spark, sf_dir) -> DataFrame:
    b = F.least(F.lit(15), F.greatest(F.lit(0), F.floor(F.col("v") * 16 + 8))).cast("long")
    return fx.rasters(spark, sf_dir).select("slide_id", "row", "col", b.alias("b"))


@query(f"""WITH {BINS}, h AS (SELECT slide_id, b, count(*) n FROM q GROUP BY ALL), t AS (SELECT slide_id, sum(n) total, sum(n * b) mass FROM h GROUP BY slide_id), c AS (SELECT slide_id, b, sum(n) OVER w n0, sum(n * b) OVER w m0 FROM h WINDOW w AS (PARTITION BY slide_id ORDER BY b)), s AS (SELECT slide_id, b, CASE WHEN n0 < total THEN CAST((mass * n0 - m0 * total) * (mass * n0 - m0 * total) AS DOUBLE) / CAST(n0 * (total - n0) AS DOUBLE) ELSE -1 END score FROM c JOIN t USING (slide_id)) SELECT slide_id, arg_max(b, score * 1000000 - b) AS threshold FROM s GROUP BY slide_id""")
def otsu_threshold(spark, sf_dir):
    """The grey level that parts a raster into two classes farthest apart, the least of equals."""
    h = _bins(spark, sf_dir).groupBy("slide_id", "b").agg(F.count("*").alias("n"))
    upto, all_ = Window.partitionBy("slide_id").orderBy("b"), Window.partitionBy("slide_id")
    mass = F.col("n") * F.col("b")
    c = h.select("slide_id", "b", F.sum("n").over(upto).alias("n0"), F.sum(mass).over(upto).alias("m0"), F.sum("n").over(all_).alias("total"), F.sum(mass).over(all_).alias("mass"))
    apart = F.col("mass") * F.col("n0") - F.col("m0") * F.col("total")
    score = F.when(F.col("n0") < F.col("total"), (apart * apart).cast("double") / (F.col("n0") * (F.col("total") - F.col("n0"))).cast("double")).otherwise(-1.0)
    return c.groupBy("slide_id").agg(F.max_by("b", F.struct(score, -F.col("b"))).alias("threshold"))


@query(f"""WITH {BINS}, p AS (SELECT slide_id, list(b ORDER BY r) b FROM (SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY "row", col) r, CAST(least(15, greatest(0, floor(v * 16 + 8))) AS BIGINT) b FROM raster) GROUP BY slide_id), c AS (SELECT slide_id, b[1] * 17 r, b[2] * 17 g, b[3] * 17 bl FROM p), m AS (SELECT *, greatest(r, g, bl) hi, least(r, g, bl) lo FROM c) SELECT slide_id, CASE WHEN hi = lo THEN 0 WHEN hi = r THEN (60.0::DOUBLE * (g - bl) / (hi - lo) + 360) % 360 WHEN hi = g THEN 60.0::DOUBLE * (bl - r) / (hi - lo) + 120 ELSE 60.0::DOUBLE * (r - g) / (hi - lo) + 240 END AS hue, CASE WHEN hi = 0 THEN 0 ELSE (hi - lo) * 1.0::DOUBLE / hi END AS saturation, hi AS "value" FROM m""")
def hue_saturation(spark, sf_dir):
    """Hue in degrees, saturation and value of a colour: the first three pixels of a raster are its channels."""
    b = _bins(spark, sf_dir).where("row = 0 and col < 3")
    c = b.groupBy("slide_id").agg(*[F.max(F.when(F.col("col") == i, F.col("b") * 17)).alias(n) for i, n in enumerate("rgb")])
    r, g, bl = (F.col(x) for x in "rgb")
    hi, lo = F.greatest(r, g, bl), F.least(r, g, bl)
    span = F.when(hi > lo, hi - lo)
    hue = F.when(hi == lo, 0.0).when(hi == r, F.pmod(60.0 * (g - bl) / span + 360, F.lit(360.0))).when(hi == g, 60.0 * (bl - r) / span + 120).otherwise(60.0 * (r - g) / span + 240)
    return c.select("slide_id", hue.alias("hue"), F.when(hi == 0, 0.0).otherwise((hi - lo) * 1.0 / F.greatest(hi, F.lit(1))).alias("saturation"), hi.alias("value"))


@query(f"""WITH {RASTER}, w AS (SELECT slide_id, "row", col, greatest(v, 0) w FROM raster), p AS (SELECT slide_id, quantile_cont(w, 0.6) q FROM w WHERE w > 0 GROUP BY slide_id) SELECT slide_id, round(sum(col * w) / sum(w), 6) AS x, round(sum("row" * w) / sum(w), 6) AS y FROM w JOIN p USING (slide_id) WHERE w >= q GROUP BY slide_id""")
def weighted_centroid(spark, sf_dir):
    """Centre of the weights at their 60th percentile and above."""
    w = fx.rasters(spark, sf_dir).where("v > 0")
    p = w.groupBy("slide_id").agg(F.expr("percentile(v, 0.6)").alias("q"))
    k = w.join(p, "slide_id").where("v >= q").groupBy("slide_id")
    mean = lambda c: F.round(F.sum(F.col(c) * F.col("v")) / F.sum("v"), 6)
    return k.agg(mean("col").alias("x"), mean("row").alias("y"))


RING = [(round(32 + math.cos(2 * math.pi * k / 72) * 20.3), round(32 + math.sin(2 * math.pi * k / 72) * 20.3)) for k in range(72)]


@query(f"""WITH {CELLS}, a AS (SELECT * FROM (VALUES {", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(RING))}) t(k, x, y)), v AS (SELECT s.slide_id, a.k, CASE WHEN c.col IS NULL THEN 0.0::DOUBLE ELSE 1 END v FROM slides s CROSS JOIN a LEFT JOIN cells c ON c.slide_id = s.slide_id AND c.col = a.x AND c."row" = a.y) SELECT slide_id, avg(v) AS strength, avg(CASE WHEN v >= 0.18 THEN 1.0::DOUBLE ELSE 0 END) AS coverage, quantile_cont(v, 0.25) AS low FROM v GROUP BY slide_id""")
def ring_support(spark, sf_dir):
    """What 72 points of a circle find on a mask: share of support, mean and first quartile."""
    points = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).cast("long").alias("col"), F.lit(y).cast("long").alias("row")) for k, (x, y) in enumerate(RING)])
    a = fx.mask_slides(spark, sf_dir).select("slide_id", F.explode(points).alias("p")).select("slide_id", "p.*")
    v = a.join(fx.mask_cells(spark, sf_dir).withColumn("on", F.lit(1.0)), ["slide_id", "row", "col"], "left").withColumn("v", F.coalesce("on", F.lit(0.0)))
    return v.groupBy("slide_id").agg(F.avg("v").alias("strength"), F.avg(F.when(F.col("v") >= 0.18, 1.0).otherwise(0.0)).alias("coverage"), F.expr("percentile(v, 0.25)").alias("low"))


@query(f"""WITH {CELLS}, p AS (SELECT s.slide_id, y.y, x.x, CAST(floor((x.x - (32 - 24.6)) / 8.2) AS BIGINT) cx, CAST(floor((y.y - (32 - 24.6)) / 8.2) AS BIGINT) cy FROM slides s CROSS JOIN range(0, {SIDE}) y(y) CROSS JOIN range(0, {SIDE}) x(x) WHERE (x.x - 32) * (x.x - 32) + (y.y - 32) * (y.y - 32) <= 24.6 * 24.6), g AS (SELECT p.slide_id, cx, cy, count(*) n, avg(CASE WHEN c.col IS NULL THEN 0.0::DOUBLE ELSE 1 END) f FROM p LEFT JOIN cells c ON c.slide_id = p.slide_id AND c.col = p.x AND c."row" = p.y WHERE cx BETWEEN 0 AND 5 AND cy BETWEEN 0 AND 5 GROUP BY ALL HAVING count(*) >= 20) SELECT slide_id, count(*) AS cells, round(avg(CASE WHEN f >= 0.3 THEN 1.0::DOUBLE ELSE 0 END), 9) AS spread FROM g GROUP BY slide_id""")
def content_spread(spark, sf_dir):
    """Share of the 6 x 6 cells of a disk, of 20 pixels at least, that hold content."""
    both = F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1)).cast("array<long>"))
    p = fx.mask_slides(spark, sf_dir).select("slide_id", both.alias("row")).select("slide_id", "row", both.alias("col"))
    dx, dy = F.col("col") - 32, F.col("row") - 32
    cell = lambda c: F.floor((F.col(c) - (32 - 24.6)) / 8.2)
    p = p.where(dx * dx + dy * dy <= 24.6 * 24.6).withColumn("cx", cell("col")).withColumn("cy", cell("row")).where("cx BETWEEN 0 AND 5 AND cy BETWEEN 0 AND 5")
    p = p.join(fx.mask_cells(spark, sf_dir).withColumn("on", F.lit(1.0)), ["slide_id", "row", "col"], "left")
    g = p.groupBy("slide_id", "cx", "cy").agg(F.count("*").alias("n"), F.avg(F.coalesce("on", F.lit(0.0))).alias("f")).where("n >= 20")
    return g.groupBy("slide_id").agg(F.count("*").alias("cells"), F.round(F.avg(F.when(F.col("f") >= 0.3, 1.0).otherwise(0.0)), 9).alias("spread"))


@query(f"""WITH {RASTER}, s AS (SELECT *, sum(v) OVER (PARTITION BY slide_id, "row" ORDER BY col ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) i, sum(v) OVER (PARTITION BY slide_id, "row" ORDER BY col ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) o FROM raster) SELECT slide_id, "row", col, round(i / 2 - o / 2, 6) AS contrast FROM s WHERE col BETWEEN 2 AND 6""")
def band_contrast(spark, sf_dir):
    """Along each line the mean of the two pixels before a place, less that of the two from it on."""
    w = Window.partitionBy("slide_id", "row").orderBy("col")
    i, o = F.sum("v").over(w.rowsBetween(-2, -1)), F.sum("v").over(w.rowsBetween(0, 1))
    return fx.rasters(spark, sf_dir).withColumn("contrast", F.round(i / 2 - o / 2, 6)).where("col BETWEEN 2 AND 6").select("slide_id", "row", "col", "contrast")


@query(f"""WITH {RASTER}, m AS (SELECT slide_id, "row", col, max(v) OVER (PARTITION BY slide_id, "row" ORDER BY col ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) v FROM raster) SELECT slide_id, "row", col, max(v) OVER (PARTITION BY slide_id, col ORDER BY "row" ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM m""")
def grey_dilation(spark, sf_dir):
    """The greatest value around each pixel."""
    near = {-1: 1.0, 0: 1.0, 1: 1.0}
    return stencil(stencil(fx.rasters(spark, sf_dir), "col", near, "max"), "row", near, "max").select("slide_id", "row", "col", "v")


@query(f"""WITH {RASTER} SELECT slide_id, "row" // 2 AS "row", col // 2 AS col, round(avg(v), 9) AS v FROM raster GROUP BY ALL""")
def area_halved(spark, sf_dir):
    """Half the size, each pixel the mean of what it covers."""
    half = lambda c: F.floor(F.col(c) / 2).cast("long")
    r = fx.rasters(spark, sf_dir).select("slide_id", half("row").alias("row"), half("col").alias("col"), "v")
    return r.groupBy("slide_id", "row", "col").agg(F.round(F.avg("v"), 9).alias("v"))


@query(f"""WITH {CANDIDATES}, c AS (SELECT slide_id, pos, confidence, area, max(confidence) OVER (PARTITION BY slide_id) best FROM cand), k AS (SELECT * FROM c WHERE confidence >= best - 0.1), r AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY area DESC, pos) n FROM k) SELECT slide_id, pos, area FROM r WHERE n = 1""")
def competitive_choice(spark, sf_dir):
    """Of what comes near the best, the largest."""
    best = F.max("confidence").over(Window.partitionBy("slide_id"))
    k = fx.candidates(spark, sf_dir).withColumn("best", best).where(F.col("confidence") >= F.col("best") - 0.1)
    return k.groupBy("slide_id").agg(F.max(F.struct("area", (-F.col("pos")).alias("p"))).alias("m")).select("slide_id", (-F.col("m.p")).alias("pos"), "m.area")


@query(f"""WITH {RASTER} SELECT slide_id, "row", col, round((least(255, greatest(0, floor(v * 255))) / 255 - 0.485) / 0.229, 6) AS v FROM raster""")
def normalized_tensor(spark, sf_dir):
    """Bytes to the scale that networks are trained with."""
    byte = F.least(F.lit(255), F.greatest(F.lit(0), F.floor(F.col("v") * 255)))
    return fx.rasters(spark, sf_dir).select("slide_id", "row", "col", F.round((byte / 255 - 0.485) / 0.229, 6).alias("v"))
