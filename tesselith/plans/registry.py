"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import coverage, decisions, inputs, planning, report

SIDE, PATCH, STRIDE, LEAST = fx.SIDE, 600, 300, 0.10
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# fixture relations, in SQL
CELLS = f"""c0 AS (SELECT CAST(l_linenumber AS BIGINT) slide_id, l_orderkey % {SIDE} "row", l_partkey % {SIDE} col, count(*) n FROM lineitem GROUP BY ALL),
c1 AS (SELECT *, sum(n) OVER (PARTITION BY slide_id) total FROM c0),
cells AS (SELECT slide_id, "row", col FROM c1 WHERE n * {SIDE * SIDE} > total),
slides AS (SELECT DISTINCT CAST(l_linenumber AS BIGINT) slide_id, 6400 + 100 * CAST(l_linenumber AS BIGINT) width, 6400 + 37 * CAST(l_linenumber AS BIGINT) height FROM lineitem)"""


def plans_sql(PATCH: int) -> str:
    return f"""{CELLS},
ys AS (SELECT *, unnest(range(0, height - {PATCH} + 1, {STRIDE})) y0 FROM slides),
grid AS (SELECT *, unnest(range(0, width - {PATCH} + 1, {STRIDE})) x0 FROM ys),
boxes AS (SELECT *, floor(x0 * {SIDE} / width) l, least({SIDE}, ceil((x0 + {PATCH}) * {SIDE} / width)) r, floor(y0 * {SIDE} / height) t, least({SIDE}, ceil((y0 + {PATCH}) * {SIDE} / height)) b FROM grid),
counted AS (SELECT g.slide_id, x0, y0, width, height, count(c.col) total, CAST(any_value((r - l) * (b - t)) AS BIGINT) area FROM boxes g LEFT JOIN cells c ON c.slide_id = g.slide_id AND c.col >= l AND c.col < r AND c."row" >= t AND c."row" < b GROUP BY ALL),
kept AS (SELECT slide_id, CAST(x0 AS BIGINT) x0, CAST(y0 AS BIGINT) y0, CAST(total AS DOUBLE) / area coverage FROM counted WHERE CAST(total AS DOUBLE) / area >= {LEAST}),
plans AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY y0, x0) - 1 AS "index" FROM kept)"""


PLANS = plans_sql(PATCH)
PART = """slides AS (SELECT p_partkey slide_id, CAST(2000 + 100 * p_size AS BIGINT) width, CAST(1500 + 37 * (p_partkey % 50) AS BIGINT) height, CASE WHEN p_partkey % 7 <> 0 THEN 0.25::DOUBLE * (1 + p_partkey % 3) END mpp FROM part)"""
INPUTS = """inputs AS (SELECT doc_id ordinal, source || '/' || doc_id path, lang || '-' || (length(text) % 997) slide_id, text content FROM documents)"""
RECORDS = """records AS (SELECT user_id slide_id, event_id "index", CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' WHEN 'purchase' THEN 'filtered' ELSE 'success' END status, value elapsed, CASE WHEN event_type = 'error' THEN props END error FROM events)"""
CANDIDATES = """cand AS (SELECT CAST(floor(o_orderkey / 5.0) AS BIGINT) slide_id, CASE o_orderkey % 5 WHEN 0 THEN 'single_circle' WHEN 1 THEN 'density' WHEN 2 THEN 'smear' WHEN 3 THEN 'double_circle' ELSE 'qmh_center_circle' END "name", o_orderkey % 5 pos, CASE WHEN o_orderstatus = 'F' THEN 'rejected' ELSE 'accepted' END status, ((o_orderkey * 37) % 100) / 100.0::DOUBLE confidence, 100 + (o_orderkey * 13) % 900 area, 80 + (o_orderkey * 7) % 200 overlap FROM orders)"""
RASTER = """raster AS (SELECT vec_id slide_id, CAST((i - 1) // 8 AS BIGINT) "row", CAST((i - 1) % 8 AS BIGINT) col, CAST(embedding[i] AS DOUBLE) v FROM embeddings, range(1, 65) t(i))"""


def region_plans(spark: SparkSession, sf_dir: str, patch: int = PATCH) -> DataFrame:
    """All places of the grid with total, area and coverage of their boxes, and whether the mask is on under their middle."""
    slides = fx.mask_slides(spark, sf_dir)
    return coverage.places(slides.join(coverage.integral(fx.mask_cells(spark, sf_dir), slides, SIDE), "slide_id"), SIDE, patch, STRIDE)


def fraction_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.numbered(region_plans(spark, sf_dir).where(F.col("coverage") >= LEAST).select("slide_id", "x0", "y0", "coverage"))


@query(f'WITH {PLANS} SELECT slide_id, "index", x0, y0, coverage FROM plans')
def patch_plan_coverage(spark, sf_dir):
    return fraction_plans(spark, sf_dir).select("slide_id", "index", "x0", "y0", "coverage")


@query(f"WITH {plans_sql(50)} SELECT slide_id, CAST(x0 AS BIGINT) x0, CAST(y0 AS BIGINT) y0 FROM counted WHERE total = area")
def inclusion_full(spark, sf_dir):
    return region_plans(spark, sf_dir, 50).where("total = area").select("slide_id", "x0", "y0")


@query(f"""WITH {PLANS} SELECT g.slide_id, CAST(x0 AS BIGINT) x0, CAST(y0 AS BIGINT) y0 FROM grid g JOIN cells c ON c.slide_id = g.slide_id AND c.col = CAST(floor((x0 + {PATCH} / 2.0) * {SIDE} / width) AS BIGINT) AND c."row" = CAST(floor((y0 + {PATCH} / 2.0) * {SIDE} / height) AS BIGINT)""")
def inclusion_center(spark, sf_dir):
    return region_plans(spark, sf_dir).where("center_on").select("slide_id", "x0", "y0")


@query(f"""WITH {PART}, x AS (SELECT *, unnest([1.0::DOUBLE, 4.0::DOUBLE, 16.0::DOUBLE]) downsample FROM slides) SELECT slide_id, downsample, CASE WHEN mpp IS NULL THEN 600 ELSE CAST(greatest(1, round_even(512 * (0.5 / (mpp * downsample)), 0)) AS BIGINT) END read_size, CASE WHEN mpp IS NULL THEN 300 ELSE CAST(greatest(1, round_even(300 * (0.5 / (mpp * downsample)), 0)) AS BIGINT) END stride, 0.5::DOUBLE output_mpp, mpp * downsample * 600 / 512 AS native_mpp FROM x""")
def effective_patching(spark, sf_dir):
    s = fx.slides(spark, sf_dir).withColumn("downsample", F.explode("downsamples"))
    mpp, d = F.col("mpp"), F.col("downsample")
    return s.select("slide_id", "downsample", planning.scaled(512, 0.5, mpp, d, 600).alias("read_size"), planning.scaled(300, 0.5, mpp, d, 300).alias("stride"), planning.output_mpp(0.5, mpp, d, 600, 512).alias("output_mpp"), planning.output_mpp(None, mpp, d, 600, 512).alias("native_mpp"))


@query(f"""WITH {PART}, l AS (SELECT *, CAST(floor(width / 4) AS BIGINT) lw, CAST(floor(height / 4) AS BIGINT) lh FROM slides), ys AS (SELECT *, unnest(range(0, lh - 400 + 1, 150)) ly FROM l WHERE lw >= 400 AND lh >= 400), xs AS (SELECT *, unnest(range(0, lw - 400 + 1, 150)) lx FROM ys) SELECT slide_id, lx, ly, CAST(round_even(lx * 4.1::DOUBLE, 0) AS BIGINT) x0, CAST(round_even(ly * 4.1::DOUBLE, 0) AS BIGINT) y0 FROM xs""")
def grid_coordinates(spark, sf_dir):
    s = fx.slides(spark, sf_dir).withColumn("lw", F.floor(F.col("width") / 4)).withColumn("lh", F.floor(F.col("height") / 4))
    return planning.grid(s, "lw", "lh", 400, 150, 4.1).select("slide_id", "lx", "ly", "x0", "y0")


@query(f"WITH {PART}, n AS (SELECT slide_id, mpp * 600 / 512 m FROM slides) SELECT slide_id, CASE WHEN m > 0 THEN 'x' || slide_id || '_y' || slide_id || '_mpp' || format('{{:.12g}}', m) || '_px512' END AS name FROM n")
def patch_naming(spark, sf_dir):
    n = fx.slides(spark, sf_dir).withColumn("m", planning.output_mpp(None, F.col("mpp"), F.lit(1.0), 600, 512))
    return n.select("slide_id", planning.patch_name("slide_id", "slide_id", "m", 512).alias("name"))


@query(f'WITH {PLANS} SELECT slide_id, "index", x0, y0 FROM plans WHERE "index" < 25')
def sample_all(spark, sf_dir):
    return planning.sample_first(fraction_plans(spark, sf_dir), 25).select("slide_id", "index", "x0", "y0")


@query(f"""WITH {PLANS}, n AS (SELECT *, count(*) OVER (PARTITION BY slide_id) n FROM plans), k AS (SELECT slide_id, n, i, CASE WHEN n <= 25 THEN i WHEN i = 24 THEN n - 1 ELSE CAST(floor(i * (CAST(n - 1 AS DOUBLE) / 24)) AS BIGINT) END p FROM (SELECT DISTINCT slide_id, n FROM n), range(0, 25) t(i)), s AS (SELECT n.* FROM n JOIN (SELECT DISTINCT slide_id, p FROM k) k ON k.slide_id = n.slide_id AND k.p = n."index") SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY y0, x0) - 1 AS "index", x0, y0 FROM s""")
def sample_uniform(spark, sf_dir):
    return planning.sample_uniform(fraction_plans(spark, sf_dir), 25).select("slide_id", "index", "x0", "y0")


@query()
def sample_random(spark, sf_dir):
    return planning.sample_random(fraction_plans(spark, sf_dir), 25, 0).select("slide_id", "index", "x0", "y0")


@query()
def preview_permutation(spark, sf_dir):
    """The first eight plans of each slide in NumPy's random order."""

    @F.pandas_udf("array<long>")
    def order(n: pd.Series) -> pd.Series:
        return n.map(lambda k: planning.preview_sample(k, 8, 3))

    n = fraction_plans(spark, sf_dir).groupBy("slide_id").agg(F.count("*").alias("n"))
    return n.select("slide_id", F.posexplode(order("n")).alias("place", "index"))


@query("WITH s AS (SELECT source, doc_id, sha256('0:' || doc_id) score FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score, doc_id) rank FROM s) SELECT source, doc_id, score, rank FROM r WHERE rank <= 5")
def bottom_k_hash(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2(F.concat(F.lit("0:"), F.col("doc_id").cast("string")), 256).alias("score"))
    return d.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("score", "doc_id")).cast("long")).where("rank <= 5")


@query()
def bottom_k_blake2b(spark, sf_dir):
    @F.pandas_udf("string")
    def score(x: pd.Series) -> pd.Series:
        return x.map(lambda v: hashlib.blake2b(f"0:{v}".encode(), digest_size=8).hexdigest())

    d = fx.table(spark, sf_dir, "documents").select("source", "doc_id").withColumn("score", score(F.col("doc_id").cast("string")))
    return d.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("score", "doc_id")).cast("long")).where("rank <= 5")


@query(f"""WITH {INPUTS}, f AS (SELECT *, first_value(ordinal) OVER w first_ordinal, first_value(sha256(content)) OVER w first_sum FROM inputs WINDOW w AS (PARTITION BY slide_id ORDER BY ordinal)) SELECT ordinal, path, slide_id, CASE WHEN ordinal = first_ordinal THEN 'keep' WHEN sha256(content) = first_sum THEN 'skip' ELSE 'conflict' END AS action FROM f""")
def input_dedup(spark, sf_dir):
    return inputs.deduplicated(fx.inputs(spark, sf_dir)).select("ordinal", "path", "slide_id", "action")


@query(f"""WITH {INPUTS} SELECT slide_id, count(*) AS inputs, count(DISTINCT sha256(content)) AS contents FROM inputs GROUP BY slide_id HAVING count(DISTINCT sha256(content)) > 1""")
def input_conflicts(spark, sf_dir):
    g = fx.inputs(spark, sf_dir).groupBy("slide_id").agg(F.count("*").alias("inputs"), F.countDistinct(F.sha2("content", 256)).alias("contents"))
    return g.where("contents > 1")


FILES = """files AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN ' "' || url || '.SVS" ' WHEN 1 THEN url || '.txt' ELSE '/data/' || page_id || '.ndpi' END path FROM pages)"""


def page_files(spark, sf_dir):
    k, url = F.col("page_id"), F.col("url")
    path = F.when(k % 3 == 0, F.concat(F.lit(' "'), url, F.lit('.SVS" '))).when(k % 3 == 1, F.concat(url, F.lit(".txt"))).otherwise(F.concat(F.lit("/data/"), k.cast("string"), F.lit(".ndpi")))
    return fx.table(spark, sf_dir, "pages").select("page_id", path.alias("path"))


@query(f"""WITH {FILES}, u AS (SELECT page_id, regexp_replace(trim(path), '^(["''])(.*)(["''])$', '\\2') p FROM files), a AS (SELECT page_id, CASE WHEN starts_with(p, '/') THEN p ELSE '/in/' || p END path, lower(regexp_extract(p, '\\.([^./]+)$', 1)) extension FROM u) SELECT * FROM a WHERE extension IN {inputs.EXTENSIONS}""")
def extension_filter(spark, sf_dir):
    p = inputs.unquoted(F.col("path"))
    f = page_files(spark, sf_dir).select("page_id", inputs.absolute(p, "/in").alias("path"), inputs.extension(p).alias("extension"))
    return f.where(F.col("extension").isin(*inputs.EXTENSIONS))


@query("""WITH f AS (SELECT conv_id directory, CASE (conv_id + turn) % 4 WHEN 0 THEN '4_' || turn || '.dcm' WHEN 1 THEN turn || '.dcm' WHEN 2 THEN turn || '.txt' ELSE '4_x' || turn END "name" FROM conversations), r AS (SELECT *, CASE WHEN "name" = '4_1.dcm' THEN 0 WHEN starts_with("name", '4_') THEN 1 WHEN ends_with("name", '.dcm') THEN 2 END rank FROM f) SELECT directory, arg_min("name", struct_pack(rank := rank, n := "name")) FILTER (WHERE rank IS NOT NULL) AS entry FROM r GROUP BY directory""")
def dicom_entrypoint(spark, sf_dir):
    k = (F.col("conv_id") + F.col("turn")) % 4
    t = F.col("turn").cast("string")
    name = F.when(k == 0, F.concat(F.lit("4_"), t, F.lit(".dcm"))).when(k == 1, F.concat(t, F.lit(".dcm"))).when(k == 2, F.concat(t, F.lit(".txt"))).otherwise(F.concat(F.lit("4_x"), t))
    return inputs.dicom_entry(fx.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("directory"), name.alias("name")))


@query("""WITH s AS (SELECT p_partkey slide_id, CASE p_partkey % 5 WHEN 0 THEN CAST(0.25 * p_size AS VARCHAR) || ', ' || CAST(0.5 * p_size AS VARCHAR) WHEN 1 THEN 'n/a;' || p_size WHEN 2 THEN '-1' WHEN 3 THEN 'unknown' ELSE p_size || '\\' || p_size END t FROM part), n AS (SELECT slide_id, list_filter(list_transform(regexp_split_to_array(t, '[,;\\\\\\s]+'), lambda x: TRY_CAST(x AS DOUBLE)), lambda x: x > 0) v FROM s) SELECT slide_id, list_avg(v) AS mpp FROM n""")
def mpp_normalise(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    t = F.when(k % 5 == 0, F.concat((F.lit(0.25) * size).cast("string"), F.lit(", "), (F.lit(0.5) * size).cast("string"))).when(k % 5 == 1, F.concat(F.lit("n/a;"), size.cast("string"))).when(k % 5 == 2, F.lit("-1")).when(k % 5 == 3, F.lit("unknown")).otherwise(F.concat(size.cast("string"), F.lit("\\"), size.cast("string")))
    return fx.table(spark, sf_dir, "part").select(k.alias("slide_id"), inputs.mean_mpp(t).alias("mpp"))


@query("SELECT o_orderkey AS slide_id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def resume_pending(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slide_id"), "o_custkey")
    done = fx.table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("slide_id"))
    return inputs.pending(o, done)


@query("WITH p AS (SELECT DISTINCT l_orderkey slide_id, 'p' || l_linenumber \"name\" FROM lineitem), d AS (SELECT DISTINCT l_orderkey slide_id, 'p' || l_linenumber \"name\" FROM lineitem WHERE l_quantity > 40) SELECT p.slide_id, p.\"name\", CASE WHEN d.slide_id IS NULL THEN 'pending' ELSE 'skipped' END AS status FROM p LEFT JOIN d ON d.slide_id = p.slide_id AND d.\"name\" = p.\"name\"")
def resume_skipped(spark, sf_dir):
    named = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("slide_id"), F.concat(F.lit("p"), F.col("l_linenumber").cast("string")).alias("name"), "l_quantity")
    return inputs.resumed(named.select("slide_id", "name").distinct(), named.where("l_quantity > 40").select("slide_id", "name").distinct()).select("slide_id", "name", "status")


SHARDED = f"""{PLANS}, s AS (SELECT slide_id, "index", CAST("index" // 40 + 1 AS BIGINT) shard, slide_id || '_' || lpad(CAST("index" // 40 + 1 AS VARCHAR), 4, '0') || '.tar' file, 'x' || x0 || '_y' || y0 || '.png' "name" FROM plans)"""


def sharded(spark, sf_dir):
    p = planning.shards(fraction_plans(spark, sf_dir), 40)
    return p.withColumn("name", F.concat(F.lit("x"), F.col("x0").cast("string"), F.lit("_y"), F.col("y0").cast("string"), F.lit(".png")))


@query(f'WITH {SHARDED} SELECT slide_id, "index", shard, file FROM s')
def shard_assignment(spark, sf_dir):
    return sharded(spark, sf_dir).select("slide_id", "index", "shard", "file")


@query(f"""WITH {SHARDED} SELECT slide_id, '{{"patch_count":' || count(*) || ',"patches":[' || string_agg('{{"index":' || "index" || ',"name":"' || "name" || '","shard":"' || file || '"}}', ',' ORDER BY "index") || ']}}' AS document FROM s GROUP BY slide_id""")
def index_document(spark, sf_dir):
    return report.index_documents(sharded(spark, sf_dir).withColumn("output", F.concat_ws("/", "file", "name")))


@query(f"""WITH {SHARDED} SELECT slide_id, bool_and(slide_id % 3 <> 0 OR "index" <> 7) AS complete FROM s GROUP BY slide_id""")
def index_integrity(spark, sf_dir):
    s = sharded(spark, sf_dir).withColumn("output", F.concat_ws("/", "file", "name"))
    files = s.select("slide_id", "output", F.when((F.col("slide_id") % 3 == 0) & (F.col("index") == 7), 0).otherwise(100).alias("length"))
    return report.index_complete(report.index_documents(s), files)


@query(f"""WITH {CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY pos) rn FROM cand WHERE status = 'accepted' AND area > 0) SELECT slide_id, "name", pos, confidence FROM r WHERE rn = 1""")
def first_success(spark, sf_dir):
    return decisions.first_success(fx.candidates(spark, sf_dir)).select("slide_id", "name", "pos", "confidence")


@query(f"""WITH {CANDIDATES}, a AS (SELECT * FROM cand WHERE status = 'accepted' AND area > 0), d AS (SELECT slide_id, min(pos) dpos, arg_min(area, pos) darea FROM a WHERE "name" = 'density' GROUP BY slide_id), j AS (SELECT a.*, dpos, darea, CASE WHEN dpos IS NULL THEN 2 WHEN pos = dpos THEN 1 WHEN confidence >= 0.65 AND CAST(overlap AS DOUBLE) / darea >= 0.9 AND CAST(area AS DOUBLE) / darea <= 3.5 THEN 0 END tier FROM a LEFT JOIN d USING (slide_id)), r AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY tier, CASE WHEN tier = 0 THEN -confidence ELSE 0 END, pos) rn FROM j WHERE tier IS NOT NULL) SELECT slide_id, "name", pos, confidence FROM r WHERE rn = 1""")
def arbitrate(spark, sf_dir):
    return decisions.arbitrate(fx.candidates(spark, sf_dir)).select("slide_id", "name", "pos", "confidence")


@query(f"""WITH {CANDIDATES} SELECT slide_id, pos, confidence, CASE WHEN status = 'accepted' AND confidence < CASE "name" WHEN 'smear' THEN 0.5 WHEN 'density' THEN 0.3 ELSE 0 END THEN 'rejected' ELSE status END AS status FROM cand""")
def confidence_gate(spark, sf_dir):
    return decisions.gate(fx.candidates(spark, sf_dir), {"smear": 0.5, "density": 0.3}).select("slide_id", "pos", "confidence", "status")


@query("""WITH x AS (SELECT doc_id, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) SELECT doc_id, CASE WHEN NOT n_chars >= 500 THEN 'length' WHEN NOT coalesce(quality = 1, FALSE) THEN 'quality' WHEN NOT coalesce(toxic = 0, FALSE) THEN 'toxic' END AS reason, n_chars >= 500 AND coalesce(quality = 1, FALSE) AND coalesce(toxic = 0, FALSE) AS kept FROM x""")
def filter_chain(spark, sf_dir):
    x = fx.table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(fx.table(spark, sf_dir, "labels"), "doc_id", "left")
    return decisions.filter_chain(x, [("length", F.col("n_chars") >= 500), ("quality", F.col("quality") == 1), ("toxic", F.col("toxic") == 0)]).select("doc_id", "reason", "kept")


DENSE = f"""c2 AS (SELECT *, sum(n) OVER (PARTITION BY slide_id) total FROM c0), dense AS (SELECT slide_id, "row", col FROM c2 WHERE n * {SIDE * SIDE} * 10 > total * 7)"""


@query(f"""WITH {CELLS}, {DENSE}, r AS (SELECT slide_id, count(*) reference_area FROM dense GROUP BY slide_id), a AS (SELECT slide_id, count(*) area FROM cells GROUP BY slide_id), o AS (SELECT slide_id, count(*) overlap FROM cells JOIN dense USING (slide_id, "row", col) GROUP BY slide_id) SELECT slide_id, area, reference_area, coalesce(overlap, 0) AS overlap, round(coalesce(overlap, 0) / reference_area::DOUBLE, 9) AS recall FROM a JOIN r USING (slide_id) LEFT JOIN o USING (slide_id)""")
def mask_overlap(spark, sf_dir):
    """Pixels that a slide's candidate region shares with its density region, by one pass over both."""
    both = fx.mask_cells(spark, sf_dir).withColumn("c", F.lit(1)).withColumn("d", F.lit(0)).union(fx.mask_cells(spark, sf_dir, 0.7).withColumn("c", F.lit(0)).withColumn("d", F.lit(1)))
    pixel = both.groupBy("slide_id", "row", "col").agg(F.max("c").alias("c"), F.max("d").alias("d"))
    g = pixel.groupBy("slide_id").agg(F.sum("c").alias("area"), F.sum("d").alias("reference_area"), F.sum(F.col("c") * F.col("d")).alias("overlap"))
    return g.withColumn("recall", F.round(F.col("overlap") / F.col("reference_area"), 9))


CIRCLES = """circles AS (SELECT s_nationkey slide_id, s_suppkey i, s_suppkey * 37 % 1000 x, s_suppkey * 91 % 300 y, 40 + s_suppkey % 60 r FROM supplier), top AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY r DESC, i) rn FROM circles), four AS (SELECT * FROM top WHERE rn <= 4)"""


def circles(spark, sf_dir):
    k = F.col("s_suppkey")
    return fx.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("slide_id"), k.alias("i"), (k * 37 % 1000).alias("x"), (k * 91 % 300).alias("y"), (40 + k % 60).alias("r"))


@query(f"""WITH {CIRCLES}, p AS (SELECT a.slide_id, a.i a, b.i b, abs(a.x - b.x) dx, least(a.r, b.r) * 1.0::DOUBLE / greatest(a.r, b.r) ratio, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / ((a.r + b.r) / 2.0::DOUBLE) apart, abs(a.y - b.y) / 300.0::DOUBLE tilt, row_number() OVER (PARTITION BY a.slide_id ORDER BY abs(a.x - b.x) DESC, a.i, b.i) n FROM four a JOIN four b ON a.slide_id = b.slide_id AND a.i < b.i) SELECT slide_id, a, b, dx, round(ratio, 9) AS ratio, round(apart, 9) AS apart, ratio >= 0.55 AND apart >= 2.3 AND tilt <= 0.22 AS accepted FROM p WHERE n = 1""")
def circle_pairs(spark, sf_dir):
    """Of the four largest circles of a slide the pair that is farthest apart sideways, and whether radii, distance and heights fit."""
    four = circles(spark, sf_dir).groupBy("slide_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("r")).alias("k"), "i", "x", "y", "r"))), 1, 4).alias("c"))
    pairs = F.flatten(F.transform("c", lambda p: F.transform(F.filter("c", lambda q: p["i"] < q["i"]), lambda q: F.struct((-F.abs(p["x"] - q["x"])).alias("k"), p["i"].alias("a"), q["i"].alias("b"), p.alias("p"), q.alias("q")))))
    m = four.select("slide_id", F.get(F.array_sort(pairs), F.lit(0)).alias("m")).where("m is not null").select("slide_id", "m.*")
    d = lambda k: F.col(f"p.{k}") - F.col(f"q.{k}")
    apart = F.sqrt(d("x") * d("x") + d("y") * d("y")) / ((F.col("p.r") + F.col("q.r")) / 2)
    ratio = F.least("p.r", "q.r") / F.greatest("p.r", "q.r")
    return m.select("slide_id", "a", "b", (-F.col("k")).alias("dx"), F.round(ratio, 9).alias("ratio"), F.round(apart, 9).alias("apart"), ((ratio >= 0.55) & (apart >= 2.3) & (F.abs(d("y")) / 300.0 <= 0.22)).alias("accepted"))


@query(f"""WITH {CIRCLES}, c AS (SELECT c_nationkey slide_id, c_custkey k, c_custkey % 1000 cx, c_custkey * 7 % 300 cy, 40 + c_custkey % 60 cr FROM customer), d AS (SELECT c.slide_id, k, cr, t.i, t.r, sqrt((t.x - cx) * (t.x - cx) + (t.y - cy) * (t.y - cy)) distance FROM c JOIN circles t ON c.slide_id = t.slide_id AND (t.x < 500) = (cx < 500)), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY distance, i) n FROM d WHERE distance <= 0.28 * 300) SELECT k AS content, slide_id, i AS nearest, round(distance, 6) AS distance, greatest(r, cr) AS radius FROM n WHERE n = 1""")
def nearest_candidate(spark, sf_dir):
    """The candidate next to each content circle, on its side and within 0.28 of the shorter side; the larger radius counts."""
    k = F.col("c_custkey")
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("slide_id"), k.alias("content"), (k % 1000).alias("cx"), (k * 7 % 300).alias("cy"), (40 + k % 60).alias("cr"))
    near = circles(spark, sf_dir).join(c, "slide_id").where((F.col("x") < 500) == (F.col("cx") < 500))
    distance = F.sqrt((F.col("x") - F.col("cx")) * (F.col("x") - F.col("cx")) + (F.col("y") - F.col("cy")) * (F.col("y") - F.col("cy")))
    near = near.withColumn("distance", distance).where(F.col("distance") <= 0.28 * 300)
    m = near.groupBy("content").agg(F.min(F.struct("distance", "i", "slide_id", F.greatest("r", "cr").alias("radius"))).alias("m"))
    return m.select("content", "m.slide_id", F.col("m.i").alias("nearest"), F.round("m.distance", 6).alias("distance"), "m.radius")


TILE = 'CASE WHEN {0} < 6 THEN {0} // 2 ELSE {0} - 3 END'


@query(f"""WITH {RASTER}, t AS (SELECT slide_id, {TILE.format('"row"')} tr, {TILE.format('col')} tc, avg(CASE WHEN v > 0.05 THEN 1.0::DOUBLE ELSE 0 END) f FROM raster GROUP BY ALL) SELECT slide_id, min(f) AS min_stain FROM t GROUP BY slide_id""")
def tile_min_stain(spark, sf_dir):
    """The least share of stain in 5 x 5 tiles; where 8 is not 5 equal parts, the first ones are longer by one."""
    part = lambda c: F.when(F.col(c) < 6, F.floor(F.col(c) / 2)).otherwise(F.col(c) - 3)
    t = fx.rasters(spark, sf_dir).groupBy("slide_id", part("row").alias("tr"), part("col").alias("tc")).agg(F.avg(F.when(F.col("v") > 0.05, 1.0).otherwise(0.0)).alias("f"))
    return t.groupBy("slide_id").agg(F.min("f").alias("min_stain"))


@query(f"""WITH {RASTER}, z AS (SELECT *, ("row" - 3.5) * ("row" - 3.5) + (col - 3.5) * (col - 3.5) d FROM raster) SELECT slide_id, round(avg(v) FILTER (WHERE d <= 6.5), 9) AS inner_mean, round(stddev_pop(v) FILTER (WHERE d <= 6.5), 9) AS inner_std, round(avg(v) FILTER (WHERE d > 6.5), 9) AS outer_mean FROM z GROUP BY slide_id""")
def zone_stats(spark, sf_dir):
    d = F.pow(F.col("row") - 3.5, 2) + F.pow(F.col("col") - 3.5, 2)
    z = fx.rasters(spark, sf_dir).withColumn("i", F.when(d <= 6.5, F.col("v"))).withColumn("o", F.when(d > 6.5, F.col("v")))
    return z.groupBy("slide_id").agg(F.round(F.avg("i"), 9).alias("inner_mean"), F.round(F.stddev_pop("i"), 9).alias("inner_std"), F.round(F.avg("o"), 9).alias("outer_mean"))


@query(f"""WITH {RASTER}, p AS (SELECT slide_id, quantile_cont(v, 0.02) lo, quantile_cont(v, 0.98) hi FROM raster GROUP BY slide_id) SELECT slide_id, "row", col, round(greatest(0, least(1, (v - lo) / greatest(1e-6, hi - lo))), 6) AS u FROM raster JOIN p USING (slide_id)""")
def percentile_norm(spark, sf_dir):
    r = fx.rasters(spark, sf_dir)
    p = r.groupBy("slide_id").agg(F.expr("percentile(v, 0.02)").alias("lo"), F.expr("percentile(v, 0.98)").alias("hi"))
    u = (F.col("v") - F.col("lo")) / F.greatest(F.lit(1e-6), F.col("hi") - F.col("lo"))
    return r.join(p, "slide_id").select("slide_id", "row", "col", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), u)), 6).alias("u"))


def _mirror(i: str) -> str:
    return f"(CASE WHEN {i} < 0 THEN -({i}) WHEN {i} > 7 THEN 14 - ({i}) ELSE {i} END)"


BLUR = f"""{RASTER}, k AS (SELECT * FROM (VALUES (-1, 0.25::DOUBLE), (0, 0.5::DOUBLE), (1, 0.25::DOUBLE)) t(d, w)), h AS (SELECT a.slide_id, a."row", a.col, sum(b.v * w) v FROM raster a CROSS JOIN k JOIN raster b ON b.slide_id = a.slide_id AND b."row" = a."row" AND b.col = {_mirror('(a.col + d)')} GROUP BY ALL), blurred AS (SELECT a.slide_id, a."row", a.col, sum(b.v * w) v FROM h a CROSS JOIN k JOIN h b ON b.slide_id = a.slide_id AND b.col = a.col AND b."row" = {_mirror('(a."row" + d)')} GROUP BY ALL)"""


def stencil(r: DataFrame, axis: str, weights: dict[int, float], how="sum") -> DataFrame:
    """Each pixel sends its value, weighted, to the pixels that read it, mirrored at the edges: one grouped sum, no join."""
    other = "col" if axis == "row" else "row"
    sends = []
    for d, w in weights.items():
        for at in range(8):
            src = at + d
            sends.append((-src if src < 0 else 14 - src if src > 7 else src, at, w))
    table_ = F.array(*[F.struct(F.lit(s).cast("long").alias("s"), F.lit(a).cast("long").alias("a"), F.lit(float(w)).alias("w")) for s, a, w in sends])
    x = r.withColumn("k", F.explode(F.filter(table_, lambda t: t["s"] == F.col(axis)))).select("slide_id", F.col("k.a").alias(axis), other, (F.col("v") * F.col("k.w")).alias("v"))
    return x.groupBy("slide_id", "row", "col").agg(getattr(F, how)("v").alias("v"))


def blurred(spark, sf_dir):
    return stencil(stencil(fx.rasters(spark, sf_dir), "col", {-1: 0.25, 0: 0.5, 1: 0.25}), "row", {-1: 0.25, 0: 0.5, 1: 0.25})


@query(f'WITH {BLUR} SELECT slide_id, "row", col, round(v, 6) AS v FROM blurred')
def gaussian_blur_8x8(spark, sf_dir):
    return blurred(spark, sf_dir).select("slide_id", "row", "col", F.round("v", 6).alias("v"))


@query(f"""WITH {BLUR}, k2 AS (SELECT * FROM (VALUES (-1, -1, 2.0::DOUBLE), (-1, 1, 2), (1, -1, 2), (1, 1, 2), (0, 0, -8)) t(dr, dc, w)), l AS (SELECT a.slide_id, a."row", a.col, sum(b.v * w) v FROM blurred a CROSS JOIN k2 JOIN blurred b ON b.slide_id = a.slide_id AND b."row" = {_mirror('(a."row" + dr)')} AND b.col = {_mirror('(a.col + dc)')} GROUP BY ALL) SELECT slide_id, round(stddev_pop(v), 6) AS laplacian_std FROM l GROUP BY slide_id""")
def laplacian_std(spark, sf_dir):
    """Deviation of the 3 x 3 Laplacian, mirrored at the edges: its corners are a product of two stencils."""
    b, ends = blurred(spark, sf_dir), {-1: 1.0, 1: 1.0}
    corners = stencil(stencil(b, "col", ends), "row", ends).withColumn("v", 2 * F.col("v"))
    l = corners.unionByName(b.withColumn("v", -8 * F.col("v"))).groupBy("slide_id", "row", "col").agg(F.sum("v").alias("v"))  # noqa: E741
    return l.groupBy("slide_id").agg(F.round(F.stddev_pop("v"), 6).alias("laplacian_std"))


@query(f"""WITH {RASTER}, d AS (SELECT a.slide_id, a."row", a.col, max(b.v) v FROM raster a JOIN raster b ON a.slide_id = b.slide_id AND abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 GROUP BY ALL) SELECT a.slide_id, a."row", a.col, min(b.v) AS v FROM d a JOIN d b ON a.slide_id = b.slide_id AND abs(a."row" - b."row") <= 1 AND abs(a.col - b.col) <= 1 GROUP BY ALL""")
def morph_close_8x8(spark, sf_dir):
    r, near = fx.rasters(spark, sf_dir), {-1: 1.0, 0: 1.0, 1: 1.0}
    for how in ("max", "min"):
        r = stencil(stencil(r, "col", near, how), "row", near, how)
    return r.select("slide_id", "row", "col", "v")


@query("""SELECT vec_id AS slide_id, round(1 / (1 + exp(list_sum(embedding[1:32]::DOUBLE[]) - list_sum(embedding[33:64]::DOUBLE[]))), 6) AS score, 1 / (1 + exp(list_sum(embedding[1:32]::DOUBLE[]) - list_sum(embedding[33:64]::DOUBLE[]))) >= 0.14677508175373077 AS kept FROM embeddings""")
def qc_decision(spark, sf_dir):
    half = lambda a, n: F.aggregate(F.slice("embedding", a, n), F.lit(0.0), lambda s, x: s + x.cast("double"))
    p = decisions.softmax_of_two(half(1, 32), half(33, 32))
    return fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("slide_id"), F.round(p, 6).alias("score"), (p >= 0.14677508175373077).alias("kept"))


@query("""WITH n AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 i, value FROM events) SELECT event_type, CAST(i // 128 AS BIGINT) AS batch, count(*) AS patches, round(sum(value), 4) AS seconds FROM n GROUP BY ALL""")
def qc_microbatch(spark, sf_dir):
    """Batches of 128 in order of time. Rows are ranked within a day; days are offset by the sums of those before, a small table."""
    e = fx.table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value", F.to_date("ts").alias("day"))
    days = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    i = F.row_number().over(Window.partitionBy("event_type", "day").orderBy("ts", "event_id")) - 1
    n = e.withColumn("i", i).join(days.select("event_type", "day", before.alias("before")), ["event_type", "day"])
    n = n.select("event_type", F.floor((F.col("before") + F.col("i")) / 128).cast("long").alias("batch"), "value")
    return n.groupBy("event_type", "batch").agg(F.count("*").alias("patches"), F.round(F.sum("value"), 4).alias("seconds"))


RESULTS = f"""{RECORDS}, g AS (SELECT slide_id, count(*) FILTER (WHERE status IN ('success', 'skipped')) patches, count(*) FILTER (WHERE status = 'failed') n_failed, count(*) FILTER (WHERE status <> 'skipped') n_done, sum(elapsed) elapsed, min(error) error FROM records GROUP BY slide_id), results AS (SELECT *, CASE WHEN n_failed > 40 THEN 'failed' WHEN n_done = 0 THEN 'skipped' ELSE 'success' END status FROM g)"""


@query(f"""WITH {RESULTS} SELECT count(*) AS slides, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped, CAST(coalesce(sum(patches), 0) AS BIGINT) AS patches, CASE WHEN count(*) > 0 AND count(*) FILTER (WHERE status = 'failed') = 0 THEN 'success' ELSE 'partial' END AS status FROM results""")
def run_summary(spark, sf_dir):
    return report.summary(report.slide_results(fx.records(spark, sf_dir), fx.MOST_FAILURES))


@query(f"""WITH {RESULTS} SELECT slide_id, patches, status, CASE WHEN status = 'failed' THEN 'error' WHEN status = 'skipped' AND error IS NOT NULL THEN 'warning' ELSE 'info' END AS level FROM results""")
def slide_log_level(spark, sf_dir):
    return report.with_level(report.slide_results(fx.records(spark, sf_dir), fx.MOST_FAILURES)).select("slide_id", "patches", "status", "level")


@query(f"""WITH {RECORDS} SELECT slide_id, round(sum(elapsed), 4) AS seconds, count(*) AS patches, round(count(*) / greatest(sum(elapsed), 1e-9), 6) AS patches_per_second FROM records GROUP BY slide_id""")
def stage_timings(spark, sf_dir):
    return report.timings(fx.records(spark, sf_dir)).select("slide_id", F.round("seconds", 4).alias("seconds"), "patches", F.round("patches_per_second", 6).alias("patches_per_second"))


@query(f"""WITH {RECORDS}, n AS (SELECT slide_id, "index", row_number() OVER (PARTITION BY slide_id ORDER BY "index") n FROM records) SELECT slide_id, "index", n FROM n WHERE n = 1 OR n % 100 = 0""")
def progress_ticks(spark, sf_dir):
    return report.ticks(fx.records(spark, sf_dir), "index").select("slide_id", "index", "n")


@query("""WITH c AS (SELECT p_brand run, '{"level":' || p_partkey % 2 || ',"patch_size":' || 16 * p_size || ',"type":"' || p_type || '"}' settings FROM part) SELECT run, count(*) AS starts, min(sha256(settings)) AS signature, min(settings) <> max(settings) AS conflict FROM c GROUP BY run""")
def config_signature(spark, sf_dir):
    """Signatures of the settings that runs were started with; a run with several settings is a conflict."""
    p = fx.table(spark, sf_dir, "part")
    settings = F.to_json(F.struct((F.col("p_partkey") % 2).alias("level"), (16 * F.col("p_size")).alias("patch_size"), F.col("p_type").alias("type")))
    c = p.select(F.col("p_brand").alias("run"), F.sha2(settings, 256).alias("s"))
    return c.groupBy("run").agg(F.count("*").alias("starts"), F.min("s").alias("signature"), (F.min("s") != F.max("s")).alias("conflict"))


@query("""WITH d AS (SELECT s_suppkey i, 's' || s_suppkey uuid, CAST(s_acctbal * 1000 AS BIGINT) free FROM supplier), t AS (SELECT unnest(['s1', '7', 's2', '3']) token) SELECT i, uuid, free FROM d WHERE EXISTS (SELECT 1 FROM t WHERE token = CAST(i AS VARCHAR) OR starts_with(uuid, token)) AND free >= 1000 ORDER BY free DESC, i DESC LIMIT 1""")
def device_pick(spark, sf_dir):
    d = fx.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("i"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("uuid"), (F.col("s_acctbal") * 1000).cast("long").alias("free"))
    seen = F.exists(F.array(*map(F.lit, ("s1", "7", "s2", "3"))), lambda t: (t == F.col("i").cast("string")) | F.startswith(F.col("uuid"), t))
    return d.where(seen & (F.col("free") >= 1000)).orderBy(F.col("free").desc(), F.col("i").desc()).limit(1)


from . import more  # noqa: E402, F401  registers its queries
