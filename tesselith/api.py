"""From slides to patches: inputs, regions, plans, filters and sinks, as one chain of DataFrames.

    images = resolve.resolved(spark, "list.txt")
    result = extract(spark, images, load_config("run.yaml"))

Each step is narrow over slides, or over chunks of a slide's plans; what is shuffled is plans, records and, for
shards, patches that passed. A step's rows are written once to the run's state, and all later steps read them there: no slide
is read, segmented or cut twice. What goes wrong with a slide is a row with its error, not the end of the run.
"""

from __future__ import annotations

import errno
import os
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config, load_config
from .operators import decisions, planning
from .operators.resolve import resolved as parse_inputs
from .operators.runs import Run, RunResult, run_id
from .sources import readers, sinks

__all__ = ["Config", "RunResult", "center_preview", "extract", "load_config", "parse_inputs", "run_preview"]

#: Plans of one task: a slide with many is cut by several.
CHUNK = 512
#: Pixels up to which a slide with one level is previewed.
PREVIEW_PIXELS = 16_000_000
SLIDE = ["ordinal", "slide_id", "source", "entrypoint", "sidecars"]
STATE = "slide_id string, patch_count long, done map<string, string>, shard long"
LEVELS = "level_widths array<long>, level_heights array<long>, downsamples array<double>"
SEGMENT = f"slide_id string, width long, height long, {LEVELS}, mpp double, reader string, color_correction string, seconds double, skip string, error string, name string, pos int, status string, confidence double, reason string, area long, overlap long, side_w int, side_h int, mask binary"
PLANNED = "slide_id string, n long, error string, chunk long, plans array<struct<index: long, x: long, y: long, coverage: double>>, level int, read_size int, output_mpp double"
RECORD = "slide_id string, index long, x long, y long, level int, size int, name string, output string, status string, error string, read_s double, filter_s double, encode_s double, data binary"


def _names(schema: str) -> list[str]:
    out, depth, word = [], 0, ""
    for c in schema + ",":
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(word.split()[0])
            word = ""
        else:
            word += c
    return out


def fatal(e: BaseException) -> bool:
    """What no other slide would survive either: memory, files or disk have run out."""
    return isinstance(e, MemoryError) or (isinstance(e, OSError) and e.errno in (errno.ENFILE, errno.EMFILE, errno.ENOMEM, errno.ENOSPC))


def states(slides: DataFrame, config: Config, previews_only: bool = False) -> DataFrame:
    """What earlier runs left of each slide: patch_count if it is complete, else the outputs that are there, and the last shard."""
    o = config.output

    def run(frames):
        for pdf in frames:
            out = []
            for slide in pdf["slide_id"]:
                folder, count, done, shard = os.path.join(o.root, slide), None, {}, 0
                if previews_only:
                    count = 0 if not o.overwrite and all(map(sinks.there, sinks.preview_paths(o.root, slide))) else None
                elif not o.overwrite:
                    count = sinks.complete_count(folder, o.mode)
                    count = count if count is not None and sinks.previews_complete(o, slide, count) else None
                    done = sinks.completed(folder, o.mode) if count is None else {}
                    shard = sinks.shard_number(folder) if o.mode == "tar" else 0
                out.append((slide, count, done, shard))
            yield pd.DataFrame(out, columns=_names(STATE)).astype({"patch_count": "Int64"})

    return slides.select("slide_id").mapInPandas(run, STATE)


def thumbnail_of(reader, config: Config) -> np.ndarray:
    w, h = reader.metadata.dimensions
    return reader.thumbnail(config.reader.thumbnail_width, max(1, round(config.reader.thumbnail_width * h / w)))


def skip_reason(metadata) -> str | None:
    w, h = metadata.dimensions
    if len(metadata.level_dimensions) == 1 and w * h > PREVIEW_PIXELS:
        return f"preview left out: one level of {w * h:,} pixels ({w}x{h}), the limit is {PREVIEW_PIXELS:,}"
    return None


def segment(slides: DataFrame, config: Config, previews: bool = False) -> DataFrame:
    """A row for each slide and heuristic of the pipe, with its mask over the thumbnail; one row with an error or a skip otherwise."""
    from .functions import regions

    def one(source, entrypoint, sidecars):
        began = time.perf_counter()
        with readers.opened(source, entrypoint, sidecars, config.reader) as r:
            m = r.metadata
            head = (*m.dimensions, [w for w, _ in m.level_dimensions], [h for _, h in m.level_dimensions], list(m.level_downsamples), m.mpp, m.reader, m.properties.get("color_correction"))
            if previews and (why := skip_reason(m)):
                return [(*head, time.perf_counter() - began, why, None, *[None] * 10)]
            thumb = thumbnail_of(r, config)
        found = [regions.run(n, thumb, config.heuristics.get(n)) for n in config.heuristic_pipe]
        ref = next((d.mask for d in found if d.name == "density" and d.status == "accepted"), None)
        out = []
        for pos, d in enumerate(found):
            area = int(d.mask.sum()) if d.mask is not None else 0
            both = int((d.mask & ref).sum()) if d.mask is not None and ref is not None else 0
            out.append((*head, time.perf_counter() - began, None, None, d.name, pos, d.status, d.confidence, d.reason, area, both, thumb.shape[1], thumb.shape[0], np.packbits(d.mask).tobytes() if d.mask is not None else None))
        return out

    def run(frames):
        for pdf in frames:
            for slide, *where in zip(pdf["slide_id"], pdf["source"], pdf["entrypoint"], pdf["sidecars"]):
                try:
                    rows = one(*where)
                except Exception as e:
                    if fatal(e):
                        raise
                    rows = [(*[None] * 8, 0.0, None, f"{type(e).__name__}: {e}", *[None] * 10)]
                yield pd.DataFrame([(slide, *r) for r in rows], columns=_names(SEGMENT)).astype({c: "Int64" for c in ("width", "height", "pos", "area", "overlap", "side_w", "side_h")})

    return slides.select("slide_id", "source", "entrypoint", "sidecars").mapInPandas(run, SEGMENT)


def chosen(found: DataFrame, config: Config) -> DataFrame:
    """The region of each slide that has one."""
    gated = decisions.gate(found, {k: v["min_confidence"] for k, v in config.heuristics.items() if "min_confidence" in v})
    if config.heuristic_strategy == "first":
        return decisions.first_success(gated)
    return decisions.arbitrate(gated, **decisions.thresholds(config.heuristic_arbitration, config.heuristics))


def plan(regions_: DataFrame, config: Config) -> DataFrame:
    """Plans of each slide in chunks: the mask stays in its slide's row, and only places that it admits leave it."""
    p = config.patching

    def run(frames):
        for pdf in frames:
            for r in pdf.itertuples():
                mpp = None if pd.isna(r.mpp) else r.mpp
                try:
                    levels = list(zip(r.level_widths, r.level_heights))
                    mask = np.unpackbits(np.frombuffer(r.mask, np.uint8), count=int(r.side_h * r.side_w)).reshape(int(r.side_h), int(r.side_w)).astype(bool)
                    e = planning.effective(p, mpp, planning.downsample(levels, r.downsamples, p.level))
                    x, y, coverage = planning.slide_plans(mask, (int(r.width), int(r.height)), levels, r.downsamples, e)
                    if not len(x):
                        raise RuntimeError("the region admits no patch")
                    out_mpp = planning.known_mpp(p, mpp, r.downsamples[p.level])
                    rows = [(r.slide_id, len(x), None, i // CHUNK, [{"index": k, "x": int(x[k]), "y": int(y[k]), "coverage": float(coverage[k])} for k in range(i, min(i + CHUNK, len(x)))], p.level, e.patch_size, out_mpp) for i in range(0, len(x), CHUNK)]
                except Exception as e:
                    rows = [(r.slide_id, 0, f"{type(e).__name__}: {e}", 0, [], p.level, 0, None)]
                yield pd.DataFrame(rows, columns=_names(PLANNED))

    return regions_.mapInPandas(run, PLANNED)


def cut(slides: DataFrame, plans: DataFrame, done: DataFrame, config: Config) -> DataFrame:
    """A record for each plan: read, filtered, encoded and, in file modes, published; what is there already is skipped."""
    p, o = config.patching, config.output

    def run(frames):
        from .functions import filters, raster

        sink = sinks.sink(o)
        for pdf in frames:
            for r in pdf.itertuples():
                there, todo, out = dict(r.done) if r.done is not None else {}, [], []
                stem = lambda t: f"x{t['x']}_y{t['y']}_mpp{format(r.output_mpp, '.12g')}_px{p.output_size}"
                for t in r.plans:
                    name = stem(t) + sink.extension
                    if name in there:
                        out.append((r.slide_id, t["index"], t["x"], t["y"], r.level, p.output_size, name, f"{r.slide_id}/{there[name]}", "skipped", None, 0.0, 0.0, 0.0, None))
                    else:
                        todo.append((t, name))
                with readers.opened(r.source, r.entrypoint, r.sidecars, config.reader) as reader:
                    for i in range(0, len(todo), config.batch_patches):
                        out += batch(reader, r, todo[i : i + config.batch_patches], sink, filters, raster)
                        yield pd.DataFrame(out, columns=_names(RECORD))
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=_names(RECORD))

    def batch(reader, r, todo, sink, filters, raster):
        row = lambda t, name, output, status, error, times=(0.0, 0.0, 0.0), data=None: (r.slide_id, t["index"], t["x"], t["y"], r.level, p.output_size, name, output, status, error, *times, data)
        out, images, left = [], [], []
        for t, name in todo:
            began = time.perf_counter()
            try:
                image = reader.read_region(t["x"], t["y"], r.level, r.read_size, r.read_size)
                images.append(image if image.shape[:2] == (p.output_size, p.output_size) else raster.resized(image, p.output_size, p.output_size))
                left.append((t, name, time.perf_counter() - began))
            except Exception as e:
                if fatal(e):
                    raise
                out.append(row(t, name, "", "failed", f"read {t['x']},{t['y']}: {type(e).__name__}: {e}"))
        began = time.perf_counter()
        try:
            verdicts = filters.run_many(images, config.post_filter_pipe, config.post_filters)
        except Exception as e:
            if fatal(e):
                raise
            return out + [row(t, name, "", "failed", f"{type(e).__name__}: {e}", (s, 0.0, 0.0)) for t, name, s in left]
        share = (time.perf_counter() - began) / max(1, len(images))
        for (t, name, read), image, v in zip(left, images, verdicts):
            if not v.keep:
                out.append(row(t, name, "", "filtered", v.reason, (read, share, 0.0)))
                continue
            began = time.perf_counter()
            try:
                data = sink.encode(image)
                output = sink.publish(r.slide_id, name, data)
                out.append(row(t, name, f"{r.slide_id}/{output}" if output else "", "success", None, (read, share, time.perf_counter() - began), data if sink.keeps else None))
            except Exception as e:
                if fatal(e):
                    raise
                out.append(row(t, name, "", "failed", f"write {t['x']},{t['y']}: {type(e).__name__}: {e}", (read, share, time.perf_counter() - began)))
        return out

    todo = plans.where("error is null and output_mpp > 0").join(slides.select("slide_id", "source", "entrypoint", "sidecars"), "slide_id").join(done, "slide_id", "left")
    return todo.repartition("slide_id", "chunk").select("slide_id", "source", "entrypoint", "sidecars", "plans", "level", "read_size", "output_mpp", "done").mapInPandas(run, RECORD)


def write_shards(records: DataFrame, states_: DataFrame, config: Config) -> DataFrame:
    """Writes the patches to shards that follow those of earlier runs; the records with their place in them."""
    from .sources.tar_shards import TarShards

    spark = records.sparkSession
    spark.dataSource.register(TarShards)
    fresh = records.where("status = 'success'").join(states_.select("slide_id", F.col("shard").alias("last")), "slide_id")
    placed = planning.shards(fresh, config.output.shard_max_count, existing=F.col("last"))
    rows = placed.repartition("slide_id", "shard").sortWithinPartitions("slide_id", "shard", "index")
    rows.select(F.concat_ws("/", "slide_id", "file").alias("shard"), "name", "data").write.format("tar_shards").option("path", config.output.root).option("mode", str(config.output.permissions)).mode("overwrite" if config.output.overwrite else "append").save()
    named = placed.select("slide_id", "index", F.concat_ws("/", "slide_id", "file", "name").alias("place"))
    return records.drop("data").join(named, ["slide_id", "index"], "left").withColumn("output", F.coalesce("place", "output")).drop("place")


def finish_slides(slides: DataFrame, regions_: DataFrame, outputs: DataFrame, config: Config, index: bool) -> DataFrame:
    """Index, samples and previews of each slide that has come through; slide_id and what went wrong."""
    o = config.output

    def run(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples():
                try:
                    if index:
                        folder = os.path.join(o.root, r.slide_id)
                        sinks.write_index(folder, [x["output"].split("/", 1)[1] for x in r.kept], o.mode == "tar")
                        if o.mode == "tar" and o.tar_preview:
                            sinks.write_samples(folder, o.tar_preview_n, o.tar_preview_seed)
                    with readers.opened(r.source, r.entrypoint, r.sidecars, config.reader) as reader:
                        thumb = thumbnail_of(reader, config)
                    mask = np.unpackbits(np.frombuffer(r.mask, np.uint8), count=int(r.side_h * r.side_w)).reshape(int(r.side_h), int(r.side_w)).astype(bool)
                    drawn = sinks.overlay(thumb, mask, [(x["x"], x["y"], r.read_size) for x in r.kept], (int(r.width), int(r.height)))
                    sinks.write_previews(o, r.slide_id, thumb, drawn)
                    out.append((r.slide_id, None))
                except Exception as e:
                    if fatal(e):
                        raise
                    out.append((r.slide_id, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["slide_id", "finish_error"])

    rows = slides.select("slide_id", "source", "entrypoint", "sidecars").join(regions_.select("slide_id", "width", "height", "side_w", "side_h", "mask"), "slide_id").join(outputs, "slide_id")
    return rows.mapInPandas(run, "slide_id string, finish_error string")


def results_of(slides: DataFrame, states_: DataFrame, found: DataFrame, regions_: DataFrame, plans: DataFrame, counted: DataFrame, finished: DataFrame) -> DataFrame:
    """A row a slide, in input order: its status, patches, reader, heuristic, seconds and error."""
    head = found.groupBy("slide_id").agg(F.first("reader").alias("reader"), F.first("color_correction").alias("color_correction"), F.max("seconds").alias("segment_s"), F.first("error").alias("read_error"), F.first("skip").alias("skip"))
    planned = plans.groupBy("slide_id").agg(F.first("n").alias("n"), F.first("error").alias("plan_error"), F.first("output_mpp").alias("output_mpp"))
    x = slides.select("ordinal", "slide_id").join(states_.select("slide_id", "patch_count"), "slide_id", "left")
    for part in (head, regions_.select("slide_id", F.col("name").alias("heuristic")), planned, counted, finished):
        x = x.join(part, "slide_id", "left")
    short = F.coalesce("n_failed", F.lit(0)) > 0
    lost = F.coalesce("patches", F.lit(0)) + F.coalesce("filtered", F.lit(0)) != F.col("n")
    error = F.coalesce(
        "read_error", F.when(F.col("heuristic").isNull(), "RuntimeError: no heuristic found a region"), "plan_error",
        F.when(~F.coalesce(F.col("output_mpp") > 0, F.lit(False)), "ValueError: names need a resolution above zero"),
        F.when(short | lost, F.concat(F.lit("RuntimeError: "), F.col("n_failed").cast("string"), F.lit(" patches failed; first: "), F.coalesce("first_error", F.lit("-")))), "finish_error",
    )
    status = F.when(F.col("patch_count").isNotNull() | F.col("skip").isNotNull(), "skipped").when(error.isNotNull(), "failed").otherwise("success")
    elapsed = F.coalesce("segment_s", F.lit(0.0)) + F.coalesce("read_s", F.lit(0.0)) + F.coalesce("filter_s", F.lit(0.0)) + F.coalesce("encode_s", F.lit(0.0))
    x = x.withColumn("error", F.when(F.col("patch_count").isNull(), F.coalesce("skip", error))).withColumn("status", status).withColumn("elapsed", elapsed)
    patches = F.when(F.col("status") == "failed", 0).otherwise(F.coalesce("patch_count", "patches", F.lit(0))).cast("long")
    x = x.withColumn("patches", patches).withColumn("patches_per_second", F.col("patches") / F.greatest(F.col("elapsed"), F.lit(1e-9)))
    return x.select("ordinal", "slide_id", "status", "patches", "reader", "heuristic", "color_correction", "elapsed", "error", "segment_s", "read_s", "filter_s", "encode_s", "filtered", "patches_per_second")


def counts(records: DataFrame) -> DataFrame:
    is_ = lambda *s: F.col("status").isin(*s)
    sums = [F.sum(c).alias(c) for c in ("read_s", "filter_s", "encode_s")]
    return records.groupBy("slide_id").agg(F.count_if(is_("success", "skipped")).alias("patches"), F.count_if(is_("filtered")).alias("filtered"), F.count_if(is_("failed")).alias("n_failed"), F.min_by("error", F.when(is_("failed"), F.col("index"))).alias("first_error"), *sums)


def _kept(records: DataFrame, plans: DataFrame) -> DataFrame:
    """slide_id, read_size, kept: outputs of each slide in the order of its plans, of slides without a failure."""
    kept = records.groupBy("slide_id").agg(F.sort_array(F.collect_list(F.when(F.col("status").isin("success", "skipped"), F.struct("index", "output", "x", "y")))).alias("kept"), F.count_if(F.col("status") == "failed").alias("bad"))
    return kept.where("bad = 0").drop("bad").join(plans.groupBy("slide_id").agg(F.first("read_size").alias("read_size")), "slide_id")


def extract(spark: SparkSession, slides: DataFrame, config: Config, run: str | None = None) -> RunResult:
    """All patches of all slides, resumed from what is there; the manifest, failures and log are under logging.root."""
    job = Run(spark, run or run_id("extract"), config)
    try:
        slides = job.stored(slides.select(*SLIDE), "slides")
        left = job.stored(states(slides, config), "states")
        todo = slides.join(left.where("patch_count is null").select("slide_id"), "slide_id", "left_semi")
        found = job.stored(segment(todo, config), "segments")
        regions_ = job.stored(chosen(found.where("error is null"), config), "regions")
        plans = job.stored(plan(regions_, config), "plans")
        records = job.stored(cut(todo, plans, left.select("slide_id", "done"), config), "patches")
        if config.output.mode == "tar":
            records = job.stored(write_shards(records, left, config), "records")
        job.write_manifest(records)
        done = spark.createDataFrame([], "slide_id string, finish_error string")
        if config.output.mode != "none":
            done = job.stored(finish_slides(todo, regions_, _kept(records, plans), config, True), "finished")
        sinks.set_modes(config.output.root, config.output.permissions)
        if config.output.mode != "none":
            sinks.set_modes(os.path.join(os.path.dirname(config.output.root.rstrip("/")), "preview"), config.output.permissions)
        return job.finish(results_of(slides, left, found, regions_, plans, counts(records), done), config.output.root)
    except BaseException:
        job.abort("the run has stopped")
        raise


def _judged(spark: SparkSession, job: Run, slides: DataFrame, config: Config):
    """Segments, regions, plans and records of all plans that the filters keep; nothing is published."""
    from dataclasses import replace

    found = job.stored(segment(slides, config, previews=True), "segments")
    regions_ = job.stored(chosen(found.where("error is null and skip is null"), config), "regions")
    plans = job.stored(plan(regions_, config), "plans")
    none = spark.createDataFrame([], "slide_id string, done map<string, string>")
    dry = replace(config, output=replace(config.output, mode="none"))
    if config.post_filter_pipe:
        records = job.stored(cut(slides, plans.withColumn("output_mpp", F.coalesce("output_mpp", F.lit(1.0))), none, dry), "records")
    else:  # no patch has to be read
        t = plans.where("error is null").select("slide_id", "level", F.explode("plans").alias("t")).select("slide_id", "t.index", "t.x", "t.y", "level")
        full = [F.lit(None).cast(k).alias(c) if c not in t.columns else F.col(c) for c, k in ((f.name, f.dataType) for f in spark.createDataFrame([], RECORD).schema)]
        records = t.select(*full).withColumn("status", F.lit("success")).withColumn("output", F.lit(""))
    return found, regions_, plans.withColumn("output_mpp", F.coalesce("output_mpp", F.lit(1.0))), records


def center_preview(spark: SparkSession, slides: DataFrame, config: Config, run: str | None = None) -> RunResult:
    """Thumbnail and overlay of each slide that lacks them, beside the output root."""
    job = Run(spark, run or run_id("center_preview"), config)
    try:
        slides = job.stored(slides.select(*SLIDE), "slides")
        left = job.stored(states(slides, config, previews_only=True), "states")
        todo = slides.join(left.where("patch_count is null").select("slide_id"), "slide_id", "left_semi")
        found, regions_, plans, records = _judged(spark, job, todo, config)
        done = job.stored(finish_slides(todo, regions_, _kept(records, plans), config, False), "finished")
        top = os.path.join(os.path.dirname(config.output.root.rstrip("/")), "preview")
        sinks.set_modes(top, config.output.permissions)
        return job.finish(results_of(slides, left, found, regions_, plans, counts(records), done), top)
    except BaseException:
        job.abort("the run has stopped")
        raise


def run_preview(spark: SparkSession, slides: DataFrame, config: Config, run: str | None = None) -> RunResult:
    """For each slide contour.jpg with the region and all plans, and n_patches sample patches chosen at random."""
    from .sources import jpeg

    name = run or run_id("preview")
    job, top, p = Run(spark, name, config), os.path.join(config.preview.root, name), config.patching

    def draw(frames):
        from .functions import raster

        for pdf in frames:
            out = []
            for r in pdf.itertuples():
                try:
                    folder = os.path.join(top, r.slide_id)
                    with readers.opened(r.source, r.entrypoint, r.sidecars, config.reader) as reader:
                        thumb = thumbnail_of(reader, config)
                        mask = np.unpackbits(np.frombuffer(r.mask, np.uint8), count=int(r.side_h * r.side_w)).reshape(int(r.side_h), int(r.side_w)).astype(bool)
                        drawn = sinks.overlay(thumb, mask, [(x["x"], x["y"], r.read_size) for x in r.kept], (int(r.width), int(r.height)))
                        sinks.published(os.path.join(folder, "contour.jpg"), jpeg.encoded(drawn, sinks.QUALITY))
                        for n, k in enumerate(planning.preview_sample(len(r.kept), config.preview.n_patches, config.preview.seed)):
                            x, y = r.kept[k]["x"], r.kept[k]["y"]
                            patch = raster.resized(reader.read_region(x, y, p.level, r.read_size, r.read_size), p.output_size, p.output_size)
                            sinks.published(os.path.join(folder, "patches", f"sample_{n:02d}_x{x}_y{y}_l{p.level}.jpg"), jpeg.encoded(patch, sinks.QUALITY))
                    out.append((r.slide_id, None))
                except Exception as e:
                    if fatal(e):
                        raise
                    out.append((r.slide_id, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["slide_id", "finish_error"])

    try:
        slides = job.stored(slides.select(*SLIDE), "slides")
        found, regions_, plans, records = _judged(spark, job, slides, config)
        rows = slides.select("slide_id", "source", "entrypoint", "sidecars").join(regions_.select("slide_id", "width", "height", "side_w", "side_h", "mask"), "slide_id").join(_kept(records, plans), "slide_id")
        done = job.stored(rows.mapInPandas(draw, "slide_id string, finish_error string"), "finished")
        sinks.set_modes(top, config.output.permissions)
        none = spark.createDataFrame([], "slide_id string, patch_count long")
        return job.finish(results_of(slides, none, found, regions_, plans, counts(records), done), top)
    except BaseException:
        job.abort("the run has stopped")
        raise
