"""Run reports: summaries, levels, timings, progress, index documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def summary(results: DataFrame) -> DataFrame:
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    good = (F.count("*") > 0) & (count("failed") == 0)
    return results.agg(F.count("*").alias("slides"), count("success").alias("success"), count("failed").alias("failed"), count("skipped").alias("skipped"), F.coalesce(F.sum("patches"), F.lit(0)).alias("patches"), F.when(good, "success").otherwise("partial").alias("status"))


def slide_results(records: DataFrame, most_failures: int = 0) -> DataFrame:
    """A row a slide from the records of its patches; more failures than most_failures fail it."""
    g = records.groupBy("slide_id").agg(F.count(F.when(F.col("status").isin("success", "skipped"), 1)).alias("patches"), F.count(F.when(F.col("status") == "failed", 1)).alias("n_failed"), F.count(F.when(F.col("status") != "skipped", 1)).alias("n_done"), F.sum("elapsed").alias("elapsed"), F.min("error").alias("error"))
    return g.withColumn("status", F.when(F.col("n_failed") > most_failures, "failed").when(F.col("n_done") == 0, "skipped").otherwise("success"))


def with_level(results: DataFrame) -> DataFrame:
    """level of a slide's log line: error if it failed; warning if it was skipped for a reason, or its colours stay as they are."""
    warning = (F.col("status") == "skipped") & F.col("error").isNotNull()
    if "color_correction" in results.columns:
        warning = warning | F.coalesce(F.startswith("color_correction", F.lit("unavailable:")), F.lit(False))
    return results.withColumn("level", F.when(F.col("status") == "failed", "error").when(warning, "warning").otherwise("info"))


def timings(records: DataFrame) -> DataFrame:
    return records.groupBy("slide_id").agg(F.sum("elapsed").alias("seconds"), F.count("*").alias("patches")).withColumn("patches_per_second", F.col("patches") / F.greatest(F.col("seconds"), F.lit(1e-9)))


def ticks(rows: DataFrame, order: str, every: int = 100) -> DataFrame:
    """Rows 1, every, 2 * every ... of each slide, with their number."""
    n = rows.withColumn("n", F.row_number().over(Window.partitionBy("slide_id").orderBy(order)).cast("long"))
    return n.where((F.col("n") == 1) | (F.col("n") % every == 0))


def index_documents(rows: DataFrame) -> DataFrame:
    """slide_id, document: JSON of the kept outputs in order, numbered anew."""
    kept = rows.withColumn("i", (F.row_number().over(Window.partitionBy("slide_id").orderBy("index")) - 1).cast("int"))
    entry = F.struct(F.col("i").alias("index"), F.substring_index("output", "/", -1).alias("name"), F.substring_index("output", "/", 1).alias("shard"))
    g = kept.groupBy("slide_id").agg(F.count("*").cast("int").alias("patch_count"), F.sort_array(F.collect_list(entry)).alias("patches"))
    return g.select("slide_id", F.to_json(F.struct("patch_count", "patches")).alias("document"))


INDEX_SCHEMA = "patch_count int, patches array<struct<index: int, name: string, shard: string>>"


def index_complete(documents: DataFrame, files: DataFrame) -> DataFrame:
    """slide_id, complete: whether the document holds as many entries as it says and every file is there and not empty."""
    d = documents.select("slide_id", F.from_json("document", INDEX_SCHEMA).alias("d"))
    entries = d.select("slide_id", F.explode("d.patches").alias("p")).select("slide_id", F.concat_ws("/", "p.shard", "p.name").alias("output"))
    lost = entries.join(files.where("length > 0"), ["slide_id", "output"], "left_anti").groupBy("slide_id").agg(F.count("*").alias("lost"))
    return d.join(lost, "slide_id", "left").select("slide_id", F.coalesce((F.col("d.patch_count") == F.size("d.patches")) & F.col("lost").isNull(), F.lit(False)).alias("complete"))
