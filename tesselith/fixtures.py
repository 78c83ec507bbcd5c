"""Slide relations made by fixed arithmetic from the tables at hand: masks, slides, inputs, records, rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 64
#: Failed patches beyond which a slide of records() counts as failed.
MOST_FAILURES = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mask_cells(spark: SparkSession, sf_dir: str, share: float = 1.0) -> DataFrame:
    """slide_id, row, col: the cells that are on. A cell is on if it holds more than its share of its slide's rows, or than so much of it."""
    li = table(spark, sf_dir, "lineitem")
    cells = li.groupBy(F.col("l_linenumber").cast("long").alias("slide_id"), (F.col("l_orderkey") % SIDE).alias("row"), (F.col("l_partkey") % SIDE).alias("col")).agg(F.count("*").alias("n"))
    totals = cells.groupBy("slide_id").agg(F.sum("n").alias("total"))
    return cells.join(totals, "slide_id").where(F.col("n") * SIDE * SIDE * 10 > F.col("total") * round(10 * share)).select("slide_id", "row", "col")


def mask_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, width, height of the slides that have a mask."""
    ids = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("long").alias("slide_id")).distinct()
    return ids.withColumn("width", 6400 + 100 * F.col("slide_id")).withColumn("height", 6400 + 37 * F.col("slide_id"))


def slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, width, height, downsamples, mpp (null for some)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(k.alias("slide_id"), (2000 + 100 * F.col("p_size")).cast("long").alias("width"), (1500 + 37 * (k % 50)).cast("long").alias("height"), F.array(F.lit(1.0), F.lit(4.0), F.lit(16.0)).alias("downsamples"), F.when(k % 7 != 0, 0.25 * (1 + k % 3)).alias("mpp"))


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ordinal, path, slide_id, content: ids collide, contents partly agree."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("ordinal"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.concat("lang", F.lit("-"), (F.length("text") % 997).cast("string")).alias("slide_id"), F.col("text").alias("content"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, index, status, elapsed, error."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    status = F.when(t == "error", "failed").when(t == "signup", "skipped").when(t == "purchase", "filtered").otherwise("success")
    return e.select(F.col("user_id").alias("slide_id"), F.col("event_id").alias("index"), status.alias("status"), F.col("value").alias("elapsed"), F.when(t == "error", F.col("props")).alias("error"))


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, row, col, v: each vector as an 8 x 8 raster."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("slide_id"), F.posexplode("embedding").alias("p", "x")).select("slide_id", F.floor(F.col("p") / 8).cast("long").alias("row"), (F.col("p") % 8).cast("long").alias("col"), F.col("x").cast("double").alias("v"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide_id, name, pos, status, confidence, area, overlap, reference_area: what heuristics decided, five for each slide."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    names = F.array(*[F.lit(x) for x in ("single_circle", "density", "smear", "double_circle", "qmh_center_circle")])
    return o.select(
        F.floor(k / 5).cast("long").alias("slide_id"), F.element_at(names, (k % 5 + 1).cast("int")).alias("name"), (k % 5).alias("pos"),
        F.when(F.col("o_orderstatus") == "F", "rejected").otherwise("accepted").alias("status"),
        ((k * 37) % 100 / 100.0).alias("confidence"), (100 + (k * 13) % 900).alias("area"), (80 + (k * 7) % 200).alias("overlap"),
    )
