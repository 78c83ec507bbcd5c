"""Mixing sources to target weights by pivotal dependent rounding.

Every document has a fractional number of copies, its source's target over its source's size. The whole
part is taken; the fractional parts are settled in pairs: mass moves from one document of a pair to the other, at random
but fair, until one of the two is taken or left. The sum of words never changes, so a source ends within one
document of its target. Chunks settle alone, and what each leaves undecided meets in a tree of ever fewer chunks.

Defined cases: null or empty text has size 0 and is never taken; null source is a source, the last one; a repeated row
is a document of its own, and so is each text under one doc_id, null or not; an empty table gives an empty result; columns other
than doc_id, text and source are not read.
"""

from __future__ import annotations

import math

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_words, stored, table

CHUNK_ROWS = 20_000
FAN_IN = 16
MOST_COPIES = 3
#: Source tables up to so many rows are broadcast (about 60 bytes a row); larger ones are joined by shuffle.
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame, weights=(1, 2, 3), cap: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target: shares by weight, cut off at cap times the source's size, the excess reshared.

    One row a source goes through single-partition windows; rows of documents do not. In order of cap over weight the
    first source that stays below its cap fixes the level per weight for it and all after it.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(float(w)) for w in weights])
    src = src.withColumn("weight", F.element_at(ws, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    src = src.withColumn("cap", F.col("source_size") * float(cap)).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left_mass = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    src = src.withColumn("level", left_mass / left_weight)
    src = src.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(everything)["level"])
    return src.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _settle(seed: int, last: bool):
    """A pass over rows sorted by (chunk, src), long documents first: an open document per group takes in the next one.

    Short ones come last, so that what stays open is short. The last of a source goes to the nearer whole number.
    """

    def ended(row):
        if last:
            return (*row[:4], float(row[1]) if 2 * row[4] >= row[1] else 0.0, False)
        return (*row, True)

    def run(frames):
        key = None
        open_row = None
        for pdf in frames:
            ids, sizes, srcs, chunks, mass = (pdf[c].tolist() for c in ("doc_id", "size", "src", "chunk", "mass"))
            out = []

            for row in zip(ids, sizes, srcs, chunks, mass):
                if (row[3], row[2]) != key:
                    if open_row is not None:
                        out.append(ended(open_row))
                    key, open_row = (row[3], row[2]), None
                if open_row is None:
                    open_row = row
                    continue
                a, b = open_row, row
                up, down = min(a[1] - a[4], b[4]), min(a[4], b[1] - b[4])
                u = xxhash.xxh64_intdigest(f"{seed}:{a[0]}:{b[0]}:{a[3]}") / 2.0**64
                to_a = u * (up + down) < down
                move = up if to_a else -down
                pair = [(*a[:4], a[4] + move), (*b[:4], b[4] - move)]
                open_row = None
                for x in pair:
                    whole = x[4] <= 1e-9 * x[1] or x[4] >= x[1] * (1 - 1e-9)
                    if whole:
                        out.append((*x[:4], float(x[1]) if x[4] > 0.5 * x[1] else 0.0, False))
                    elif open_row is None:
                        open_row = x
                    else:  # rounding noise: both are within it of a whole number
                        out.append((*x[:4], float(x[1]) if x[4] > 0.5 * x[1] else 0.0, False))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "size", "src", "chunk", "mass", "pending"])
        if open_row is not None:
            out = [ended(open_row)]
            yield pd.DataFrame(out, columns=["doc_id", "size", "src", "chunk", "mass", "pending"])

    return run


def mix_plan(docs: DataFrame, weights=(1, 2, 3), cap: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """doc_id, t, size, source, source_size, target, copies: how often the mix takes each document; t is a hash of its text."""
    sizes = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("t")), "sizes")
    src = stored(source_targets(sizes, weights, cap).withColumn("src", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))), "sources")
    small = src.count() <= BROADCAST_SOURCES
    doc_source = sizes.join(F.broadcast(src) if small else src, sizes["source"].eqNullSafe(src["source"])).select(sizes["doc_id"], "t", sizes["size"], sizes["source"], "source_size", "target", "src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    doc_source = doc_source.withColumn("base", F.least(F.floor(rate + 1e-12), F.lit(cap)).cast("long")).withColumn("frac", F.greatest(rate - F.col("base"), F.lit(0.0)))
    chunks = max(1, math.ceil(sizes.count() / CHUNK_ROWS))
    # a row's identity, as text, goes through pandas without nulls and joins as a plain value
    doc_source = doc_source.withColumn("key", F.concat_ws(":", "doc_id", "t"))
    todo = doc_source.where((F.col("size") > 0) & (F.col("frac") > 1e-12)).select(
        F.col("key").alias("doc_id"), "size", "src", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(chunks)).cast("long").alias("chunk"), (F.col("size") * F.col("frac")).alias("mass")
    )
    schema = "doc_id string, size long, src long, chunk long, mass double, pending boolean"
    settled = None
    while True:
        dealt = todo.repartition(max(1, min(chunks, 4096)), "chunk").sortWithinPartitions("chunk", "src", F.col("size").desc(), F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "mass")
        step = stored(dealt.mapInPandas(_settle(seed, chunks == 1), schema), "settled")
        done = step.where(~F.col("pending")).select("doc_id", "size", "src", (F.col("mass") > 0).cast("long").alias("extra"))
        settled = done if settled is None else settled.unionByName(done)
        if chunks == 1:
            break
        chunks = math.ceil(chunks / FAN_IN)
        todo = step.where("pending").select("doc_id", "size", "src", F.floor(F.col("chunk") / FAN_IN).cast("long").alias("chunk"), "mass")
    # repeated rows are interchangeable: rank them on both sides
    rank = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("key", "size", "src").orderBy(F.lit(0))))
    extra = settled.withColumnRenamed("doc_id", "key").withColumn("rank", F.row_number().over(Window.partitionBy("key", "size", "src").orderBy(F.col("extra").desc())))
    out = rank(doc_source).join(extra, ["key", "size", "src", "rank"], "left")
    return out.select("doc_id", "t", "size", "source", "source_size", "target", (F.when(F.col("size") > 0, F.col("base") + F.coalesce("extra", F.lit(0))).otherwise(0)).cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as the plan takes it. Rows are told apart by doc_id, text and source; which
    of several equal rows is taken oftener is left open."""
    named = lambda df, row, t: df.withColumn("key", F.to_json(F.struct(f"{row}doc_id", f"{row}source", t.alias("t")))).withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("order")))
    plan = named(mix_plan(docs, **options).withColumn("order", -F.col("copies")), "", F.col("t"))
    plan = stored(plan.where("copies > 0").select("key", "rank", F.col("copies").cast("int").alias("copies")), "plan")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.lit(0).alias("order"))  # no name of docs meets one used here
    rows = named(rows, "row.", F.xxhash64("row.text")).join(plan, ["key", "rank"])
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")
