"""I-Match document fingerprints, with DataFrame functions alone.

Terms are the lower-cased words of a text. The lexicon holds the terms whose document frequency lies in a band, that
is, whose inverse document frequency is neither small nor large. SLOTS random subsets of the lexicon, dense and sparse,
each give a hash of the distinct terms that a text has in them, the same for any order; the hashes in a row are the fingerprint. Likeness
is the share of equal slots among those that are not empty in both.

Lexicon size: with P pairs of document and term there are at most P / T terms of frequency T or more; T is at least
P / MOST_TERMS, so MOST_TERMS rows (of 24 bytes) bound what is broadcast at any input size.

Defined cases: null text is the empty text; a text without a term of the lexicon is fingerprinted by its lower-cased self; equal
texts have equal fingerprints; a null doc_id sorts first; repeated rows stay rows, ordered by doc_id, then text; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Share of the documents that hold a term of the lexicon.
BAND = (0.001, 0.1)
MOST_TERMS = 500_000
#: (number of slots, a term is in such a slot with probability 1 / this)
RATES = ((4, 4), (8, 16), (12, 32), (12, 64), (12, 128), (10, 512), (6, 2048))
SLOTS = sum(n for n, _ in RATES)
EMPTY = "0000"
BUCKET_ROWS = 1000
SPACE = "[\\x20\\x09-\\x0D]+"


def terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), SPACE))


def lexicon(docs: DataFrame, band=BAND, most_terms: int = MOST_TERMS) -> DataFrame:
    """h, idx, mask: the terms in the band, by hash, and the slots that each is in. The empty term is in none."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select(F.explode(terms(text)).alias("t")).where("t != ''").groupBy(F.xxhash64("t").alias("h")).agg(F.count("*").alias("df"))
    df = stored(df.where("df >= 2"), "df")
    n, pairs = docs.count(), df.agg(F.sum("df")).first()[0] or 0
    least = max(2.0, band[0] * n, pairs / most_terms)
    mask, slot = F.lit(0).cast("long"), 0
    for count, rate in RATES:
        for _ in range(count):
            bit = F.shiftleft(F.lit(1).cast("long"), slot)
            mask = mask.bitwiseOR(F.when(F.pmod(F.xxhash64("h", F.lit(slot)), F.lit(rate)) == 0, bit).otherwise(F.lit(0).cast("long")))
            slot += 1
    lex = df.where((F.col("df") >= least) & (F.col("df") <= max(2.0, band[1] * n))).select("h", mask.alias("mask"))
    return lex.union(docs.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("h"), F.lit(0).cast("long").alias("mask")))


def _bit(slot: int) -> Column:
    return F.col("mask").bitwiseAND(F.lit((1 << slot) - (1 << 64) * (slot == 63))) != 0


def slot_hashes() -> list[Column]:
    """Aggregates over the distinct terms (h, mask) of a text: a hash for each slot, 0 where it has none of them.

    Terms are hashed with the slot's number and combined by exclusive or, which is the same for every order of distinct
    terms: what sorting them is for is kept, and the 64 subsets take one generated pass instead of 64.
    """
    none = F.lit(0).cast("long")
    slots = [F.bit_xor(F.when(_bit(k), F.xxhash64("h", F.lit(k))).otherwise(none)).alias(f"s{k}") for k in range(SLOTS)]
    return [F.bit_xor(F.xxhash64("h", F.lit(SLOTS))).alias("whole"), F.count("*").alias("n"), *slots]


def fingerprint() -> Column:
    """From slot_hashes() and own, the hash of the whole text, which stands in where no term is in the lexicon."""
    slots = [F.when(F.col(f"s{k}") == 0, EMPTY).otherwise(F.lpad(F.substring(F.hex(f"s{k}"), -4, 4), 4, "f")) for k in range(SLOTS)]
    return F.concat(F.lpad(F.hex(F.when(F.col("n") > 1, F.col("whole")).otherwise(F.col("own"))), 16, "0"), *slots)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those that are not empty in both; the whole-lexicon hash counts as a slot."""
    at = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    pick = lambda x, i: F.substr(x, i * 4 + 17, F.lit(4))
    used = F.size(F.filter(at, lambda i: (pick(a, i) != EMPTY) | (pick(b, i) != EMPTY))) + 1
    same = F.size(F.filter(at, lambda i: (pick(a, i) == pick(b, i)) & (pick(a, i) != EMPTY))) + F.when(F.substring(a, 1, 16) == F.substring(b, 1, 16), 1).otherwise(0)
    return F.when(a == b, 1.0).otherwise(same / used).cast("double")


def _ranges(docs: DataFrame) -> Column:
    """A bucket number that rises with k, about BUCKET_ROWS rows each: 64 quantiles, each cut into equal parts."""
    n, bounds = docs.agg(F.count("*"), F.percentile_approx("k", [i / 64 for i in range(65)], 1000)).first()
    bounds = sorted(set(bounds or [0]))
    if len(bounds) < 2:
        return F.lit(0).cast("long")
    parts = max(1, math.ceil(n / 64 / BUCKET_ROWS))
    lows, highs = F.array(*[F.lit(x) for x in bounds[:-1]]), F.array(*[F.lit(x) for x in bounds[1:]])
    q = F.greatest(F.lit(1), F.size(F.filter(lows, lambda b: b <= F.col("k"))))
    low, high = F.element_at(lows, q).cast("double"), F.element_at(highs, q).cast("double")
    part = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor((F.col("k").cast("double") - low) / (high - low) * parts)))
    return ((q - 1) * parts + part).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """bucket, rn, guest, doc_id, text, next_text: each document with the next one in ascending doc_id.

    Each bucket holds a copy, its guest, of the first document of the next bucket; the last bucket has the very first.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(2**63))).alias("k"))
    docs = docs.withColumn("bucket", _ranges(docs))
    firsts = stored(docs.groupBy("bucket").agg(F.min("k").alias("k")), "firsts")
    by = Window.orderBy("bucket")
    to = firsts.select("k", F.coalesce(F.lag("bucket").over(by), F.max("bucket").over(Window.partitionBy())).alias("to"))
    to = F.broadcast(to) if firsts.count() <= 1_000_000 else to
    guests = docs.join(to, "k").groupBy("to", "k").agg(F.min(F.struct("text", "doc_id")).alias("x"))
    guests = guests.select(F.col("x.doc_id").alias("doc_id"), F.col("x.text").alias("text"), "k", F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    rows = docs.withColumn("guest", F.lit(False)).unionByName(guests)
    w = Window.partitionBy("bucket").orderBy("guest", "k", "text")
    return rows.select("bucket", F.row_number().over(w).alias("rn"), "guest", "doc_id", "text", F.lead("text").over(w).alias("next_text"))


def fingerprints(rows: DataFrame, keys: list[str], texts: list[str], lex: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """keys, kind, the carried columns and fp: for each row the fingerprint of each text; kind is its place in the list.

    With rows dealt by one of the keys no further exchange is needed.
    """
    # what is made inside the array is made once a text; made beside explode() it would be made for each exploded row
    carried = carried or {}
    once = [F.struct(F.col(t).alias("t"), F.xxhash64(F.lower(t)).alias("own"), *[c.alias(n) for n, c in carried.items()]) for t in texts]
    x = rows.select(*keys, F.posexplode(F.array(*once)).alias("kind", "x")).where("x.t is not null")
    group = [*keys, "kind", "own", *carried]
    x = x.select(*keys, "kind", "x.own", *[f"x.{n}" for n in carried], F.explode(F.array_union(terms(F.col("x.t")), F.array(F.lit("")))).alias("term"))
    x = x.select(*group, F.xxhash64("term").alias("h")).join(F.broadcast(lex), "h")
    x = x.groupBy(*group).agg(*slot_hashes())
    return x.select(*keys, "kind", *carried, fingerprint().alias("fp"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lex = lexicon(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    rows = with_next(docs).withColumn("edited", F.when(~F.col("guest"), edited))
    carried = {"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)}
    fps = fingerprints(rows, ["bucket", "rn", "guest", "doc_id"], ["text", "edited"], lex, carried)
    one = fps.groupBy("bucket", "rn", "guest", "doc_id", *carried).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fingerprint"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fingerprint"))
    one = one.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("rn"))).where("not guest")
    near = likeness(F.col("fingerprint"), F.col("edited_fingerprint")), likeness(F.col("fingerprint"), F.col("next"))
    return one.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near[0].alias("near_edited"), near[1].alias("near_next"))
