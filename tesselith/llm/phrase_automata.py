"""Substring dedup by repeated-phrase automata.

Recurring passages of WINDOW words and more are confirmed (see recurrence), with the least document they start in. Documents that
hold some are dealt into shards; the passages of a shard are compiled into one Aho-Corasick automaton over word numbers,
and the shard's documents are streamed through it, which gives every place of every passage. A word goes if it lies in a
passage that also starts in a document with a smaller doc_id.

Defined cases: null, empty and blank texts have no words; texts of fewer words than a window lose nothing; texts are never
cut; a null doc_id is the greatest; rows with one doc_id do not count as copies of each other; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import table
from .recurrence import LAST, Words, covered, recurring_runs

WINDOW = 13


def locate_phrases(window: int):
    def locate(anchors, fragments, lo, hi):
        import ahocorasick

        number: dict[bytes, int] = {}
        rows = [tuple(number.setdefault(w, len(number)) for w in f.split(b" ")) for f in fragments]
        least: dict[tuple, int] = {}
        most: dict[tuple, int] = {}
        for words, a, b in zip(rows, lo, hi):
            for i in range(len(words) - window + 1):
                passage = words[i : i + window]
                if passage not in least:
                    least[passage], most[passage] = a, b
                else:
                    least[passage], most[passage] = min(a, least[passage]), max(b, most[passage])
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        confirmed = False
        for passage, a in least.items():
            if a < most[passage]:
                automaton.add_word(passage, a)
                confirmed = True
        if not confirmed:
            return
        automaton.make_automaton()
        for i, words in enumerate(rows):
            at = [(end - window + 1, owner) for end, owner in automaton.iter(words)]
            if at:
                yield i, [x for x, _ in at], [x for _, x in at]

    return locate


REMOVED = "node long, doc long, n_removed long, kept string, kept_sha256 string"


def streamed(window: int):
    """For lots of documents with their confirmed passages: an automaton for each lot, and its documents run through it."""

    def apply(lots):
        import ahocorasick

        for lot in lots:
            number: dict[bytes, int] = {}
            rows = [tuple(number.setdefault(w, len(number)) for w in text.split(b" ")) for _, _, text, *_ in lot]
            least: dict[tuple, int] = {}
            for words, (_, _, _, starts, runs, owners) in zip(rows, lot):
                for s, r, owner in zip(starts.tolist(), runs.tolist(), owners.tolist()):
                    passage = words[s : s + r + window - 1]
                    if owner < least.get(passage, LAST):
                        least[passage] = owner
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for passage, owner in least.items():
                automaton.add_word(passage, (owner, len(passage)))
            automaton.make_automaton()
            out = []
            for words, (node, doc, text, *_) in zip(rows, lot):
                at = [(end - n + 1, n) for end, (owner, n) in automaton.iter(words) if owner < doc]
                starts, sizes = np.array(at, np.int64).T
                gone = covered(len(words), starts, sizes - window + 1, window)
                kept = b" ".join(w for w, g in zip(text.split(b" "), gone.tolist()) if not g)
                out.append((node, doc, int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            types = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [x.split()[0] for x in REMOVED.split(", ")])

    return apply


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, node, n_words, n_removed, kept (null: unchanged), kept_sha256 for every row."""
    rows, hit = recurring_runs(docs, Words, window, locate_phrases(window), streamed(window), REMOVED, 6)
    copy = (F.col("doc") > F.col("first_doc")) & (F.col("n") >= window)
    x = rows.join(hit, ["node", "doc"], "left")
    return x.select(
        "doc_id", "node", F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without the words that go; a row that loses none keeps its text as it is, one that loses all stays, empty."""
    x = removals(docs, window).where("n_removed > 0").groupBy(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "node").agg(F.first("kept").alias("kept"))
    names = docs.columns
    held = docs.select("doc_id", "text", F.struct(*[docs[c] for c in names]).alias("row"))  # no name of docs meets one used here
    schema = StructType([StructField("own", LongType()), StructField("doc_id", LongType()), held.schema["row"]])

    def own(batches):  # rows that share a doc_id may have other texts: the node tells them apart
        kind = Words()
        for b in batches:
            nodes = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(kind.join(kind.split((t or "").encode())))))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), b.column("doc_id"), b.column("row")], ["own", "doc_id", "row"])

    y = held.mapInArrow(own, schema)
    y = y.join(x, (F.coalesce("doc_id", F.lit(LAST)) == F.col("doc")) & (F.col("own") == F.col("node")), "left")
    now = {"text": F.coalesce("kept", F.col("row.text")), "n_chars": F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in names else None}
    return y.select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in names])


def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
