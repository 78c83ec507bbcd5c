"""Suffix-array dedup of bytes by two-stage sorting.

Per shard of fragments one suffix array: suffixes smaller than their successors are sorted directly, by their first
LENGTH bytes, which is all that counts here; every other suffix follows from its successor's place by a scan over the
buckets of first bytes, in ascending order. Within a bucket the suffixes that begin with a run of its byte follow in waves.
Common prefixes of neighbours, up to LENGTH, then show the strings that recur.

Defined cases: null text is the empty text; texts of fewer than LENGTH bytes lose nothing; texts are never cut; a null doc_id is
the greatest; rows with one doc_id do not count as copies of each other; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .recurrence import Bytes, covered, recurring_runs

LENGTH = 50


def _eights(raw: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as a number; raw has eight bytes more than places."""
    n = len(raw) - 8
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | raw[i : i + n].astype(np.uint64)
    return out


def suffix_array(text: bytes, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first depth bytes (rounded up to eights), and those of each place as numbers, a row an eight."""
    n, words = len(text) + 1, -(-depth // 8)  # with an end mark, which is least of all
    raw = np.frombuffer(text + b"\0" * (8 * words + 9), np.uint8)
    eights = _eights(raw)
    t = raw[:n].astype(np.int64)
    # smaller than the successor: by the next byte that differs; the end mark is sorted directly
    step = np.sign(np.append(t[1:] - t[:-1], 1))
    differs = np.flatnonzero(step)
    small = step[differs[np.searchsorted(differs, np.arange(n))]] > 0
    direct = np.flatnonzero(small)
    # lexsort compares eight by eight; most direct suffixes differ in the first
    order = direct[np.lexsort([eights[direct + 8 * w] for w in reversed(range(words))])]
    bounds = np.searchsorted(t[order], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        large = [x for x in induced[c] if len(x)]
        wave = np.concatenate(large) if large else np.zeros(0, np.int64)
        done = []
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(t[before] == c) & ~small[before]]
        bucket = np.concatenate([*done, order[bounds[c] : bounds[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(t[before] > c) & ~small[before]]
        byte = t[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
        if len(before):
            for part in np.split(before, cuts):
                induced[int(t[part[0]])].append(part)
    order = np.concatenate(out)
    return order[order < n - 1], eights


def common_prefixes(order: np.ndarray, eights: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Of each suffix but the first with the one before it in the order: length of the common prefix, at most `most`."""
    a, b = order[:-1], order[1:]
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for w in range(-(-most // 8)):
        x = eights[a[open_] + 8 * w] ^ eights[b[open_] + 8 * w]
        same = x == 0
        ended = open_[~same]
        lead = x[~same]
        for i in range(1, 8):
            out[ended] += (lead >> np.uint64(64 - 8 * i)) == 0
        open_ = open_[same]
        out[open_] += 8
    return np.minimum(out, most)


def locate_strings(length: int):
    def locate(anchors, fragments, lo, hi):
        text = b"".join(fragments)
        sizes = np.array([len(f) for f in fragments], np.int64)
        starts = np.cumsum(sizes) - sizes
        order, eights = suffix_array(text, length)
        which = np.repeat(np.arange(len(sizes)), sizes)
        room = (starts + sizes)[which] - np.arange(len(text)) >= length  # the string ends in its fragment
        lcp = common_prefixes(order, eights, length)
        whole = room[order]
        group = np.cumsum(np.append(True, lcp < length))
        order, group = order[whole], group[whole]
        if not len(order):
            return
        lo, hi = np.array(lo, np.int64), np.array(hi, np.int64)
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        least, most = (f.reduceat(x[which[order]], cuts) for f, x in ((np.minimum, lo), (np.maximum, hi)))
        n = np.diff(np.append(cuts, len(order)))
        recurs = np.repeat(least < most, n)
        place, owner = order[recurs], np.repeat(least, n)[recurs]
        if not len(place):
            return
        by = np.argsort(place)
        place, owner = place[by], owner[by]
        mine = which[place]
        ends = np.flatnonzero(np.append(mine[1:] != mine[:-1], True)) + 1
        begin = 0
        for end in ends.tolist():
            i = int(mine[begin])
            yield i, (place[begin:end] - starts[i]).tolist(), owner[begin:end].tolist()
            begin = end

    return locate


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary, null: unchanged), kept_sha256 for every row."""
    schema = "node long, doc long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def cut(lots):
        for lot in lots:
            out = []
            for node, doc, text, starts, runs, _ in lot:
                raw = np.frombuffer(text, np.uint8)
                gone = covered(len(raw), starts, runs, length)
                kept = raw[~gone].tobytes()
                out.append((node, doc, int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), kept, hashlib.sha256(kept).hexdigest()))
            types = *[pa.int64()] * 4, pa.binary(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [x.split()[0] for x in schema.split(", ")])

    rows, hit = recurring_runs(docs, Bytes, length, locate_strings(length), cut, schema, 1)
    x = rows.join(hit, ["node", "doc"], "left")
    copy = (F.col("doc") > F.col("first_doc")) & (F.col("n") >= length)
    return x.select(
        "doc_id", F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
