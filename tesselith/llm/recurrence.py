"""Where runs of W symbols (words, bytes) recur across documents: the frame for both substring operators.

Each run of W symbols has an anchor, the least hash of the K-symbol grams in it; equal runs have equal anchors. A text falls
into stretches of runs with one anchor; the symbols of a stretch are its fragment. Fragments meet at their anchor, as two
hashes and a place, without their symbols:

* an anchor in one text only cannot lie in a recurring run: that settles almost all of the corpus;
* of equal fragments all but those of the least document recur, whatever else there is, and only the least one goes on. This is
  done in each task first, so that a passage that everybody has is one row a task;
* where an anchor has fragments that differ, these alone are fetched, once each, and a locator (automata, suffix
  arrays) finds in bounded shards of them every run that recurs, and the least document it starts in;
* an anchor with very many different fragments is not left to one shard: its fragments are cut into single runs, which meet
  in the same way by their own hash.

What recurs is a hit: a place in a text and a document with a smaller doc_id that has the same symbols. Places travel in
packed rows dealt by the text they are in. A null doc_id counts as the greatest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, joined_to_class, pieces, stored
from .shingles import WordHashes, mixed

LAST = 2**63 - 1
#: Bytes of text that are hashed at once (some 80 bytes of work space each), whose places are merged at once (20), and
#: that share a destination.
PIECE_BYTES, LOT_BYTES, DEST_BYTES = 1 << 20, 8 << 20, 16 << 20
#: Places of a bucket, about: some 100 bytes each while it is sorted.
BUCKET_PLACES = 500_000
#: Symbols in the different fragments of one anchor beyond which they are cut into single runs.
CROWDED = 1 << 16
#: Bytes of fragments that a locator gets at once.
SHARD_BYTES = 2 << 20
ODD = 0x9E3779B97F4A7C15
SPREAD = (1 << 20) - 1


class Words:
    """Symbols are words of bytes."""

    grams = 6

    def __init__(self):
        self.cache = WordHashes()

    def split(self, text: bytes) -> list[bytes]:
        return text.split()

    def join(self, symbols) -> bytes:
        return b" ".join(symbols)

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """One number a symbol of all texts, and how many each text has."""
        return self.cache.of(texts)


class Bytes:
    """Symbols are single bytes. Grams are long enough that few recur by chance."""

    grams = 24

    def split(self, text: bytes) -> bytes:
        return text

    def join(self, symbols) -> bytes:
        return bytes(symbols)

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1), sizes


def rolled(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k symbols in a row, from those of 1, 2, 4, ... symbols."""
    if len(symbols) < k:
        return np.zeros(0, np.uint64)
    out, done, now, width = None, 0, symbols, 1
    while True:
        if k & width:
            if out is None:
                out = now
            else:
                out = out[: len(symbols) - done - width + 1] * np.uint64(pow(ODD, width, 1 << 64)) + now[done : len(symbols) - width + 1]
            done += width
        if 2 * width > k:
            return mixed(out)
        now = now[:-width] * np.uint64(pow(ODD, width, 1 << 64)) + now[width:]
        width *= 2


def sliding(a: np.ndarray, w: int) -> np.ndarray:
    """Least of every w values in a row."""
    step, out = 1, a
    while 2 * step <= w:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - (w - step)], out[w - step :]) if w > step else out


class Powers:
    """Powers of ODD and of its inverse, as many as were ever asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", ODD), ("down", pow(ODD, -1, 1 << 64))):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))


def stretches(kind, powers: Powers, texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """anchor, fragment hash, text number, start and number of runs of each stretch."""
    flat, sizes = kind.hashes(texts)
    grams = rolled(flat, kind.grams)
    w = window - kind.grams + 1
    none = np.zeros(0, np.int64)
    if len(grams) < w:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    least = sliding(grams, w)
    first = np.cumsum(sizes) - sizes
    end = np.minimum(first + np.maximum(0, sizes - window + 1), len(least))  # of the runs within the text
    full = first < end
    full = np.flatnonzero(full)
    if not len(full):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    cuts = np.union1d(cuts[cuts > first[full[0]]], first[full])
    text = full[np.searchsorted(first[full], cuts, "right") - 1]
    inside = cuts < end[text]
    cuts, text = cuts[inside], text[inside]
    stop = np.minimum(np.append(cuts[1:], LAST), end[text])
    powers.upto(len(grams) + 1)
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(grams * powers.up[: len(grams)], out=sums[1:])
    fragment = mixed((sums[stop + w - 1] - sums[cuts]) * powers.down[cuts] + (stop - cuts).astype(np.uint64))
    return least[cuts], fragment, text, cuts - first[text], stop - cuts


def packed(columns: list[np.ndarray], widths: str) -> bytes:
    """Columns of numbers as bytes: 5 is the low five bytes, 4 a 32-bit and 8 a 64-bit number."""
    n = len(columns[0])
    out = [np.array([n], "<i8").tobytes()]
    for c, w in zip(columns, widths):
        out.append(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes() if w == "5" else c.astype("<u4" if w == "4" else "<i8").tobytes())
    return b"".join(out)


def unpacked(data: bytes, widths: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, "<i8", 1)[0]), 8, []
    for w in widths:
        if w == "5":
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :5] = np.frombuffer(data, np.uint8, 5 * n, at).reshape(-1, 5)
            out.append(wide.view("<u8")[:, 0].astype(np.int64))
        else:
            out.append(np.frombuffer(data, "<u4" if w == "4" else "<i8", n, at).astype(np.int64))
        at += int(w) * n
    return out


def grouped(node, doc, columns: list[np.ndarray], widths: str) -> bytes:
    """Rows in which those of one text come in a row, with the text named once."""
    first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (doc[1:] != doc[:-1])))
    table = packed([node[first], doc[first], np.diff(np.append(first, len(node)))], "884")
    return table + packed(columns, widths)


def ungrouped(data: bytes, widths: str) -> list[np.ndarray]:
    """node, doc and the columns."""
    n = int(np.frombuffer(data, "<i8", 1)[0])
    node, doc, size = unpacked(data, "884")
    return [np.repeat(node, size), np.repeat(doc, size), *unpacked(data[8 + 20 * n :], widths)]


def _together(blobs: list[bytes], widths: str) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*(ungrouped(b, widths) for b in blobs))] if blobs else [np.zeros(0, np.int64) for _ in range(2 + len(widths))]


#: Packed columns: places have anchor, fragment hash, start, runs; hits have start, runs, the smaller document; open places have
#: anchor, fragment hash, start, runs, and whether the anchor is crowded.
PLACES, HITS, OPEN = "5544", "448", "55444"
HIT, OPENED, TEXT, FRAGMENT, RUNS = range(5)
PACKED = "kind int, k long, data binary"


def _cuts(key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of the stretches of equal values."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    yield from zip(key[first].tolist(), first.tolist(), [*first[1:].tolist(), len(key)])


def _by_text(kind: int, dests: int, node, doc, columns: list, widths: str) -> Iterator[tuple[int, int, bytes]]:
    """Packed rows of places by destination, which follows from their text."""
    order = np.lexsort((doc, node, dest_of(node, doc, dests)))
    node, doc, columns = node[order], doc[order], [c[order] for c in columns]
    for dest, a, b in _cuts(dest_of(node, doc, dests)):
        yield kind, dest, grouped(node[a:b], doc[a:b], [c[a:b] for c in columns], widths)


def dest_of(node: np.ndarray, doc: np.ndarray, dests: int) -> np.ndarray:
    """The document counts, so that copies of one text do not all go to one place."""
    return ((node.view(np.uint64) >> np.uint64(20)).astype(np.int64) + (doc & SPREAD)) % dests


def _rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Packed rows as Arrow batches of some 32 MB."""
    for i, j in pieces([r[2] for r in rows], 32 << 20):
        k, dest, data = zip(*rows[i:j])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(dest, pa.int64()), pa.array(data, pa.binary())], ["kind", "k", "data"])


def _merged(places: list[np.ndarray], buckets: int, dests: int) -> list[tuple]:
    """Packed rows of the places of one lot (anchor, hash, node, doc, start, runs, in ascending doc): of equal fragments
    only those of the least document go to their bucket, all others are hits of it."""
    a, h, node, doc, start, runs = places
    order = np.argsort(mixed(a + h * np.uint64(ODD)), kind="stable")
    x, y, d = a[order], h[order], doc[order]
    first = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(order) else np.zeros(0, bool)
    lo = d[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    least = np.empty(len(order), np.int64)
    least[order] = lo
    later = least < doc
    out = list(_by_text(HIT, dests, node[later], doc[later], [start[later], runs[later], least[later]], HITS))
    a, h, node, doc, start, runs = (c[~later] for c in places)
    bucket = ((a >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    a, h, node, doc, start, runs = (c[order] for c in (a, h, node, doc, start, runs))
    for k, i, j in _cuts(bucket[order]):
        out.append((RUNS, k, grouped(node[i:j], doc[i:j], [a[i:j], h[i:j], start[i:j], runs[i:j]], PLACES)))
    return out


def scan_rows(docs: DataFrame, make_kind: Callable) -> DataFrame:
    """doc_id, node, n (symbols), sha256 of all symbols, z: the symbols, compressed."""

    def run(batches):
        kind = make_kind()
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            for i, j in pieces(texts, 8 << 20):
                parts = [kind.split(t) for t in texts[i:j]]
                n = [len(p) for p in parts]
                whole = list(map(kind.join, parts))
                node = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(x)))) for x in whole]
                sha = [hashlib.sha256(x).hexdigest() for x in whole]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(map(press, whole), pa.binary())], ["doc_id", "node", "n", "sha256", "z"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, node long, n long, sha256 string, z binary")


def unzipped(values: list[bytes]) -> list[bytes]:
    return list(map(zstandard.ZstdDecompressor().decompress, values))


def scan_places(rows: DataFrame, make_kind: Callable, window: int, buckets: int, dests: int) -> DataFrame:
    """Packed rows: places by bucket, and the hits that a lot of texts settles by itself."""

    def run(batches):
        kind, powers = make_kind(), Powers()
        for b in batches:
            whole = unzipped(b.column("z").to_pylist())
            docs, nodes, shas = (b.column(c).to_pylist() for c in ("doc", "node", "sha256"))
            for i, j in pieces(whole, LOT_BYTES):
                texts: dict[str, int] = {}
                for k in sorted(range(i, j), key=docs.__getitem__):
                    texts.setdefault(shas[k], k)  # copies of a whole text are settled by its hash
                kept = list(texts.values())
                found = []
                for s, e in pieces([whole[k] for k in kept], PIECE_BYTES):
                    a, h, t, start, runs = stretches(kind, powers, [whole[k] for k in kept[s:e]], window)
                    node, doc = (np.array([x[k] for k in kept[s:e]], np.int64) for x in (nodes, docs))
                    found.append((a, h, node[t], doc[t], start, runs))
                yield from _rows(_merged([np.concatenate(x) for x in zip(*found)], buckets, dests))

    return rows.select("doc", "node", "sha256", "z").mapInArrow(run, PACKED)


def settle(dealt: DataFrame, dests: int, window: int, exact: bool) -> DataFrame:
    """Packed rows by destination: hits, and the open places whose anchor has fragments that differ. exact: the fragments are
    single runs, which differ if their hashes do, so that none is open. Rows of a bucket come in a row."""

    def settled(blobs):
        node, doc, a, h, start, runs = _together(blobs, PLACES)
        order = np.lexsort((doc, h, a))
        node, doc, a, h, start, runs = (c[order] for c in (node, doc, a, h, start, runs))
        anchor = np.append(True, a[1:] != a[:-1])
        equal = anchor | np.append(True, h[1:] != h[:-1])
        lo = doc[np.maximum.accumulate(np.where(equal, np.arange(len(a)), 0))]
        hit = lo < doc
        out = list(_by_text(HIT, dests, node[hit], doc[hit], [start[hit], runs[hit], lo[hit]], HITS))
        if exact:
            return out
        number = np.cumsum(anchor) - 1
        fragments = np.bincount(number, equal)
        at = np.flatnonzero(anchor)
        differ = (fragments > 1) & (np.minimum.reduceat(lo, at) != np.maximum.reduceat(lo, at))
        crowded = np.bincount(number, np.where(hit, 0, runs + window)) > CROWDED
        rest = differ[number] & ~hit
        return out + list(_by_text(OPENED, dests, node[rest], doc[rest], [a[rest], h[rest], start[rest], runs[rest], crowded[number[rest]]], OPEN))

    def run(batches):
        now, held = None, []
        for b in batches:
            for kind, k, data in zip(*(b.column(c).to_pylist() for c in ("kind", "k", "data"))):
                if kind == HIT:
                    yield from _rows([(kind, k, data)])
                    continue
                if k != now and held:
                    yield from _rows(settled(held))
                    held = []
                now = k
                held.append(data)
        if held:
            yield from _rows(settled(held))

    return dealt.mapInArrow(run, PACKED)


def _texts_with(batches, widths: dict[int, str]) -> Iterator[tuple]:
    """Rows of (k, kind, node, doc, z, data), sorted by k and kind, packed rows before texts: for each text its node, doc,
    z, data, and the packed columns of each kind that belong to it. Repeated rows are left out."""
    now, held, tables, seen = None, {kind: [] for kind in widths}, None, set()
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("k", "kind", "node", "doc", "z", "data")]
        for k, kind, node, doc, z, data in zip(*cols):
            if k != now:
                now, held, tables, seen = k, {kind: [] for kind in widths}, None, set()
            if kind != TEXT:
                held[kind].append(data)
                continue
            if tables is None:
                tables = {}
                for one, blobs in held.items():
                    x = _together(blobs, widths[one])
                    order = np.lexsort((x[1], x[0]))
                    tables[one] = [c[order] for c in x]
                held = {kind: [] for kind in widths}
            if (node, doc) in seen:
                continue  # a repeated row
            seen.add((node, doc))
            mine = {}
            for one, x in tables.items():
                a, e = np.searchsorted(x[0], node), np.searchsorted(x[0], node, "right")
                p, q = a + np.searchsorted(x[1][a:e], doc), a + np.searchsorted(x[1][a:e], doc, "right")
                mine[one] = [c[p:q] for c in x[2:]]
            yield k, node, doc, z, data, mine


OUT = "kind int, k long, node long, doc long, h long, s long, data binary, known binary"
NAMES = [c.split()[0] for c in OUT.split(", ")]
TYPES = [pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.binary()]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)


def cut(texts: DataFrame, make_kind: Callable, window: int, buckets: int, dests: int) -> DataFrame:
    """Texts with a hit or an open place (kind TEXT, known: the hits); fragments of open places (FRAGMENT: k is the
    anchor); and, packed by bucket, the single runs of crowded anchors (RUNS), with the hits among them."""

    def run(batches):
        kind, out, size = make_kind(), [], 0
        crowd, crowd_size = [], 0

        def runs_of_crowd():
            crowd.sort(key=lambda x: x[2])
            flat, sizes = kind.hashes([x[0] for x in crowd])
            first = np.cumsum(sizes) - sizes
            runs = sizes - window + 1
            g, g2 = rolled(flat, window), rolled(mixed(flat), window)
            at = np.repeat(first - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
            node, doc, start = (np.repeat(np.array([x[i] for x in crowd], np.int64), runs) for i in (1, 2, 3))
            start = start + at - np.repeat(first, runs)
            places = [g[at], g2[at], node, doc, start, np.ones(len(at), np.int64)]
            return [(kind_, k, None, None, None, None, data, None) for kind_, k, data in _merged(places, buckets, dests)]

        for k, node, doc, z, _, mine in _texts_with(batches, {HIT: HITS, OPENED: OPEN}):
            if crowd_size > PIECE_BYTES:
                yield _table(runs_of_crowd())
                crowd, crowd_size = [], 0
            a, h, start, runs, crowded = mine[OPENED]
            if not len(a) and not len(mine[HIT][0]):
                continue
            out.append((TEXT, k, node, doc, None, None, z, packed(mine[HIT], HITS)))
            size += len(z) + len(out[-1][-1])
            if len(a):
                symbols = kind.split(unzipped([z])[0])
                for a_, h_, s, r, c in zip(*(x.tolist() for x in (a, h, start, runs, crowded))):
                    fragment = kind.join(symbols[s : s + r + window - 1])
                    if c:
                        crowd.append((fragment, node, doc, s))
                        crowd_size += len(fragment)
                    else:
                        out.append((FRAGMENT, a_, node, doc, h_, s, fragment, None))
                        size += len(fragment)
            if size > 4 * PIECE_BYTES:
                yield _table(out)
                out, size = [], 0
        if crowd:
            yield _table(runs_of_crowd())
        if out:
            yield _table(out)

    return texts.mapInArrow(run, OUT)


def shards(batches, most: int = SHARD_BYTES) -> Iterator[list[list]]:
    """k, h, node, doc, s, data of whole anchors (rows come sorted by k, h), with about most bytes of fragments."""
    rest: list[list] = [[] for _ in range(6)]
    size = 0
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("k", "h", "node", "doc", "s", "data")]
        ends = [0, *(i for i in range(1, len(cols[0])) if cols[0][i] != cols[0][i - 1]), len(cols[0])]
        for i, j in zip(ends, ends[1:]):
            if size >= most and rest[0][-1] != cols[0][i]:
                yield rest
                rest, size = [[] for _ in range(6)], 0
            for r, c in zip(rest, cols):
                r += c[i:j]
            size += sum(map(len, cols[5][i:j]))
    if rest[0]:
        yield rest


def located(fragments: DataFrame, locate: Callable, dests: int) -> DataFrame:
    """Packed hits by destination: the runs of the fragments that also start in a smaller document."""

    def run(batches):
        out, size = [], 0
        for k, h, node, doc, s, data in shards(batches):
            key = list(zip(k, h))
            first = [i for i in range(len(key)) if not i or key[i] != key[i - 1] or data[i] != data[i - 1]]  # equal ones are of one document
            last = [*first[1:], len(key)]
            docs = [doc[i] for i in first]
            for i, at, owner in locate([k[x] for x in first], [data[x] for x in first], docs, docs):
                at, owner = np.array(at, np.int64), np.array(owner, np.int64)
                at, owner = at[owner < docs[i]], owner[owner < docs[i]]
                if len(at):
                    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])))
                    runs = np.diff(np.append(new, len(at)))
                    for row in range(first[i], last[i]):
                        out.append((np.full(len(new), node[row]), np.full(len(new), doc[row]), at[new] + s[row], runs, owner[new]))
                        size += len(new)
            if size > BUCKET_PLACES:
                yield from _rows(hits(out))
                out, size = [], 0
        if out:
            yield from _rows(hits(out))

    def hits(out):
        node, doc, *columns = (np.concatenate(c) for c in zip(*out))
        return list(_by_text(HIT, dests, node, doc, columns, HITS))

    return fragments.mapInArrow(run, PACKED)


def recurring_runs(docs: DataFrame, make_kind: Callable, window: int, locate: Callable, apply: Callable, schema: str, n_bytes: int) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, doc, node, n, sha256, first_doc) of all documents, and what apply makes of the texts with hits.

    locate takes the anchors, fragments and least and greatest documents of a shard and gives for a fragment's number the starts
    of runs that recur with the least document of each run. apply takes an iterator of lots, lists of (node, doc, text,
    starts, runs, smaller documents), and gives Arrow batches of schema; n_bytes is a symbol's length, about.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(scan_rows(docs, make_kind).withColumn("doc", F.coalesce("doc_id", F.lit(LAST))), "rows")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    symbols = rows.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + int(symbols * 2 / (window - make_kind().grams + 2)) // BUCKET_PLACES
    dests = 1 + symbols * n_bytes // DEST_BYTES
    wide = max(parts, buckets)

    places = scan_places(rows, make_kind, window, buckets, dests).repartition(wide, "k").sortWithinPartitions("k", "kind")
    settled = stored(settle(places, dests, window, False), "settled")

    bare = [F.lit(None).cast("long").alias(c) for c in ("node", "doc")]
    by_dest = lambda df: df.select("k", "kind", *bare, F.lit(None).cast("binary").alias("z"), "data")
    dest = (F.shiftrightunsigned("node", 20) + F.col("doc").bitwiseAND(F.lit(SPREAD).cast("long"))) % F.lit(dests).cast("long")
    texts = rows.where(F.col("n") >= window).select(dest.alias("k"), F.lit(TEXT).alias("kind"), "node", "doc", "z", F.lit(None).cast("binary").alias("data"))
    texts = by_dest(settled).union(texts).repartition(max(parts, dests), "k").sortWithinPartitions("k", "kind")
    pieces_ = stored(cut(texts, make_kind, window, buckets, dests), "cut")
    drop_stored(settled)

    found = located(pieces_.where(F.col("kind") == FRAGMENT).repartition(parts, "k").sortWithinPartitions("k", "h"), locate, dests)
    runs = pieces_.where(F.col("kind") == RUNS).select("kind", "k", "data").repartition(wide, "k").sortWithinPartitions("k")
    more = by_dest(found.union(settle(runs, dests, window, True)).union(pieces_.where(F.col("kind") == HIT).select("kind", "k", "data")))
    known = pieces_.where(F.col("kind") == TEXT).select("k", "kind", "node", "doc", F.col("data").alias("z"), F.col("known").alias("data"))
    again = more.union(known).repartition(max(parts, dests), "k").sortWithinPartitions("k", "kind")

    def finish(batches):
        def lots():
            lot, size = [], 0
            for node, doc, text, hit in _known_and(batches):
                lot.append((node, doc, text, *hit))
                size += len(text)
                if size >= SHARD_BYTES:
                    yield lot
                    lot, size = [], 0
            if lot:
                yield lot

        yield from apply(lots())

    copies = rows.groupBy("sha256").agg(F.min("doc").alias("first_doc"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    named = joined_to_class(rows.drop("z"), copies, "sha256", "doc").withColumn("first_doc", F.coalesce("first_doc", "doc"))
    return named, again.mapInArrow(finish, schema)


def _known_and(batches) -> Iterator[tuple]:
    """Texts with their earlier hits, which came with them, and the later ones."""
    for _, node, doc, z, known, mine in _texts_with(batches, {HIT: HITS}):
        hit = [np.concatenate(x) for x in zip(unpacked(known, HITS), mine[HIT])]
        if len(hit[0]):
            yield node, doc, unzipped([z])[0], hit


def covered(n: int, starts: np.ndarray, runs: np.ndarray, window: int) -> np.ndarray:
    """Which of n symbols lie in one of the runs from starts on."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + runs + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0
