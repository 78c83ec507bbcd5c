"""Byte-level BPE encoding and decoding by merge replay.

The distinct pre-tokens of a batch that a worker has not met before lie side by side in one symbol array. An inverted
index leads from every mergeable pair, by the rank of what it becomes (pairs that become one token have one rank), to the places where it
stands. Ranks are replayed in order from a heap; each merge touches its two neighbours only and enters the pairs that they
now form. Where a new pair has a lower rank than the one being replayed, its pre-token is encoded alone, so that ids never
differ from the library's. What is encoded is kept for later batches, up to a bound.

Defined cases: null text is the empty text, with no ids; texts are never cut; special strings are ordinary text; repeated
rows stay rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import units
from .common import once, table

RANKS = "byte_bpe_multi_50k.tiktoken"
NONE = (1 << 17) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeReplay:
    """Encodes distinct pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= NONE:
            raise ValueError("ids above 17 bits are not supported")
        self.ranks = ranks
        self.pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << 17 | b] = rank
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.append(np.array([self.pairs[k] for k in self.keys.tolist()], np.int64), -1)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)
        self.byte_id = np.array([ranks.get(bytes([i]), NONE) for i in range(256)], np.int64)
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token

    def rank_of(self, left, right):
        key = left << 17 | right
        i = self.keys.searchsorted(key)
        return np.where(self.keys[i] == key, self.values[i], -1)

    def alone(self, word: bytes) -> list[int]:
        """One pre-token: merge the lowest pair, the leftmost first, until none is left."""
        ids = [int(self.byte_id[b]) for b in word]
        while len(ids) > 1:
            best = min(((self.pairs.get(a << 17 | b, NONE), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))))
            if best[0] == NONE:
                break
            ids[best[1] : best[1] + 2] = [best[0]]
        return ids

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens, one after another, and how many each has.

        Place 0 and the place after each pre-token hold no symbol. now[p] is the rank of the pair that starts at p.
        """
        raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        begins = np.cumsum([1] + [len(w) + 1 for w in words])
        sym = self.byte_id[raw]
        sym[0] = sym[begins[1:] - 1] = NONE
        n = len(raw)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[-1], before[0] = 0, 0
        now = np.append(self.rank_of(sym[:-1], sym[1:]), -1)
        index: dict[int, list] = {}
        heap: list[int] = []
        odd: list[np.ndarray] = []

        def enter(places, ranks_):
            if len(places) > 1:
                order = np.argsort(ranks_, kind="stable")
                places, ranks_ = places[order], ranks_[order]
                cuts = [0, *(np.flatnonzero(ranks_[1:] != ranks_[:-1]) + 1).tolist(), len(places)]
            else:
                cuts = [0, 1]
            for r, i, j in zip(ranks_[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if r in index:
                    index[r].append(places[i:j])
                else:
                    index[r] = [places[i:j]]
                    heapq.heappush(heap, r)

        at = np.flatnonzero(now >= 0)
        if len(at):
            enter(at, now[at])
        while heap:
            rank = heapq.heappop(heap)
            found = index.pop(rank)
            p = found[0] if len(found) == 1 else np.concatenate(found)
            p = p[now[p] == rank]
            if len(p) > 1:
                p = np.unique(p)
            if not len(p):
                continue
            q = after[p]
            overlap = q[:-1] == p[1:]
            if overlap.any():  # of places in a chain every second one, from the left
                keep, last = [], -1
                for x, y in zip(p.tolist(), q.tolist()):
                    if x != last:
                        keep.append((x, y))
                        last = y
                p, q = np.array(keep).T
            right = after[q]
            touching = right[:-1] == p[1:]
            if touching.any():  # what stands for a moment between two merges
                i = np.flatnonzero(touching)
                between = self.rank_of(np.full(len(i), rank), sym[p[i + 1]])
                odd.append(p[i][(between >= 0) & (between <= rank)])
            sym[p], sym[q], now[q] = rank, NONE, -1
            after[p], before[right] = right, p
            left = before[p]
            places = np.concatenate((p, left))
            new = self.rank_of(sym[places], sym[after[places]])
            now[places] = new
            is_pair = new >= 0
            if is_pair.any():
                places, new = places[is_pair], new[is_pair]
                low = new <= rank
                if low.any():
                    odd.append(places[low])
                enter(places, new)
        live = sym != NONE
        sizes = np.add.reduceat(live.astype(np.int64), begins[:-1]) if words else np.zeros(0, np.int64)
        flat = sym[live]
        again = np.unique(np.searchsorted(begins, np.concatenate(odd), "right") - 1).tolist() if odd else []
        if again:
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            for w in again:
                parts[w] = np.array(self.alone(words[w]), np.int64)
                sizes[w] = len(parts[w])
            flat = np.concatenate(parts)
        return flat, sizes

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct pre-tokens, and how many each has. A pre-token that is a token is not merged at all."""
        code = [w.encode() for w in words]
        whole = np.array([self.ranks.get(c, -1) for c in code], np.int64)
        is_one = whole >= 0
        flat, sizes = self.replay([c if r < 0 else b"" for c, r in zip(code, whole.tolist())])
        where = np.concatenate(([0], np.cumsum(sizes)[:-1]))[is_one]
        return np.insert(flat, where, whole[is_one]), sizes + is_one


class Coder:
    """Texts to ids and back, for whole Arrow batches."""

    def __init__(self, ranks_path: str, pattern: str):
        self.replay = MergeReplay(load_ranks(ranks_path))
        self.find = regex.compile(pattern).findall
        self.cut = pattern == units.PATTERN
        self.memory = units.UnitCoder(self._encode)
        self.tokens = pa.array(self.replay.table, pa.binary())
        self.decimals = pa.array([f"{i},".encode() for i in range(len(self.replay.table))], pa.binary())

    def _encode(self, some: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.find(u) for u in some.to_pylist()]
        number: dict[str, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for x in found for w in x), np.int64)
        flat, sizes = self.replay.encode(list(number))
        starts = np.cumsum(sizes) - sizes
        n = sizes[words]
        ends = np.cumsum(n)
        where = np.repeat(starts[words] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        each = np.append(0, ends)[np.append(0, np.cumsum([len(x) for x in found])).astype(np.int64)]
        return flat[where], np.diff(each)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row, and how many each text has."""
        return self.memory.ids(texts.fill_null(""), self.cut)


def _slices(table: pa.Array, ids: np.ndarray, sizes: np.ndarray):
    """For each text the bytes of the table's entries of its ids, joined."""
    for i in range(0, len(sizes), 1000):
        begin, n = int(sizes[:i].sum()), sizes[i : i + 1000]
        x = table.take(pa.array(ids[begin : begin + int(n.sum())]))
        _, offsets, data = x.buffers()
        at = np.frombuffer(offsets, np.int32, len(x) + 1) if len(x) else np.zeros(1, np.int32)
        ends = at[np.append(0, np.cumsum(n))].tolist()
        data = memoryview(data) if data is not None else memoryview(b"")
        yield from (data[a:b] for a, b in zip(ends, ends[1:]))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the token ids of each text."""

    def run(batches):
        coder = once(("bpe", ranks_path, pattern), lambda: Coder(ranks_path, pattern))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _lists(*coder.ids(b.column("text")))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(ids.astype(np.int32)))


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, decoded: the bytes of each list of ids."""

    def run(batches):
        ranks = load_ranks(ranks_path)
        tokens = dict(zip(ranks.values(), ranks))
        for b in batches:
            out = [b"".join(map(tokens.__getitem__, x or ())) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: both directions in one pass, so that no ids leave the task."""

    def run(batches):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        coder = once(("bpe", ranks_path, pattern), lambda: Coder(ranks_path, pattern))
        for b in batches:
            ids, sizes = coder.ids(b.column("text"))
            enc = [sha(x[: max(0, len(x) - 1)]) for x in _slices(coder.decimals, ids, sizes)]
            dec = [sha(x) for x in _slices(coder.tokens, ids, sizes)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_and_verify(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256; fails if the decoded bytes are not those of the text."""

    def run(batches):
        coder = once(("bpe", ranks_path, pattern), lambda: Coder(ranks_path, pattern))
        for b in batches:
            ids, sizes = coder.ids(b.column("text"))
            dec = []
            for i, (x, t) in enumerate(zip(_slices(coder.tokens, ids, sizes), b.column("text"))):
                if bytes(x) != (t.as_py() or "").encode():
                    raise ValueError(f"not the same after decoding: {b.column('doc_id')[i]}")
                dec.append(hashlib.sha256(x).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), _lists(ids, sizes), pa.array(dec, pa.string())], ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def op1_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str = RANKS) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(ranks), public_tokenizers.PATTERN)
