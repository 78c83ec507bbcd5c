"""Token ids in files of canonical, length-limited Huffman code.

Ids are counted over all documents; package-merge gives the code lengths, which alone describe the code. Documents lie in
ascending doc_id, whole, in blocks of about BLOCK_TOKENS ids. Each block can be read alone: it has the bit offset of
every STEP-th id, so that decoding takes one table look-up an id in as many lanes as there are offsets.

Files: two Parquet folders, `code` (id, length) and `blocks` (part, block, doc_ids, sizes, offsets, payload).

Defined cases: null text is the empty text, which is the end id alone; a null doc_id comes first; rows with one doc_id are
ordered by their ids; texts are never cut; an empty table gives empty files; further columns are not read.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import units
from .common import drop_stored, once, shared_dir, stored, table

TOKENIZER = "byte_bpe_50k.json"
END = 0
BLOCK_TOKENS, STEP = 1 << 16, 128
#: Code lengths fit in a decoding table of 2 ** this entries at least, and two more bits than the ids need.
LEAST_LIMIT = 16
#: Units that the library gets at once: its results take a kilobyte each.
ENCODED_AT_ONCE = 10_000


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Package-merge: the best code lengths up to limit; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    w = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate((w, packages))
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(w))
        both = both[rank]
        packages = both[0 : len(both) // 2 * 2 : 2] + both[1::2]
    take = 2 * len(w) - 2
    for is_id in reversed(levels):
        ids = int(is_id[:take].sum())
        out[order[:ids]] += 1
        take = 2 * (take - ids)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code words that follow from the lengths: shorter first, then smaller ids."""
    codes, code, before = np.zeros(len(lengths), np.int64), 0, 0
    for i in sorted(np.flatnonzero(lengths).tolist(), key=lambda i: (lengths[i], i)):
        code <<= int(lengths[i]) - before
        codes[i], before = code, int(lengths[i])
        code += 1
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bit offset of every STEP-th id, and the bits, the first one highest in its byte."""
    n = lengths[ids]
    end = np.cumsum(n)
    at = end - n
    word, room = at >> 6, 64 - (at & 63) - n
    value = codes[ids].astype(np.uint64)
    here = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64))
    total = int(end[-1] + 63 >> 6) if len(ids) else 0
    words = np.zeros(total + 1, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.bitwise_or.reduceat(here, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
    return at[::STEP].astype(np.int32), words[:total].astype(">u8").tobytes()


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.limit = max(1, int(lengths.max(initial=1)))
        self.ids, self.sizes = np.zeros(1 << self.limit, np.int32), np.ones(1 << self.limit, np.int64)
        codes = canonical(lengths)
        for i in np.flatnonzero(lengths).tolist():
            free = self.limit - int(lengths[i])
            a, b = int(codes[i]) << free, int(codes[i]) + 1 << free
            self.ids[a:b], self.sizes[a:b] = i, lengths[i]

    def block(self, offsets: np.ndarray, payload: bytes, n: int) -> np.ndarray:
        """The n ids of a block: one lane from each offset, all in step."""
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        at, out = offsets.astype(np.int64), np.zeros((len(offsets), STEP), np.int32)
        last, down = len(window) - 1, np.uint32(32 - self.limit)
        for k in range(STEP):
            x = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> down
            out[:, k] = self.ids[x]
            at += self.sizes[x]
        return out.ravel()[:n]


class Library:
    """The tokenizers library, which gets each unit of texts once while it is remembered.

    Plain units (a space, then no white space) are given to it side by side as one text, which it takes apart at the spaces; a
    token that begins with a space then begins a unit. Texts with an added token's string go to it whole.
    """

    def __init__(self, path: str):
        import json
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        bare = not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
        self.cut = bare and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.spaced = np.zeros(self.size, bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # what stands for a space in byte-level tokens
        self.memory = units.UnitCoder(self._encode)

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter((i for x in out for i in x), np.int32), np.array([len(x) for x in out], np.int64)

    def _encode(self, some: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        if not self.cut:
            return self._alone(some.to_pylist())
        plain, flats, sizes = units.plain(some), [], np.zeros(len(some), np.int64)
        order = []
        for which in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for i in range(0, len(which), ENCODED_AT_ONCE):
                at = which[i : i + ENCODED_AT_ONCE]
                part = some.take(pa.array(at))
                if plain[at[0]]:
                    raw, _ = units.text_bytes(part)
                    flat = np.array(self.tok.encode_batch_fast([raw.tobytes().decode()], add_special_tokens=False)[0].ids, np.int32)
                    begin = np.flatnonzero(self.spaced[flat])
                    if len(begin) == len(at):
                        n = np.diff(np.append(begin, len(flat)))
                    else:
                        flat, n = self._alone(part.to_pylist())
                else:
                    flat, n = self._alone(part.to_pylist())
                flats.append(flat)
                sizes[at] = n
                order.append(at)
        flat, order = np.concatenate(flats), np.concatenate(order)
        starts = np.zeros(len(some), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        ends = np.cumsum(sizes)
        return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(flat))], sizes

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row, and how many each text has."""
        texts = texts.fill_null("")
        odd = np.zeros(len(texts), bool)
        for t in self.added:
            odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.memory.ids(texts, self.cut)
        rest, n = self.memory.ids(pc.if_else(pa.array(odd), pa.scalar(""), texts), self.cut)
        parts = np.split(rest, np.cumsum(n)[:-1])
        for i in np.flatnonzero(odd).tolist():
            parts[i], _ = self._alone([texts[i].as_py()])
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


def id_type(size: int) -> str:
    """Ids of a vocabulary of this size travel in two bytes if they can, and in four otherwise."""
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_path: str, end: int = END) -> DataFrame:
    """doc_id, ids: the ids of each whole text and the end id, of id_type() of the vocabulary."""

    def run(batches):
        library = once(("tokenizers", tokenizer_path), lambda: Library(tokenizer_path))
        kind = id_type(library.size)
        for b in batches:
            ids, sizes = library.ids(b.column("text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, end).astype(kind)
            at = np.append(0, ends + np.arange(1, len(ends) + 1)) * ids.itemsize
            data = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), data], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def write_files(tokens: DataFrame, path: str, kind: str) -> None:
    """tokens: doc_id, ids of numpy type kind. Writes path/code and path/blocks."""
    spark = tokens.sparkSession

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column("ids").to_pylist()), kind)
            n = np.bincount(ids, minlength=len(total))
            n[: len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # as many as the vocabulary has, at most
    counts = np.zeros(max((r[0] for r in rows), default=0) + 1, np.int64)
    for i, n in rows:
        counts[i] = n
    lengths = code_lengths(counts, max(LEAST_LIMIT, math.ceil(math.log2(len(rows) + 1)) + 2))
    spark.createDataFrame([(i, int(lengths[i])) for i in np.flatnonzero(lengths).tolist()], "id long, length int").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast((canonical(lengths), lengths))

    width = np.dtype(kind).itemsize

    def blocks(batches):
        codes, lens = code.value
        part, block, ids, docs_, size = None, 0, [], [], 0

        def made():
            flat = np.frombuffer(b"".join(ids), kind).astype(np.int64)
            offsets, payload = pack(flat, codes, lens)
            cols = [part], [block], [docs_], [[len(x) // width for x in ids]], [offsets.tolist()], [payload]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()))], ["part", "block", "doc_ids", "sizes", "offsets", "payload"])

        for b in batches:
            for part_, doc, x in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "ids"))):
                part = part_
                ids.append(x)
                docs_.append(doc)
                size += len(x) // width
                if size >= BLOCK_TOKENS:
                    yield made()
                    block, ids, docs_, size = block + 1, [], [], 0
        if ids:
            yield made()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids").select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    ordered.mapInArrow(blocks, "part int, block long, doc_ids array<long>, sizes array<long>, offsets array<int>, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids: decoded from the files, each document with its place in the whole."""
    code = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, np.int64)
    for r in code:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.parquet(f"{path}/blocks")
    n = blocks.select("part", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = n.groupBy("part").agg(F.sum("n").alias("n")).withColumn("part_start", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = n.select("part", "block", within.alias("in_part")).join(parts.select("part", "part_start"), "part").select("part", "block", (F.col("part_start") + F.col("in_part")).alias("start"))

    def decode(batches):
        decoder = Decoder(lengths)
        for b in batches:
            for start, doc_ids, sizes, offsets, payload in zip(*(b.column(c).to_pylist() for c in ("start", "doc_ids", "sizes", "offsets", "payload"))):
                ids = decoder.block(np.array(offsets), payload, sum(sizes)).astype("<u4")
                ends = np.cumsum(sizes)
                out = [ids[e - s : e].tobytes() for s, e in zip(sizes, ends.tolist())]
                cols = doc_ids, (ends - sizes + start).tolist(), sizes, out
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "n_tokens", "ids"])

    # starts has a row of 20 bytes for each block of BLOCK_TOKENS ids; the join's strategy is left to its measured size
    return blocks.join(starts, ["part", "block"]).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    import public_tokenizers

    where = public_tokenizers.path(tokenizer)
    tokens = stored(tokenize(table(spark, sf_dir, "documents"), where), "tokens")
    path = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_files(tokens, path, id_type(Library(where).size))
    drop_stored(tokens)
    return read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
