"""MinHash near-dedup by an LSH forest.

Texts with one shingle set are one node. A node's signature gives TREES orders: each sorts the nodes by values
of its own. Nodes that share the first DEPTH values of an order are a region; within it the sort goes DEEPER. Both depths
are the same for every region. Neighbours by longest common prefix are the first
candidates. What they link becomes components; then, in every region that still holds several components, rows are compared
across components, block with block, on inverted indexes of their full sets, so that no region is cut short and no
pairs are written out. Before full sets are fetched, 128 bits of the signatures sort out pairs that are far from the
threshold (by four deviations). Every link is confirmed on full shingle sets.

A pair of similarity s shares a region with probability 1 - (1 - s^4)^16: 0.9998 at 0.8.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; texts are never cut; rows with one
doc_id are one document with several texts; a null doc_id has a null component unless linked; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import joined_to_class, pieces, stored, table
from .components import components
from .shingles import WordHashes, shingle_sets

TREES, DEPTH, DEEPER = 16, 4, 4
HASHES = TREES * DEPTH
#: Rows of a region that are held at once.
BLOCK_ROWS = 1024
#: Of the 64 two-bit parts of two signatures so many are equal at similarity 0.8, but for one pair in 100,000.
ALIKE = 42
#: Rows of a part and queries of a block of the audit.
AUDIT_ROWS, AUDIT_QUERIES = 4096, 64


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, t, n, node, sig: a hash of the text, size of the shingle set, its hash and its HASHES least values; node is null without words."""

    def run(batches):
        cache, (mul, add) = WordHashes(), _coefficients(HASHES)
        for b in batches:
            texts = [(t or "").encode().lower() for t in b.column("text").to_pylist()]
            for i, j in pieces(texts, 4 << 20):
                sets = shingle_sets(texts[i:j], k, cache)
                n = np.array([len(s) for s in sets], np.int64)
                node = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) if len(s) else None for s in sets]
                full = n > 0
                sig = np.zeros((int(full.sum()), HASHES), ">u4")
                if full.any():
                    flat = np.concatenate(sets)
                    starts = (np.cumsum(n) - n)[full]
                    for h in range(HASHES):
                        sig[:, h] = np.minimum.reduceat((flat * mul[h] + add[h]) >> np.uint64(32), starts)
                rows = iter(sig)
                out = [next(rows).tobytes() if f else None for f in full.tolist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("doc_id", "t")), pa.array(n), pa.array(node, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "t", "n", "node", "sig"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, "doc_id long, t long, n long, node long, sig binary")


def forest(nodes: DataFrame) -> DataFrame:
    """node, sig to one row a tree: tree, prefix (hash of DEPTH values), key (the next ones), node, s1, s2."""

    def run(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), ">u4").reshape(-1, HASHES).astype(np.uint32)
            two = (sig & np.uint32(3)).astype(np.uint64)
            s = [np.bitwise_or.reduce(two[:, h : h + 32] << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=1).view(np.int64) for h in (0, 32)]
            wide = np.hstack((sig, sig[:, : DEPTH + DEEPER])).astype(">u4")
            node = b.column("node").to_numpy()
            for t in range(TREES):
                at = t * DEPTH
                prefix = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(x.tobytes(), t)))) for x in np.ascontiguousarray(wide[:, at : at + DEPTH])]
                key = [x.tobytes() for x in np.ascontiguousarray(wide[:, at + DEPTH : at + DEPTH + DEEPER])]
                yield pa.RecordBatch.from_arrays([pa.array(prefix, pa.int64()), pa.array(key, pa.binary()), pa.array(node, pa.int64()), pa.array(s[0]), pa.array(s[1])], ["prefix", "key", "node", "s1", "s2"])

    return nodes.select("node", "sig").mapInArrow(run, "prefix long, key binary, node long, s1 long, s2 long")


def alike(s1, s2, t1, t2) -> np.ndarray:
    """Equal two-bit parts of signatures."""
    low = np.uint64(0x5555555555555555)
    count = 0
    for a, b in ((s1, t1), (s2, t2)):
        x = a.view(np.uint64) ^ b.view(np.uint64)
        count = count + 32 - np.bitwise_count((x | x >> np.uint64(1)) & low).astype(np.int64)
    return count


def _regions(frames):
    """Whole regions (rows of one prefix, which come in a row): frame, starts and ends of the regions in it."""
    rest = None
    for pdf in frames:
        pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
        p = pdf["prefix"].to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(p[1:] != p[:-1]) + 1))
        rest = pdf.iloc[cuts[-1] :]
        if len(cuts) > 1:
            yield pdf.iloc[: cuts[-1]], cuts[:-1], cuts[1:]
    if rest is not None and len(rest):
        yield rest, np.array([0]), np.array([len(rest)])


def _neighbours(frames):
    """Neighbours in an order, and the rows of regions of three or more."""
    for pdf, starts, ends in _regions(frames):
        node, s1, s2, prefix = (pdf[c].to_numpy() for c in ("node", "s1", "s2", "prefix"))
        i = np.flatnonzero(prefix[1:] == prefix[:-1])
        i = i[alike(s1[i], s2[i], s1[i + 1], s2[i + 1]) >= ALIKE]
        pairs = pd.DataFrame({"prefix": None, "a": np.minimum(node[i], node[i + 1]), "b": np.maximum(node[i], node[i + 1]), "s1": 0, "s2": 0})
        member = np.repeat(ends - starts >= 3, ends - starts)
        rows = pd.DataFrame({"prefix": prefix[member], "a": node[member], "b": node[member], "s1": s1[member], "s2": s2[member]})
        for out in (pairs, rows):
            if len(out):
                yield out


def _open_rows(frames):
    """Rows of a region that have a partner alike in another component: prefix, node, comp."""
    for pdf, starts, ends in _regions(frames):
        prefix, node, comp, s1, s2 = (pdf[c].to_numpy() for c in ("prefix", "node", "comp", "s1", "s2"))
        many = np.flatnonzero(np.minimum.reduceat(comp, starts) != np.maximum.reduceat(comp, starts))
        wanted = np.zeros(len(node), bool)
        for a, b in zip(starts[many].tolist(), ends[many].tolist()):
            # the largest component last: its rows are not compared among themselves
            _, number, size = np.unique(comp[a:b], return_inverse=True, return_counts=True)
            order = np.lexsort((number, size[number])) + a
            c = comp[order]
            begin = 0
            for end in (np.flatnonzero(c[1:] != c[:-1]) + 1).tolist():
                rest = order[end:]
                for x in order[begin:end]:
                    near = rest[alike(s1[x : x + 1], s2[x : x + 1], s1[rest], s2[rest]) >= ALIKE]
                    wanted[near] = True
                    wanted[x] |= len(near) > 0
                begin = end
        if wanted.any():
            yield pd.DataFrame({"prefix": prefix[wanted], "node": node[wanted], "comp": comp[wanted]})


def _joined(percent: int):
    """Links that join components, confirmed on full sets; rows of (prefix, i, j), a pair of blocks, come in a row.

    An inverted index of the block's sets gives one row's intersections with all others at once. Rows of the largest
    component are only answered to, not asked, and components once joined are not asked again: pairs are never written out.
    """

    def block(g):
        node, comp, sets = g["node"].to_numpy(), g["comp"].to_numpy(), [np.frombuffer(x, np.uint64) for x in g["items"]]
        n = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), n)
        _, item = np.unique(np.concatenate(sets), return_inverse=True)
        by = np.argsort(item, kind="stable")
        posted, first = row[by], np.append(0, np.cumsum(np.bincount(item)))
        begin = np.cumsum(n) - n
        ids, number, size = np.unique(comp, return_inverse=True, return_counts=True)
        up = list(range(len(ids)))

        def top(k):
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        out, most = [], int(np.argmax(size))
        for x in np.argsort(size[number], kind="stable").tolist():
            if number[x] == most:
                continue
            mine = item[begin[x] : begin[x] + n[x]]
            both = np.bincount(np.concatenate([posted[first[k] : first[k + 1]] for k in mine.tolist()]), minlength=len(n))
            for y in np.flatnonzero((100 * both >= percent * (n + n[x] - both)) & (number != number[x])).tolist():
                p, q = top(int(number[x])), top(int(number[y]))
                if p != q:
                    up[max(p, q)] = min(p, q)
                    out.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(out, columns=["a", "b"])

    def run(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            key = pdf[["prefix", "i", "j"]].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1))
            for s, e in zip(cuts[:-1], cuts[1:]):
                yield block(pdf.iloc[s:e])
            rest = pdf.iloc[cuts[-1] :]
        if rest is not None and len(rest):
            yield block(rest)

    return run


def full_sets(wanted: DataFrame, docs: DataFrame, sigs: DataFrame, k: int) -> DataFrame:
    """node, items: the full shingle set of each wanted node, from a text that has it."""
    wanted = wanted.distinct()
    whose = sigs.where("node is not null and doc_id is not null").join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def sets(batches):
        cache = WordHashes()
        for b in batches:
            texts = [(t or "").encode().lower() for t in b.column("text").to_pylist()]
            for i, j in pieces(texts, 4 << 20):
                found = shingle_sets(texts[i:j], k, cache)
                node = [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) if len(s) else None for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["node", "items"])

    texts = docs.select("doc_id", "text").join(whose.select("doc_id").distinct(), "doc_id").select("text")
    texts = texts.union(docs.where("doc_id is null").select("text"))  # no id tells these apart: their nodes do, below
    return stored(texts.mapInArrow(sets, "node long, items binary").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, sigs: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b of the pairs whose full sets have 100 * intersection >= percent * union."""
    full = full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b"))), docs, sigs, k)

    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = pairs.join(full.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(full.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    return x.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, t, n, group for every row: a hash of its text, the size of its shingle set, and its class, null without words."""
    docs = docs.select("doc_id", "text")
    sigs = stored(signatures(docs, k), "sigs")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = sigs.where("node is not null").groupBy("node").agg(F.min("sig").alias("sig"))
    dealt = forest(nodes).repartition(parts, "prefix").sortWithinPartitions("prefix", "key", "node")
    first = stored(dealt.mapInPandas(_neighbours, "prefix long, a long, b long, s1 long, s2 long"), "regions")
    near = first.where("prefix is null").select("a", "b").distinct()
    links = stored(confirmed(near, docs, sigs, k, percent), "links")
    comp = components(links)
    rows = first.where("prefix is not null").select("prefix", F.col("a").alias("node"), "s1", "s2")
    rows = rows.join(comp, rows["node"] == comp["id"], "left").select("prefix", "node", "s1", "s2", F.coalesce("comp", "node").alias("comp"))
    mixed = rows.groupBy("prefix").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("prefix")
    rows = rows.join(mixed, "prefix", "left_semi").repartition(parts, "prefix").sortWithinPartitions("prefix", "comp")
    open_rows = stored(rows.mapInPandas(_open_rows, "prefix long, node long, comp long"), "open")
    if open_rows.limit(1).count():
        full = full_sets(open_rows.select("node"), docs, sigs, k)
        sized = open_rows.join(open_rows.groupBy("prefix").agg(F.count("*").alias("n")), "prefix").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
        own = sized.withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
        dealt = own.select("prefix", "node", "comp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("prefix", "node", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(full, "node")
        dealt = dealt.repartition(parts, "prefix", "i", "j").sortWithinPartitions("prefix", "i", "j", "node")
        more = stored(dealt.mapInPandas(_joined(percent), "a long, b long").distinct(), "links")
        if more.limit(1).count():
            links = links.union(more)
            comp = components(links)
    named = sigs.select("doc_id", "t", "n", "node").join(comp.withColumnRenamed("id", "node"), "node", "left")
    return named.select("doc_id", "t", "n", F.coalesce("comp", "node").alias("group"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row. A null doc_id is the greatest: kept where its class has no other."""
    named = classes(docs, k, percent)
    least = named.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    out = joined_to_class(named, least, "group", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that are the least of their class: by doc_id, a null one last, then by a hash of the text.

    Rows without words stay, and so do repeated rows of the least document: rows are told apart by doc_id and text.
    """
    named = stored(classes(docs, k, percent).where("group is not null"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t")
    first = named.groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("rows")).where("rows > 1").select("group", "first")
    gone = joined_to_class(named, first, "group", "t").where(F.col("first").isNotNull() & ~order.eqNullSafe(F.col("first"))).select("doc_id", "t").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))  # no name of docs meets one used here
    return rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("t")), "left_anti").select("row.*")


def audit(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[int, int]:
    """Links of the documents whose id is divisible by 100 with all others, by brute force, and how many of them lie in one
    class. Queries go in blocks of AUDIT_QUERIES against parts of AUDIT_ROWS rows, on inverted indexes of the queries' sets."""
    docs = docs.select("doc_id", "text").withColumn("t", F.xxhash64("text"))

    def sets(batches):
        cache = WordHashes()
        for b in batches:
            texts = [(t or "").encode().lower() for t in b.column("text").to_pylist()]
            for i, j in pieces(texts, 4 << 20):
                found = [s.tobytes() for s in shingle_sets(texts[i:j], k, cache)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("doc_id", "t")), pa.array(found, pa.binary())], ["doc_id", "t", "items"])

    group = classes(docs, k, percent).where("group is not null").select("doc_id", "t", "group").dropDuplicates(["doc_id", "t"])
    rows = docs.mapInArrow(sets, "doc_id long, t long, items binary").dropDuplicates(["doc_id", "t"])
    rows = stored(rows.join(group, ["doc_id", "t"]).withColumn("row", F.xxhash64("doc_id", "t")), "audit")  # null ids are no queries and have no links here
    asked = rows.where("doc_id % 100 = 0")
    parts, blocks = (max(1, -(-df.count() // n)) for df, n in ((rows, AUDIT_ROWS), (asked, AUDIT_QUERIES)))
    one = F.struct("row", "group", "items")
    queries = asked.groupBy(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block")).agg(F.collect_list(one).alias("q"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")).agg(F.collect_list(one).alias("r"))

    def compare(batches):
        for b in batches:
            for qs, rs in zip(b.column("q").to_pylist(), b.column("r").to_pylist()):
                q = [np.frombuffer(x["items"], np.uint64) for x in qs]
                n = np.array([len(x) for x in q])
                values, number = np.unique(np.concatenate(q), return_inverse=True)
                order = np.argsort(number, kind="stable")
                whose, first = np.repeat(np.arange(len(q)), n)[order], np.append(0, np.cumsum(np.bincount(number)))
                links = same = 0
                for x in rs:
                    items = np.frombuffer(x["items"], np.uint64)
                    at = np.searchsorted(values, items)
                    at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == items)]
                    both = np.bincount(np.concatenate([whose[first[i] : first[i + 1]] for i in at.tolist()]), minlength=len(q)) if len(at) else np.zeros(len(q), int)
                    for i in np.flatnonzero(100 * both >= percent * (n + len(items) - both)).tolist():
                        if qs[i]["row"] != x["row"]:
                            links += 1
                            same += qs[i]["group"] == x["group"]
                yield pa.RecordBatch.from_arrays([pa.array([links]), pa.array([same])], ["links", "same"])

    got = queries.join(held, "part").select("q", "r").mapInArrow(compare, "links long, same long")
    return tuple(got.agg(F.coalesce(F.sum("links"), F.lit(0)), F.coalesce(F.sum("same"), F.lit(0))).first())


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)
