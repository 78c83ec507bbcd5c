"""Embedding near-dedup by NN-descent.

Equal vectors of one label are one node. Neighbour lists begin with neighbours in ORDERS orders by random hyperplanes and
improve by rounds: each node compares its neighbours with one another. Pairs at the threshold or above are kept
for good. An audit then compares a query set of each label (about ASKED nodes, all of a smaller label) with all rows of
the label, in blocks: its cost grows with the rows, not with their square. Recall is averaged over query nodes of one label and one power of two of links, so that large groups do not
outweigh small ones; labels with an average below AUDIT get more orders and rounds, and after ATTEMPTS all their
rows are compared block with block. A list that is saturated, all of it above the threshold, may hide links: it is enlarged to its
whole component, whose members are compared block with block, so that links are counted and not written out.

Defined cases: a null label, a null, empty or zero vector, null or non-finite components or another number of
dimensions than the label's vectors it meets: linked with nothing; equal vectors are links of each other; rows with one
vec_id are rows of their own; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stored, stored, table
from .components import components

THRESHOLD = 0.93
NEIGHBOURS, ROUNDS, ORDERS, REACH = 8, 2, 16, 4
AUDIT, ATTEMPTS = 0.995, 4
BLOCK = 512
#: Query nodes of a label, about, however many rows it has; of a label with as many nodes or fewer all are asked.
ASKED = 512


def _unit(vectors: list[bytes]) -> np.ndarray:
    """Vectors of length 1, in double precision. Doubles have one byte more than their numbers take."""
    wide = bool(vectors) and len(vectors[0]) % 4 == 1
    kind, n = (np.float64, 8) if wide else (np.float32, 4)
    raw = np.frombuffer(b"".join(vectors), np.uint8).reshape(len(vectors), -1)
    x = np.ascontiguousarray(raw[:, : raw.shape[1] // n * n]).view(kind).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(rows: DataFrame) -> DataFrame:
    """vec_id, node, label, vec: node is null where a row links with nothing; label is dimension and label as one text."""
    wide = rows.schema["embedding"].dataType.simpleString() != "array<float>"
    kind, end = (np.float64, b"d") if wide else (np.float32, b"")

    def run(batches):
        for b in batches:
            node, vec, label = [], [], []
            for v, y in zip(b.column("embedding").to_pylist(), b.column("label").to_pylist()):
                x = np.array(v, kind) if v and y is not None and None not in v else None
                good = x is not None and np.isfinite(x).all() and x.any()
                vec.append((x + kind(0)).tobytes() + end if good else None)
                label.append(f"{len(x)}:{y}" if good else None)
                node.append(int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(label[-1].encode() + vec[-1])))) if good else None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(node, pa.int64()), pa.array(label, pa.string()), pa.array(vec, pa.binary())], ["vec_id", "node", "label", "vec"])

    numbers = F.col("embedding").cast("array<double>" if wide else "array<float>")
    return rows.select("vec_id", numbers.alias("embedding"), F.col("label").cast("string").alias("label")).mapInArrow(run, "vec_id long, node long, label string, vec binary")


def ordered_pairs(nodes: DataFrame, first: int, orders: int) -> DataFrame:
    """a, b, sim of neighbours, up to REACH apart, in orders by signs of random projections."""

    def keys(batches):
        for b in batches:
            if not b.num_rows:
                continue
            label = np.array(b.column("label").to_pylist())
            for one in np.unique(label):
                at = np.flatnonzero(label == one)
                part = b.take(pa.array(at))
                x = _unit(part.column("vec").to_pylist())
                for k in range(first, first + orders):
                    planes = np.random.default_rng(1000 + k).standard_normal((x.shape[1], 24))
                    key = ((x @ planes) > 0) @ (1 << np.arange(24)[::-1])
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.int32()), part.column("label"), pa.array(key.astype(np.int64)), part.column("node"), part.column("vec")], ["k", "label", "key", "node", "vec"])

    def near(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            group = pdf["k"].astype(str) + ":" + pdf["label"]
            cuts = np.concatenate(([0], np.flatnonzero(group.to_numpy()[1:] != group.to_numpy()[:-1]) + 1, [len(pdf)]))
            for s, e in zip(cuts[:-1], cuts[1:]):
                x, node = _unit(pdf["vec"].iloc[s:e].tolist()), pdf["node"].to_numpy()[s:e]
                for d in range(1, min(REACH, len(node) - 1) + 1):
                    sim = np.einsum("ij,ij->i", x[:-d], x[d:])
                    yield pd.DataFrame({"a": np.minimum(node[:-d], node[d:]), "b": np.maximum(node[:-d], node[d:]), "sim": sim})
            rest = pdf.iloc[-REACH:]

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.mapInArrow(keys, "k int, label string, key long, node long, vec binary")
    rows = rows.repartitionByRange(parts, "k", "label", "key", "node").sortWithinPartitions("k", "label", "key", "node")
    return rows.mapInPandas(near, "a long, b long, sim double").where("a != b").groupBy("a", "b").agg(F.max("sim").alias("sim"))


def lists(pairs: DataFrame) -> DataFrame:
    """v, u, sim, least: the NEIGHBOURS best of each node, and the worst likeness among them."""
    both = pairs.select(F.col("a").alias("v"), F.col("b").alias("u"), "sim").union(pairs.select("b", "a", "sim"))
    w = Window.partitionBy("v").orderBy(F.col("sim").desc(), "u")
    best = both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= NEIGHBOURS)
    return best.withColumn("least", F.min("sim").over(Window.partitionBy("v"))).select("v", "u", "sim", "least")


def descend(pairs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """a, b, sim: better pairs among the neighbours, either way, of each node; and the lists, which are stored."""
    best = stored(lists(pairs), "lists")
    least = best.groupBy("v").agg(F.min("least").alias("least")).withColumnRenamed("v", "u")
    around = best.select("v", "u", "sim").union(best.select(F.col("u").alias("v"), F.col("v").alias("u"), "sim")).distinct()
    w = Window.partitionBy("v").orderBy(F.xxhash64("u"))
    around = around.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 2 * NEIGHBOURS)  # reverse lists are sampled, as usual
    around = around.join(least, "u").join(nodes.select(F.col("node").alias("u"), "vec"), "u").select("v", "u", "least", "vec")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            v = pdf["v"].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(v[1:] != v[:-1]) + 1))
            out = []
            u, low = pdf["u"].to_numpy(), pdf["least"].to_numpy()
            x = _unit(pdf["vec"].tolist())
            for s, e in zip(cuts[:-1], cuts[1:]):
                sims = x[s:e] @ x[s:e].T
                i, j = np.nonzero(np.triu((sims > np.minimum.outer(low[s:e], low[s:e])) | (sims >= THRESHOLD), 1))
                if len(i):
                    out.append(pd.DataFrame({"a": np.minimum(u[s + i], u[s + j]), "b": np.maximum(u[s + i], u[s + j]), "sim": sims[i, j]}))
            rest = pdf.iloc[cuts[-1] :]
            if out:
                yield pd.concat(out)
        if rest is not None and len(rest):
            u, x = rest["u"].to_numpy(), _unit(rest["vec"].tolist())
            i, j = np.triu_indices(len(u), 1)
            yield pd.DataFrame({"a": np.minimum(u[i], u[j]), "b": np.maximum(u[i], u[j]), "sim": (x @ x.T)[i, j]})

    dealt = around.repartition(parts, "v").sortWithinPartitions("v", "u")
    return dealt.mapInPandas(compare, "a long, b long, sim double").where("a != b"), best


def audit(nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """label, size, recall: the mean share of a query node's links that comp accounts for, by label and power of two of links.

    Links are found by comparing each query node with all rows of its label. Accounted for is what lies in one component, as
    components are compared in full. Queries go in blocks of one label.
    """
    sized = nodes.join(nodes.groupBy("label").agg(F.count("*").alias("n")), "label").join(comp.withColumnRenamed("id", "node"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    parts = F.ceil(F.col("n") / (8 * BLOCK)).cast("int")
    q = sized.where(F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("n") / ASKED)) == 0)
    q = q.withColumn("asks", F.count("*").over(Window.partitionBy("label"))).withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("asks") / BLOCK)))
    q = q.groupBy("label", "block").agg(F.collect_list(F.struct("node", "comp", "vec")).alias("q"), F.first(parts).alias("parts"))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))  # a task has one part of a label's rows, not all
    cut = sized.withColumn("part", F.pmod(F.hash("node"), parts))
    cut = cut.groupBy("label", "part").agg(F.collect_list(F.struct("node", "comp", "vec")).alias("rows"))

    def compare(batches):
        for b in batches:
            for label, qs, rows in zip(b.column("label").to_pylist(), b.column("q").to_pylist(), b.column("rows").to_pylist()):
                node, of = np.array([r["node"] for r in qs]), np.array([r["comp"] for r in qs])
                near = _unit([r["vec"] for r in qs]) @ _unit([r["vec"] for r in rows]).T >= THRESHOLD
                near &= node[:, None] != np.array([r["node"] for r in rows])
                got = near & (of[:, None] == np.array([r["comp"] for r in rows]))
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(qs)), pa.array(node), pa.array(near.sum(axis=1)), pa.array(got.sum(axis=1))], ["label", "node", "links", "got"])

    each = q.join(cut, ["label", "part"]).select("label", "q", "rows").mapInArrow(compare, "label string, node long, links long, got long")
    each = each.groupBy("label", "node").agg(F.sum("links").alias("links"), F.sum("got").alias("got")).where("links > 0")
    return each.groupBy("label", F.floor(F.log2("links")).alias("size")).agg(F.avg(F.col("got") / F.col("links")).alias("recall"))


def joined_in_full(nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """a, b: pairs of components of one label that hold a link, from comparing all its rows, block with block.

    Of each two blocks only a forest that joins components is written out, not their links.
    """
    sized = nodes.join(nodes.groupBy("label").agg(F.count("*").alias("n")), "label").join(comp.withColumnRenamed("id", "node"), "node", "left")
    blocks = F.ceil(F.col("n") / (8 * BLOCK)).cast("int")
    own = sized.select("label", "node", F.coalesce("comp", "node").alias("comp"), "vec", blocks.alias("blocks")).withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
    rows = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "comp", "vec")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(g):
        x, (ids, number) = _unit(g["vec"].tolist()), np.unique(g["comp"].to_numpy(), return_inverse=True)
        up = list(range(len(ids)))

        def top(k):
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k

        out = []
        for s in range(0, len(x), BLOCK):
            p, q = np.nonzero(x[s : s + BLOCK] @ x.T >= THRESHOLD)
            p, q = number[s + p], number[q]
            for k in np.unique(p[p < q] * len(ids) + q[p < q]).tolist():
                a, b = top(k // len(ids)), top(k % len(ids))
                if a != b:
                    up[max(a, b)] = min(a, b)
                    out.append((ids[min(a, b)], ids[max(a, b)]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def run(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            label, i, j = (pdf[c].to_numpy() for c in ("label", "i", "j"))
            cuts = np.concatenate(([0], np.flatnonzero((label[1:] != label[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1))
            for s, e in zip(cuts[:-1], cuts[1:]):
                yield join(pdf.iloc[s:e])
            rest = pdf.iloc[cuts[-1] :]
        if rest is not None and len(rest):
            yield join(rest)

    dealt = rows.repartition(parts, "label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
    return dealt.mapInPandas(run, "a long, b long").distinct()


def count_links(members: DataFrame) -> DataFrame:
    """members: comp, node, vec, m. node, links: for each node the rows it is linked with, other than its own node's."""
    sized = members.join(members.groupBy("comp").agg(F.count("*").alias("n")), "comp")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = sized.withColumn("blocks", blocks).withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
    rows = own.select("comp", "node", "vec", "m", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "vec", "m")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(frames):
        rest = None

        def one(g):
            i, j = g["i"].iloc[0], g["j"].iloc[0]
            x, m, node, own_ = _unit(g["vec"].tolist()), g["m"].to_numpy(), g["node"].to_numpy(), g["own"].to_numpy()
            near = x @ x.T >= THRESHOLD
            np.fill_diagonal(near, False)
            if i != j:
                near &= own_[:, None] != own_[None, :]
            return pd.DataFrame({"node": node, "links": near @ m})

        for pdf in frames:
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            key = pdf[["comp", "i", "j"]].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1))
            done = [one(pdf.iloc[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]
            rest = pdf.iloc[cuts[-1] :]
            if done:
                yield pd.concat(done)
        if rest is not None and len(rest):
            yield one(rest)

    dealt = rows.repartition(parts, "comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node")
    return dealt.mapInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def _both(best: DataFrame) -> DataFrame:
    return best.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "sim").distinct()


def near_vectors(rows: DataFrame) -> tuple[DataFrame, float]:
    """vec_id, n_links, component_id, kept for every row; and the least audited recall of a label and size of groups."""
    own = stored(nodes_of(rows), "vectors")
    nodes = stored(own.where("node is not null").groupBy("node").agg(F.min("label").alias("label"), F.min("vec").alias("vec"), F.count("*").alias("m")), "nodes")
    todo = nodes.select("node", "label", "vec")
    graph, links, recall, comp = None, None, 1.0, None
    for attempt in range(ATTEMPTS):
        new, passing = ordered_pairs(todo, attempt * ORDERS, ORDERS), []
        graph = stored(new if graph is None else graph.union(new).distinct(), "graph")
        above = graph.where(F.col("sim") >= THRESHOLD).select("a", "b")
        before, links = links, above if links is None else links.union(above)
        for _ in range(ROUNDS):
            pairs, best = descend(graph, todo)
            better = stored(pairs, "better")
            drop_stored(best)
            links = links.union(better.where(F.col("sim") >= THRESHOLD).select("a", "b"))
            passing += [graph, better]
            graph = stored(_both(lists(graph.union(better).groupBy("a", "b").agg(F.max("sim").alias("sim")))), "graph")
        links = stored(links.distinct(), "links")
        for df in [*passing, *([before] if before is not None else [])]:  # what only led here
            drop_stored(df)
        comp = components(links)
        audited = stored(audit(todo, comp), "audit")
        passed, short = audited.groupBy("label").agg(F.min("recall").alias("r")), audited.where(F.col("recall") < AUDIT).select("label").distinct()
        recall = min(recall, passed.where(F.col("r") >= AUDIT).agg(F.coalesce(F.min("r"), F.lit(1.0))).first()[0])
        todo = stored(todo.join(short, "label", "left_semi"), "short")
        if not todo.limit(1).count():
            break
        graph = graph.join(todo.select(F.col("node").alias("a")), "a", "left_semi")
    else:
        more = stored(joined_in_full(todo, comp), "links")
        if more.limit(1).count():
            comp = components(links.union(more))
    members = comp.withColumnRenamed("id", "node").join(nodes.select("node", "vec", "m"), "node")
    linked = count_links(members)
    named = own.join(comp.withColumnRenamed("id", "node"), "node", "left").withColumn("group", F.coalesce("comp", "node")).join(nodes.select("node", "m"), "node", "left").join(linked, "node", "left")
    least = named.where("group is not null").groupBy("group").agg(F.min("vec_id").alias("least"))
    out = named.join(least, "group", "left").select("vec_id", F.coalesce(F.col("m") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), recall


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))[0]
