"""Slides from inputs: lists, single paths or sequences, resolved where the files are, with their companions.

    slides = resolved(spark, "list.txt", root="/data")   # ordinal, source, entrypoint, slide_id, sidecars

An input that is missing, of another kind or without a DICOM file fails the query, and so do two inputs of one slide_id with
different contents. A repeated path, and an input of one slide_id with the same content, is left out: the first stays.
Contents are read only of inputs whose slide_id is taken, in a stage of their own; windows hold ids and hashes.
"""

from __future__ import annotations

import glob
import hashlib
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import inputs

SPEC = "ordinal long, source string, entrypoint string, slide_id string, sidecars array<string>, error string"


def listed(spark: SparkSession, value) -> DataFrame:
    """ordinal, path: lines of a .txt file that exists (blank ones dropped), a single path, or the members of a sequence."""
    if isinstance(value, (str, os.PathLike)):
        path = os.fspath(value)
        if path.lower().endswith(".txt") and os.path.isfile(path):
            # one file, read in order: the place in the file is the ordinal
            lines = spark.read.text(f"file://{os.path.abspath(path)}", wholetext=True)
            rows = lines.select(F.posexplode(F.split("value", "\r\n|\r|\n")).alias("ordinal", "path"))
            return rows.select(F.col("ordinal").cast("long"), inputs.unquoted(F.col("path")).alias("path")).where("path != ''")
        value = [path]
    rows = [(i, os.fspath(v)) for i, v in enumerate(value)]
    return spark.createDataFrame(rows, "ordinal long, path string").select("ordinal", inputs.unquoted(F.col("path")).alias("path"))


def resolve(path: str) -> tuple:
    """source, entrypoint, slide_id, sidecars of one path."""
    source = os.path.realpath(os.path.expanduser(path))
    if not os.path.exists(source):
        raise FileNotFoundError(source)
    name = os.path.basename(source)
    if os.path.isdir(source):
        found = sorted(os.path.basename(f) for f in glob.glob(os.path.join(glob.escape(source), "*.dcm")))
        volume = [f for f in found if f.startswith("4_")]
        if not found:
            raise ValueError(f"no DICOM file in {source}")
        entry = "4_1.dcm" if "4_1.dcm" in found else (volume or found)[0]
        return source, os.path.join(source, entry), name, []
    stem, kind = os.path.splitext(name)
    if kind.lower()[1:] not in (*inputs.EXTENSIONS, "png"):
        raise ValueError(f"not a kind of slide: {kind or '<none>'}")
    beside = os.path.splitext(source)[0]
    return source, source, stem, [beside] if kind.lower() == ".mrxs" and os.path.isdir(beside) else []


def checksum(source: str, entrypoint: str, sidecars) -> str:
    """SHA-256 over all files of a slide, each with its place and size before it."""
    digest = hashlib.sha256()
    for i, top in enumerate([source] if os.path.isdir(source) else [entrypoint, *sidecars]):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(top) for f in fs) if os.path.isdir(top) else [top]
        for path in sorted(files, key=lambda p: p.split(os.sep)):
            label = f"{i}:{os.path.relpath(path, top).replace(os.sep, '/') if os.path.isdir(top) else ''}".encode()
            for number, data in ((len(label), label), (os.path.getsize(path), b"")):
                digest.update(number.to_bytes(8, "big") + data)
            with open(path, "rb") as f:
                while chunk := f.read(1 << 20):
                    digest.update(chunk)
    return digest.hexdigest()


def specs(rows: DataFrame, root: str | None = None) -> DataFrame:
    """A row for each path, with its error if it does not resolve."""

    def run(frames):
        for pdf in frames:
            out = []
            for ordinal, path in zip(pdf["ordinal"], pdf["path"]):
                try:
                    out.append((ordinal, *resolve(path), None))
                except Exception as e:
                    out.append((ordinal, path, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SPEC.split(", ")])

    where = inputs.absolute(F.col("path"), root) if root else F.col("path")
    return rows.select("ordinal", where.alias("path")).mapInPandas(run, SPEC)


def with_actions(rows: DataFrame) -> DataFrame:
    """specs with action: keep, again (a path met before), same (content met before) or conflict."""
    rows = rows.where("error is null").drop("error")
    by_path = Window.partitionBy("entrypoint").orderBy("ordinal")
    rows = rows.withColumn("again", F.row_number().over(by_path) > 1)
    fresh = rows.where(~F.col("again"))
    many = fresh.groupBy("slide_id").agg(F.count("*").alias("n"), F.min("ordinal").alias("first")).where("n > 1").drop("n")

    def sums(frames):
        for pdf in frames:
            yield pd.DataFrame({"ordinal": pdf["ordinal"], "sum": [checksum(*x) for x in zip(pdf["source"], pdf["entrypoint"], pdf["sidecars"])]})

    hashed = fresh.join(many, "slide_id", "left_semi").select("ordinal", "source", "entrypoint", "sidecars").mapInPandas(sums, "ordinal long, sum string")
    own = fresh.select("ordinal", "slide_id").join(many, "slide_id").join(hashed, "ordinal")
    first = own.where("ordinal = first").select("slide_id", F.col("sum").alias("first_sum"))
    told = own.join(first, "slide_id").select("ordinal", F.when(F.col("ordinal") == F.col("first"), "keep").when(F.col("sum") == F.col("first_sum"), "same").otherwise("conflict").alias("told"))
    return rows.join(told, "ordinal", "left").withColumn("action", F.when(F.col("again"), "again").otherwise(F.coalesce("told", F.lit("keep")))).drop("again", "told")


def resolved(spark: SparkSession, value, root: str | None = None) -> DataFrame:
    """ordinal, source, entrypoint, slide_id, sidecars of the slides; fails where an input does, or none is left."""
    rows = specs(listed(spark, value), root)
    bad = rows.where("error is not null").orderBy("ordinal").limit(1).collect()
    if bad:
        kind, _, text = bad[0]["error"].partition(": ")
        raise {"FileNotFoundError": FileNotFoundError}.get(kind, ValueError)(text)
    told = with_actions(rows)
    clash = told.where("action = 'conflict'").orderBy("ordinal").limit(1).collect()
    if clash:
        raise ValueError(f"one slide_id, several contents: {clash[0]['slide_id']!r}, {clash[0]['entrypoint']}")
    kept = told.where("action = 'keep'").drop("action")
    if not kept.limit(1).count():
        raise ValueError("no inputs")
    return kept
