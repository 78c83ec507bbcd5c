"""Shared helpers: durable intermediate tables, Arrow stages and bounded caches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of bytes other than the six ASCII white spaces.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: executors need a folder that they share with the driver")
    return _own_dirs.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tesselith-"))


#: With this on, what a write has shuffled is deleted at its end, when its result is safe.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, what: str = "t") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete what stored() wrote for df, once nothing reads it any more."""
    spark = df.sparkSession
    for f in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: A class is joined to its rows in so many places, so that a class that holds a third of all rows is not one task's.
SALTS = 16


def joined_to_class(rows: DataFrame, classes: DataFrame, key: str, spread: str) -> DataFrame:
    """rows left joined with classes (a row a key, of keys with several rows) on key; the column spread tells rows of a class apart."""
    salted = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(salted, [key, "salt"], "left").drop("salt")


_made: dict = {}


def once(key: tuple, make: Callable):
    """What make gives, made once in a worker process and not for each task: coders, models, their caches."""
    if key not in _made:
        _made[key] = make()
    return _made[key]


def pieces(values: list, most_bytes: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of a list of texts with about most_bytes each, so that work space stays bounded."""
    start = size = 0
    for i, v in enumerate(values):
        size += len(v) if v else 0
        if size >= most_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


def n_words(text):
    """Column: number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
