"""A corpus pipeline: toxic texts go, one text of each group of near copies stays, repeated passages go, sources are mixed
to their weights, and what is left is encoded and decoded by byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs. All but the last return the columns of docs.

Defined cases are those of the operators that the stages call.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tesselith.llm import bpe, minhash_forest, mixing, phrase_automata, toxicity
from tesselith.llm.common import shared_dir, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.keep_one(docs, k=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrase_automata.remove_repeated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256: the decoded bytes are those of the text."""
    return bpe.encode_and_verify(docs, public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Hashed signatures, automata and random rounding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
