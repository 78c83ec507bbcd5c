"""Token counts by whole-token shortcut.

In this kind of model no piece has a space mark after another character, so that a text falls apart before each run of
space marks, and the parts encode independently. For every vocabulary string it is proved once, with the library, whether
it encodes alone as one token; parts that are such strings count one. Only the rest are merged, each distinct one once in
a while: a bounded table keeps their counts. Proofs and table are a worker's, for all its tasks.

Defined cases: null and empty texts have 0 bytes and 0 tokens; texts are never cut; repeated rows stay rows; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import once, pieces, table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: So many counts of merged parts are kept in a worker (about 120 bytes each).
KEPT = 600_000
MARK = "▁"


class PieceCounter:
    """Counts tokens as sentencepiece does, without begin and end."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        spec = proto.normalizer_spec
        kinds = pb.ModelProto.SentencePiece
        own = [p.piece for p in proto.pieces if p.type == kinds.NORMAL]
        marked = any(MARK in p.lstrip(MARK) for p in own)
        special = any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        # the split is sound only if nothing is normalised, no piece crosses it and nothing is matched before merging
        self.splits = not (marked or special or spec.precompiled_charsmap or spec.remove_extra_whitespaces) and spec.escape_whitespaces and spec.add_dummy_prefix and not proto.trainer_spec.treat_whitespace_as_suffix
        proto.normalizer_spec.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        proved = [p for p, ids in zip(own, self.bare.encode(own, num_threads=1)) if len(ids) == 1] if self.splits else []
        self.single = dict.fromkeys(proved, 1)
        # a line end is in no piece, so that a text also falls apart around it
        self.lines = self.splits and not any("\n" in p for p in own)
        self.counts = dict(self.single)
        self.part = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if self.lines else f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(x) for x in self.whole.encode(texts, num_threads=1)]
        if len(self.counts) > KEPT + len(self.single):
            self.counts = dict(self.single)
        parts = [self.part.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.counts
        new = list({p for x in parts for p in x if p not in known})
        if new:
            known.update(zip(new, map(len, self.bare.encode(new, num_threads=1))))
        get = known.__getitem__
        return [sum(map(get, x)) for x in parts]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches):
        counter = once(("pieces", path), lambda: PieceCounter(path))
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            n = []
            for i, j in pieces(texts, 2 << 20):
                n += counter.count(texts[i:j])
            n = pa.array(n, pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, n, pa.array([x > limit for x in n.to_pylist()], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(model))
