"""Choosing a region among heuristics' decisions, chains of patch filters, and their conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_CONFIDENCE, MIN_RECALL, MAX_AREA_RATIO = 0.65, 0.90, 3.5


def gate(decisions: DataFrame, least: dict[str, float]) -> DataFrame:
    """accepted below its heuristic's least confidence becomes rejected; confidence is clipped to 0..1."""
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("confidence")))
    need = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in least.items() for v in kv]), F.col("name")) if least else F.lit(None).cast("double"), F.lit(0.0))
    return decisions.withColumn("confidence", clipped).withColumn("status", F.when((F.col("status") == "accepted") & (F.col("confidence") < need), "rejected").otherwise(F.col("status")))


def first_success(decisions: DataFrame) -> DataFrame:
    """The accepted decision of each slide that comes first."""
    w = Window.partitionBy("slide_id").orderBy("pos")
    return decisions.where("status = 'accepted' and area > 0").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def thresholds(common: dict, own: dict) -> dict:
    """Arguments of arbitrate() from settings: what holds for all, and what single heuristics set for themselves."""
    names = {"arbitration_min_confidence": "least", "min_density_recall": "recall", "max_density_area_ratio": "ratio", "density_guard": "guard"}
    shared = {"least": "min_specialized_confidence", "recall": "min_density_recall", "ratio": "max_density_area_ratio"}
    per = {h: {names[k]: v for k, v in o.items() if k in names} for h, o in own.items()}
    return {k: float(common[v]) for k, v in shared.items() if v in common} | {"own": {h: o for h, o in per.items() if o}}


def arbitrate(decisions: DataFrame, least: float = MIN_CONFIDENCE, recall: float = MIN_RECALL, ratio: float = MAX_AREA_RATIO, own: dict | None = None) -> DataFrame:
    """Of each slide the surest decision that is safe against its first accepted density region; without that, the first.

    own has least, recall, ratio and guard (whether recall and ratio count at all) of single heuristics.
    """
    ok = decisions.where("status = 'accepted' and area > 0")
    w = Window.partitionBy("slide_id")
    ok = ok.withColumn("ref", F.min(F.when(F.col("name") == "density", F.struct("pos", "area"))).over(w))
    set_ = lambda key, default: _by_name({h: o[key] for h, o in (own or {}).items() if key in o}, default)
    has_recall = F.col("overlap") / F.greatest(F.lit(1), F.col("ref.area")) >= set_("recall", recall)
    has_ratio = F.col("area") / F.greatest(F.lit(1), F.col("ref.area")) <= set_("ratio", ratio)
    is_ref = F.col("ref").isNotNull() & (F.col("pos") == F.col("ref.pos"))
    safe = F.col("ref").isNotNull() & ~is_ref & (F.col("confidence") >= set_("least", least)) & (~set_("guard", True) | (has_recall & has_ratio))
    # safe ones by confidence, then place; then density; without density the first
    tier = F.when(safe, 0).when(is_ref, 1).when(F.col("ref").isNull(), 2)
    order = [F.col("tier"), F.when(F.col("tier") == 0, -F.col("confidence")).otherwise(0.0), F.col("pos")]
    ok = ok.withColumn("tier", tier).where("tier is not null")
    return ok.withColumn("rn", F.row_number().over(w.orderBy(*order))).where("rn = 1").drop("rn", "ref", "tier")


def _by_name(values: dict, default) -> Column:
    out = F.lit(default)
    for name, v in values.items():
        out = F.when(F.col("name") == name, F.lit(type(default)(v))).otherwise(out)
    return out


def filter_chain(rows: DataFrame, filters: list[tuple[str, Column]]) -> DataFrame:
    """kept and reason: filters in order, the first that rejects gives the reason; an unknown outcome (error) rejects."""
    reason = F.lit(None).cast("string")
    for name, keep in reversed(filters):
        reason = F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)).otherwise(reason)
    return rows.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())


def softmax_of_two(zero: Column, one: Column) -> Column:
    return 1.0 / (1.0 + F.exp(zero - one))
