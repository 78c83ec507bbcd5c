"""Connected components of a distributed edge list: least labels travel along edges, and labels of labels are taken."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. Returns id, comp for every node of an edge: the least id that can be reached.

    Each round is written to the shared folder. Degrees are no matter: labels are joined to edges (a skewed join can be
    split) and reduced by partial minimum. Rounds grow with the logarithm of a component's width.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    now = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        label = now.select(F.col("id").alias("b"), F.col("comp").alias("c"))
        low = both.join(label, "b").groupBy("a").agg(F.min("c").alias("m")).withColumnRenamed("a", "id")
        hooked = stored(now.join(low, "id").select("id", F.col("comp").alias("was"), F.least("comp", "m").alias("comp")), "hooked")
        top = hooked.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        after = stored(hooked.join(top, "comp").select("id", "was", F.least("comp", "up").alias("comp")), "labels")
        changed = after.where("was != comp").limit(1).count()
        drop_stored(hooked)
        drop_stored(now)
        now = after.select("id", "comp")
        if not changed:
            return now
