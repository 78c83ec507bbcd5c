"""Coverage of rectangles by a mask: a containment join solved by prefix sums.

Each slide's inclusive prefix sums are one array, bounded by the thumbnail's size. All places of a slide are counted within
its own row, and only the counts leave it: neither pixels nor sums are joined or copied to places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def integral(cells: DataFrame, slides: DataFrame, side: int) -> DataFrame:
    """slide_id, sums: prefix sums of a side x side mask, row by row, from its cells that are on."""
    grid = slides.select("slide_id", F.explode(F.sequence(F.lit(0), F.lit(side * side - 1))).alias("p"))
    grid = grid.select("slide_id", F.floor(F.col("p") / side).cast("long").alias("row"), (F.col("p") % side).cast("long").alias("col"))
    dense = grid.join(cells.withColumn("on", F.lit(1).cast("long")), ["slide_id", "row", "col"], "left").withColumn("on", F.coalesce("on", F.lit(0)))
    running = lambda by, to: Window.partitionBy("slide_id", by).orderBy(to).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dense = dense.withColumn("s", F.sum("on").over(running("row", "col"))).withColumn("s", F.sum("s").over(running("col", "row")))
    return dense.groupBy("slide_id").agg(F.sort_array(F.collect_list(F.struct("row", "col", "s", "on"))).alias("x")).select("slide_id", F.transform("x", lambda x: x["s"]).alias("sums"), F.transform("x", lambda x: x["on"]).alias("mask"))


def box(x: Column, span, slide_side: Column, side: int) -> tuple[Column, Column]:
    clamp = lambda v: F.greatest(F.lit(0), F.least(F.lit(side), v)).cast("int")
    return clamp(F.floor(x * side / slide_side)), clamp(F.ceil((x + span) * side / slide_side))


def places(slides: DataFrame, side: int, patch: int, stride: int) -> DataFrame:
    """slides: slide_id, width, height, sums, mask. A row for each place of the grid with x0, y0, total and area of its box,
    and whether the mask is on under its middle; none where a side is too short."""
    at = lambda r, c: F.when((r == 0) | (c == 0), F.lit(0)).otherwise(F.element_at("sums", (r - 1) * side + c))
    middle = lambda v, slide_side: F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((v + patch / 2.0) * side / slide_side))).cast("int")

    def one(x, y):
        (left, right), (top, bottom) = box(x, patch, F.col("width"), side), box(y, patch, F.col("height"), side)
        total = at(bottom, right) - at(top, right) - at(bottom, left) + at(top, left)
        on = F.element_at("mask", middle(y, F.col("height")) * side + middle(x, F.col("width")) + 1) == 1
        return F.struct(x.alias("x0"), y.alias("y0"), total.alias("total"), ((right - left) * (bottom - top)).cast("long").alias("area"), on.alias("center_on"))

    steps = lambda c: F.sequence(F.lit(0).cast("long"), (F.col(c) - patch).cast("long"), F.lit(stride).cast("long"))
    found = F.flatten(F.transform(steps("height"), lambda y: F.transform(steps("width"), lambda x: one(x, y))))
    fits = (F.col("width") >= patch) & (F.col("height") >= patch)
    out = slides.select("slide_id", "width", "height", F.explode(F.when(fits, found)).alias("p")).select("slide_id", "width", "height", "p.*")
    return out.withColumn("coverage", F.when(F.col("area") > 0, F.col("total") / F.col("area")).otherwise(0.0))
