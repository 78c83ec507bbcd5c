"""Patch planning: effective sizes, grids, names, sampling, shards."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scaled(size: int, target_mpp, mpp: Column, downsample: Column, otherwise: int) -> Column:
    """A size at the target resolution, half to even, 1 at least; unchanged where a resolution is missing."""
    return F.when(mpp.isNotNull() & F.lit(target_mpp).isNotNull(), F.greatest(F.lit(1.0), F.bround(F.lit(float(size)) * (F.lit(target_mpp) / (mpp * downsample)))).cast("long")).otherwise(F.lit(otherwise).cast("long"))


def output_mpp(target_mpp, mpp: Column, downsample: Column, patch: int, output: int) -> Column:
    return F.coalesce(F.lit(target_mpp).cast("double"), mpp * downsample * patch / output)


def grid(slides: DataFrame, width: str, height: str, patch, stride, downsample=1.0) -> DataFrame:
    """A row for each place of the grid, with lx, ly at the level and x0, y0 at level 0; none where a side is too short."""
    steps = lambda side: F.when((F.col(width) >= patch) & (F.col(height) >= patch), F.sequence(F.lit(0).cast("long"), (F.col(side) - patch).cast("long"), F.lit(stride).cast("long") if isinstance(stride, int) else stride))
    out = slides.withColumn("ly", F.explode(steps(height))).withColumn("lx", F.explode(steps(width)))
    return out.withColumn("x0", F.bround(F.col("lx") * downsample).cast("long")).withColumn("y0", F.bround(F.col("ly") * downsample).cast("long"))


def numbered(plans: DataFrame, by=("y0", "x0")) -> DataFrame:
    """With index: 0, 1, ... in each slide, in grid order."""
    return plans.withColumn("index", (F.row_number().over(Window.partitionBy("slide_id").orderBy(*by)) - 1).cast("long"))


def twelve_digits(x: str) -> Column:
    """The column x with up to 12 significant digits and no trailing zeros, for values from 0.0001 to below 1e12."""
    return F.expr(f"regexp_replace(format_string(concat('%.', cast(greatest(0, 11 - cast(floor(log10({x})) as int)) as string), 'f'), {x}), '([.]0+$)|((?<=[.][0-9]{{0,20}}[1-9])0+$)', '')")


def patch_name(x: str, y: str, mpp: str, size: int) -> Column:
    """Name of a patch, null where the resolution is missing or not above zero."""
    name = F.concat(F.lit("x"), F.col(x).cast("string"), F.lit("_y"), F.col(y).cast("string"), F.lit("_mpp"), twelve_digits(mpp), F.lit(f"_px{size}"))
    return F.when(F.col(mpp) > 0, name)


def uniform_places(n: Column, most: int) -> Column:
    """Places of at most `most` evenly spread rows out of n: the floor of a linear ramp whose last value is n - 1."""
    ramp = F.transform(F.sequence(F.lit(0), F.lit(max(most - 1, 0))), lambda i: F.when((i == most - 1) & F.lit(most > 1), n - 1).otherwise(F.floor(i * ((n - 1).cast("double") / max(most - 1, 1)))).cast("long"))
    return F.when(n <= most, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(ramp)


def sample_uniform(plans: DataFrame, most: int) -> DataFrame:
    """Evenly spread rows of each slide, numbered anew."""
    n = plans.withColumn("n", F.count("*").over(Window.partitionBy("slide_id")))
    kept = n.where(F.array_contains(uniform_places(F.col("n"), most), F.col("index"))).drop("n")
    return numbered(kept.drop("index"))


def sample_first(plans: DataFrame, most: int) -> DataFrame:
    return plans.where(F.col("index") < most) if most > 0 else plans


def sample_random(plans: DataFrame, most: int, seed: int) -> DataFrame:
    """The same places that NumPy's default generator chooses without replacement, in grid order."""
    counts = plans.groupBy("slide_id").agg(F.count("*").alias("n"))

    @F.pandas_udf("array<long>")
    def chosen(n: pd.Series) -> pd.Series:
        return n.map(lambda k: np.sort(np.random.default_rng(seed).choice(k, most, replace=False)) if 0 < most < k else np.arange(k))

    places = counts.select("slide_id", F.explode(chosen("n")).alias("index"))
    return numbered(plans.join(places, ["slide_id", "index"], "left_semi").drop("index"))


def shards(rows: DataFrame, most: int, order: str = "index", existing=0) -> DataFrame:
    """With shard number and file name: rows of each slide in order, `most` to a shard, after those that exist."""
    rn = F.row_number().over(Window.partitionBy("slide_id").orderBy(order)) - 1
    number = (F.floor(rn / most) + 1 + existing).cast("long")
    return rows.withColumn("shard", number).withColumn("file", F.format_string("%s_%04d.tar", F.col("slide_id").cast("string"), number))


# One slide at a time, for steps in which its mask is at hand anyway: the same rules over arrays.


def downsample(levels, downsamples, level: int) -> float:
    if not 0 <= level < len(levels):
        raise ValueError(f"no level {level}")
    if level >= len(downsamples) or not downsamples[level] > 0:
        raise ValueError(f"no downsample for level {level}")
    return float(downsamples[level])


def effective(patching, mpp: float | None, down: float):
    """Settings with the read size and stride that give the target resolution; as they are where one is not known."""
    if patching.mpp is None or mpp is None:
        return patching
    scale = patching.mpp / (mpp * down)
    return replace(patching, patch_size=max(1, round(patching.output_size * scale)), stride=max(1, round(patching.stride * scale)))


def known_mpp(patching, mpp: float | None, down: float) -> float | None:
    """The resolution of what is written: the target, or that of the read size; None where neither is known."""
    if patching.mpp is not None or mpp is None:
        return patching.mpp
    return mpp * down * patching.patch_size / patching.output_size


def slide_plans(mask: np.ndarray, size: tuple[int, int], levels, downsamples, p) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x and y at level 0, and coverage, of the places of the level's grid that the mask admits, sampled if there are too many."""
    down = downsample(levels, downsamples, p.level)
    (lw, lh), (w, h), (rows, cols) = levels[p.level], size, mask.shape
    if p.patch_size > lw or p.patch_size > lh:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float)
    at = lambda n: np.rint(np.arange(0, n - p.patch_size + 1, p.stride) * down).astype(np.int64)
    y, x = (v.ravel() for v in np.meshgrid(at(lh), at(lw), indexing="ij"))
    extent = p.patch_size * down
    edge = lambda v, n, side, f: np.clip(f(v * n / side), 0, n).astype(np.int64)
    a, c = edge(x, cols, w, np.floor), edge(x + extent, cols, w, np.ceil)
    b, d = edge(y, rows, h, np.floor), edge(y + extent, rows, h, np.ceil)
    sums = np.pad(mask.astype(np.int64), ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    total, area = sums[d, c] - sums[b, c] - sums[d, a] + sums[b, a], (c - a) * (d - b)
    coverage = np.where(area > 0, total / np.maximum(area, 1), 0.0)
    if p.inclusion == "full":
        keep = (area > 0) & (total == area)
    elif p.inclusion == "center":
        middle = lambda v, n, side: np.clip(((v + extent / 2) * n / side).astype(np.int64), 0, n - 1)
        keep = mask[middle(y, rows, h), middle(x, cols, w)]
    else:
        keep = coverage >= p.min_region_fraction
    x, y, coverage = x[keep], y[keep], coverage[keep]
    n, most = len(x), p.max_patches_per_slide
    if 0 < most < n:
        if p.sampling == "random":
            places = np.sort(np.random.default_rng(p.seed).choice(n, size=most, replace=False))
        else:
            places = np.arange(most) if p.sampling == "all" else np.linspace(0, n - 1, num=most, dtype=int)
        x, y, coverage = x[places], y[places], coverage[places]
    return x, y, coverage


def preview_sample(n: int, most: int, seed: int) -> list[int]:
    """The first places of a random order of n."""
    return np.random.default_rng(seed).permutation(n)[:most].tolist() if min(n, most) > 0 else []
