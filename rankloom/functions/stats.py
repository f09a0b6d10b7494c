"""Aggregates and arithmetic with the guards that ANSI mode and degenerate groups need."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def pearson(x: Column, y: Column, over: WindowSpec | None = None) -> Column:
    """Correlation of a group as an aggregate, or over a window; 0 if either is constant, not finite, or of one row."""
    sx, sy, xy, n = (a if over is None else a.over(over) for a in (F.stddev_pop(x), F.stddev_pop(y), F.covar_pop(x, y), F.count(x)))
    usable = finite(sx) & finite(sy) & (sx > 0) & (sy > 0) & (n > 1)
    return F.when(usable, F.try_divide(xy, sx * sy)).otherwise(F.lit(0.0))


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def mse(prediction: Column, target: Column) -> Column:
    return F.avg((prediction - target) * (prediction - target))


def mae(prediction: Column, target: Column) -> Column:
    return F.avg(F.abs(prediction - target))


def smooth_l1(prediction: Column, target: Column, beta: float = 1.0) -> Column:
    gap = F.abs(prediction - target)
    return F.avg(F.when(gap < beta, gap * gap * 0.5 / beta).otherwise(gap - 0.5 * beta))


def denormalised(x: Column, mean: float, std: float, mode: str = "train_zscore") -> Column:
    return x * F.lit(std) + F.lit(mean) if mode == "train_zscore" else x


def normalised(x: Column, mean: float, std: float, mode: str = "train_zscore", clip: float | None = None) -> Column:
    """z-score, clipped to [-clip, clip] if asked; the clip holds without the z-score too."""
    z = (x - F.lit(mean)) / F.lit(std) if mode == "train_zscore" else x
    return z if clip is None else F.greatest(F.lit(-float(clip)), F.least(F.lit(float(clip)), z))


def contiguous_shard(position: Column, total: int, shards: int) -> Column:
    """Shard of a 0-based position when the first total % shards shards get one row more."""
    size, more = divmod(total, shards)
    wide = F.lit(more * (size + 1))
    narrow = F.floor((position - wide) / F.lit(max(size, 1))) + F.lit(more)
    return F.when(position < wide, F.floor(position / F.lit(size + 1))).otherwise(narrow).cast("int")


def floor_shard_bounds(rank: Column, total: Column, shards: int) -> tuple[Column, Column]:
    """Start and end of a rank's rows when bounds are floors of equal shares."""
    return F.floor(total * rank / F.lit(shards)).cast("long"), F.floor(total * (rank + 1) / F.lit(shards)).cast("long")


def batch_seed(base: int, generator: Column, start: Column) -> Column:
    """Fixed formula: a seed of its own for each generator and micro-batch."""
    return F.lit(base) + generator * F.lit(1_000_003) + start * F.lit(97)
