"""Ordered operators: first rows, first groups, shards, samples, counts of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import stats as S


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by an explicit order."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows by the hash of their keys and the seed."""
    return df.orderBy(F.sha1(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))), *keys).limit(n)


def value_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def with_contiguous_shard(df: DataFrame, position: str, shards: int) -> DataFrame:
    """df with the shard of its 0-based position; the number of rows is counted first."""
    return df.withColumn("shard", S.contiguous_shard(F.col(position), df.count(), shards))


def with_floor_shard(df: DataFrame, position: str, shards: int) -> DataFrame:
    """df with the shard whose floor bounds hold its 0-based position."""
    total = max(df.count(), 1)
    return df.withColumn("shard", F.floor((F.col(position) * shards + (shards - 1)) / F.lit(total)).cast("int")) if total < shards else df.withColumn("shard", (F.ceil((F.col(position) + 1) * F.lit(shards) / F.lit(total)) - 1).cast("int"))
