"""Regression labels: splits, sampling, score statistics, normalised labels and tokenised tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import stats as S
from rankloom.operators.candidates import hashed

#: A tokenizer takes texts and the longest length, and gives the ids of each.
Tokenizer = Callable[[list[str], int], list[list[int]]]


@dataclass(frozen=True)
class ScoreStats:
    mode: str = "train_zscore"
    mean: float = 0.0
    std: float = 1.0
    clip_abs: float | None = None


def score_stats_row(df: DataFrame, score: str, mode: str = "train_zscore") -> DataFrame:
    """One row: mode, mean and population deviation; a deviation that isn't finite or is below 1e-6 becomes 1."""
    x = F.col(score).cast("double")
    if mode == "none":
        return df.agg(F.count(x).alias("n")).select(F.lit(mode).alias("mode"), F.lit(0.0).alias("mean"), F.lit(1.0).alias("std"), "n")
    std = F.stddev_pop(x)
    return df.agg(F.avg(x).alias("mean"), F.when(S.finite(std) & (std >= 1e-6), std).otherwise(1.0).alias("std"), F.count(x).alias("n")).select(F.lit(mode).alias("mode"), "mean", "std", "n")


def score_stats(df: DataFrame, score: str, mode: str = "train_zscore", clip_abs: float | None = None) -> ScoreStats:
    row = score_stats_row(df, score, mode).first()
    if not row["n"]:
        raise ValueError("no scores to take statistics of")
    return ScoreStats(mode, row["mean"], row["std"], clip_abs)


def label(score: Column, stats: ScoreStats) -> Column:
    return S.normalised(score.cast("double"), stats.mean, stats.std, stats.mode, stats.clip_abs)


def with_split(df: DataFrame, ratio: float = 0.02, base: int = 10_000, split: str = "split") -> DataFrame:
    """df with its own split if it has a validation part, else one by stable example keys; an empty train part fails."""
    if split in df.columns and df.where(F.col(split) == "validation").head(1):
        return df
    out = df.withColumn(split, ids.split_by_bucket(ids.example_key(df), ratio, base))
    if ratio > 0 and not out.where(F.col(split) == "train").head(1):
        raise ValueError("the split leaves nothing to train on")
    return out


def sampled(df: DataFrame, n: int | None, seed: int, *keys: str) -> DataFrame:
    """n rows by seeded order, the same for the same seed; evaluation takes the training seed plus one."""
    return df if n is None else df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def whitespace_tokens(texts: list[str], longest: int) -> list[list[int]]:
    """A stand-in tokenizer: a stable id for each word."""
    return [[hashed(w) % 32_000 for w in t.split()[:longest]] for t in texts]


def tokenized(df: DataFrame, stats: ScoreStats, score: str = "teacher_score", tokenizer: Tokenizer = whitespace_tokens, longest: int = 4096, keep: bool = False) -> DataFrame:
    """input_ids, attention_mask, labels, teacher_score_raw and length of each example, after its raw columns if kept.

    The tokenizer gets Arrow batches and is loaded once in each worker.
    """

    @F.pandas_udf("array<int>")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(tokenizer(texts.tolist(), longest))

    out = df.withColumn("input_ids", tokens(M.example_text(df)))
    raw = df.columns if keep else []
    return out.select(
        *raw, "input_ids", F.transform("input_ids", lambda _: F.lit(1)).alias("attention_mask"), label(F.col(score), stats).alias("labels"),
        F.col(score).cast("double").alias("teacher_score_raw"), F.size("input_ids").cast("long").alias("length"),
    )
