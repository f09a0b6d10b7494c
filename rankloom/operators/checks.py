"""Checks of tables over all their rows; a check returns what is wrong, so an empty result passes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions import text as X
from rankloom.sources.tables import require


def non_empty(df: DataFrame) -> DataFrame:
    if not df.head(1):
        raise ValueError("the table is empty")
    return df


def _broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of those they break; a rule of null is broken."""
    named = F.array(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()))
    return df.withColumn("violations", F.filter(named, lambda x: x.isNotNull())).where(F.size("violations") > 0)


def prompt_violations(df: DataFrame) -> DataFrame:
    require(df, ["messages", "prompt_raw", "num_prompt_messages", "prompt_char_len"])
    last = F.try_element_at("messages", F.lit(-1))
    return _broken(df, {
        "no_messages": F.size("messages") > 0, "last_not_user": last["role"] == "user", "blank_prompt": X.clean(F.col("prompt_raw")) != "",
        "wrong_length": F.col("prompt_char_len") == F.length("prompt_raw"), "wrong_count": F.col("num_prompt_messages") == F.size("messages"),
    })


def candidate_violations(df: DataFrame) -> DataFrame:
    require(df, ["messages", "prompt_raw", "response", "teacher_score", "prompt_hash", "response_hash", "sample_id", "candidate_index"])
    return _broken(df, {
        "no_messages": F.size("messages") > 0, "blank_prompt": X.clean(F.col("prompt_raw")) != "", "no_response": F.col("response").isNotNull(), "bad_score": ~F.isnan("teacher_score") & (F.abs("teacher_score") < F.lit(float("inf"))),
        "bad_hash": (F.length("prompt_hash") == 40) & (F.length("response_hash") == 40) & (F.length("sample_id") == 40), "negative_index": F.col("candidate_index") >= 0,
    })


def pair_violations(df: DataFrame) -> DataFrame:
    require(df, ["chosen_score", "rejected_score", "score_margin", "chosen_sample_id", "rejected_sample_id"])
    rules = {"not_better": F.col("chosen_score") > F.col("rejected_score"), "no_margin": F.col("score_margin") > 0, "same_sample": F.col("chosen_sample_id") != F.col("rejected_sample_id")}
    for name in ("chosen_messages", "rejected_messages"):
        if name in df.columns:
            rules[f"{name}_end"] = F.try_element_at(name, F.lit(-1))["role"] == "assistant"
    return _broken(df, rules)


def hard_prompt_violations(df: DataFrame) -> DataFrame:
    require(df, ["messages", "group_key", "hard_prompt_score", "hard_prompt_rank", "selection_reason"])
    return _broken(df, {"bad_rank": F.col("hard_prompt_rank") >= 1})


def repeated(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def leaked(df: DataFrame, key: str = "prompt_hash", split: str = "split") -> DataFrame:
    """Keys in more than one split."""
    return df.groupBy(key).agg(F.min(split).alias("a"), F.max(split).alias("b")).where("a <> b").select(key)


def without(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Keys of rows that other lacks: empty for a subset."""
    return rows.select(key).distinct().join(other.select(key), key, "left_anti")


def count_mismatches(df: DataFrame, expected: dict[str, int], by: str = "split") -> list[str]:
    """Differences between a table's counts and a summary's, over all groups."""
    wanted = df.sparkSession.createDataFrame(list(expected.items()), T.StructType([T.StructField("key", df.schema[by].dataType), T.StructField("expected", T.LongType())]))
    found = df.groupBy(F.col(by).alias("found_key")).agg(F.count(F.lit(1)).alias("rows"))
    both = found.join(wanted, F.col("found_key").eqNullSafe(F.col("key")), "full_outer")
    # A null key of the table is a group too, so presence is told by the counts.
    key = F.when(F.col("rows").isNotNull(), F.col("found_key")).otherwise(F.col("key")).alias("key")
    rows, wants = F.coalesce("rows", F.lit(0)), F.coalesce("expected", F.lit(0))
    wrong = both.where(rows != wants).select(key, rows.alias("rows"), wants.alias("expected")).collect()
    return [f"{r['key']}: {r['rows']} rows, {r['expected']} expected" for r in sorted(wrong, key=lambda r: str(r["key"]))]


def distinct_count(df: DataFrame, *key: str) -> int:
    return df.select(*key).distinct().count()


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return sorted(set(columns) - set(df.columns))
