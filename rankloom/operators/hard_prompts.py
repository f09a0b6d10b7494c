"""Prompts on which a student ranks candidates worst, and their training rows.

The score of a prompt is ours: 1 less its pairwise accuracy, plus half of 1 less its Spearman
correlation halved, plus one half if the top candidate differs. Prompts without pairs aren't hard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.operators.metrics import prompt_metrics


def hard_prompts(df: DataFrame, group: str, teacher: str, student: str, order: str, n: int, margin: float = 0.0) -> DataFrame:
    """All prompts with hard_prompt_score; the n hardest are selected and have a rank and a reason.

    n is the feature's limit: a bounded list, ranked on its own and joined back.
    """
    rows = prompt_metrics(df, group, teacher, student, order, margin)
    missed = F.when(F.col("top1_match"), 0.0).otherwise(0.5)
    rows = rows.withColumn("hard_prompt_score", F.when(F.col("pairs") > 0, F.abs(F.round((1 - F.col("pairwise_accuracy")) + 0.25 * (1 - F.col("prompt_spearman")) + missed, 9))).otherwise(0.0))
    hardest = rows.where("pairs > 0").orderBy(F.col("hard_prompt_score").desc(), "group_key").limit(n).select("group_key", "hard_prompt_score")
    ranks = hardest.select("group_key", F.row_number().over(Window.orderBy(F.col("hard_prompt_score").desc(), "group_key")).cast("long").alias("hard_prompt_rank"))
    rows = rows.join(ranks, "group_key", "left").withColumn("selected", F.col("hard_prompt_rank").isNotNull())
    reason = F.when(F.col("selected"), F.when(~F.col("top1_match"), "top1_mismatch").when(F.col("pairwise_accuracy") < 1, "pair_errors").otherwise("lowest_rank"))
    return rows.withColumn("selection_reason", reason).drop("credit")


def hard_training_rows(df: DataFrame, hard: DataFrame, group: str, teacher: str, student: str) -> DataFrame:
    """Candidates of the selected prompts, with what selected them."""
    chosen = hard.where("selected").select(
        F.col("group_key").alias(group), "hard_prompt_score", "hard_prompt_rank", F.col("selection_reason").alias("hard_selection_reason"), F.col("pairwise_accuracy").alias("prompt_pairwise_accuracy"), "prompt_spearman"
    )
    return df.join(chosen, group).withColumn("score_abs_error_denorm", F.abs(F.col(student) - F.col(teacher)))
