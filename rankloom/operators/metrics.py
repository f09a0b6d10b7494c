"""One set of scores against another: global metrics, and ranking metrics by prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import stats as S
from rankloom.operators.work import stored


def group_column(df: DataFrame, primary: str = "global_prompt_index", fallback: str = "prompt_hash") -> str:
    for name in (primary, fallback):
        if name in df.columns:
            return name
    raise ValueError(f"needs {primary} or {fallback}")


def rank_average(df: DataFrame, value: str, name: str = "rank", by: str | None = None) -> DataFrame:
    """df with 1-based ranks of value, ties averaged, within each `by`.

    Without `by`, a window would sort the table in one task. Values are counted instead, the counts
    dealt in ranges of values, and added up in two levels; ranks then join back by value. df is read twice.
    """
    if by is not None:
        # Rows up to the last that ties, by the same order: a window by value would sort doubles again.
        w = Window.partitionBy(by).orderBy(value)
        return df.withColumn(name, (F.rank().over(w) + F.count(F.lit(1)).over(w)) / F.lit(2.0))
    return df.join(average_ranks(df, value, name), F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def average_ranks(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """(_value, name): the tie-averaged rank of each distinct value in the whole table.

    Distinct values are dealt in ranges, as many as the session has shuffle partitions, and stored with their range.
    """
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = stored(counts.repartitionByRange("_value").withColumn("_part", F.spark_partition_id()), "rank-ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.sum("_n").alias("_s")).select("_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range.
    ranked = dealt.join(F.broadcast(starts), "_part")
    below = F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return ranked.select("_value", (below + (F.col("_n") + 1) / F.lit(2.0)).alias(name))


def global_metrics(df: DataFrame, teacher: str = "teacher_score", student: str = "student_score_denorm", student_norm: str = "student_score_norm") -> DataFrame:
    """One row: size, means, population deviations, errors, Pearson's and Spearman's correlation; zeros without rows."""
    t, s, n = (F.col(c).cast("double") for c in (teacher, student, student_norm))
    rows = stored(df.select(t.alias("_t"), s.alias("_s"), n.alias("_z")), "metric-rows")
    ranks = {c: average_ranks(rows, c, f"_r{c[1:]}").withColumnRenamed("_value", c) for c in ("_t", "_s")}
    ranked = rows.join(ranks["_t"], rows["_t"].eqNullSafe(ranks["_t"]["_t"])).drop(ranks["_t"]["_t"])
    ranked = ranked.join(ranks["_s"], ranked["_s"].eqNullSafe(ranks["_s"]["_s"])).drop(ranks["_s"]["_s"])
    t, s, z = F.col("_t"), F.col("_s"), F.col("_z")
    return ranked.agg(
        F.count(F.lit(1)).alias("n"),
        S.or_zero(F.avg(t)).alias("teacher_score_mean"), S.or_zero(F.stddev_pop(t)).alias("teacher_score_std"),
        S.or_zero(F.avg(s)).alias("student_score_denorm_mean"), S.or_zero(F.stddev_pop(s)).alias("student_score_denorm_std"),
        S.or_zero(F.avg(z)).alias("student_score_norm_mean"), S.or_zero(F.stddev_pop(z)).alias("student_score_norm_std"),
        S.or_zero(S.mse(s, t)).alias("mse_denorm"), S.or_zero(S.mae(s, t)).alias("mae_denorm"),
        S.pearson(s, t).alias("pearson_denorm"), S.pearson(F.col("_rs"), F.col("_rt")).alias("spearman_denorm"),
    )


def training_metrics(df: DataFrame, prediction: str, label: str, mean: float, std: float, mode: str = "train_zscore") -> DataFrame:
    """One row of errors and correlations of normalised scores, as they are and denormalised."""
    p, y = F.col(prediction), F.col(label)
    dp, dy = (S.denormalised(x, mean, std, mode) for x in (p, y))
    return df.agg(
        S.or_zero(S.mse(p, y)).alias("mse"), S.or_zero(S.mae(p, y)).alias("mae"), S.pearson(p, y).alias("pearson"), S.or_zero(S.smooth_l1(p, y)).alias("smooth_l1"),
        S.or_zero(S.mse(dp, dy)).alias("mse_denorm"), S.or_zero(S.mae(dp, dy)).alias("mae_denorm"), S.pearson(dp, dy).alias("pearson_denorm"),
    )


def _agreement(x: Column, y: Column, margin: float) -> tuple[Column, Column]:
    """Whether a pair counts, and its credit: 1 in the same order, one half if the student ties."""
    dt, ds = x["t"] - y["t"], x["s"] - y["s"]
    credit = F.when(((dt > 0) & (ds > 0)) | ((dt < 0) & (ds < 0)), 1.0).when(ds == 0, 0.5).otherwise(0.0)
    return F.abs(dt) > margin, credit


def prompt_metrics(df: DataFrame, group: str, teacher: str, student: str, order: str, margin: float = 0.0) -> DataFrame:
    """A row a group: its size, and for two candidates or more top-1 agreement, pairs, credit and Spearman's correlation.

    The first candidate by `order` wins ties for the top. Candidates of a group are compared with
    each other from one row, so the pairs of a group never leave its task. Windows over the rows
    sorted for the ranks serve as aggregates: no task holds a table of its groups.
    """
    rows = df.select(F.col(group).alias("group_key"), F.col(teacher).cast("double").alias("t"), F.col(student).cast("double").alias("s"), F.col(order).alias("o"))
    rows = rank_average(rank_average(rows, "t", "rt", "group_key"), "s", "rs", "group_key")
    w = Window.partitionBy("group_key")
    # Any one row of a group serves in the end; this order is that of the last ranks, so nothing is sorted again.
    rows = rows.withColumn("_n", F.row_number().over(w.orderBy("s")))
    first = lambda x: F.min_by("o", F.struct((-F.col(x)).alias("v"), "o")).over(w)
    groups = rows.select(
        "group_key", "_n", F.count(F.lit(1)).over(w).alias("candidates"), (first("t") == first("s")).alias("top1_match"), S.pearson(F.col("rt"), F.col("rs"), w).alias("spearman"),
        F.collect_list(F.struct("o", "t", "s")).over(w).alias("_all"), F.avg(F.abs(F.col("s") - F.col("t"))).over(w).alias("mean_abs_error"),
    )
    # Counts of pairs don't depend on the order of _all; a sort here would be inlined below and run for each candidate.
    groups = groups.where("_n = 1")

    def after(x: Column, i: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("pairs"), F.lit(0.0).alias("credit"))

        def step(a: Column, y: Column) -> Column:
            counts, credit = _agreement(x, y, margin)
            return F.struct((a["pairs"] + F.when(counts, 1).otherwise(0).cast("long")).alias("pairs"), (a["credit"] + F.when(counts, credit).otherwise(0.0)).alias("credit"))

        return F.aggregate(F.slice("_all", i + 2, F.size("_all")), zero, step)

    each = F.transform("_all", after)
    groups = groups.withColumn("pairs", F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x["pairs"])).withColumn("credit", F.aggregate(each, F.lit(0.0), lambda a, x: a + x["credit"]))
    several = F.col("candidates") >= 2
    return groups.select(
        "group_key", "candidates", F.when(several, F.col("top1_match")).alias("top1_match"), "pairs", "credit",
        F.when(F.col("pairs") > 0, F.try_divide("credit", "pairs")).alias("pairwise_accuracy"), F.when(several, F.col("spearman")).alias("prompt_spearman"), "mean_abs_error",
    )


def group_metrics(df: DataFrame, group: str, teacher: str, student: str, order: str, margin: float = 0.0) -> DataFrame:
    """One row of ranking metrics over all groups; those of candidates' number count every group."""
    p = prompt_metrics(df, group, teacher, student, order, margin)
    zero, several = S.or_zero, F.col("candidates") >= 2
    return p.agg(
        F.count(F.lit(1)).alias("num_prompt_groups"), F.count(F.when(several, 1)).alias("num_prompt_groups_multi_candidate"),
        zero(F.avg("candidates")).alias("candidate_count_per_prompt_mean"), zero(F.median("candidates")).alias("candidate_count_per_prompt_median"),
        F.coalesce(F.max("candidates"), F.lit(0)).alias("candidate_count_per_prompt_max"),
        zero(F.avg(F.col("top1_match").cast("double"))).alias("top1_agreement"), F.count("top1_match").alias("top1_agreement_num_prompts"),
        zero(F.try_divide(F.sum("credit"), F.sum("pairs"))).alias("pairwise_accuracy_micro"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairwise_accuracy_micro_num_pairs"),
        zero(F.avg("pairwise_accuracy")).alias("pairwise_accuracy_macro"), F.count("pairwise_accuracy").alias("pairwise_accuracy_macro_num_prompts"),
        zero(F.avg("prompt_spearman")).alias("prompt_spearman_mean"), zero(F.median("prompt_spearman")).alias("prompt_spearman_median"), F.count("prompt_spearman").alias("prompt_spearman_num_prompts"),
        F.lit(float(margin)).alias("pairwise_margin"),
    )


def evaluate(df: DataFrame, group: str, teacher: str = "teacher_score", student: str = "student_score_denorm", student_norm: str = "student_score_norm", order: str = "sample_id", margin: float = 0.0) -> DataFrame:
    """Global and group metrics in one row."""
    return global_metrics(df, teacher, student, student_norm).crossJoin(group_metrics(df, group, teacher, student, order, margin))


def recheck(df: DataFrame, n: int, position: str, teacher: str = "teacher_score", student: str = "student_score_denorm", group: str | None = None) -> DataFrame:
    """Metrics of the first n rows by position, in one row, with the sizes of the table and of the subset; an empty table fails."""
    if n < 1 or not df.head(1):
        raise ValueError("there are no rows to check")
    first = df.orderBy(position).limit(n)
    s, t = F.col(student), F.col(teacher)
    groups = [F.count_distinct(group).alias("num_prompt_groups_checked")] if group else []
    found = first.agg(F.count(F.lit(1)).alias("num_rows_checked"), S.mae(s, t).alias("mae"), S.mse(s, t).alias("mse"), S.pearson(s, t).alias("pearson"), *groups)
    # Both sides have one row.
    return df.agg(F.count(F.lit(1)).alias("num_rows_total")).crossJoin(found)


#: Columns of a light predictions table, where they exist.
LIGHT_COLUMNS = ("sample_id", "prompt_hash", "generator_model", "candidate_index")


def predictions(df: DataFrame, group: str, keep_all: bool = False, teacher: str = "teacher_score", response: str = "response") -> DataFrame:
    """The predictions table: all columns, or the few that identify a row, with both scores."""
    if keep_all:
        return df
    names = [c for c in dict.fromkeys(["sample_id", group, *LIGHT_COLUMNS[1:], teacher, response]) if c in df.columns]
    return df.select(*names, F.col("student_score_norm").cast("float").cast("double").alias("student_score_norm"), "student_score_denorm")
