"""Preference pairs from scored candidates: filters, ranking strategies, margins, limits, splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import text as X
from rankloom.sources.tables import require

STRATEGIES = ("best_vs_rest", "top_bottom", "all_pairs", "adjacent")
#: Columns that scored candidates must have, and those that pairs take over from the prompt where they exist.
CANDIDATE_COLUMNS = (
    "messages", "response", "response_hash", "teacher_score", "teacher_model", "generator_model", "generator_key", "generator_model_index", "candidate_index",
    "sample_id", "prompt_hash", "prompt_raw", "global_prompt_index",
)
PROMPT_COLUMNS = (
    "prompt_raw", "prompt_language", "answer_language", "source_alias", "source_dataset", "source_split", "source_config_name", "source_data_dir", "source_example_id",
    "source_row_number", "wrapped_for_japanese_answer", "num_prompt_messages", "prompt_char_len", "local_prompt_index", "rank",
)
#: Groups of up to so many candidates have their pairs, 2016 at most, sorted in one row; pairs of larger ones go through a sort that spills.
IN_ROW = 64
_SIDE = ("sample_id", "teacher_score", "response_hash", "generator_model", "generator_key", "generator_model_index", "candidate_index")


@dataclass(frozen=True)
class PairOptions:
    strategy: str = "best_vs_rest"
    min_margin: float = 0.0
    max_pairs: int | None = None
    min_candidates: int = 2
    drop_empty: bool = True
    dedupe: bool = True
    conversations: bool = False
    val_ratio: float = 0.0
    seed: int = 42
    max_groups: int | None = None

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        if self.min_margin < 0 or self.min_candidates < 2 or not 0 <= self.val_ratio < 1:
            raise ValueError("needs min_margin >= 0, min_candidates >= 2 and 0 <= val_ratio < 1")
        if self.max_pairs is not None and self.max_pairs < 1 or self.max_groups is not None and self.max_groups < 1:
            raise ValueError("limits must be positive")


def ranked(rows: DataFrame, group: str = "global_prompt_index", score: str = "teacher_score", item: str = "sample_id", response: str | None = "response", dedupe: str | None = "response_hash", drop_empty: bool = True, min_candidates: int = 2) -> DataFrame:
    """Candidates left after the filters, with their 0-based `position` by score, and the group's counts before and after.

    Scores must be finite. Only the best of candidates with one response hash stays; groups of fewer
    than min_candidates fall away. One exchange by group serves all steps.
    """
    everyone = Window.partitionBy(group)
    best = (F.col(score).desc(), item)
    said = X.clean(F.col(response)) != "" if drop_empty and response else F.lit(True)
    out = rows.withColumn("_said", F.coalesce(said, F.lit(False)))
    # Each count follows a window by the group whose sort serves it too; a window by group and hash would need an exchange or a sort more.
    if dedupe:
        this = F.struct(dedupe)
        before = F.lag(this).over(everyone.orderBy(dedupe, F.col("_said").desc(), *best))
        out = out.withColumn("_first", ~this.eqNullSafe(before)).withColumn("num_candidates_raw", F.count(F.lit(1)).over(everyone))
        out = out.where("_said AND _first").drop("_first")
        out = out.withColumn("position", F.row_number().over(everyone.orderBy(*best)) - 1).withColumn("num_candidates_after_filter", F.count(F.lit(1)).over(everyone))
    else:
        before = everyone.orderBy(*best).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("position", F.count_if("_said").over(before).cast("int") - 1)
        out = out.withColumn("num_candidates_raw", F.count(F.lit(1)).over(everyone)).withColumn("num_candidates_after_filter", F.count_if("_said").over(everyone)).where("_said")
    return out.drop("_said").where(F.col("num_candidates_after_filter") >= min_candidates)


def _large_groups(candidates: DataFrame, group: str, row: Column, score: str, min_margin: float, keep: Column) -> DataFrame:
    """(group, _p, c, r): every pair of better and worse that reaches the margin, from two explodes: a row is built for one better candidate at a time."""
    groups = candidates.groupBy(group).agg(F.array_sort(F.collect_list(row)).alias("_all"), F.min_by(keep, "position").alias("_p")).where(F.size("_all") > 1)
    better = groups.select(group, "_p", "_all", F.explode(F.sequence(F.lit(0), F.size("_all") - 2)).alias("_i"))
    better = better.select(group, "_p", F.get("_all", F.col("_i")).alias("c"), F.slice("_all", F.col("_i") + 2, F.size("_all")).alias("_worse"))
    margin = lambda r: F.col("c")[score] - r[score]
    return better.select(group, "_p", "c", F.explode(F.filter("_worse", lambda r: (margin(r) > 0) & (margin(r) >= min_margin))).alias("r"))


def _small_groups(candidates: DataFrame, group: str, row: Column, score: str, item: str, min_margin: float, max_pairs: int | None, keep: Column) -> DataFrame:
    """(group, _p, c, r, _n): the same pairs with their ranks, from one row a group. They are sorted there, so no pair is sorted or stored with what it carries."""
    groups = candidates.withColumn("_all", F.collect_list(row).over(Window.partitionBy(group))).where("position = 0")
    margin = lambda c, r: c[score] - r[score]

    def of(c: Column, i: Column) -> Column:
        worse = F.filter(F.slice("_all", i + 2, F.size("_all")), lambda r: (margin(c, r) > 0) & (margin(c, r) >= min_margin))
        return F.transform(worse, lambda r: F.struct((-margin(c, r)).alias("m"), c[item].alias("ci"), r[item].alias("ri"), c.alias("c"), r.alias("r")))

    # sort_array compares whole structs; array_sort would interpret a comparison for each step.
    found = F.sort_array(F.flatten(F.transform(F.sort_array("_all"), of)))
    if max_pairs is not None:
        found = F.slice(found, 1, max_pairs)
    return groups.select(group, keep.alias("_p"), F.posexplode(found).alias("_n", "x")).select(group, "_p", F.col("x.c").alias("c"), F.col("x.r").alias("r"), (F.col("_n") + 1).alias("_n"))


def paired(candidates: DataFrame, strategy: str = "best_vs_rest", min_margin: float = 0.0, max_pairs: int | None = None, group: str = "global_prompt_index", score: str = "teacher_score", item: str = "sample_id", carry: tuple[str, ...] = (), keep: tuple[Column, ...] = (), all_small: bool = False) -> DataFrame:
    """(group, c, r, score_margin, pair_rank_within_prompt, *keep): candidates as structs `c` and `r` of position, item, score and carried columns.

    candidates are those of `ranked`, whose exchange by group also serves here. A margin must be
    positive and reach min_margin. Pairs rank by margin, then by the two items. `keep` are named
    expressions over the columns of the group's best candidate. `all_small` tells that no group has
    more than IN_ROW candidates; else all_pairs reads the exchange again for the large ones.
    """
    row = F.struct("position", item, score, *carry)
    prompt = F.struct(F.lit(0).alias("_"), *keep)
    by_position = Window.partitionBy(group).orderBy("position")
    margin = F.col(f"c.{score}") - F.col(f"r.{score}")
    known = None
    if strategy == "all_pairs":
        size = F.col("num_candidates_after_filter")
        small = candidates if all_small else candidates.where(size <= IN_ROW)
        known = _small_groups(small, group, row, score, item, min_margin, max_pairs, prompt)
        pairs = _large_groups(candidates.where(size > IN_ROW), group, row, score, min_margin, prompt)
    else:
        chosen = F.lag(row).over(by_position) if strategy == "adjacent" else F.first(row).over(by_position)
        pairs = candidates.withColumn("c", chosen).withColumn("_p", F.first(prompt).over(by_position)).where("position > 0")
        if strategy == "top_bottom":
            pairs = pairs.where(F.col("position") == F.col("num_candidates_after_filter") - 1)
        pairs = pairs.select(group, "_p", "c", row.alias("r"))
    if known is None or not all_small:
        pairs = pairs.where((margin > 0) & (margin >= min_margin))
        pairs = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(margin.desc(), f"c.{item}", f"r.{item}")))
        if max_pairs is not None:
            pairs = pairs.where(F.col("_n") <= max_pairs)
        pairs = pairs if known is None else known.union(pairs)
    else:
        pairs = known
    return pairs.select(group, "c", "r", margin.alias("score_margin"), (F.col("_n") - 1).cast("long").alias("pair_rank_within_prompt"), "_p.*").drop("_")


def first_groups(rows: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of the n smallest groups; n is a limit that the user asks for, and so bounds what is broadcast."""
    return rows.join(rows.select(group).distinct().orderBy(group).limit(n), group, "left_semi")


def _packed(rows: DataFrame) -> DataFrame:
    """rows with a prompt_hash of lower-case hex digits as bytes in `_hash_bytes`, half as much to shuffle; any other stays as it is."""
    made = F.unhex("prompt_hash")
    made = F.when(F.lower(F.hex(made)) == F.col("prompt_hash"), made)
    return rows.withColumn("_hash_bytes", made).withColumn("prompt_hash", F.when(F.col("_hash_bytes").isNull(), F.col("prompt_hash")))


def build_pairs(rows: DataFrame, options: PairOptions | None = None, columns: tuple[str, ...] | None = None, at_rest: bool = False) -> DataFrame:
    """Pair rows of scored candidates, with what belongs to the prompt from its best candidate.

    `columns` names the columns of pairs to build: what only others need isn't shuffled. Catalyst
    can't tell by itself, as candidates meet as structs. `at_rest` tells that rows are cheap to read
    twice (files, not model calls): all_pairs then looks first whether any group is large.
    """
    o = options or PairOptions()
    require(rows, CANDIDATE_COLUMNS)
    if o.max_groups is not None:
        rows = first_groups(rows, "global_prompt_index", o.max_groups)
    packed = isinstance(rows.schema["prompt_hash"].dataType, T.StringType)
    left = ranked(_packed(rows) if packed else rows, dedupe="response_hash" if o.dedupe else None, drop_empty=o.drop_empty, min_candidates=o.min_candidates)
    if packed:
        left = left.withColumn("prompt_hash", F.coalesce(F.lower(F.hex("_hash_bytes")), "prompt_hash")).drop("_hash_bytes")
    prompt = tuple(c for c in PROMPT_COLUMNS if c in rows.columns)
    keep = {c: F.col(c) for c in ("messages", "prompt_hash", "teacher_model", "num_candidates_raw", "num_candidates_after_filter", *prompt)} | {"split": ids.split_by_fraction(F.col("prompt_hash"), o.val_ratio, o.seed)}
    carry = {"response": ("chosen", "rejected")} | {c: (f"chosen_{c}", f"rejected_{c}") for c in _SIDE if c not in ("sample_id", "teacher_score")}
    if columns is not None:
        used = {*columns, *(("prompt_hash",) if "pair_id" in columns else ()), *(("messages", "chosen", "rejected") if o.conversations else ())}
        keep = {c: x for c, x in keep.items() if c in used}
        carry = {c: names for c, names in carry.items() if used.intersection(names)}
    all_small = at_rest and o.strategy == "all_pairs" and not rows.groupBy("global_prompt_index").count().where(F.col("count") > IN_ROW).head(1)
    pairs = paired(left, o.strategy, o.min_margin, o.max_pairs, all_small=all_small, carry=tuple(carry), keep=tuple(x.alias(f"_p_{c}") for c, x in keep.items()))
    p = {c: F.col(f"_p_{c}") for c in keep}
    side = {f"{name}_{'score' if c == 'teacher_score' else c}": F.col(f"{s}.{c}") for c in _SIDE for s, name in (("c", "chosen"), ("r", "rejected")) if c in ("sample_id", "teacher_score") or c in carry}
    made = {"pair_strategy": F.lit(o.strategy), "pair_rank_within_prompt": F.col("pair_rank_within_prompt"), "global_prompt_index": F.col("global_prompt_index"), "score_margin": F.col("score_margin")} | side | p
    if "prompt_hash" in p:
        made["pair_id"] = ids.pair_id(p["prompt_hash"], F.col("c.sample_id"), F.col("r.sample_id"), F.lit(o.strategy))
    if "response" in carry:
        made |= {"chosen": F.col("c.response"), "rejected": F.col("r.response")}
    if o.conversations:
        made |= {f"{x}_messages": M.with_response(p["messages"], made[x]) for x in ("chosen", "rejected")}
    order = ("pair_id", "split", "pair_strategy", "pair_rank_within_prompt", "messages", "chosen", "rejected", "prompt_hash", "global_prompt_index", "teacher_model", "score_margin", *side, "num_candidates_raw", "num_candidates_after_filter", *prompt)
    names = columns or (*order, *(("chosen_messages", "rejected_messages") if o.conversations else ()))
    return pairs.select(*(made[c].alias(c) for c in names))


def group_outcomes(rows: DataFrame, pairs: DataFrame, group: str = "global_prompt_index") -> DataFrame:
    """How many groups gave pairs and how many were skipped."""
    made = pairs.select(group).distinct().withColumn("_made", F.lit(True))
    seen = rows.select(group).distinct().join(made, group, "left")
    return seen.groupBy(F.when(F.col("_made"), "processed").otherwise("skipped").alias("outcome")).agg(F.count(F.lit(1)).alias("groups"))


def margins(pairs: DataFrame, by: str = "split") -> DataFrame:
    return pairs.groupBy(by).agg(F.count(F.lit(1)).alias("pairs"), F.min("score_margin").alias("min_margin"), F.max("score_margin").alias("max_margin"), F.avg("score_margin").alias("avg_margin"))
