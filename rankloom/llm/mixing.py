"""Mixing sources to target weights.

Documents get hash-random keys. The high bits of a key deal the documents of a source into ranges
of equal expected size, so sorting by key is a sort inside ranges, and prefix sums of sizes are the
sums of earlier ranges plus a running sum inside the own one. Each source is cut at its budget of
words exactly; a budget above the source's size repeats whole epochs first. The document at the cut
gives its leading words.

Sources in order of code points, null last, get the weights in turn. Targets that would exceed
`most` times their source are held there, and the excess is shared anew by weight, which is a water
level: sources below it are capped, the others get weight times level. Only the table of sources
is put in one order; it has a row for each source and range.

Defined results: a null text has size 0 and takes nothing; rows without any words give targets of
0; repeated rows are separate documents; an empty table gives an empty result;
a text is counted whole, in one task; of columns named like a result the result stays, and columns of
any other name come back as they were.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.common import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 17
_BLANKS = r"[\x20\x09-\x0D]+"
_RESULTS = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    """Number of words: the pieces between white space, without the empty ones at either end."""
    inner = F.size(F.split(text, _BLANKS)) - F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) - F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(inner).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes (_source, source, source_size), a row a source, with target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = left / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("_level", level)
    # The first source that its cap doesn't hold sets the level for itself and all after it.
    water = F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), "source", "_level"))).over(everything)
    return levels.withColumn("target", F.least("_cap", F.coalesce(F.col("_weight") * water["_level"], F.col("_cap")))).select("_source", "source", "source_size", "target")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, size: Column | None = None) -> DataFrame:
    """docs with size, source_size, target and taken: the words that the mix takes of each, repeats counted."""
    docs = docs.drop(*_RESULTS)
    bits = max(4, math.ceil(math.log2(docs.count() + 1) / 2))
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    # The given columns travel in a struct, so their names meet none of ours.
    rows = docs.select(
        F.struct("*").alias("_row"), (word_count(F.col(text)) if size is None else size).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_source"), hashed.alias("_key"),
    ).withColumn("_range", F.shiftrightunsigned("_key", 64 - bits))
    ranges = stored(rows.groupBy("_source", F.col("_row")[source].alias("source"), "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    aims = targets(ranges.groupBy("_source", "source").agg(F.sum("_words").alias("source_size")), weights, share, most).drop("source")
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_source", "_range", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start")).join(aims, "_source")
    inside = Window.partitionBy("_source", "_range").orderBy("_key", F.col("_row")[key], "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return rows.join(starts, ["_source", "_range"]).select("_row.*", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each whole copy, and one whose text is cut at the budget.

    A cut text is its leading words, joined by blanks; a column n_chars follows it.
    """
    columns = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")
    planned = mix(docs, text=text, **options).where("taken > 0").select(row, F.expr("taken div size").alias("_whole"), F.expr("cast(taken % size AS int)").alias("_rest"))
    copies = F.sequence(F.lit(1), (F.col("_whole") + F.when(F.col("_rest") > 0, 1).otherwise(0)).cast("int"))
    planned = planned.withColumn("_copy", F.explode(copies))
    given, at_cut = F.col("_row"), F.col("_copy") > F.col("_whole")
    trimmed = F.regexp_replace(given[text], r"^[\x20\x09-\x0D]+", "")
    cut = F.concat_ws(" ", F.slice(F.split(trimmed, _BLANKS), 1, F.greatest(F.col("_rest"), F.lit(1))))
    changed = {text: F.when(at_cut, cut).otherwise(given[text])}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(at_cut, F.length(cut).cast("long")).otherwise(given["n_chars"])
    return planned.select(*(changed.get(c, given[c]).alias(c) for c in columns))
