"""Prompt pools: raw records to prompt rows, and deduplicated quotas by source in order of priority."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import text as X
from rankloom.operators.work import stored
from rankloom.sources.catalog import Source


def source_id(df: DataFrame) -> Column:
    """The record's id under any known name; the last name's value stands as it is."""
    known = [F.col(k) for k in M.ID_KEYS if k in df.columns]
    # A zero falls through like an empty text, but for the last.
    given = [F.when(c.cast("string") != "0", c.cast("string")) for c in known[:-1]]
    return X.clean(X.first_said(*given, known[-1])) if known else F.lit("")


def prompt_rows(records: DataFrame, source: Source, position: str) -> DataFrame:
    """Prompt rows of the records that hold a prompt in an allowed language; position is the record's place in its source."""
    trimmed = records.select(M.trim_to_prompt(M.extract(records)).alias("messages"), source_id(records).alias("source_example_id"), F.col(position).cast("long").alias("source_row_number"))
    rows = trimmed.where("messages IS NOT NULL").withColumn("prompt_raw", M.last_user(F.col("messages")))
    rows = rows.withColumn("prompt_language", X.prompt_language(F.col("prompt_raw"), F.lit(source.language)))
    if source.allowed is not None:
        rows = rows.where(F.col("prompt_language").isin(*source.allowed))
    wrap = F.lit(source.ask_for_japanese) & (F.col("prompt_language") == "en")
    rows = rows.withColumn("wrapped_for_japanese_answer", wrap).withColumn("messages", F.when(wrap, M.ask_for_answer(F.col("messages"))).otherwise(F.col("messages")))
    return rows.select(
        "messages", "prompt_raw", "prompt_language", F.lit("ja").alias("answer_language"), F.lit(source.alias).alias("source_alias"), F.lit(source.path).alias("source_dataset"),
        F.lit(source.split).alias("source_split"), F.lit(source.config).alias("source_config_name"), F.lit(source.data_dir).alias("source_data_dir"), "source_example_id", "source_row_number",
        "wrapped_for_japanese_answer", F.size("messages").cast("long").alias("num_prompt_messages"), F.length("prompt_raw").cast("long").alias("prompt_char_len"),
    )


def with_dedup_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dedup_key", ids.sha1(ids.dedup_key(F.col("messages"))))


def _accept(rows: DataFrame, key: str, position: str, target: int, taken: DataFrame | None) -> DataFrame:
    """First rows of each key by position that no earlier source took, up to target.

    An order by position with a limit is a bounded top-k of each partition, not a window over the
    whole source, so a large source is not sorted in one task.
    """
    first = rows.groupBy(key).agg(F.min(position).alias(position))
    if taken is not None:
        first = first.join(taken, key, "left_anti")
    return first.orderBy(position).limit(target)


def quota_dedup(rows: DataFrame, quotas: Mapping[str, int], source: str = "source_alias", key: str = "dedup_key", position: str = "source_row_number") -> tuple[DataFrame, DataFrame]:
    """Rows that the pool accepts, and a row of counts for each source.

    Sources come in the order of quotas. A source is read by position and stops when it has its
    quota; a row is skipped if it can't be used (null key) or its key was accepted before, by this
    source or an earlier one. Keys beyond a source's stop stay free for later ones, so the sources
    are folded one by one, with the accepted keys stored after each. A quota of 0 reads nothing.
    A row is known by its source and position; position must be unique in a source.
    """
    taken: DataFrame | None = None
    stats: DataFrame | None = None
    for alias, target in quotas.items():
        own = rows.where(F.col(source) == alias)
        if target > 0:
            usable = own.where(F.col(key).isNotNull()).select(key, position)
            accepted = stored(_accept(usable, key, position, target, taken), "pool-keys")
            done = accepted.agg(F.count(F.lit(1)).alias("n"), F.max(position).alias("last")).first()
            scanned = own if done["n"] < target else own.where(F.col(position) <= done["last"])
            counts = scanned.agg(F.count(F.lit(1)).alias("scanned"), F.count(F.when(F.col(key).isNull(), 1)).alias("skipped_parse"))
            collected = done["n"]
            mine = accepted.select(key, F.lit(alias).alias(source), position)
            taken = mine if taken is None else taken.unionByName(mine)
        else:
            counts = own.limit(0).agg(F.count(F.lit(1)).alias("scanned"), F.count(F.lit(1)).alias("skipped_parse"))
            collected = 0
        row = counts.select(
            F.lit(alias).alias(source), F.lit(target).cast("long").alias("requested"), F.lit(collected).cast("long").alias("collected"), "scanned",
            (F.col("scanned") - F.lit(collected) - F.col("skipped_parse")).alias("skipped_dedup"), "skipped_parse",
        )
        stats = row if stats is None else stats.unionByName(row)
    if stats is None:
        raise ValueError("no sources are asked for")
    if taken is None:
        return rows.limit(0), stats
    return rows.join(taken.select(source, position), [source, position], "left_semi"), stats


def seeded_order(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """df in an order that depends on the seed and the keys alone."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)


def positions(df: DataFrame, seed: int, *keys: str, by: str | None = None) -> DataFrame:
    """df with `position`, from 0, in the seeded order within each `by`.

    The high bits of the hash deal the rows of a `by` into ranges, counted and added up, so that neither
    the table nor a large `by` is sorted in one task. df is read twice.
    """
    bits = max(1, math.ceil(math.log2(df.count() + 1) / 2))
    # The given columns travel in a struct, so their names meet none of ours.
    dealt = df.select(F.struct("*").alias("_row"), F.struct(F.col(by) if by else F.lit(0)).alias("_by"), F.xxhash64(F.lit(seed), *keys).alias("_hash"))
    dealt = dealt.withColumn("_range", F.shiftright("_hash", 64 - bits))
    earlier = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_by", "_range").agg(F.count(F.lit(1)).alias("_n")).select("_by", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_by", "_range").orderBy("_hash", *(F.col("_row")[k] for k in keys))
    counted = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    same = counted["_by"].eqNullSafe(starts["_by"]) & (counted["_range"] == starts["_range"])
    return counted.join(starts, same).select(*(F.col("_row")[c].alias(c) for c in df.columns if c.lower() != "position"), (F.col("_start") + F.col("_at")).cast("long").alias("position"))
