"""Guards of a run: its configuration, its output folder, and where it may resume."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.sources.tables import committed, exists, write_summary, write_table

#: Settings that a resumed run may not change.
CANDIDATE_KEYS = (
    "prompt_dataset_dir", "output_dir", "final_dataset_subdir", "train_split", "messages_column", "max_prompts", "generator_models", "teacher_model",
    "num_candidates_per_prompt", "prompt_micro_batch_size", "generator_max_input_length", "teacher_max_length", "max_new_tokens", "temperature", "top_p",
    "repetition_penalty", "do_sample", "dtype", "seed", "trust_remote_code", "world_size", "total_prompts",
)
PAIR_KEYS = (
    "teacher_dataset_dir", "train_split", "pairing_strategy", "min_score_margin", "max_pairs_per_prompt", "min_candidates_per_prompt", "drop_empty_responses",
    "dedupe_response_hash", "store_conversation_columns", "val_ratio", "split_seed", "max_prompt_groups", "input_rows",
)


def run_config(spark: SparkSession, path: str, current: Mapping[str, object], keys: Iterable[str], allow_mismatch: bool = False) -> dict:
    """Write the configuration on the first run; later return the first one, or stop if a key differs."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(1).collect()
    except AnalysisException:
        rows = []
    if not rows:
        write_summary(spark, dict(current), path)
        return dict(current)
    existing = json.loads(rows[0][0])
    now = json.loads(json.dumps(dict(current), default=str))
    wrong = [f"{k}: was {existing.get(k)!r}, is {now.get(k)!r}" for k in keys if existing.get(k) != now.get(k)]
    if wrong and not allow_mismatch:
        raise ValueError("the run's configuration has changed: " + "; ".join(wrong))
    return existing


def stage_key(config: Mapping[str, object]) -> str:
    """Name of a stage's cached result: another configuration has another."""
    return hashlib.sha1(json.dumps(dict(config), sort_keys=True, default=str).encode()).hexdigest()[:16]


def cached_stage(spark: SparkSession, root: str, config: Mapping[str, object], build) -> DataFrame:
    """A stage's table from its cache; built and written first if its configuration is new."""
    path = f"{root.rstrip('/')}/{stage_key(config)}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)


def guard_output(spark: SparkSession, path: str, overwrite: bool = False, allowed: Iterable[str] = ()) -> None:
    """Stop if the output folder holds anything but the allowed names."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if overwrite or not fs.exists(place):
        return
    found = {s.getPath().getName() for s in fs.listStatus(place)} - set(allowed)
    if found:
        raise FileExistsError(f"{path} exists and holds {sorted(found)[:5]}")


def append_log(entries: DataFrame, path: str) -> None:
    """Add entries to a commit log or manifest, a folder of Parquet files; each call is committed as a whole."""
    entries.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of a log; none where nothing was written."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def valid_parts(spark: SparkSession, log: DataFrame, part: str = "part_id", path: str = "path", order: str = "seq") -> DataFrame:
    """The last entry of each part whose file exists, by part; a log has a row for each part, whose paths are listed."""
    last = committed(log, part, order)
    there = [(x,) for (x,) in last.select(path).distinct().toLocalIterator() if exists(spark, x)]
    return last.join(spark.createDataFrame(there, f"`{path}` string"), path, "left_semi").orderBy(part)


def resume_at(log: DataFrame, end: str = "end") -> int:
    """Where a run goes on: the largest end of its log, or 0."""
    return int(log.agg(F.max(end)).first()[0] or 0)


def finalise(spark: SparkSession, log: DataFrame, out: str, split: str = "split", overwrite: bool = False) -> DataFrame:
    """Only compact: the parts that a log names and that exist become one table by split, which is returned."""
    files = [r["path"] for r in valid_parts(spark, log).toLocalIterator()]
    if not files:
        raise ValueError("nothing that is committed exists")
    guard_output(spark, out, overwrite)
    write_table(spark.read.parquet(*files), out, split, overwrite=overwrite)
    return spark.read.parquet(out)


def contiguous_prefix(parts: DataFrame, start: str = "start", end: str = "end", by: Iterable[str] = ()) -> DataFrame:
    """The parts that follow on from 0 without a gap, for each `by`; the rest would be done again."""
    w = Window.partitionBy(*by).orderBy(start, end)
    linked = F.col(start) == F.coalesce(F.lag(end).over(w), F.lit(0))
    return parts.withColumn("_ok", F.min(linked.cast("int")).over(w)).where("_ok = 1").drop("_ok")


def completion(parts: DataFrame, totals: DataFrame, by: Iterable[str]) -> DataFrame:
    """How far each of `by` has come against its total, and whether that is all."""
    done = parts.groupBy(*by).agg(F.max("end").alias("committed_end"))
    joined = totals.join(done, list(by), "left").withColumn("committed_end", F.coalesce("committed_end", F.lit(0)).cast("long"))
    return joined.withColumn("complete", F.col("committed_end") == F.col("total"))
