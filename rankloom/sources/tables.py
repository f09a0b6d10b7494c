"""Tables in files: splits, parts, JSON lines, partial results, summaries."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, is_dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions import text as X


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """df, if it has the columns; an error lists those that it lacks."""
    if lacking := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing columns: {lacking}")
    return df


def read_split(spark: SparkSession, path: str, split: str | None = "train", columns: Iterable[str] = (), head: int | None = None, position: str | None = None) -> DataFrame:
    """A saved table, or one split of a table that is partitioned by split; head takes the first rows by position."""
    df = spark.read.parquet(path)
    if split is not None and "split" in df.columns:
        whole, df = df, df.where(F.col("split") == split)
        if not df.head(1):
            have = {r[0] for r in whole.select("split").distinct().limit(100).collect()}
            raise ValueError(f"{path} has no split {split!r}, but {sorted(map(str, have))}")
    df = require(df, columns)
    if head is not None:
        if position is None:
            raise ValueError("taking the first rows needs a position column")
        df = df.orderBy(position).limit(head)
    return df


def read_parts(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """All part files below a folder as one table."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)


def committed(log: DataFrame, key: str = "part_id", order: str = "seq") -> DataFrame:
    """The last entry of each part in a commit log."""
    columns = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_last"))
    return last.select(key, *(F.col(f"_last.{c}").alias(c) for c in columns))


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_committed(spark: SparkSession, log: DataFrame, path: str = "path") -> DataFrame:
    """The part files that a commit log names and no others, without those that are gone; the log has a row for each part."""
    files = [r[0] for r in committed(log).select(path).orderBy(path).toLocalIterator()]
    files = [x for x in files if exists(spark, x)]
    if not files:
        raise ValueError("nothing that is committed exists")
    return spark.read.parquet(*files)


def write_table(df: DataFrame, path: str, split: str | None = None, rows_per_file: int | None = None, overwrite: bool = False, compression: str = "zstd") -> None:
    """df as Parquet, committed as a whole; split names the column that parts it into folders."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(split) if split else writer).parquet(path)


def _checked(line: Column, parsed: Column) -> Column:
    """Not a JSON object: an error, with the line."""
    return F.when(parsed.isNull() | ~F.startswith(X.strip(line), F.lit("{")), F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring(line, 1, 200))).cast(T.StringType())).otherwise(line)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of JSON lines, and the whole line as `_line`; blank lines are skipped, others than objects fail."""
    return parse_jsonl(spark.read.text(path), schema)


def parse_jsonl(lines: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    found = lines.select(F.col(column).alias("_line")).where(X.strip(F.col(column)) != "")
    found = found.withColumn("_line", _checked(F.col("_line"), F.try_parse_json("_line")))
    return found.withColumn("_record", F.from_json("_line", schema)).select("_record.*", "_line")


def with_fields(line: Column, **added: Column) -> Column:
    """A JSON object's text with fields added at its end in place of its own of those names; its other fields stay."""
    others = F.map_filter(F.from_json(line, "map<string,variant>"), lambda k, _: ~k.isin(*added))
    has = F.arrays_overlap(F.coalesce(F.json_object_keys(line), F.array().cast("array<string>")), F.array(*map(F.lit, added)))
    line = F.when(has, F.to_json(others)).otherwise(line)
    more = F.to_json(F.struct(*(v.alias(k) for k, v in added.items())), {"ignoreNullFields": "false"})
    body = F.regexp_replace(line, r"\s*\}\s*\z", "")
    return F.concat(body, F.when(F.regexp_like(body, F.lit(r"\{\s*\z")), F.lit("")).otherwise(F.lit(",")), F.substring(more, 2, 2**31 - 1))


def write_jsonl(df: DataFrame, path: str, line: str | None = None, overwrite: bool = False) -> None:
    """A JSON object a line: the column `line` if given, else all columns."""
    text = F.col(line) if line else F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    df.select(text.alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def partial_scores(df: DataFrame, index: str, score: str) -> DataFrame:
    """Scores as partial results keep them: the row's index and a float."""
    return df.select(F.col(index).cast("long").alias("orig_index"), F.col(score).cast("float").alias("score"))


def merge_scores(rows: DataFrame, index: str, parts: DataFrame, name: str = "student_score_norm") -> DataFrame:
    """rows with their scores; an error if a row has none or several, or a score no row."""
    parts = parts.groupBy("orig_index").agg(F.max("score").cast("double").alias(name), F.count(F.lit(1)).alias("_n"))
    joined = rows.join(parts, rows[index] == parts["orig_index"], "full_outer")
    problem = F.when(F.col("orig_index").isNull(), F.concat(F.lit("no score for row "), rows[index].cast("string"))).when(rows[index].isNull(), F.concat(F.lit("no row for score "), F.col("orig_index").cast("string"))).when(F.col("_n") > 1, F.concat(F.lit("several scores for row "), F.col("orig_index").cast("string")))
    return joined.withColumn(name, F.when(problem.isNotNull(), F.raise_error(problem).cast("double")).otherwise(F.col(name))).drop("orig_index", "_n")


def uncovered(rows: DataFrame, index: str, parts: DataFrame) -> DataFrame:
    """Indices of rows without a score."""
    return rows.select(F.col(index).alias("orig_index")).join(parts.select("orig_index"), "orig_index", "left_anti")


def summary(df: DataFrame, by: Sequence[str] = ("split",)) -> dict:
    """Rows and columns of a table, by split or other columns: what summary files hold."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).orderBy(*by).collect()
    return {"total_rows": sum(r["rows"] for r in counts), "columns": [c for c in df.columns if c not in by], "groups": [r.asDict() for r in counts]}


def stamp() -> str:
    """Now, in UTC, to the second."""
    return datetime.now(UTC).isoformat(timespec="seconds")


def pool_summary(stats: DataFrame, requested: Mapping[str, int], specs: Mapping[str, object], **settings: object) -> dict:
    """What a pool was built from: settings, quotas, the counts of each source (a row each) and how sources were declared."""
    sources = [r.asDict() for r in stats.orderBy(stats.columns[0]).collect()]
    return {**settings, "counts": dict(requested), "total_rows": sum(r["collected"] for r in sources), "sources": sources, "source_specs": {k: asdict(v) if is_dataclass(v) else v for k, v in specs.items()}}


def candidate_summary(rows: DataFrame, completion: DataFrame, part_files: int, **settings: object) -> dict:
    """What a candidate table holds, when it was finished and how far each generator has come (a row each)."""
    return {"finalized_at": stamp(), **settings, "total_rows": rows.count(), "total_part_files": part_files, "generator_completion": [r.asDict() for r in completion.orderBy(completion.columns[0]).collect()], "columns": rows.columns}


def training_summary(rows: DataFrame, stats: object, split: str = "split", **settings: object) -> dict:
    """Rows by split of a tokenised table, with the score statistics that its labels rest on."""
    counts = rows.groupBy(split).agg(F.count(F.lit(1)).alias("n")).collect()
    return {**settings, "score_normalization": asdict(stats) if is_dataclass(stats) else stats, "splits": {r[split]: r["n"] for r in sorted(counts, key=lambda r: str(r[split]))}}


def read_summary(spark: SparkSession, path: str) -> dict:
    """The object that write_summary wrote."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_summary(spark: SparkSession, value: dict, path: str) -> None:
    """One JSON object in a folder of one file, through Spark's own file systems."""
    text = json.dumps(value, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
