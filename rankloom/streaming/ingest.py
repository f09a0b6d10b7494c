"""Streams of files: appending with resume, and deduplication over all that has come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def append(stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write what has come and stop. A batch goes to a folder of its own, replaced if it is done again,
    and the checkpoint says which files are done, so a run that was cut off goes on where it stopped."""

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{out.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, *key: str) -> DataFrame:
    """Rows whose key has not come before; the state holds every key."""
    return stream.dropDuplicates(list(key))
