"""What the text operators share: reading tables, the shared work folder and row identity."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch that goes to Python; a batch holds whole rows, so it is about this many texts large.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of long texts small enough for an executor's Python memory: lowers the session's limit, never raises it.

    Plans read the limit when they run, so it stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


@contextmanager
def uncollected() -> Iterator[None]:
    """The collector of cycles paused, for a step that makes many objects and no cycles; workers are shared, so it goes on after."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def give_back() -> None:
    """Return what Arrow's pool and the C heap hold but don't use to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, with memory given back when a task ends: workers are shared, so else each holds its largest task's through all later stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="rankloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{work_dir(spark)}/rankloom-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


#: Rows of one id each that are broadcast (tens of bytes each); above that they are joined by shuffle.
BROADCAST_ROWS = 500_000


def few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of ids, marked for broadcast if it has at most `rows` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def discard(*tables: DataFrame) -> None:
    """Delete tables that stored() made and that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_string()).fill_null("")


def pieces(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about `most` bytes; one longer row makes a range of its own."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        upto = min(max(upto, at + 1), len(texts))
        yield at, upto
        at = upto
