"""A corpus from documents to token ids: quality, line and near-duplicate filters, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and the documents that its predecessor kept, and returns a
DataFrame; all but the last return the columns of documents. `run` applies them in turn, each
result written to the shared folder as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import few, stored, table
from rankloom.llm.log_templates import without_templates
from rankloom.llm.mixing import mixed
from rankloom.llm.near_dup import near_duplicates
from rankloom.llm.pieces import encode
from rankloom.llm.quality import quality
from rankloom.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality(docs).where("kept").select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that recur across them."""
    return without_templates(docs).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (five words, similarity 0.8), and one row of each of its texts."""
    groups = stored(near_duplicates(docs), "near-groups")
    gone = few(stored(groups.where("NOT kept").select(F.col("doc_id").alias("_id")).distinct(), "near-gone"))
    left = docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti")
    # Rows of one id and text are copies; only ids of several rows are compared, so other texts don't move.
    again = few(stored(groups.where("kept").groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_id"), "near-again"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = left.join(again, same, "left_semi").withColumn("_first", F.xxhash64("text")).dropDuplicates(["doc_id", "_first"])
    return left.join(again, same, "left_anti").select(*COLUMNS).union(rows.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    return mixed(docs).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and ids of each row."""
    out = encode(docs, vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality rules", good),
    ("line dedup", without_boilerplate),
    ("near-duplicates", one_of_each),
    ("source mix", mixture),
    ("sentencepiece", encoded),
]

#: SQL can't express MinHash components, the hash order of the mix or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
