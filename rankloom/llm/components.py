"""Connected components of undirected edges, without collecting them.

Runs of edges are first contracted where they lie, by a union of at most CHUNK edges in memory, which
leaves an edge from each vertex to the smallest one it reaches there. Alternating stars join what
is left, round by round, until every vertex hangs on one root.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import discard, giving_back, stored

#: Each round at least halves what is left of the longest chain, in practice; the loop ends by itself.
MOST_ROUNDS = 60
#: Edges contracted together in a worker's memory.
CHUNK = 200_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components: for each chunk, every vertex to the smallest of its chunk's component."""

    def united(chunk: list[pa.RecordBatch]) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while root.setdefault(top, top) != top:
                top = root[top]
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for batch in chunk:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in root]
        pairs = [(x, top) for x, top in pairs if x != top]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[pa.RecordBatch] = []
        for batch in batches:
            chunk.append(batch)
            if sum(x.num_rows for x in chunk) >= CHUNK:
                yield united(chunk)
                chunk = []
        if chunk:
            yield united(chunk)

    return edges.mapInArrow(giving_back(run), "a long, b long").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest vertex they share: for larger ones of each vertex, or for the others and itself."""
    if large:
        near = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = near.join(least, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex has one edge to a root, and roots none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(edges.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("v").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child + root > 1").head(1)


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long ids -> (id, component): the smallest id reachable, for every id of an edge."""
    now = stored(_contracted(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")), "cc")
    for _ in range(MOST_ROUNDS):
        if _settled(now):
            break
        before, now = now, stored(_star(_star(now, large=True), large=False), "cc")
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    # `now` stays: the result reads it.
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
