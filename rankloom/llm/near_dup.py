"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

Two small collections of M half keys of R minimum hashes each stand for M * M tables: the key of
table (i, j) combines half key i of the first collection with half key j of the second, so
2 * M * R minimum hashes are computed instead of 2 * M * M * R. Documents of similarity s meet with
a chance of (1 - (1 - s^R)^M)^2, 0.9998 at s = 0.85 for M = 10 and R = 3.

Equal sets are one class first. In each bucket, members are compared with its pivot, the smallest
id, and confirmed links are joined to components; a bucket whose members then still lie in several
components has the pairs across its components compared as well, so no candidate pair is left
undecided, yet no pairs are made inside what is already linked.

Defined results: a null or empty text, or one without words, has no shingles and is its own
component; a text of fewer words than a shingle is one shingle; rows with words that share an id
are one document, so their links are joined; a null id is its own component, null, and kept; equal
texts are alike whatever their number; a text is worked on whole, so the longest bounds the memory;
other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm import kernels as K
from rankloom.llm.common import discard, few, giving_back, pieces, small_batches, stored, text_column
from rankloom.llm.components import components


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, least similarity in percent, half keys of a collection and hashes of a half key."""

    words: int = 5
    percent: int = 80
    halves: int = 10
    hashes: int = 3
    seed: int = 11


#: Ids of documents to confirm that are broadcast (8 bytes each); above that they are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Shingles of a block of documents that are compared in memory with another block.
BLOCK_SHINGLES = 500_000

_SIGNATURE = "doc_id long, n_shingles long, set_key long, halves array<long>"


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a block, and where each text's begin."""
    w = K.words(texts, lower=True)
    hashes, counts, total = w.hashes(), w.counts, len(w.start)
    text_of = w.text_of
    rolling = K.Rolling(hashes)
    whole = text_of[n - 1 :] == text_of[: total - n + 1] if total >= n else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    grams, of = rolling.grams(n)[at] if len(at) else np.zeros(0, np.uint64), text_of[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        grams = np.concatenate([grams, rolling.runs(w.first[short], w.first[short + 1])])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        grams, of = grams[order], of[order]
    salted = grams ^ K.mix((of + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    keep = np.ones(len(grams), bool)
    keep[K.later(salted, K.repeats(salted))] = False
    grams, of = grams[keep], of[keep]
    return grams, np.searchsorted(of, np.arange(len(texts) + 1))


def signatures(docs: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """key, n_shingles, a hash of the whole set, and the half keys of both collections."""
    small_batches(docs.sparkSession)
    rng = np.random.default_rng(s.seed)
    factors = (rng.integers(0, 2**63, 2 * s.halves * s.hashes, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def block(texts: pa.Array) -> list[pa.Array]:
        grams, first = shingles(texts, s.words)
        sizes = np.diff(first)
        some = np.flatnonzero(sizes)
        halves = np.zeros((len(texts), 2 * s.halves), np.uint64)
        keys = np.zeros(len(texts), np.uint64)
        if len(some):
            keys[some] = K.mix(np.add.reduceat(K.mix(grams ^ np.uint64(s.seed)), first[some]) + sizes[some].astype(np.uint64))
            for i in range(2 * s.halves):
                band = np.full(len(some), i + 1, np.uint64)
                for factor in factors[i * s.hashes : (i + 1) * s.hashes]:
                    band = K.mix(band * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(grams * factor, first[some]))
                halves[some, i] = band
        flat = pa.array(halves.view(np.int64).ravel())
        return [pa.array(sizes, pa.int64()), pa.array(keys.view(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * 2 * s.halves), flat)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in pieces(texts, K.BLOCK):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *block(texts.slice(a, b - a))], names=["doc_id", "n_shingles", "set_key", "halves"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(giving_back(run), _SIGNATURE)


def _shared(slots: DataFrame, name: str) -> DataFrame:
    """slots (set_key, half) -> (set_key, name): the half keys that a class has in common with another, for classes with any."""
    often = slots.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    return slots.join(often, "half", "left_semi").groupBy("set_key").agg(F.array_sort(F.collect_list("half")).alias(name))


def _keys(classes: DataFrame, s: Settings) -> DataFrame:
    """(key, id, set_key, n) of the tables in which a class may meet another: a table needs both its half keys shared.

    A half key holds its slot. Classes alone in the whole first collection leave before the second is looked at.
    """
    one = stored(_shared(classes.select("set_key", F.explode(F.slice("halves", 1, s.halves)).alias("half")), "one"), "near-halves")
    left = classes.join(one.select("set_key"), "set_key", "left_semi")
    two = _shared(left.select("set_key", F.explode(F.slice("halves", s.halves + 1, s.halves)).alias("half")), "two")
    both = one.join(two, "set_key").join(classes.select("set_key", "id", "n"), "set_key")
    pairs = both.withColumn("x", F.explode("one")).withColumn("y", F.explode("two"))
    keys = stored(pairs.select(F.xxhash64("x", "y").alias("key"), "id", "set_key", "n"), "near-keys")
    discard(one)
    return keys


def _alike_sizes(s: Settings, a: Column, b: Column) -> Column:
    """Sets of a similarity of p percent have sizes in at least that proportion."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * s.percent


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """(set_key, grams): the sorted shingle hashes, as bytes, of the documents with those ids, dealt by set_key."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).join(ids, "doc_id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in pieces(texts, K.BLOCK):
                grams, first = shingles(texts.slice(a, b - a), s.words)
                sets = [np.sort(grams[x:y]) for x, y in zip(first[:-1], first[1:], strict=True)]
                keys = [int(K.mix(np.add.reduce(K.mix(g ^ np.uint64(s.seed)), keepdims=True) + np.uint64(len(g))).view(np.int64)[0]) for g in sets]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([g.tobytes() for g in sets], pa.binary())], names=["set_key", "grams"])

    return chosen.mapInArrow(giving_back(run), "set_key long, grams binary").dropDuplicates(["set_key"])


def _confirm(docs: DataFrame, pairs: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """Of pairs (a, b, a_key, b_key) those whose full sets are alike enough: (a, b), stored."""
    pairs = stored(pairs, "near-pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-ids")
    sets = stored(_sets(docs, ids, key, text, s), "near-sets")
    both = pairs.join(sets.toDF("a_key", "a_grams"), "a_key").join(sets.toDF("b_key", "b_grams"), "b_key").select("a", "b", "a_grams", "b_grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int(np.count_nonzero(y[at] == x)) if len(y) else 0
                keep.append(100 * common >= s.percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], names=["a", "b"])

    links = stored(both.mapInArrow(giving_back(run), "a long, b long"), "near-links")
    discard(pairs, ids, sets)
    return links


def _across(docs: DataFrame, keys: DataFrame, pivots: DataFrame, found: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """Links (a, b) between components that meet in a bucket, one for each document and component at least; stored.

    Buckets with one pivot share most members, so their members are put together by pivot. Those
    outside a group's largest component, the askers, are compared with all its members, whatever the
    size of the group. Askers and members are dealt to blocks of bounded shingles; a set is sent
    once to each cell of an asking and a told block that needs it, and only links leave a cell.
    """
    spark = docs.sparkSession
    placed = keys.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    members = placed.join(pivots.select("key", F.col("pivot.set_key").alias("pivot")).join(mixed, "key"), "key").select("pivot", "id", "set_key", "n", "component").distinct()
    members = stored(members, "near-members")
    sizes = members.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    groups = sizes.groupBy("pivot").agg(F.max(F.struct("c", (-F.col("component")).alias("low"), "n")).alias("most"), F.sum("n").alias("n"))
    in_blocks = lambda n: F.greatest(F.ceil(n / BLOCK_SHINGLES), F.lit(1)).cast("int")
    groups = groups.select("pivot", (-F.col("most.low")).alias("main"), in_blocks(F.col("n")).alias("told_blocks"), in_blocks(F.col("n") - F.col("most.n")).alias("ask_blocks"))
    # Stored, so that a pivot of many members is not dealt to one task for the join.
    groups = stored(groups, "near-groups")
    ids = stored(members.select(F.col("id").alias("doc_id")).distinct(), "near-ids")
    sets = stored(_sets(docs, ids, key, text, s), "near-sets")
    rows = members.join(few(groups), "pivot").join(sets, "set_key")
    rows = rows.withColumn("own_q", F.pmod(F.hash("set_key"), F.col("ask_blocks"))).withColumn("own_t", F.pmod(F.hash(F.lit(1), "set_key"), F.col("told_blocks")))
    # A member is told to every asking block; an asker asks every told block as well. In one cell it does both.
    outside = F.col("component") != F.col("main")
    cell = lambda q, t, asks, told: F.struct(q.alias("q"), t.alias("t"), asks.alias("asks"), told.alias("told"))
    told = F.transform(F.sequence(F.lit(0), F.col("ask_blocks") - 1), lambda q: cell(q, F.col("own_t"), outside & (q == F.col("own_q")), F.lit(True)))
    asked = F.transform(F.filter(F.sequence(F.lit(0), F.col("told_blocks") - 1), lambda t: outside & (t != F.col("own_t"))), lambda t: cell(F.col("own_q"), t, F.lit(True), F.lit(False)))
    dealt = rows.withColumn("place", F.explode(F.concat(told, asked))).select("pivot", "place.*", "id", "component", "grams")

    def compare(group: pa.Table) -> pa.Table:
        asks, told = group.column("asks").to_numpy(), group.column("told").to_numpy()
        ids, parts = group.column("id").to_numpy(), group.column("component").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("grams").combine_chunks()] if len(group) else []
        queries, targets = np.flatnonzero(asks), np.flatnonzero(told)
        links: list[tuple[int, int]] = []
        if len(queries) and len(targets):
            lengths = np.array([len(x) for x in sets])
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            start = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.concatenate([codes[start[t] : start[t + 1]] for t in targets])
            first = np.concatenate([[0], np.cumsum(lengths[targets])[:-1]])
            flag = np.zeros(int(codes.max()) + 1, np.int64)
            for q in queries:
                own = codes[start[q] : start[q + 1]]
                flag[own] = 1
                common = np.add.reduceat(flag[flat], first)
                flag[own] = 0
                alike = targets[(100 * common >= s.percent * (lengths[q] + lengths[targets] - common)) & (parts[targets] != parts[q])]
                links += [(int(ids[q]), int(ids[alike[i]])) for i in np.unique(parts[alike], return_index=True)[1]]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    small_batches(spark)
    links = stored(dealt.groupBy("pivot", "q", "t").applyInArrow(compare, "a long, b long"), "near-links")
    discard(members, groups, ids, sets)
    return links


def _by_id(some: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the rows that share an id: they are one document."""
    several = some.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high").select("doc_id")
    rows = some.join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct().join(classes.select("set_key", "id"), "set_key")
    return rows.join(rows.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; kept is whether it is its component's smallest id."""
    s = settings or Settings()
    signed = stored(signatures(docs, key, text, s), "near-signatures")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("c")), "near-classes")
    keys = _keys(classes, s)
    pivots = keys.groupBy("key").agg(F.min(F.struct("id", "set_key", "n")).alias("pivot"), F.count(F.lit(1)).alias("c")).where("c > 1").select("key", "pivot")
    near = keys.join(pivots, "key").where((F.col("set_key") != F.col("pivot.set_key")) & _alike_sizes(s, F.col("n"), F.col("pivot.n")))
    columns = [F.col("pivot.id").alias("a"), F.col("id").alias("b"), F.col("pivot.set_key").alias("a_key"), F.col("set_key").alias("b_key")]
    confirmed = _confirm(docs, near.select(*columns).distinct(), key, text, s)
    links = stored(confirmed.union(_by_id(some, classes)), "near-links")
    found = components(links)
    more = _across(docs, keys, pivots, found, key, text, s)
    if more.head(1):
        found = components(links.union(more))
    # Only classes of several rows or with links differ from their rows' ids.
    merged = classes.join(found, "id", "left").where("c > 1 OR component IS NOT NULL").select("set_key", F.coalesce("component", "id").alias("component"))
    merged = stored(merged, "near-merged")
    discard(classes, keys, confirmed, links, more)
    out = signed.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(merged, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
