"""Language-model scores by prediction by partial matching over bytes, with a unigram baseline.

Counts of every run of ORDER + 1 symbols of the training texts (bytes and a boundary) and of every
word are added up over all executors; shorter contexts are sums of longer ones. All counted runs
are in the model: it is tables in the shared folder, which grow with the corpus.

A symbol is coded in its longest counted context. With D symbols and total T there, a symbol of
count n has n / (T + D) and an escape D / (T + D); after an escape the next shorter context leaves
the symbols of the longer one out of all of n, T and D (symbol exclusion). Below order 0 the symbols
left are equally likely.

Words are known by 64-bit hashes. The most frequent words and the most frequent runs, at most NODES
each, are scored where the text is read; the other words and runs of a document are joined with the
table of all counts, and runs that were not counted go down the orders by joins on their contexts.
NODES and SHARE move work between the two ways and change no score.

Defined results: a null or empty text is one end token; a null id is held out; without training
tokens the baseline is 0 for each token and the model is uniform; repeated rows are scored each;
other columns don't matter; an empty table gives an empty result. A text is read whole, so the longest bounds the memory.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm import kernels as K
from rankloom.llm.common import giving_back, pieces, small_batches, stored, text_column

ORDER = 5
#: Words, and runs, that are scored where the text is read; all others are joined.
NODES = 1 << 20
#: Runs rarer than one in SHARE are joined in any case, so that their part doesn't jump where the NODES are used up.
SHARE = 1 << 25
#: Bits of a symbol: 256 bytes and the boundary, which stands before a text and ends it.
BITS, EDGE, SYMBOLS = 9, 256, 257
#: Distinct keys that a task gathers before it hands them on.
GATHERED = 3_000_000
WORD_KIND, RUN_KIND = 0, 1
#: Hash of the end token; that of a word equals it with a chance of 2^-64.
END = np.uint64(zlib.crc32(b"end of text") * 2654435761 + 1)
_U = np.uint64


def held_out(key: Column) -> Column:
    """Whether a document is kept from training, by the remainder of its id's checksum."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(True))


def runs(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of order + 1 symbols that ends at each symbol of each lower-cased text and at its end, and where each text's begin."""
    data, offsets = K.block_bytes(texts)
    n, lengths = len(texts), np.diff(offsets)
    # Each text is laid out as `order` boundaries, its bytes and a boundary.
    first = offsets[:-1] + np.arange(n) * (order + 1)
    symbols = np.full(len(data) + n * (order + 1), EDGE, np.uint64)
    is_byte = np.ones(len(symbols), bool)
    for j in range(order):
        is_byte[first + j] = False
    is_byte[first + order + lengths] = False
    symbols[is_byte] = K.lowered(data)
    keys = symbols[order:].copy()
    for j in range(1, order + 1):
        keys |= symbols[order - j : len(symbols) - j] << _U(BITS * j)
    target = is_byte
    target[first + order + lengths] = True
    return keys[target[order:]], offsets + np.arange(n + 1)


class Gathered:
    """Counts of 64-bit keys in bounded memory."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        order = np.sort(keys)
        cut = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else np.zeros(0, np.int64)
        self.parts.append((order[cut], np.diff(np.append(cut, len(order)))))
        self.size += len(cut)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        # One array after the other, and what it is made of let go: a worker's peak is here.
        all_keys, all_counts = (list(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        keys = np.concatenate(all_keys)
        del all_keys
        counts = np.concatenate(all_counts)
        del all_counts
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        counts = counts[order]
        del order
        cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts, cut) if len(cut) else counts[:0]
        self.parts, self.size = [(keys[cut], counts)], len(cut)
        return self.parts[0]


def counts(docs: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """(kind, key, n): counts of words and of runs over all texts, each with the end token or boundary."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {WORD_KIND: Gathered(), RUN_KIND: Gathered()}

        def handed(kind: int) -> Iterator[pa.RecordBatch]:
            if held[kind].parts:
                keys, n = held[kind].merged()
                for a in range(0, len(keys), 100_000):
                    k = keys[a : a + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[a : a + 100_000])], names=["kind", "key", "n"])
            held[kind] = Gathered()

        for batch in batches:
            texts = text_column(batch, text)
            for a, b in pieces(texts, K.BLOCK):
                part = texts.slice(a, b - a)
                held[WORD_KIND].add(np.concatenate([K.words(part, lower=True).hashes(), np.full(b - a, END)]))
                held[RUN_KIND].add(runs(part, order)[0])
            for kind, g in held.items():
                if g.size > GATHERED:
                    g.merged()
                    if g.size > GATHERED // 2:
                        yield from handed(kind)
        for kind in held:
            yield from handed(kind)

    # Tasks have added up their own keys, so before the exchange an aggregate would only hold them once more, in the JVM.
    return docs.select(text).mapInArrow(giving_back(run), "kind int, key long, n long").repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Table:
    """Positions of 64-bit keys, looked up in bulk by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.shift, self.last = _U(64 - bits), (1 << bits) - 1
        self.keys, self.at = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.at[slot[left]] < 0
            self.at[slot[left[free]]] = left[free]
            lost = self.at[slot[left]] != left
            self.keys[slot[left[~lost]]] = keys[left[~lost]]
            left = left[lost]
            slot[left] = (slot[left] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        slot = self._slot(keys)
        out = self.at[slot]
        left = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            got = self.at[slot[left]]
            out[left] = got
            left = left[(got >= 0) & (self.keys[slot[left]] != keys[left])]
        return out


@dataclass
class Level:
    """Contexts of one length and their runs: log counts, and log totals and escapes, whole and with a longer context's exclusions."""

    runs: Table
    contexts: Table
    log_n: np.ndarray
    log_p: np.ndarray
    escape: np.ndarray
    below_total: np.ndarray
    below_escape: np.ndarray


class Model:
    """A model in one process, which `scores` doesn't use: of D kept symbols and total T in a context, of which X belong to runs
    not kept, an escape has (X + D) / (T + D). levels[k]: sorted run keys of k + 1 symbols with counts, and sorted context keys with totals, runs not kept included."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.levels: list[Level] = []
        self.left = SYMBOLS
        below: tuple | None = None
        log = lambda x: np.log(np.maximum(x, 1e-300))
        for k, (keys, n, contexts, totals) in enumerate(levels):
            of = np.searchsorted(contexts, keys >> _U(BITS))
            kinds = np.bincount(of, minlength=len(contexts))
            kept = np.bincount(of, n, len(contexts))
            whole, miss = totals + kinds, totals - kept + kinds
            if k == 0:
                self.left = SYMBOLS - len(keys)
                total, rest = np.full(len(contexts), float(max(self.left, 1))), np.ones(len(contexts))
            else:
                # What the suffix has left without this context's symbols.
                b_keys, b_n, b_contexts, b_whole, b_miss, b_kinds = below
                suffix = np.searchsorted(b_contexts, contexts & _U((1 << BITS * (k - 1)) - 1))
                same = np.searchsorted(b_keys, keys & _U((1 << BITS * k) - 1))
                total = b_whole[suffix] - np.bincount(of, b_n[same], len(contexts)) - kinds
                rest = b_miss[suffix] - kinds
            self.levels.append(Level(Table(keys), Table(contexts), np.log(n.astype(float)), np.log(n.astype(float)) - log(whole[of]), log(miss) - log(whole), log(total), np.where(total > 0, log(rest) - log(total), 0.0)))
            below = (keys, n.astype(float), contexts, whole.astype(float), miss.astype(float), kinds)

    def score(self, keys: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each run, after those before it."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        longer: np.ndarray | None = None  # position of the longer context, or -1 while none was known
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            own = keys[left] & _U((1 << BITS * (k + 1)) - 1)
            at = level.runs.find(own)
            found = at >= 0
            if longer is None:
                out[left[found]] += level.log_p[at[found]]
            else:
                after = longer >= 0
                hit = found & after
                out[left[hit]] += level.log_n[at[hit]] - self.levels[k + 1].below_total[longer[hit]]
                hit = found & ~after
                out[left[hit]] += level.log_p[at[hit]]
            miss = ~found
            left, own, after_miss = left[miss], own[miss], None if longer is None else longer[miss]
            context = level.contexts.find(own >> _U(BITS))
            known = context >= 0
            if after_miss is None:
                out[left[known]] += level.escape[context[known]]
            else:
                after = after_miss >= 0
                hit = known & after
                out[left[hit]] += self.levels[k + 1].below_escape[after_miss[hit]]
                hit = known & ~after
                out[left[hit]] += level.escape[context[hit]]
            longer = context
            if not len(left):
                return out
        # Below order 0: the symbols that the corpus doesn't have.
        out[left] -= np.log(max(self.left, 1))
        return out


def _threshold(df: DataFrame, most: int) -> int:
    """The smallest power of two that at most `most` values of n reach."""
    steps = {r["step"]: r["c"] for r in df.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("c")).collect()}
    total, step = 0, max(steps, default=0) + 1
    while step > 0 and total + steps.get(step - 1, 0) <= most:
        step -= 1
        total += steps.get(step, 0)
    return 1 << step


def _arrays(df: DataFrame) -> list[np.ndarray]:
    table = df.toArrow()
    columns = [table.column(c).to_numpy() for c in table.column_names]
    order = np.argsort(columns[0].view(np.uint64), kind="stable")
    return [c[order] for c in columns]


def kept_counts(counted: DataFrame, order: int = ORDER, nodes: int = NODES) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of a Model from the counts of all runs; it collects at most `nodes` runs and contexts an order."""
    whole = counted.where(F.col("kind") == RUN_KIND).select("key", "n")
    levels, least = [], 1
    for k in range(order + 1):
        level = whole if k == order else whole.groupBy(F.col("key").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1)).alias("key")).agg(F.sum("n").alias("n"))
        least = max(least, _threshold(level, nodes))
        keys, n = _arrays(level.where(F.col("n") >= least))
        contexts = level.groupBy(F.shiftright("key", BITS).alias("key")).agg(F.sum("n").alias("total"), F.max("n").alias("most")).where(F.col("most") >= least).drop("most")
        names, totals = _arrays(contexts)
        levels.append((keys.view(np.uint64), n, names.view(np.uint64), totals))
    return levels


def fit(counted: DataFrame, order: int = ORDER, nodes: int = NODES) -> Model:
    return Model(kept_counts(counted, order, nodes))


_loaded: dict[str, tuple[Table, np.ndarray, Table, np.ndarray]] = {}


def _load(name: str, words: np.ndarray, word_logs: np.ndarray, common: np.ndarray, run_logs: np.ndarray) -> tuple[Table, np.ndarray, Table, np.ndarray]:
    """The tables of a broadcast, built once in each worker: they are several times as large as their keys."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = (Table(words), word_logs, Table(common), run_logs)
    return _loaded[name]


def _suffix(key: Column | str, symbols: int) -> Column:
    return (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit((1 << BITS * symbols) - 1))


def _uncounted(whole: DataFrame, keys: DataFrame, order: int) -> DataFrame:
    """(key, log): natural log probability of the last symbol of runs (key) that are not among the counted ones (key, n)."""
    levels = [whole]
    for k in range(order - 1, -1, -1):
        levels.insert(0, stored(levels[0].groupBy(_suffix("key", k + 1).alias("key")).agg(F.sum("n").alias("n")), "ppm-level"))
    # Tables of at most 2^18 rows whatever the corpus.
    small = lambda df, symbols: F.broadcast(df) if symbols <= 2 else df
    # gone, gone_kinds: what the longer context excludes, 0 where that was not counted.
    left, out = keys.select("key", F.lit(0.0).alias("log"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("gone_kinds")), []
    for k in range(order, -1, -1):
        asked = left.withColumn("context", F.shiftright(_suffix("key", k + 1), BITS))
        runs = levels[k].withColumn("context", F.shiftright("key", BITS)).join(asked.select("context").distinct(), "context", "left_semi")
        below = F.lit(0).cast("long")
        if k:
            runs = runs.withColumn("shorter", _suffix("key", k)).join(small(levels[k - 1].toDF("shorter", "below"), k), "shorter")
            below = F.sum("below")
        contexts = runs.groupBy("context").agg((F.sum("n") + F.count(F.lit(1))).alias("whole"), F.count(F.lit(1)).alias("kinds"), below.alias("below"))
        joined = asked.withColumn("own", _suffix("key", k + 1)).join(small(contexts, k), "context", "left")
        joined = joined.join(small(levels[k].toDF("own", "n"), k + 1), "own", "left")
        total, rest = F.col("whole") - F.col("gone") - F.col("gone_kinds"), F.col("kinds") - F.col("gone_kinds")
        step = F.when(F.col("n").isNotNull(), F.log(F.col("n") / total)).when(total > 0, F.log(rest / total)).otherwise(0.0)
        known = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        done = stored(joined.select("key", (F.col("log") + step).alias("log"), known("below").alias("gone"), known("kinds").alias("gone_kinds"), F.col("n").isNotNull().alias("found")), "ppm-order")
        out.append(done.where("found").select("key", "log"))
        left = done.where("NOT found").drop("found")
    # Below order 0: the symbols that the corpus doesn't have.
    logs = left.select("key", F.col("log") - F.lit(float(np.log(max(SYMBOLS - levels[0].count(), 1)))))
    for df in out:
        logs = logs.union(df)
    return logs.toDF("key", "log")


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, nodes: int = NODES) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each text, learnt from those not held out."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("held_out", held_out(F.col("doc_id")))
    counted = stored(counts(rows.where(~F.col("held_out")), "text", order), "ppm-counts")
    words = counted.where(F.col("kind") == WORD_KIND).select(F.col("key").alias("word"), "n")
    total = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, kinds = int(total[0] or 0), int(total[1])
    norm = tokens + 0.1 * (kinds + 1)
    least = _threshold(words, nodes)
    common = _arrays(words.where(F.col("n") >= least))
    # A context has SYMBOLS runs at most. What training texts hold is always found here, in the longest context.
    whole = counted.where(F.col("kind") == RUN_KIND).select("key", "n")
    context = Window.partitionBy(F.shiftright("key", BITS))
    placed = stored(whole.select("key", "n", F.log(F.col("n") / (F.sum("n").over(context) + F.count(F.lit(1)).over(context))).alias("log")), "ppm-runs")
    symbols = int(whole.agg(F.sum("n")).first()[0] or 0)
    least_run = max(_threshold(whole, nodes), -(-symbols // SHARE))
    often = _arrays(placed.where(F.col("n") >= least_run).select("key", "log"))
    held = spark.sparkContext.broadcast((common[0].view(np.uint64), np.log10((common[1] + 0.1) / norm), often[0].view(np.uint64), often[1]))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, logs, run_table, run_logs = _load(name, *held.value)
        columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "kind", "key", "times"]
        none = lambda size, kind: pa.nulls(size, kind)

        def others(kind: int, rest: np.ndarray, text_of: np.ndarray, ids: pa.Array, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            """Keys to be joined, once a text with their number."""
            if not len(rest):
                return
            sort = np.lexsort((rest, text_of))
            rest, text_of = rest[sort], text_of[sort]
            cut = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (text_of[1:] != text_of[:-1])]))
            times = np.diff(np.append(cut, len(rest)))
            for a in range(0, len(cut), 100_000):
                c = cut[a : a + 100_000]
                m = len(c)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text_of[c])), none(m, id_type), none(m, pa.bool_()), none(m, pa.int64()), none(m, pa.int64()), none(m, pa.float64()), none(m, pa.float64()), pa.array(np.full(m, kind, np.int32)), pa.array(rest[c].view(np.int64)), pa.array(times[a : a + 100_000], pa.int64())],
                    names=columns,
                )

        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in pieces(texts, K.BLOCK):
                part, n = texts.slice(a, b - a), b - a
                w = K.words(part, lower=True)
                hashes, of = w.hashes(), w.text_of
                # The end token of each text comes after all words.
                hashes, of = np.concatenate([hashes, np.full(n, END)]), np.concatenate([of, np.arange(n)])
                at = table.find(hashes)
                found = at >= 0
                known = np.bincount(of[found], minlength=n)
                base = np.bincount(of[found], logs[at[found]], n)
                keys, first = runs(part, order)
                run_of = np.repeat(np.arange(n), np.diff(first))
                run_at = run_table.find(keys)
                seen = run_at >= 0
                score = np.bincount(run_of[seen], run_logs[run_at[seen]], n)
                ids = batch.column(0).slice(a, n)
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column(1).slice(a, n), batch.column(3).slice(a, n), pa.array(w.counts + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()), none(n, pa.int32()), none(n, pa.int64()), none(n, pa.int64())], names=columns
                )
                yield from others(WORD_KIND, hashes[~found], of[~found], ids, batch.column(1).type)
                yield from others(RUN_KIND, keys[~seen], run_of[~seen], ids, batch.column(1).type)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, kind int, key long, times long"
    small_batches(spark)
    read = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
    passed = stored(read.mapInArrow(giving_back(run), schema), "ppm-scores")
    seldom = passed.where(F.col("kind") == WORD_KIND).select("row", F.col("key").alias("word"), "times").join(words.where(F.col("n") < least), "word", "left")
    log = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.1)) / F.lit(norm))
    of_words = seldom.select("row", F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"), (F.col("times") * log).alias("base"), F.lit(0.0).alias("score"))
    # Runs below the threshold have their logs already; the others were not counted.
    rest = passed.where(F.col("kind") == RUN_KIND).select("row", "key", "times")
    asked = stored(rest.select("key").distinct().join(placed.where(F.col("n") < least_run).select("key", "log"), "key", "left"), "ppm-asked")
    run_logs = asked.where("log IS NOT NULL").union(_uncounted(whole, asked.where("log IS NULL").select("key"), order))
    of_runs = rest.join(run_logs, "key").select("row", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), (F.col("times") * F.col("log") / F.lit(float(np.log(10)))).alias("score"))
    more = of_words.union(of_runs).groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("score").alias("more_score"))
    out = passed.where("kind IS NULL").join(more, "row", "left")
    return out.select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), (F.col("score") / F.lit(float(np.log(10))) + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
