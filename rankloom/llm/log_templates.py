"""Line deduplication through a tree of log templates.

A line's path in the tree is its number of tokens and its first `depth` tokens, where a token with
a digit counts as a variable field. Lines of one leaf that agree in enough tokens fall into one
template, whose other positions become variable. A template that recurs in `min_docs` carriers or more is dropped from
all documents. Texts that near-deduplication puts in one group (`near_dup`, with its settings) are
one carrier, and so are exact copies: what only copies share stays, for near-deduplication to decide.

A document loses its boilerplate however much of it that is, and may become empty.

Only hashes of lines leave a scan; the tokens are read again for one line of each distinct sequence
in leaves that hold several. A leaf is always grown in one pass, whatever its size: an index of parts
of the templates finds those that can agree enough. The sequences of a leaf are in one task's memory.

Defined results: a null text stays null, an empty one empty; lines of fewer than `min_words` tokens
are never dropped; repeated rows and equal texts are treated alike; a text is worked on whole, so
the longest bounds the memory; of columns named like a result (n_lines, n_dropped) the result
stays; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import kernels as K
from rankloom.llm.common import discard, giving_back, pieces, small_batches, stored, text_column
from rankloom.llm.near_dup import near_duplicates


@dataclass(frozen=True)
class Tree:
    """Leading tokens of a path, least tokens of a line, least carriers of a dropped template, and percentage of agreeing
    tokens in a template. Lines of fewer tokens than twice the path's and two more have too few to tell templates by."""

    depth: int = 3
    min_words: int = 8
    min_docs: int = 3
    agree: int = 70


#: Bytes of ids and line lists that are broadcast; above that they are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Sequences of a task's worth of leaves.
PART = 4_000

_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
#: Stands for a variable field.
_ANY = np.uint64(0)


def _tokens(w: K.Words) -> np.ndarray:
    """Hash of each token; all tokens with a digit are one variable field."""
    digits = np.concatenate([[0], np.cumsum(_DIGIT[w.data])])
    hashes = w.hashes()
    return np.where(digits[w.end] > digits[w.start], _ANY, hashes | np.uint64(1))


def _lines(w: K.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number in the text, and first and last word of each line with words."""
    breaks = np.flatnonzero(w.data == 10)
    starts = np.union1d(w.offsets[:-1], breaks + 1)
    starts = starts[starts < len(w.data)]
    text = np.searchsorted(w.offsets, starts, "right") - 1
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, w.offsets[text])
    first = np.searchsorted(w.start, starts)
    last = np.append(first[1:], len(w.start))[: len(first)]
    keep = last > first
    return text[keep], number[keep], first[keep], last[keep]


def _paths(texts: pa.Array, tree: Tree) -> dict[str, np.ndarray]:
    """Leaf and token sequence, as hashes, of each line that is long enough."""
    w = K.words(texts)
    text, number, first, last = _lines(w)
    keep = last - first >= tree.min_words
    text, number, first, last = (x[keep] for x in (text, number, first, last))
    rolling = K.Rolling(_tokens(w))
    head = rolling.runs(first, np.minimum(first + tree.depth, last))
    leaf = K.mix(head + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"text": text, "line": number, "leaf": leaf.view(np.int64), "seq": rolling.runs(first, last).view(np.int64)}


def _few(df: DataFrame, lines: str | None = None) -> DataFrame:
    """A stored table of an id, and of line numbers if named, marked for broadcast if it is small enough."""
    size = F.lit(64) + (4 * F.size(lines) if lines else F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def _often(rows: DataFrame, key: str, carrier: str, tree: Tree) -> DataFrame:
    """The keys with enough carriers, stored: a join with them sends no frequent key to one task, be it by broadcast or dealt anew."""
    found = rows.select(key, carrier).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return stored(found.where(F.col("n") >= tree.min_docs).select(key), f"line-often-{key}")


def _grow(sequences: list[np.ndarray], agree: int) -> tuple[list[int], list[np.ndarray]]:
    """Template of each sequence, and the templates: each sequence joins the one it agrees with most, if enough.

    With at most m disagreements, one of m + 1 blocks of positions agrees in full, so templates are
    looked up by blocks; positions that are the same in all sequences are left out of them.
    """
    rows = np.stack(sequences)
    width = rows.shape[1]
    free = np.flatnonzero((rows != rows[0]).any(axis=0))
    most = width - -(-agree * width // 100)
    blocks = np.array_split(free, most + 1) if len(free) > most else []
    index: list[dict[bytes, list[int]]] = [{} for _ in blocks]
    templates = np.empty((0, width), np.uint64)
    n, of = 0, []
    for tokens in rows:
        names = [tokens[block].tobytes() for block in blocks]
        if n:
            near = [x for i, name in zip(index, names, strict=True) if (x := i.get(name))]
            # Old entries of a template that has changed stay: the comparison decides.
            some = np.arange(n) if not blocks or sum(map(len, near)) >= n else np.unique(np.concatenate([np.zeros(0, np.int64), *near]).astype(np.int64))
            if len(some):
                same = np.count_nonzero(templates[some] == tokens, axis=1)
                at = int(same.argmax())
                if 100 * int(same[at]) >= agree * width:
                    best = int(some[at])
                    before = templates[best].copy()
                    templates[best] = np.where(before == tokens, tokens, _ANY)
                    for i, block in zip(index, blocks, strict=True):
                        if (before[block] != templates[best][block]).any():
                            i.setdefault(templates[best][block].tobytes(), []).append(best)
                    of.append(best)
                    continue
        if n == len(templates):
            templates = np.concatenate([templates, np.empty((max(8, n), width), np.uint64)])
        templates[n] = tokens
        for i, name in zip(index, names, strict=True):
            i.setdefault(name, []).append(n)
        of.append(n)
        n += 1
    return of, list(templates[:n])


def _grown(rows: DataFrame, groups: str, tree: Tree) -> DataFrame:
    """rows (leaf, docs, seq, tokens), whole leaves in each group, with template, unique in its leaf."""
    small_batches(rows.sparkSession)

    def grow(task: pa.Table) -> pa.Table:
        task = task.sort_by([("leaf", "ascending"), ("docs", "descending"), ("seq", "ascending")])
        leaf, seq = (task.column(c).to_numpy() for c in ("leaf", "seq"))
        tokens = [np.frombuffer(x.as_buffer(), np.uint64) for c in task.column("tokens").chunks for x in c]
        cuts = np.flatnonzero(np.diff(leaf) != 0) + 1
        made = np.zeros(len(seq), np.int64)
        for a, b in zip([0, *cuts], [*cuts, len(seq)], strict=True):
            if b > a:
                of = np.array(_grow(tokens[a:b], tree.agree)[0])
                # A template is named by its first sequence.
                made[a:b] = seq[a:b][np.unique(of, return_index=True)[1]][of]
        return pa.table({"leaf": leaf, "seq": seq, "template": made})

    return rows.groupBy(groups).applyInArrow(grow, "leaf long, seq long, template long")


def _templates(docs: DataFrame, lines: DataFrame, text: str, tree: Tree) -> DataFrame:
    """(leaf, seq, template) of the distinct sequences in leaves with several; elsewhere the sequence is the template."""
    distinct = stored(lines.groupBy("leaf", "seq").agg(F.min(F.struct("text_id", "line")).alias("at"), F.count(F.lit(1)).alias("docs")), "line-sequences")
    several = stored(distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("leaf"), "line-several")
    chosen = stored(distinct.join(_few(several), "leaf").select("leaf", "seq", "docs", F.col("at.text_id").alias("text_id"), F.col("at.line").alias("line")), "line-chosen")
    total = chosen.count()
    wanted = _few(stored(chosen.groupBy("text_id").agg(F.array_sort(F.collect_list("line")).alias("wanted")), "line-texts"), "wanted")
    read = docs.select(F.xxhash64(text).alias("text_id"), F.col(text).alias("text")).join(wanted, "text_id").select("text_id", "text", "wanted")
    small_batches(docs.sparkSession)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, lines = text_column(batch, "text"), batch.column(0), batch.column(2)
            for a, b in pieces(texts, K.BLOCK):
                w = K.words(texts.slice(a, b - a))
                of, number, first, last = _lines(w)
                # Places of the wanted lines, as one number for text and line.
                some = lines.slice(a, b - a)
                asked = some.value_lengths().to_numpy(zero_copy_only=False)
                places = (np.repeat(np.arange(b - a), asked) << 32) | some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                keep = np.flatnonzero(np.isin((of.astype(np.int64) << 32) | number, places))
                hashes = _tokens(w)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array(of[keep])), pa.array(number[keep], pa.int32()), pa.array([hashes[first[i] : last[i]].tobytes() for i in keep], pa.binary())], names=["text_id", "line", "tokens"]
                )

    found = chosen.join(read.mapInArrow(giving_back(tokens), "text_id long, line int, tokens binary"), ["text_id", "line"]).dropDuplicates(["leaf", "seq"])
    rows = found.withColumn("task", F.pmod(F.xxhash64("leaf"), F.lit(max(1, total // PART))))
    grown = stored(_grown(rows.select("task", "leaf", "docs", "seq", "tokens"), "task", tree), "line-templates")
    discard(distinct, several, chosen)
    return grown


def recurring(docs: DataFrame, text: str = "text", tree: Tree | None = None) -> DataFrame:
    """(text_id, drop): the numbers of the lines to drop from each text, for texts that lose any."""
    tree = tree or Tree()
    small_batches(docs.sparkSession)

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = text_column(batch, "text"), batch.column(0)
            for a, b in pieces(texts, K.BLOCK):
                m = _paths(texts.slice(a, b - a), tree)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array(m["text"])), pa.array(m["line"], pa.int32()), *(pa.array(m[c], pa.int64()) for c in ("leaf", "seq"))], names=["text_id", "line", "leaf", "seq"]
                )

    scanned = docs.select(F.xxhash64(text).alias("text_id"), F.col(text).alias("text")).mapInArrow(giving_back(paths), "text_id long, line int, leaf long, seq long")
    every = stored(scanned.dropDuplicates(["text_id", "line"]), "lines")
    shared = _often(every, "leaf", "text_id", tree)
    lines = stored(every.join(_few(shared), "leaf", "left_semi"), "line-shared")
    discard(every, shared)
    templates = _templates(docs, lines, text, tree)
    placed = lines.join(templates, ["leaf", "seq"], "left").withColumn("template", F.coalesce("template", "seq"))
    placed = stored(placed.select("text_id", "line", F.xxhash64("leaf", "template").alias("template")), "line-placed")
    discard(lines, templates)
    often = _often(placed, "template", "text_id", tree)
    hits = stored(placed.join(_few(often), "template", "left_semi"), "line-hits")
    discard(placed, often)
    # Only texts with such lines can make several carriers one.
    ids = _few(stored(hits.select("text_id").distinct(), "line-hit-texts"))
    some = docs.select(F.xxhash64(text).alias("text_id"), F.col(text).alias("text")).join(ids, "text_id", "left_semi")
    groups = near_duplicates(some, "text_id").where("NOT kept").select(F.col("doc_id").alias("text_id"), F.col("component_id").alias("carrier")).distinct()
    carried = hits.select("template", "text_id").distinct().join(_few(stored(groups, "line-carriers")), "text_id", "left").withColumn("carrier", F.coalesce("carrier", "text_id"))
    return hits.join(_few(_often(carried, "template", "carrier", tree)), "template", "left_semi").groupBy("text_id").agg(F.array_sort(F.collect_list("line")).alias("drop"))


def without_templates(docs: DataFrame, text: str = "text", tree: Tree | None = None, counts: bool = False) -> DataFrame:
    """docs with the recurring lines left out of their texts; a column n_chars follows; counts adds n_lines and n_dropped."""
    columns = [c for c in docs.columns if not (counts and c.lower() in ("n_lines", "n_dropped"))]
    drops = _few(stored(recurring(docs, text, tree).toDF("_text_id", "_drop"), "line-drops"), "_drop")
    lines = F.split(F.col(text), "\n")
    joined = docs.withColumn("_text_id", F.xxhash64(text)).join(drops, "_text_id", "left")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_drop", i)), "\n")
    out = joined.withColumn("_left", F.when(F.col("_drop").isNull(), F.col(text)).otherwise(left))
    if counts:
        out = out.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long")).withColumn("n_dropped", F.coalesce(F.size("_drop"), F.lit(0)).cast("long"))
    out = out.withColumn(text, F.col("_left"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("_drop").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
    return out.select(*columns, *(["n_lines", "n_dropped"] if counts else []))
