"""SentencePiece encoding and decoding through a table of distinct chunks.

A chunk is a run of white-space markers and what follows up to the next marker. Where no piece of
the vocabulary holds a marker after another character, merges never cross chunks, so each distinct
chunk is segmented once and its ids are joined back by position. A model for which that does not
hold is applied to whole texts. Defined results: a null or empty text has no ids and decodes to "";
repeated rows are encoded alike; of columns named like a result the result stays; an empty table gives
an empty result. The ids of a text are held whole, so the longest bounds the memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import giving_back, pieces, small_batches, text_column, uncollected

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Distinct chunks in each of the two halves of a task's table. When the newer half is full it
#: becomes the older one, so chunks that come again stay and memory is bounded.
TABLE = 100_000
#: Characters of a chunk that is kept; longer ones are segmented each time.
KEPT = 100

#: Rows of an Arrow batch and bytes of text segmented together: the more, the more chunks recur.
ROWS, BLOCK = 1000, 3 << 20
#: Ids of a chunk, and the same in decimal.
Segmented = tuple[list[int], str]


class ChunkEncoder:
    def __init__(self, model: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.newer: dict[str, Segmented] = {}
        self.older: dict[str, Segmented] = {}
        self.by_chunk = self.separable()

    def forget(self) -> None:
        """Empty the table, so that a worker keeps the model alone for its next task."""
        self.newer, self.older = {}, {}

    def separable(self) -> bool:
        """Whether chunks can be segmented apart: no piece crosses a marker, and normalisation only marks blanks and the start."""
        sp = self.model
        if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size())):
            return False
        probe = " a  B ﬁ\t\nc "
        return sp.normalize(probe) == MARK + probe.replace(" ", MARK)

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text that is not empty, each with one marker of its run left out."""
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [x[1:].replace(MARK, " ") for x in _CHUNK.findall(MARK + text.replace(" ", MARK))]

    def _segment(self, chunks: list[str]) -> list[list[int]]:
        if not self.by_chunk:
            return self.model.encode(chunks, num_threads=1)
        # An empty text gets no marker of its own; a lone marker is what is left of two.
        found = self.model.encode(chunks, num_threads=1)
        for i, chunk in enumerate(chunks):
            if not chunk:
                found[i] = [self.model.piece_to_id(MARK)]
        return found

    def _look_up(self, distinct: list[str]) -> list[Segmented]:
        """Ids of each distinct chunk, and the same in decimal."""
        newer, older = self.newer, self.older
        found = list(map(newer.get, distinct))
        missing = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(missing, map(older.get, map(distinct.__getitem__, missing)), strict=True):
            found[i] = x
        new = [i for i in missing if found[i] is None]
        for i, ids in zip(new, self._segment([distinct[i] for i in new]), strict=True):
            found[i] = (ids, ",".join(map(str, ids)))
        if len(newer) + len(missing) > TABLE:
            self.older, self.newer = newer, {}
        self.newer.update((distinct[i], found[i]) for i in missing if len(distinct[i]) <= KEPT)
        return found

    def batch(self, texts: pa.Array) -> Batch:
        """The texts as positions in a table of the ids of their distinct chunks."""
        with uncollected():
            return self._batch(texts)

    def _batch(self, texts: pa.Array) -> Batch:
        odd = pc.or_(pc.match_substring_regex(texts, f"^ |  | $|{MARK}"), pc.equal(texts, ""))
        if self.by_chunk and not pc.any(odd).as_py():
            split = pc.split_pattern(texts, " ")
        elif self.by_chunk:
            # A few odd texts are split here, by the rule for runs of markers.
            split = pa.array([self.chunks(x) if x else [] for x in texts.to_pylist()], pa.list_(pa.string()))
        else:
            split = pa.array([[x] if x else [] for x in texts.to_pylist()], pa.list_(pa.string()))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = split.offsets.to_numpy().astype(np.int64)
        return Batch(coded.indices.to_numpy(), first - first[0], self._look_up(distinct))


@dataclass
class Batch:
    """Text t is chunks code[first[t]:first[t + 1]]; chunk c has the ids table[c][0]."""

    code: np.ndarray
    first: np.ndarray
    table: list[Segmented]

    def ids(self) -> pa.ListArray:
        ids = [x[0] for x in self.table]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        sizes = lengths[self.code]
        ends = np.cumsum(sizes)
        at = np.repeat(starts[self.code] - ends + sizes, sizes) + np.arange(int(sizes.sum()))
        ends = np.concatenate([[0], ends])
        return pa.ListArray.from_arrays(pa.array(ends[self.first].astype(np.int32)), pa.array(flat[at], pa.int32()))

    def written(self) -> list[str]:
        """The ids of each text in decimal, joined by commas."""
        names = [x[1] for x in self.table]
        return [",".join(map(names.__getitem__, self.code[a:b].tolist())) for a, b in zip(self.first[:-1], self.first[1:], strict=True)]


@lru_cache(2)
def encoder(model: str) -> ChunkEncoder:
    """One for each worker process and model file."""
    return ChunkEncoder(model)


def blocks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of whole rows of about BLOCK bytes, with their texts; null texts are empty."""
    texts = text_column(batch, text)
    for a, b in pieces(texts, BLOCK):
        yield batch.slice(a, b - a), texts.slice(a, b - a).cast(pa.string())


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with their ids: array<int>. The model file is read by each worker at the same path."""
    small_batches(docs.sparkSession, ROWS)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != ids.lower()))
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part, texts in blocks(batch, text):
                    yield pa.RecordBatch.from_arrays([*part.columns, encoder(model).batch(texts).ids()], names=[*part.schema.names, ids])
        finally:
            encoder(model).forget()

    return kept.mapInArrow(giving_back(run), schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded with the text of its ids; null ids give ""."""
    small_batches(encoded.sparkSession, ROWS)
    kept = encoded.select(*(F.col(f"`{c}`") for c in encoded.columns if c.lower() != decoded.lower()))
    schema = T.StructType([*kept.schema.fields, T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sp = encoder(model).model
            made = pa.array([sp.decode(x) if x else "" for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, decoded])

    return kept.mapInArrow(giving_back(run), schema)


def digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded in one pass."""
    small_batches(docs.sparkSession, ROWS)
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part, texts in blocks(batch, text):
                    coded = encoder(model).batch(texts)
                    ids = coded.ids()
                    decoded = [encoder(model).model.decode(x) if x else "" for x in ids.to_pylist()]
                    made = [pa.array(np.diff(ids.offsets.to_numpy()), pa.int64()), pa.array(map(_sha, coded.written()), pa.string()), pa.array(map(_sha, decoded), pa.string())]
                    yield pa.RecordBatch.from_arrays([part.column(0), *made], names=schema.names)
        finally:
            encoder(model).forget()

    return docs.select(F.col(key), F.col(text)).mapInArrow(giving_back(run), schema)
