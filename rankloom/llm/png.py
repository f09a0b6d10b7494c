"""Media columns: payload bytes as greyscale PNG images in binary columns, and hashes of them.

Images are 64 samples wide. Chunks carry their CRC, which the reader tests; scan lines use the
None, Sub or Up filter by band, and the reader undoes all five filters in numpy. The feature is
the signs of the low frequencies of a cosine transform of the image reduced to 32 x 32.
Defined results: a null or empty payload is one line of zeros; equal payloads give equal bytes, repeated rows alike;
of columns named like a result the result stays; an empty table gives an empty result. An image is held
whole, so the longest text bounds the memory.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import small_batches

#: Fixed values of the format: its signature, and samples of 8 bits in one grey channel.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
DEPTH, GREY = 8, 0
NONE, SUB, UP, AVERAGE, PAETH = range(5)

WIDTH = 64
#: Lines that share a filter.
BAND = 256
LEVEL = 4


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def padded(payload: bytes, width: int = WIDTH) -> bytes:
    return payload + b"\0" * (-len(payload) % width if payload else width)


def encode(payload: bytes, width: int = WIDTH) -> bytes:
    """PNG of a payload whose length is a positive multiple of width."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    lines = np.empty((len(image), width + 1), np.uint8)
    for top in range(0, len(image), BAND):
        band = image[top : top + BAND]
        left = np.zeros_like(band)
        left[:, 1:] = band[:, :-1]
        above = np.zeros_like(band)
        above[1:] = band[:-1]
        if top:
            above[0] = image[top - 1]
        tries = (band, band - left, band - above)
        kind = min(range(3), key=lambda k: np.count_nonzero(np.bincount(tries[k].ravel(), minlength=256)))
        lines[top : top + BAND, 0] = kind
        lines[top : top + BAND, 1:] = tries[kind]
    header = struct.pack(">IIBBBBB", width, len(image), DEPTH, GREY, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def _paeth(a: int, b: int, c: int) -> int:
    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
    return a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c


def _unfilter(kinds: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Samples of grey 8-bit scan lines; runs of lines with one filter are undone together."""
    out = lines.copy()
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(kinds)], strict=True):
        kind = kinds[a]
        above = out[a - 1] if a else np.zeros(lines.shape[1], np.uint8)
        if kind == SUB:
            np.cumsum(lines[a:b], axis=1, dtype=np.uint8, out=out[a:b])
        elif kind == UP:
            np.cumsum(lines[a:b], axis=0, dtype=np.uint8, out=out[a:b])
            out[a:b] += above
        elif kind in (AVERAGE, PAETH):
            for y in range(a, b):
                up, left, corner = out[y - 1].tolist() if y else [0] * lines.shape[1], 0, 0
                row = lines[y].tolist()
                for x, v in enumerate(row):
                    row[x] = left = (v + ((left + up[x]) // 2 if kind == AVERAGE else _paeth(left, up[x], corner))) & 255
                    corner = up[x]
                out[y] = row
        elif kind != NONE:
            raise ValueError(f"unknown filter {kind}")
    return out


def decode(media: bytes) -> np.ndarray:
    """Samples of a grey 8-bit PNG without interlacing; damaged chunks are refused."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, width, height, body = 8, 0, 0, []
    while True:
        size, kind = struct.unpack_from(">I4s", media, at)
        data = media[at + 8 : at + 8 + size]
        if len(data) != size or struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(data, zlib.crc32(kind)):
            raise ValueError(f"chunk {kind!r} is damaged")
        at += size + 12
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", data)
            if rest != [DEPTH, GREY, 0, 0, 0]:
                raise ValueError("only grey images of 8 bits without interlacing are read")
        elif kind == b"IDAT":
            body.append(data)
        elif kind == b"IEND":
            break
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    if lines.size != height * (width + 1):
        raise ValueError("wrong number of samples")
    lines = lines.reshape(height, width + 1)
    return _unfilter(lines[:, 0], lines[:, 1:])


_SIDE, _LOW = 32, 8
_COSINE = np.cos(np.pi * np.arange(_LOW + 1)[:, None] * (2 * np.arange(_SIDE)[None, :] + 1) / (2 * _SIDE))


def cosine_hash(image: np.ndarray) -> bytes:
    """8 bytes: which of 64 low frequencies, but the constant one, exceed their median."""
    high, wide = image.shape
    rows = np.linspace(0, high, _SIDE + 1).astype(np.int64)
    cols = np.linspace(0, wide, _SIDE + 1).astype(np.int64)
    # Means of blocks from an integral image; a block has a line and a column at least.
    total = np.zeros((high + 1, wide + 1), np.int64)
    np.cumsum(np.cumsum(image, axis=0, dtype=np.int64), axis=1, out=total[1:, 1:])
    top, low = np.minimum(rows[:-1], high - 1), np.maximum(rows[1:], np.minimum(rows[:-1], high - 1) + 1)
    left, right = np.minimum(cols[:-1], wide - 1), np.maximum(cols[1:], np.minimum(cols[:-1], wide - 1) + 1)
    box = total[np.ix_(low, right)] - total[np.ix_(top, right)] - total[np.ix_(low, left)] + total[np.ix_(top, left)]
    small = box / ((low - top)[:, None] * (right - left)[None, :])
    bands = np.round(_COSINE @ small @ _COSINE.T, 6)
    low_ones = bands[1:, 1:].ravel()
    return np.packbits(low_ones > np.median(low_ones)).tobytes()


def store(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """docs with a binary column `media`: the PNG of each text's UTF-8, zero-padded; n_bytes is the length before."""
    small_batches(docs.sparkSession)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in (media.lower(), "n_bytes")))
    schema = T.StructType([*kept.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField(media, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            payloads = [(x.as_py() or b"") for x in column]
            made = [pa.array(map(len, payloads), pa.int64()), pa.array([encode(padded(x)) for x in payloads], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "n_bytes", media])

    return kept.mapInArrow(run, schema)


FEATURES = T.StructType([
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()),
    T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("cosine_hash", T.BinaryType()),
])


def features(stored: DataFrame, media: str = "media") -> DataFrame:
    """The stored images read back: digests of their payloads and stored forms, and the cosine hash in a binary column."""
    small_batches(stored.sparkSession)
    names = [f.name for f in FEATURES]
    kept = [c for c in stored.columns if c != media and c.lower() not in names]
    stored = stored.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{media}`"))
    schema = T.StructType([*stored.drop(media).schema.fields, *FEATURES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for x in batch.column(len(kept)):
                image = decode(x.as_py())
                payload = image.tobytes()
                for column, value in zip(rows, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(x.as_py()), hashlib.sha256(x.as_py()).hexdigest(), cosine_hash(image)), strict=True):
                    column.append(value)
            made = [pa.array(v, f) for v, f in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=[*kept, *names])

    return stored.mapInArrow(run, schema)
