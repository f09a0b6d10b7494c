"""A WARC archive of pages, dictionary-compressed, and its reader.

Each archive begins with a skippable frame that holds a Zstandard dictionary, built from a bounded
sample of its own records (the first SAMPLE bytes of them); every record after it is a frame of its
own. Records of equal payloads of at least MIN_REVISIT bytes are revisits of the one with the
smallest key. A task writes archives under names that no other attempt uses and reports them only
when it ends, so lost executors leave orphans but no wrong manifest.
Defined results: a null payload is empty; a null key comes last, can't be referred to, and is read
back as null; rows that share the smallest key are all responses; an empty table gives an empty
manifest, which reads back as no records. Of columns named like a result the result stays, others are
left alone. A payload is held whole in memory, so the longest bounds it; so is the longest record of an archive.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import new_path, small_batches, stored

#: Fixed values of the format: the number of the skippable frame that holds the dictionary, the first
#: number of a trained dictionary, and line ends.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437
CRLF = "\r\n"

MIN_REVISIT = 100
#: Bytes of records from which the dictionary is built, of the dictionary, and of records in an archive.
SAMPLE, DICTIONARY, ARCHIVE = 1 << 20, 32 << 10, 256 << 20
LEVEL = 3
READ = 1 << 16
#: Groups of equal payloads that are broadcast (about 100 bytes each); above that they are joined by shuffle.
BROADCAST_GROUPS = 100_000

_MANIFEST = "archive string, records long, bytes long, dictionary_bytes long"
_RECORDS = "key long, record_type string, refers_to long, target_uri string, payload_bytes long, payload_digest string"


def roles(pages: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """pages with payload_bytes, payload_digest, record_type and refers_to."""
    pages = pages.drop("payload_bytes", "payload_digest", "record_type", "refers_to")
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumn("payload_bytes", F.octet_length(body).cast("long")).withColumn("payload_digest", F.sha2(body.cast("binary"), 256))
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _first IS NOT NULL")
    groups = stored(groups.drop("_n"), "warc-groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    found = rows.join(groups, "payload_digest", "left")
    again = F.col("_first").isNotNull() & ~F.col(key).eqNullSafe(F.col("_first"))
    return found.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("_first"))).drop("_first")


def _record_id(key: object, digest: str) -> str:
    return f"<urn:x-page:{'null' if key is None else key}:{digest[:16]}>"


def _key_of(record_id: str | None) -> int | None:
    found = re.match(r"<urn:x-page:(-?\d+):", record_id or "")
    return int(found[1]) if found else None


def _record(key: object, url: str | None, payload: bytes, digest: str, kind: str, refers_to: object) -> bytes:
    # A response's block is an HTTP message; a revisit keeps its head and leaves the payload out.
    head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}".encode()
    block = head + (payload if kind == "response" else b"")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:x-page:unknown")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(key, digest)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if kind == "revisit":
        fields += [("WARC-Refers-To", _record_id(refers_to, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1", CRLF, *(f"{a}: {b}{CRLF}" for a, b in fields), CRLF]).encode() + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on the samples; of too few samples, their first bytes."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write_archive(folder: str, records: Iterator[bytes], first: list[bytes]) -> tuple[str, int, int, int]:
    """One archive of the records in first and of those that follow until it is full."""
    dictionary = build_dictionary(first)
    body = dictionary.as_bytes()
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    path = f"{path}/{uuid.uuid4().hex}.warc.zst"
    n = raw = size = 0
    with fs.open_output_stream(path) as out:
        for frame in (struct.pack("<II", DICTIONARY_FRAME, len(body)) + body,):
            size += out.write(frame)
        for source in (first, records):
            for record in source:
                size += out.write(press.compress(record))
                n, raw = n + 1, raw + len(record)
                if raw >= ARCHIVE and source is records:
                    return f"{folder}/{path.rsplit('/', 1)[1]}", n, size, len(body)
    return f"{folder}/{path.rsplit('/', 1)[1]}", n, size, len(body)


def write_archives(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the rows of roles() to archives in a folder that all executors share; the manifest of archives."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or new_path(spark, "warc")
    columns = [key, url, payload, "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[bytes]:
            for batch in batches:
                for k, u, body, digest, kind, refers in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                    yield _record(k, u, (body or "").encode(), digest, kind, refers)

        records = made()
        while True:
            first, size = [], 0
            for record in records:
                first.append(record)
                size += len(record)
                if size >= SAMPLE:
                    break
            if not first:
                return
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in _write_archive(folder, records, first)], names=["archive", "records", "bytes", "dictionary_bytes"])

    return stored(pages.select(*columns).mapInArrow(run, _MANIFEST), "warc-manifest")


def _frames(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of an archive, streamed."""
    fs, at = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(at) as raw:
        number, size = struct.unpack("<II", raw.read(8))
        if number != DICTIONARY_FRAME:
            raise ValueError(f"{path} doesn't begin with a dictionary")
        body = raw.read(size)
        trained = body[:4] == struct.pack("<I", DICTIONARY_MAGIC)
        dictionary = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdDecompressor(dict_data=dictionary)
        chunk = raw.read(READ)
        while chunk:
            frame, parts = press.decompressobj(), []
            while not frame.eof:
                if not chunk and not (chunk := raw.read(READ)):
                    raise ValueError(f"{path} ends inside a record")
                parts.append(frame.decompress(chunk))
                chunk = b"" if not frame.eof else frame.unused_data
            yield _parsed(path, b"".join(parts))
            chunk = chunk or raw.read(READ)


def _parsed(path: str, record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split(CRLF)
    fields = dict(x.split(": ", 1) for x in lines)
    size = int(fields.get("Content-Length", -1))
    if not version.startswith("WARC/") or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{path} holds a frame that is no record")
    return fields, rest[:size]


def read_archives(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """Records of the archives of a manifest: digests and sizes of the payloads as read, and on request the payloads.

    A revisit's size and digest are those of the payload that it leaves out, from its own fields; `resolved` takes them from its response.
    """
    schema = _RECORDS + (", payload binary" if payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(path: str) -> Iterator[tuple]:
        for fields, block in _frames(path):
            head, _, body = block.partition(b"\r\n\r\n")
            kind = fields["WARC-Type"]
            if kind == "response":
                size, digest = len(body), hashlib.sha256(body).hexdigest()
                if fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                    raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is damaged")
            else:
                size, digest = int(re.search(rb"Content-Length: (\d+)", head)[1]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
            yield (_key_of(fields["WARC-Record-ID"]), kind, _key_of(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"], size, digest, *([body if kind == "response" else None] if payload else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held: list[tuple] = []
                for row in rows(path):
                    held.append(row)
                    if len(held) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=False)], names=names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=False)], names=names)

    return manifest.select("archive").repartition(max(1, min(manifest.count(), 4096)), "archive").mapInArrow(run, schema)


def resolved(records: DataFrame) -> DataFrame:
    """records with the size and digest of each revisit as read from the response that it refers to; one that finds none, or another payload, fails.

    Only responses that are referred to are joined, and a key alone doesn't tell them: rows may share it.
    """
    kept = stored(records, "warc-records")
    again = F.col("record_type") == "revisit"
    wanted = kept.where(again).select(F.col("refers_to").alias("_key"), F.col("payload_digest").alias("_digest")).distinct()
    responses = kept.where(~again).select(F.col("key").alias("_key"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).distinct()
    found = stored(wanted.join(responses, ["_key", "_digest"]), "warc-referred")
    if found.count() <= BROADCAST_GROUPS:
        found = F.broadcast(found)
    joined = kept.join(found, again & (F.col("refers_to") == F.col("_key")) & (F.col("payload_digest") == F.col("_digest")), "left")
    lost = again & ~F.coalesce(F.col("_bytes") == F.col("payload_bytes"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("no such response for the revisit "), F.coalesce(F.col("key").cast("string"), F.lit("null"))))
    size = F.when(lost, wrong.cast("long")).otherwise(F.coalesce("_bytes", "payload_bytes"))
    return joined.select(*(size.alias(c) if c == "payload_bytes" else F.col(c) for c in records.columns))
