import hashlib
import struct

import pyarrow.fs as pafs
import pytest
import zstandard

from rankloom.llm import queries, warc
from rankloom.llm.oracle import SQL

BIG = "<p>" + "same page " * 30


def pages(spark):
    rows = [(5, "u", BIG), (2, "u", BIG), (9, "v", BIG), (9, "v", BIG), (1, "w", "short"), (3, "w", "short"), (4, None, None), (7, "a b\r\nX: y", ""), (None, "n", BIG), (8, "é", "WARC/1.1\r\n\r\n\r\n" * 20), (6, "long", "é" * 700_000)]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")


def test_round_trip(spark):
    rows, df = pages(spark)
    for parts in (1, 4):
        manifest = warc.write_archives(warc.roles(df.repartition(parts)))
        got = warc.read_archives(manifest, payload=True).collect()
        by_text = {}
        for key, _, html in rows:
            if key is not None:
                by_text.setdefault(html or "", []).append(key)
        want = []
        for key, _, html in rows:
            body = (html or "").encode()
            first = min(by_text[html or ""])
            again = len(body) >= 100 and key != first and rows.count((key, _, html)) + len(by_text[html or ""]) > 1
            want.append((str(key), len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None, None if again else body))
        assert sorted(map(str, ((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got))) == sorted(map(str, want))


def test_archives_are_frames_after_a_dictionary(spark):
    _, df = pages(spark)
    entry = warc.write_archives(warc.roles(df.coalesce(1))).first()
    fs, path = pafs.FileSystem.from_uri(entry.archive)
    with fs.open_input_stream(path) as f:
        data = f.read()
    number, size = struct.unpack("<II", data[:8])
    assert number == warc.DICTIONARY_FRAME and size == entry.dictionary_bytes and len(data) == entry.bytes
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    left, n = data[8 + size :], 0
    while left:
        one = press.decompressobj()
        assert one.decompress(left).startswith(b"WARC/1.1\r\nWARC-Type: ") and one.eof
        left, n = one.unused_data, n + 1
    assert n == entry.records == 11


def test_damage_is_found(spark, tmp_path):
    _, df = pages(spark)
    manifest = warc.write_archives(warc.roles(df.where("page_id = 1").coalesce(1)))
    fs, path = pafs.FileSystem.from_uri(manifest.first().archive)
    with fs.open_input_stream(path) as f:
        data = bytearray(f.read())
    for cut in (bytes(data[:-3]), bytes(data[4:])):
        with fs.open_output_stream(path) as f:
            f.write(cut)
        with pytest.raises(Exception, match="ends inside|doesn't begin|zstd|dictionary"):
            warc.read_archives(manifest).collect()


def test_revisits_are_resolved(spark):
    _, df = pages(spark)
    records = warc.read_archives(warc.write_archives(warc.roles(df)))
    assert sorted(map(str, warc.resolved(records).collect())) == sorted(map(str, records.collect()))
    without = records.where("NOT (key = 2 AND record_type = 'response')")
    with pytest.raises(Exception, match="no such response"):
        warc.resolved(without).collect()


def test_large_sample_trains_a_dictionary(spark):
    df = spark.range(3000).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "concat('<html><title>page ', id, '</title><body>', repeat(concat('text ', id % 17, ' and more of it '), 20), '</body></html>') AS html")
    manifest = warc.write_archives(warc.roles(df.coalesce(2)))
    assert all(10_000 < r.dictionary_bytes <= warc.DICTIONARY for r in manifest.collect())
    assert warc.read_archives(manifest).where("record_type = 'response'").count() + warc.read_archives(manifest).where("record_type = 'revisit'").count() == 3000


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(warc.roles(empty))).count() == 0


def test_query_equals_sql(spark, sf_dir, same_rows):
    same_rows(queries.op6_warc_archives(spark, sf_dir), SQL["op6_warc_archives"])
