import hashlib
import random
import zlib

import numpy as np
import pytest

from rankloom.llm import png, queries


def filtered(image, kinds):
    """PNG of an image with a given filter for each line, written from the format's rules."""
    out, before = b"", [0] * image.shape[1]
    for row, kind in zip(image.tolist(), kinds, strict=True):
        left, corner, line = 0, 0, bytearray([kind])
        for x, v in enumerate(row):
            up = before[x]
            p = left + up - corner
            near = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            line.append((v - (0, left, up, (left + up) // 2, near)[kind]) % 256)
            left, corner = v, up
        before, out = row, out + bytes(line)
    header = png.struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0, 0, 0, 0)
    body = zlib.compress(out)
    return png.SIGNATURE + png._chunk(b"IHDR", header) + png._chunk(b"tEXt", b"k\0v") + png._chunk(b"IDAT", body[:9]) + png._chunk(b"IDAT", body[9:]) + png._chunk(b"IEND", b"")


def test_all_filters_are_undone():
    r = np.random.default_rng(1)
    image = r.integers(0, 256, (40, 64), dtype=np.uint8)
    for kinds in ([k] * 40 for k in range(5)):
        assert (png.decode(filtered(image, kinds)) == image).all()
    assert (png.decode(filtered(image, [random.Random(i).randint(0, 4) for i in range(40)])) == image).all()


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 64, b"ab" * 5000, bytes(range(256)) * 700, "日本語 text\n".encode() * 3000])
def test_round_trip(payload):
    media = png.encode(png.padded(payload))
    assert png.decode(media).tobytes() == payload + b"\0" * (-len(payload) % 64 if payload else 64)
    assert len(png.cosine_hash(png.decode(media))) == 8


def test_damage_is_found():
    media = bytearray(png.encode(png.padded(b"hello")))
    media[45] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        png.decode(bytes(media))
    with pytest.raises(ValueError, match="not a PNG"):
        png.decode(b"GIF89a")


def test_features(spark):
    texts = [None, "", "same", "same", "é" * 33, "x" * 200_000]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, Media string")
    got = {r.doc_id: r for r in png.features(png.store(df)).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        payload = png.padded(raw)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert got[2].media_sha256 == got[3].media_sha256 and got[2].cosine_hash == got[3].cosine_hash and got[0].cosine_hash == got[1].cosine_hash
    assert png.features(png.store(df.limit(0))).count() == 0


def test_like_images_have_like_hashes():
    r = np.random.default_rng(2)
    smooth = np.cumsum(np.cumsum(r.normal(size=(64, 64)), 0), 1)
    image = ((smooth - smooth.min()) / np.ptp(smooth) * 200).astype(np.uint8)
    far = r.integers(0, 256, (64, 64), dtype=np.uint8)
    distance = lambda a, b: sum(bin(x ^ y).count("1") for x, y in zip(png.cosine_hash(a), png.cosine_hash(b), strict=True))
    assert distance(image, image + 3) <= 4 < distance(image, far)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op9_png_media(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        payload = png.padded(texts[r.doc_id].encode())
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert len(r.feature) == 16
