import hashlib
import random

import pyarrow as pa
import sentencepiece

from rankloom.llm import pieces as P
from rankloom.llm import queries

MODEL = queries.vocabulary("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", P.MARK, f"a{P.MARK}b", f"{P.MARK}{P.MARK} a", "\n", "a\nb", "\t \t", "x" * 5000, f"{chr(0x3000)} a", " \n ", "<s> a </s>", "<unk>", "<0x0A> b", "\0 a", "日本 語", "same same same"]


def test_ids_equal_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(2)
    texts = ODD + ["".join(r.choice([" ", "  ", "a", "b", P.MARK, "\n", "the", "ing", "é", "<s>", "日", "😀", "."]) for _ in range(r.randint(0, 25))) for _ in range(500)]
    plain = [t for t in texts if t and "  " not in t and P.MARK not in t and t.strip(" ") == t]
    for some in (texts, plain, [""], []):
        coded = P.ChunkEncoder(MODEL).batch(pa.array(some, pa.string()))
        want = sp.encode(some) if some else []
        assert coded.ids().to_pylist() == want
        assert coded.written() == [",".join(map(str, x)) for x in want]


def test_the_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(P, "TABLE", 10)
    e = P.ChunkEncoder(MODEL)
    for i in range(30):
        e.batch(pa.array([f"w{i} common w{i + 1}"]))
    assert len(e.newer) <= 14 and len(e.older) <= 14


def test_models_with_crossing_pieces_get_whole_texts(monkeypatch):
    e = P.ChunkEncoder(MODEL)
    e.by_chunk = False
    assert e.batch(pa.array(ODD)).ids().to_pylist() == e.model.encode(ODD)


def test_encode_and_decode(spark):
    texts = [None, *ODD, "word " * 50_000]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, IDS string")
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in P.decode(P.encode(df, MODEL), MODEL).collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == sp.encode(t or "") and got[i].decoded == (sp.decode(sp.encode(t)) if t else "")
    assert P.encode(df.limit(0), MODEL).count() == 0


def test_query(spark, sf_dir):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = sp.encode(r.text)
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    assert sorted(tuple(r) for r in queries.op10_sentencepiece_chunks(spark, sf_dir).collect()) == sorted(want)
