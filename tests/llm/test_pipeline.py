import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from rankloom.llm.quality import Rules
from rankloom.llm.mixing import mixed
from rankloom.llm.queries import vocabulary

from test_near_dup import brute as near_brute
from test_quality import brute as quality_brute



def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = P.good(spark, docs, sf_dir).cache()
    assert {r.doc_id for r in good.collect()} == {i for i, t in texts.items() if quality_brute(t, Rules())["kept"]}
    lines = P.without_boilerplate(spark, good, sf_dir).cache()
    assert lines.columns == P.COLUMNS and lines.count() == good.count()
    assert lines.where("n_chars <> length(text)").join(good.where("n_chars <> length(text)"), "doc_id", "left_anti").count() == 0
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    once = P.one_of_each(spark, lines, sf_dir).cache()
    assert sorted(r.doc_id for r in once.collect()) == sorted(k for k, _, c in near_brute(rows, 5, 80) if k == c)
    mix = P.mixture(spark, once, sf_dir)
    assert sorted(map(tuple, mix.collect())) == sorted(map(tuple, mixed(once).select(*P.COLUMNS).collect()))
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    want = sorted((r.doc_id, sp.encode(r.text)) for r in mix.collect())
    assert sorted((r.doc_id, r.ids) for r in P.run(spark, sf_dir).collect()) == want


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clean = " ".join(f"word{i} of" for i in range(80))
    df = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (3, clean, "en", "a", len(clean)), (3, clean, "en", "a", len(clean)), (None, clean + " tail", "en", None, 5)], schema)
    for name, stage in P.STAGES:
        df = stage(spark, df, "").cache()
        assert df.count() >= 1, name
    assert df.where("doc_id IN (1, 2)").count() == 0
    empty = spark.createDataFrame([], schema)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, "")
    assert empty.select(F.col("ids")).count() == 0
