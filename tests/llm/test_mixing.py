import random

import pytest
from pyspark.sql import functions as F

from rankloom.llm import queries
from rankloom.llm.mixing import mix, mixed, word_count


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        aims = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if aims[s] > most * sizes[s]}
        if not over:
            return out | aims
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def table(spark, seed, n=400):
    r = random.Random(seed)
    words = lambda: " ".join("w" * r.randint(1, 4) for _ in range(r.choice([0, 1, 3, 20, 200])))
    rows = [(i, r.choice([None, words(), words() + " "]), r.choice(["hot", "hot", "hot", "a", "ä", "Z", None])) for i in range(n)]
    return rows + rows[:3], spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string")


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rows, df = table(spark, seed)
    got = mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    aims = brute_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(aims[source]) for r in own)
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(0 <= r.taken <= 2 * r["size"] for r in own)
    again = mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_gives_the_words_that_mix_takes(spark):
    _, df = table(spark, 9)
    df = df.withColumn("n_chars", F.length("text").cast("long")).withColumn("taken", F.lit("clash"))
    ours = ["_row", "_source", "_key", "_range", "_start", "_copy", "_whole"]
    for name in ours:
        df = df.withColumn(name, F.col("doc_id") + len(name))
    assert all(r[name] == r.doc_id + len(name) for r in mix(df).collect() for name in ours)
    out = mixed(df).withColumn("words", word_count(F.col("text")))
    want = mix(df).groupBy("source").agg(F.sum("taken")).collect()
    got = {r[0]: r[1] for r in out.groupBy("source").agg(F.sum("words")).collect()}
    assert {s: n for s, n in want if n} == got
    assert out.columns[:-1] == df.columns and out.where("n_chars <> length(text)").count() == 0


def test_a_very_long_text_is_counted_whole(spark):
    rows = [(1, "word " * 400_000, "a"), (2, "one two", "a"), (3, " ".join(["x"] * 1000), "b")]
    got = {r.doc_id: r for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1]["size"] == 400_000 and got[1].source_size == 400_002
    assert sum(r.taken for r in got.values() if r.source == "a") == int(got[1].target)


def test_nothing_to_mix(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    only = mix(spark.createDataFrame([(1, None, "a"), (None, "", None)], schema)).collect()
    assert all(r.target == 0 and r.taken == 0 for r in only)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", "\na\tb\x0b", "a b", "  a  b  ", "\x0c"]
    got = spark.createDataFrame([(x,) for x in texts], "t string").select(word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [len((x or "").encode().split()) for x in texts]


def test_query(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op2_source_mixing(spark, sf_dir).collect()
    sizes = {}
    for d in docs.values():
        sizes[d.source] = sizes.get(d.source, 0) + len(d.text.encode().split())
    aims = brute_targets(sizes)
    taken = {}
    for r in got:
        source = docs[r.doc_id].source
        assert r["size"] == len(docs[r.doc_id].text.encode().split()) and r.target == pytest.approx(aims[source]) and r.taken <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    assert len(got) == len(docs) and all(taken[s] == int(aims[s] + 1e-6) for s in aims)
