import random

import pytest

from pyspark.sql import functions as F

from rankloom.llm import components as C
from rankloom.llm import near_dup as N
from rankloom.llm import queries
from rankloom.llm.components import components


def sets_of(text, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n, percent):
    """Component of each row: rows are joined by their sets, and by their smallest ids."""
    sets = [sets_of(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                root[find(i)] = find(j)
            if rows[i][0] is not None and rows[j][0] is not None and common and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return [(key, len(s), None if key is None else low[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def mutated(r, words, share):
    return [f"x{r.random()}" if r.random() < share else w for w in words]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "one"), (None, "one two"), (906, "a a a a a a"), (907, "a a a a"), (908, "ß É one"), (909, "word " * 3000)]
    key = 0
    for _ in range(12):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.choice([5, 30, 120]))]
        for _ in range(r.choice([1, 3, 12])):
            rows.append((key, " ".join(mutated(r, base, r.choice([0, 0.01, 0.03, 0.06])))))
            key += 1
    r.shuffle(rows)
    df = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, component_id int")
    got = N.near_duplicates(df, settings=N.Settings(3, 85)).collect()
    want = brute(rows, 3, 85)
    assert sorted((str(x.doc_id), x.n_shingles, x.component_id) for x in got) == sorted((str(a), b, c) for a, b, c in want)
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_links_across_the_components_of_a_bucket(spark, monkeypatch):
    """A chain in which the ends are unlike: pivots alone don't find it."""
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 300)
    words = [f"w{i}" for i in range(200)]
    chain = [(i, " ".join(words[i * 5 : i * 5 + 100])) for i in range(20)]
    df = spark.createDataFrame(chain, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in N.near_duplicates(df, settings=N.Settings(3, 85)).collect()}
    assert got == {k: c for k, _, c in brute(chain, 3, 85)} and set(got.values()) == {0}


def test_rows_that_share_an_id_are_one_document(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcd"}
    rows = [(3, text["a"]), (7, text["a"]), (7, text["b"]), (9, text["b"]), (9, text["c"]), (5, text["d"]), (5, text["d"]), (5, None), (7, "")]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(brute(rows, 5, 80))
    assert {x.component_id for x in got if x.n_shingles} == {3, 5}


def test_group_of_copies_below_the_threshold(spark, monkeypatch):
    """Copies of one base that are mostly too unlike each other: their links are found across many components."""
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 2000)
    r = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(mutated(r, base, 0.02))) for i in range(150)]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows, 5, 80)
    assert len({c for _, _, c in want}) > 5
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(want)


def test_large_groups_of_copies(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(300)] + [(1000 + i, " ".join(mutated(r, base, 0.03))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(x.doc_id, x.n_shingles, x.component_id) for x in N.near_duplicates(df, settings=N.Settings(3, 85)).collect()]
    assert sorted(got) == sorted(brute(rows, 3, 85))


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("chunk", [200_000, 1])
def test_components_of_chains_and_stars(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 400), (400, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 400: 300, 500: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_hub_of_many_edges(spark):
    edges = spark.range(1, 100_001).select(F.lit(0).alias("a"), F.col("id").alias("b"))
    assert components(edges.repartition(8)).where("component = 0").count() == 100_001


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op7_tensored_minhash(spark, sf_dir).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(brute(rows, 3, 85))
