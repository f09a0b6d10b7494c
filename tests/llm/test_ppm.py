import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rankloom.llm import ppm, queries


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def symbols(text, order):
    return [256] * order + list(lower(text).encode()) + [256]


class Brute:
    """The model straight from its definition."""

    def __init__(self, texts, order, least=1):
        self.order, self.n = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            s = symbols(t, order)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.n[k][tuple(s[i - k : i])][s[i]] += 1
        self.kept = [{c: {s: n for s, n in d.items() if n >= least} for c, d in level.items()} for level in self.n]
        self.kept = [{c: d for c, d in level.items() if d} for level in self.kept]

    def log(self, history, s):
        out, gone = 0.0, set()
        for k in range(self.order, -1, -1):
            c = tuple(history[len(history) - k :])
            kept = self.kept[k].get(c)
            if kept is None:
                continue
            total = sum(n for x, n in self.n[k][c].items() if x not in gone)
            kinds = sum(x not in gone for x in kept)
            other = sum(n for x, n in self.n[k][c].items() if x not in gone and x not in kept)
            if s in kept and s not in gone:
                return out + math.log(kept[s] / (total + kinds))
            if total + kinds:
                out += math.log((other + kinds) / (total + kinds))
            gone |= set(kept)
        return out - math.log(257 - len(gone))

    def text(self, t):
        s = symbols(t, self.order)
        return sum(self.log(s[i - self.order : i], s[i]) for i in range(self.order, len(s)))


TRAIN = ["abracadabra", "Abra cad", "aaaa b\n", "", "né né", "the cat the hat"]
TEST = ["abra", "", "zzz é", "the rat\x00", "日本"]


@pytest.mark.parametrize("nodes", [1 << 20, 12])
def test_model_equals_its_definition(spark, nodes):
    counted = ppm.counts(spark.createDataFrame([(x,) for x in TRAIN], "text string"), "text", 3).cache()
    model = ppm.fit(counted, 3, nodes)
    least = 1
    for k in range(4):  # thresholds are powers of two and don't fall with the order
        n = Counter()
        for t in TRAIN:
            s = symbols(t, 3)
            n.update(tuple(s[i - k : i + 1]) for i in range(3, len(s)))
        while sum(c >= least for c in n.values()) > nodes:
            least *= 2
        brute = Brute(TRAIN, 3, 1)
    mine = Brute(TRAIN, 3)
    steps, least = [], 1
    for k in range(4):
        flat = [c for d in mine.n[k].values() for c in d.values()]
        while sum(c >= least for c in flat) > nodes:
            least *= 2
        steps.append(least)
    brute.kept = [{c: {s: n for s, n in d.items() if n >= m} for c, d in level.items()} for level, m in zip(mine.n, steps, strict=True)]
    brute.kept = [{c: d for c, d in level.items() if d} for level in brute.kept]
    keys, first = ppm.runs(pa.array(TEST, pa.large_string()), 3)
    got = np.add.reduceat(model.score(keys), first[:-1])
    assert got == pytest.approx([brute.text(t) for t in TEST])
    for history in (symbols("ab", 3)[-4:-1], symbols("né", 3)[1:4], [7, 7, 7]):
        assert sum(math.exp(brute.log(history, s)) for s in range(257)) == pytest.approx(1)


def test_scores_equal_brute_force(spark):
    rows = [(i, x) for i, x in enumerate([*TRAIN, *TEST, None, "A a A", "rare words here"] * 2)] + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(i, x, "clash") for i, x in rows], "doc_id long, text string, score string")
    got = ppm.scores(df).collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    train = [x for i, x in rows if not held(i)]
    words = lambda x: [*lower(x).encode().split(), None]
    c = Counter(w for x in train for w in words(x))
    n, v = sum(c.values()), len(c)
    model = Brute(train, ppm.ORDER)
    want = sorted((str(i), held(i), len(words(x)), sum(c[w] > 0 for w in words(x)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(x)), 6), round(model.text(x) / math.log(10), 6)) for i, x in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_seldom_words_are_joined(spark):
    df = spark.createDataFrame([(i, f"w{i % 40} w{i % 7} the the") for i in range(200)], "doc_id long, text string")
    few = {r.doc_id: r for r in ppm.scores(df, nodes=4).collect()}
    for r in ppm.scores(df).collect():
        assert few[r.doc_id].base_score == pytest.approx(r.base_score) and few[r.doc_id].n_known == r.n_known


def test_seldom_runs_are_joined(spark):
    rows = [(i, x) for i, x in enumerate([*TRAIN, *TEST, "A a A", "rare words here", "cat hat ab\x01"] * 2)]
    train = [x for i, x in rows if zlib.crc32(str(i).encode()) % 10]
    model = Brute(train, ppm.ORDER)
    got = {r.doc_id: r.score for r in ppm.scores(spark.createDataFrame(rows, "doc_id long, text string"), nodes=4).collect()}
    assert got == pytest.approx({i: model.text(x) / math.log(10) for i, x in rows})


def test_rare_runs_are_joined(spark, monkeypatch):
    rows = [(i, x) for i, x in enumerate([*TRAIN, *TEST] * 2)]
    whole = {r.doc_id: r.score for r in ppm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    monkeypatch.setattr(ppm, "SHARE", 50)
    assert {r.doc_id: r.score for r in ppm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == pytest.approx(whole)


def test_nothing_to_learn(spark):
    assert ppm.scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    row = ppm.scores(spark.createDataFrame([(None, "a")], "doc_id long, text string")).first()
    assert row.train_tokens == 0 and row.base_score == 0 and row.score == pytest.approx(-2 * math.log10(257))


def test_gathering_in_parts(spark, monkeypatch):
    g = ppm.Gathered()
    for part in ([1, 2, 2], [], [2, 9]):
        g.add(np.array(part, np.uint64))
    keys, n = g.merged()
    assert keys.tolist() == [1, 2, 9] and n.tolist() == [1, 3, 1]


def test_merging_holds_few_copies_of_the_keys():
    g, random = ppm.Gathered(), np.random.default_rng(1)
    parts = [random.integers(0, 1 << 19, 50_000, dtype=np.uint64) for _ in range(20)]
    tracemalloc.start()
    try:
        for part in parts:
            g.add(part)
        size = g.size
        tracemalloc.reset_peak()
        keys, n = g.merged()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 16 bytes a key, and twice that while they are sorted.
    assert peak < 40 * size
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (keys == want[0]).all() and (n == want[1]).all()


def test_counts_are_added_up_behind_the_exchange(spark):
    plan = ppm.counts(spark.createDataFrame([("a b",)], "text string"))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "Aggregate" in above and "MapInArrow" in below
    assert "Aggregate" not in below and "Exchange" not in below


def test_query_predicts_held_out_text(spark, sf_dir):
    got = queries.op3_byte_ppm(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    bits = -sum(r.score for r in got if r.held_out) / math.log10(2) / sum(len(texts[r.doc_id].encode()) for r in got if r.held_out)
    assert bits < 3.0 and any(r.held_out for r in got)
