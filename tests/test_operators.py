import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import candidates as C
from rankloom.operators import checks, labels, metrics, pairs, pool
from rankloom.operators.hard_prompts import hard_prompts
from rankloom.plans import queries as plans
from rankloom.sources.catalog import Source


def sequential_pool(rows, quotas):
    seen, out, stats = set(), [], {}
    for alias, target in quotas.items():
        scanned = parse = dup = got = 0
        for source, pos, key in sorted(r for r in rows if r[0] == alias):
            if got >= target:
                break
            scanned += 1
            if key is None:
                parse += 1
            elif key in seen:
                dup += 1
            else:
                seen.add(key)
                out.append((source, pos))
                got += 1
        stats[alias] = (target, got, scanned, dup, parse)
    return out, stats


@pytest.mark.parametrize("seed", range(4))
def test_quota_dedup_equals_the_sequential_rule(spark, seed):
    r = random.Random(seed)
    rows = [(s, i, r.choice([None, *"abcdefghij"])) for s in "xyz" for i in range(r.randint(0, 25))]
    quotas = {"z": r.randint(0, 6), "x": r.randint(0, 6), "y": r.choice([0, 30])}
    df = spark.createDataFrame([(a, i, k) for a, i, k in rows], "source_alias string, source_row_number long, dedup_key string")
    got, stats = pool.quota_dedup(df, quotas)
    want, counts = sequential_pool([(a, i, k or None) for a, i, k in rows if True], quotas)
    assert sorted((x.source_alias, x.source_row_number) for x in got.collect()) == sorted(want)
    found = {x.source_alias: (x.requested, x.collected, x.scanned, x.skipped_dedup, x.skipped_parse) for x in stats.collect()}
    assert found == counts


def test_prompt_rows(spark):
    df = spark.createDataFrame([("Tell me more about it", 0, "u1", 0), ("日本語で", 3, "u2", 1), (" ", 4, "u3", 2)], "question string, id int, uuid string, position long")
    rows = pool.prompt_rows(df, Source("s", "p", language="auto", allowed=("en",), ask_for_japanese=True), "position").collect()
    assert [(x.source_example_id, x.prompt_raw, x.wrapped_for_japanese_answer) for x in rows] == [("u1", "Tell me more about it", True)]
    assert rows[0].messages[0].content.startswith("Tell me more about it\n\nPlease") and rows[0].prompt_char_len == 21


def brute_pairs(rows, o):
    out = []
    for g in {x["g"] for x in rows}:
        group = sorted((x for x in rows if x["g"] == g and (x["response"].strip() or not o.drop_empty)), key=lambda x: (-x["score"], x["sid"]))
        if o.dedupe:
            seen = set()
            group = [x for x in group if not (x["rh"] in seen or seen.add(x["rh"]))]
        n = len(group)
        if n < o.min_candidates:
            continue
        meet = {"top_bottom": [(0, n - 1)], "adjacent": [(i, i + 1) for i in range(n - 1)], "best_vs_rest": [(0, j) for j in range(1, n)], "all_pairs": [(i, j) for i in range(n) for j in range(i + 1, n)]}[o.strategy]
        found = [(group[i]["score"] - group[j]["score"], group[i]["sid"], group[j]["sid"]) for i, j in meet]
        found = sorted((x for x in found if x[0] > 0 and x[0] >= o.min_margin), key=lambda x: (-x[0], x[1], x[2]))
        out += [(g, c, r, k, m) for k, (m, c, r) in enumerate(found[: o.max_pairs])]
    return sorted(out)


def candidate_table(spark, rows):
    df = spark.createDataFrame([(x["g"], x["score"], x["sid"], x["response"], x["rh"]) for x in rows], "global_prompt_index long, teacher_score double, sample_id string, response string, response_hash string")
    for name, value in (("teacher_model", "t"), ("generator_model", "m"), ("generator_key", "k"), ("prompt_hash", "h"), ("prompt_raw", "p")):
        df = df.withColumn(name, F.lit(value))
    return df.withColumn("messages", F.array().cast("array<struct<role:string,content:string>>")).withColumn("generator_model_index", F.lit(0)).withColumn("candidate_index", F.lit(0))


@pytest.mark.parametrize("in_row", [3, 6, 64])
@pytest.mark.parametrize(("margin", "most", "dedupe"), [(0.0, None, False), (1.0, 3, True)])
def test_all_pairs_of_small_and_large_groups(spark, monkeypatch, in_row, margin, most, dedupe):
    monkeypatch.setattr(pairs, "IN_ROW", in_row)
    r = random.Random(in_row)
    rows = [{"g": min(r.randint(0, 40), 12), "score": float(r.randint(0, 9)), "sid": f"s{i:03}", "response": r.choice(["a", "b", " "]), "rh": r.choice("pqrstuvw")} for i in range(110)]
    df = candidate_table(spark, rows)
    sizes = [sum(x["g"] == g for x in rows) for g in range(13)]
    assert min(sizes) <= 3 and max(sizes) > 64
    o = pairs.PairOptions("all_pairs", margin, most, dedupe=dedupe, val_ratio=0.5)
    columns = ("global_prompt_index", "chosen_sample_id", "rejected_sample_id", "pair_rank_within_prompt", "score_margin")
    for at_rest in (False, True):
        assert sorted(map(tuple, pairs.build_pairs(df, o, columns, at_rest).collect())) == brute_pairs(rows, o)
    whole = pairs.build_pairs(df, o)
    for names in (("pair_id", "split"), ("rejected", "pair_id", "num_candidates_raw"), ("chosen_generator_key", "messages")):
        one = pairs.build_pairs(df, o, names)
        assert one.columns == list(names) and sorted(one.collect()) == sorted(whole.select(*names).collect())


@pytest.mark.parametrize("name", ["pairs_all", "pairs_ties"])
def test_pairs_are_not_sorted_with_what_they_carry(spark, sf_dir, name):
    plan = plans.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == (2 if name == "pairs_all" else 1) and "margin" not in "".join(x for x in plan.splitlines() if "Sort [" in x)
    assert "order " not in plan


@pytest.mark.parametrize("strategy", pairs.STRATEGIES)
@pytest.mark.parametrize(("margin", "most", "dedupe"), [(0.0, None, True), (2.0, 2, True), (1.0, 1, False)])
def test_pairs_equal_brute_force(spark, strategy, margin, most, dedupe):
    r = random.Random(strategy)
    rows = [{"g": r.randint(0, 30), "score": float(r.randint(0, 5)), "sid": f"s{i:03}", "response": r.choice(["a", "b", " ", "c"]), "rh": r.choice("pqrst")} for i in range(120)]
    df = spark.createDataFrame([(x["g"], x["score"], x["sid"], x["response"], x["rh"]) for x in rows], "global_prompt_index long, teacher_score double, sample_id string, response string, response_hash string")
    kind = "array<struct<role:string,content:string>>"
    for name, value in (("teacher_model", "t"), ("generator_model", "m"), ("generator_key", "k"), ("prompt_hash", "h"), ("prompt_raw", "p")):
        df = df.withColumn(name, F.lit(value))
    df = df.withColumn("messages", F.array().cast(kind)).withColumn("generator_model_index", F.lit(0)).withColumn("candidate_index", F.lit(0))
    o = pairs.PairOptions(strategy, margin, most, dedupe=dedupe, conversations=True)
    made = pairs.build_pairs(df, o)
    got = sorted((x.global_prompt_index, x.chosen_sample_id, x.rejected_sample_id, x.pair_rank_within_prompt, x.score_margin) for x in made.collect())
    assert got == brute_pairs(rows, o)
    assert not checks.pair_violations(made).head(1)


def ranks(x):
    x = np.asarray(x)
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


def corr(x, y):
    return 0.0 if len(x) < 2 or np.std(x) <= 0 or np.std(y) <= 0 else float(np.corrcoef(x, y)[0, 1])


def test_metrics_equal_numpy(spark):
    r = random.Random(5)
    rows = [(r.randint(0, 40), f"s{i:03}", float(r.randint(0, 6)), float(r.randint(0, 6))) for i in range(150)]
    df = spark.createDataFrame(rows, "g long, sid string, t double, s double").withColumn("z", F.col("s") / 2)
    t, s = np.array([x[2] for x in rows]), np.array([x[3] for x in rows])
    m = metrics.global_metrics(df, "t", "s", "z").first()
    assert m.n == 150 and m.mse_denorm == pytest.approx(np.mean((s - t) ** 2)) and m.teacher_score_std == pytest.approx(np.std(t))
    assert m.pearson_denorm == pytest.approx(corr(s, t)) and m.spearman_denorm == pytest.approx(corr(ranks(s), ranks(t)))

    top, micro, total, macro, rho = [], 0.0, 0, [], []
    for g in sorted({x[0] for x in rows}):
        own = sorted(x[1:] for x in rows if x[0] == g)
        if len(own) < 2:
            continue
        a, b = np.array([x[1] for x in own]), np.array([x[2] for x in own])
        top.append(int(a.argmax()) == int(b.argmax()))
        rho.append(corr(ranks(a), ranks(b)))
        credit = n = 0
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                if abs(a[i] - a[j]) > 1.0:
                    n += 1
                    credit += 1.0 if (a[i] - a[j]) * (b[i] - b[j]) > 0 else 0.5 if b[i] == b[j] else 0.0
        if n:
            macro.append(credit / n)
            micro, total = micro + credit, total + n
    q = metrics.group_metrics(df, "g", "t", "s", "sid", 1.0).first()
    assert q.top1_agreement == pytest.approx(np.mean(top)) and q.top1_agreement_num_prompts == len(top)
    assert q.pairwise_accuracy_micro == pytest.approx(micro / total) and q.pairwise_accuracy_micro_num_pairs == total
    assert q.pairwise_accuracy_macro == pytest.approx(np.mean(macro)) and q.prompt_spearman_median == pytest.approx(np.median(rho))


def test_metrics_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "g long, sid string, t double, s double, z double")
    assert metrics.global_metrics(empty, "t", "s", "z").first().mse_denorm == 0.0
    assert metrics.group_metrics(empty, "g", "t", "s", "sid").first().top1_agreement == 0.0


def test_prompt_metrics_sort_once_a_score_and_keep_no_table_of_groups(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 1.0), (1, "b", -0.0, 2.0), (1, "c", float("nan"), 3.0), (1, "d", float("nan"), 3.0), (None, "e", 2.0, 5.0), (None, "f", 1.0, 4.0)], "g long, sid string, t double, s double")
    made = metrics.prompt_metrics(df, "g", "t", "s", "sid").select("group_key", "candidates", "prompt_spearman")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and "Aggregate" not in plan
    got = {r.group_key: (r.candidates, r.prompt_spearman) for r in made.collect()}
    assert got == {1: (4, pytest.approx(corr([1.5, 1.5, 3.5, 3.5], [1, 2, 3.5, 3.5]))), None: (2, pytest.approx(1.0))}


def test_prompt_metrics_of_larger_groups(spark):
    r = random.Random(3)
    rows = [(g, f"s{i:03}", float(r.randint(0, 9)), float(r.randint(0, 9))) for g, n in ((1, 64), (2, 65), (3, 150)) for i in range(n)]
    made = metrics.prompt_metrics(spark.createDataFrame(rows, "g long, sid string, t double, s double"), "g", "t", "s", "sid")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and "array_sort" not in plan
    for x in made.collect():
        own = [v[2:] for v in rows if v[0] == x.group_key]
        met = [(a, b) for i, a in enumerate(own) for b in own[i + 1 :] if a[0] != b[0]]
        assert (x.candidates, x.pairs) == (len(own), len(met))
        assert x.credit == sum(0.5 if a[1] == b[1] else float((a[0] - b[0]) * (a[1] - b[1]) > 0) for a, b in met)


def test_global_ranks_have_no_single_partition_sort(spark):
    df = spark.range(2000).select((F.col("id") % 700).cast("double").alias("v"))
    got = {r.v: r["rank"] for r in metrics.rank_average(df, "v").collect()}
    x = [float(i % 700) for i in range(2000)]
    assert got == dict(zip(x, ranks(x), strict=True))


def test_labels(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "x double")
    stats = labels.score_stats(df, "x", clip_abs=1.0)
    assert stats.mean == 3.0 and stats.std == pytest.approx(np.std([1, 2, 6]))
    assert [round(r[0], 6) for r in df.select(labels.label(F.col("x"), stats)).collect()] == [round(max(-1, min(1, (v - 3) / np.std([1, 2, 6]))), 6) for v in (1, 2, 6)]
    assert labels.score_stats(df.where("x = 1"), "x").std == 1.0
    with pytest.raises(ValueError, match="no scores"):
        labels.score_stats(df.limit(0), "x")
    with pytest.raises(ValueError, match="nothing to train"):
        labels.with_split(spark.createDataFrame([("k",)], "prompt_hash string"), 0.99999, 10_000).count()
    own = spark.createDataFrame([("a", "validation"), ("b", "train")], "prompt_hash string, split string")
    assert labels.with_split(own).collect() == own.collect()


def test_candidates_do_not_depend_on_partitions(spark):
    kind = "messages array<struct<role:string,content:string>>, global_prompt_index long"
    prompts = spark.createDataFrame([([{"role": "user", "content": f"q{i}"}], i) for i in range(20)], kind)
    g = C.Generation(models=("a/b", "c"), candidates=2)
    run = lambda n: sorted((r.sample_id, r.teacher_score) for r in C.build_candidates(prompts.repartition(n), g).collect())
    assert run(1) == run(5) and len(run(2)) == 80
    assert not checks.candidate_violations(C.build_candidates(prompts, g)).head(1)
    with pytest.raises(ValueError, match="one candidate"):
        C.Generation(candidates=2, sample=False)
    with pytest.raises(Exception, match="gave 0"):
        C.generate(C.fan_out(prompts, g), lambda: lambda f: f.head(0).assign(response=[], response_token_len=[])).count()


def test_records_are_scored(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    got = C.score_records(df, ("train_zscore", 10.0, 2.0)).collect()
    assert all(r.student_score_denorm == r.student_score_norm * 2 + 10 for r in got)


def test_hard_prompts(spark):
    rows = [(1, "a", 3.0, 1.0), (1, "b", 2.0, 2.0), (1, "c", 1.0, 3.0), (2, "a", 2.0, 2.0), (2, "b", 1.0, 1.0), (3, "a", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g long, sid string, t double, s double")
    got = {r.group_key: r for r in hard_prompts(df, "g", "t", "s", "sid", 1).collect()}
    assert got[1].hard_prompt_rank == 1 and got[1].selection_reason == "top1_mismatch" and got[1].hard_prompt_score == 2.0
    assert not got[2].selected and got[3].hard_prompt_score == 0.0


def test_count_mismatches_sees_every_group(spark):
    df = spark.range(10_500).selectExpr("cast(id as string) AS split")
    assert checks.count_mismatches(df, {str(i): 1 for i in range(10_500)}) == []
    some = spark.createDataFrame([(None,), ("a",)], "split string")
    assert checks.count_mismatches(some, {"b": 2}) == ["None: 1 rows, 0 expected", "a: 1 rows, 0 expected", "b: 0 rows, 2 expected"]
    assert checks.count_mismatches(some, {None: 1, "a": 1, "c": 0}) == []


def test_checks(spark):
    df = spark.createDataFrame([("p", "train"), ("p", "validation"), ("q", "train")], "prompt_hash string, split string")
    assert [r[0] for r in checks.leaked(df).collect()] == ["p"]
    assert checks.count_mismatches(df, {"train": 2, "validation": 2}) == ["validation: 1 rows, 2 expected"]
    assert checks.without(df, df.where("prompt_hash = 'p'"), "prompt_hash").first()[0] == "q"
    with pytest.raises(ValueError, match="empty"):
        checks.non_empty(df.limit(0))
    with pytest.raises(ValueError, match="missing columns"):
        checks.pair_violations(df)


def test_positions_follow_the_seeded_order(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, "b").alias("by"), F.lit("clash").alias("_range"))
    order = [r.id for r in pool.seeded_order(df, 5, "id").collect()]
    got = pool.positions(df, 5, "id")
    assert got.columns == [*df.columns, "position"]
    assert [r.id for r in got.orderBy("position").collect()] == order and {r.position for r in got.collect()} == set(range(3000))
    assert got.where("_range = 'clash'").count() == 3000
    grouped = {}
    for r in pool.positions(df, 5, "id", by="by").collect():
        grouped.setdefault(r.by, {})[r.position] = r.id
    by = {r.id: r.by for r in df.collect()}
    assert {k: [v[i] for i in range(len(v))] for k, v in grouped.items()} == {k: [i for i in order if by[i] == k] for k in (None, "b", "hot")}
    assert pool.positions(df.limit(0), 5, "id").count() == 0


def test_prompt_hashes_are_shuffled_as_bytes(spark, sf_dir):
    plan = plans.queries()["pairs_ties"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "_hash_bytes" in plan[plan.index("Exchange ") :]
    hashes = ["0aff", "0AFF", "abc", "x1", "", " 0a", None, "é"]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(hashes)], "i int, prompt_hash string")
    held = pairs._packed(rows).orderBy("i").collect()
    assert [(x.prompt_hash, x["_hash_bytes"]) for x in held] == [(None, b"\x0a\xff"), *((h, None) for h in hashes[1:4]), (None, b""), (" 0a", None), (None, None), ("é", None)]
