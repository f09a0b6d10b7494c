import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from rankloom.llm import log_templates as L
from rankloom.llm import queries

from test_near_dup import brute as near_brute


def prose(i, n=12):
    return " ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}{'xyz'[(i + j) % 3] * (1 + i % 5)}" for j in range(n))


def docs(spark, texts):
    return spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, n_lines string")


def run(spark, texts, **tree):
    return {r.doc_id: r for r in L.without_templates(docs(spark, texts), tree=L.Tree(**tree), counts=True).collect()}


def body(i):
    return "\n".join(prose(i * 7 + k, 14) for k in range(4))


def test_variable_fields_fall_into_one_template(spark):
    lines = [f"user {n} logged in at node {w} from the office today with success" for n, w in zip(range(6), ["alpha", "beta", "gamma", "delta", "eps", "zeta"], strict=True)]
    got = run(spark, [f"{body(i)}\n{x}\nend {i}" for i, x in enumerate(lines)])
    for i in range(6):
        assert got[i].text == f"{body(i)}\nend {i}" and (got[i].n_dropped, got[i].n_lines) == (1, 6)


def test_few_documents_short_lines_and_copies_stay(spark):
    two = "a line that only two of the documents have in common"
    short = "of the and"
    copy = body(30)
    texts = [f"{body(1)}\n{two}", f"{body(2)}\n{two}", *(f"{body(10 + i)}\n{short}" for i in range(6)), copy, copy, copy, copy, None, "", "\n\n"]
    got = run(spark, texts)
    assert {i: r.text for i, r in got.items()} == dict(enumerate(texts))
    near = [body(40), body(40) + "\nmore", body(40) + "\nstill more", body(40) + "\nand more of it here"]
    assert [r.text for _, r in sorted(run(spark, near).items())] == near


def brute(texts, tree):
    """The whole rule on distinct texts, apart from its Spark code; only the order of equally frequent sequences is taken from their hashes."""
    texts = list(dict.fromkeys(t for t in texts if t))
    lines = []
    for t in texts:
        for number, line in enumerate(t.split("\n")):
            words = line.encode().split()
            if len(words) >= tree.min_words:
                masked = tuple(b"" if any(48 <= c <= 57 for c in w) else w for w in words)
                lines.append((t, number, (len(words), masked[: tree.depth]), masked))
    seq = {}
    for t in texts:
        paths = L._paths(pa.array([t], pa.large_string()), tree)
        seq |= dict(zip([x[3] for x in lines if x[0] == t], paths["seq"].tolist(), strict=True))
    leaves, template = defaultdict(Counter), {}
    for _, _, leaf, masked in lines:
        leaves[leaf][masked] += 1
    codes = defaultdict(lambda: len(codes) + 1, {b"": 0})
    for leaf, counts in leaves.items():
        ordered = sorted(counts, key=lambda m: (-counts[m], seq[m]))
        of, _ = one_pass([np.array([codes[w] for w in m], np.uint64) for m in ordered], tree.agree)
        template |= {(leaf, m): (leaf, i) for m, i in zip(ordered, of, strict=True)}
    where = defaultdict(set)
    for t, _, leaf, masked in lines:
        where[template[leaf, masked]].add(t)
    hits = {k: v for k, v in where.items() if len(v) >= tree.min_docs}
    some = sorted({t for v in hits.values() for t in v})
    carrier = dict(zip(some, [c for _, _, c in near_brute(list(enumerate(some)), 5, 80)], strict=True))
    gone = {k for k, v in hits.items() if len({carrier[t] for t in v}) >= tree.min_docs}
    drop = {(t, number) for t, number, leaf, masked in lines if template[leaf, masked] in gone}
    return {t: "\n".join(x for i, x in enumerate(t.split("\n")) if (t, i) not in drop) for t in texts}


def test_exact_lines_equal_brute_force(spark):
    shared = [prose(500 + i, 9 + i % 4) for i in range(5)]
    texts = [f"{body(i)}\n{shared[i % 5]}\n{shared[(i * i) % 5]}\n\n{body(i + 100)}" for i in range(40)] + [shared[0], shared[1] + "\nx"]
    got = run(spark, texts)
    want = brute(texts, L.Tree())
    assert [got[i].text for i in range(len(texts))] == [want[t] for t in texts] and want[shared[0]] == ""


def test_templates_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    heads = ["the job ran in", "a user of the", "seen at node 7 by"]
    line = lambda: f"{heads[rng.integers(3)]} " + " ".join("alpha beta gamma delta".split()[k] for k in rng.integers(0, 4, rng.integers(5, 9)))
    texts = [f"{own(i)}\n" + "\n".join(line() for _ in range(rng.integers(0, 4))) for i in range(120)]
    texts += [t + "\nand more" for t in texts[:20]] + [line() for _ in range(10)]
    got, want = run(spark, texts), brute(texts, L.Tree())
    assert [got[i].text for i in range(len(texts))] == [want[t] for t in texts]
    assert 20 < sum(want[t] != t for t in want) < len(want)


def test_large_leaves_are_grown_in_parts(spark, monkeypatch):
    monkeypatch.setattr(L, "PART", 5)
    lines = [f"the same head of a line with one field {w} and the same tail" for w in (f"f{chr(97 + i)}{chr(98 + i)}" for i in range(24))]
    got = run(spark, [f"{body(i)}\n{x}" for i, x in enumerate(lines)])
    assert all(got[i].text == body(i) for i in range(24))


def test_grow():
    import numpy as np

    rows = [np.array(x, np.uint64) for x in ([1, 2, 3, 4], [1, 2, 3, 5], [9, 8, 7, 6], [1, 2, 3, 4], [1, 2, 0, 9])]
    of, templates = L._grow(rows, 70)
    assert of == [0, 0, 1, 0, 2] and templates[0].tolist() == [1, 2, 3, 0]


def one_pass(rows, agree):
    templates, of = [], []
    for tokens in rows:
        same = [int((t == tokens).sum()) for t in templates]
        best = max(range(len(same)), key=lambda i: (same[i], -i), default=None)
        if best is not None and 100 * same[best] >= agree * len(tokens):
            templates[best] = np.where(templates[best] == tokens, tokens, L._ANY)
        else:
            best = len(templates)
            templates.append(tokens.copy())
        of.append(best)
    return of, [t.tolist() for t in templates]


def test_grow_equals_comparing_all():
    rng = np.random.default_rng(5)
    for width, values, agree in [(8, 3, 70), (12, 6, 70), (12, 3, 70), (30, 2, 70), (9, 4, 100), (9, 4, 0)]:
        rows = rng.integers(0, values, (700, width)).astype(np.uint64)
        rows[:, :3] = 7
        of, templates = L._grow(list(rows), agree)
        assert (of, [t.tolist() for t in templates]) == one_pass(rows, agree)


def own(i, lines=6):
    return "\n".join(" ".join(f"{i}own{k}word{j}" for j in range(6)) for k in range(lines))


def test_boilerplate_goes_however_much_and_near_copies_are_one_carrier(spark):
    passage = " ".join(f"passage{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    copied = "\n".join(prose(i, 14) for i in range(60, 66))
    texts = [f"{own(i)}\n{passage}" for i in range(4)] + [passage] + [copied + more for more in ("", "\nmore", "\nstill more", "\nof it")]
    got = run(spark, texts)
    assert [got[i].text for i in range(len(texts))] == [own(i) for i in range(4)] + [""] + texts[5:]
    # Two near copies and another document are two carriers.
    line = prose(60, 14)
    texts = [copied, copied + "\nmore", f"{own(9)}\n{line}"]
    assert [r.text for _, r in sorted(run(spark, texts).items())] == texts
    got = run(spark, [*texts, f"{own(10)}\n{line}"])
    assert [got[i].n_dropped for i in range(4)] == [1, 1, 1, 1]


def test_query_and_pipeline_drop_what_fills_most_of_a_document(spark, tmp_path):
    import corpus_pipeline

    passage = " ".join(f"passage{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    rows = [(i, f"{own(i)}\n{passage}", "en", "web", 0) for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.n_dropped for r in queries.op8_log_templates(spark, str(tmp_path)).collect()] == [1] * 5
    assert {r.doc_id: r.text for r in corpus_pipeline.without_boilerplate(spark, table, str(tmp_path)).collect()} == {i: own(i) for i in range(5)}


def test_size_of_a_task_changes_no_line(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [f"{own(i)}\nthe same head {' '.join('abcd'[k] for k in rng.integers(0, 4, 9))}" for i in range(400)]
    whole = {i: r.n_dropped for i, r in run(spark, texts).items()}
    assert len(set(whole.values())) == 2
    monkeypatch.setattr(L, "PART", 20)
    assert {i: r.n_dropped for i, r in run(spark, texts).items()} == whole


def test_long_empty_and_repeated(spark):
    long = " ".join(f"t{i}" for i in range(300_000))
    got = run(spark, [long, long, body(1), body(1)])
    assert got[0].text == long and got[3].text == body(1)
    assert L.without_templates(docs(spark, []), counts=True).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op8_log_templates(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute(list(texts.values()), L.Tree())
    assert {i: r.text_sha256 for i, r in got.items()} == {i: hashlib.sha256(want.get(t, t).encode()).hexdigest() for i, t in texts.items()}
    assert any(r.n_dropped for r in got.values())
