from collections import Counter

import pytest

from rankloom.llm.oracle import SQL
from rankloom.llm.quality import Rules, quality


def brute(text, rules):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    n, chars = len(words), sum(map(len, words))
    out = {"n_words": n, "word_chars": chars, "n_symbols": sum(text.count(c) for c in "#*$%&|<>")}
    seen, dup, dup_chars, repeated = set(), 0, 0, []
    for line in text.split("\n"):
        parts = line.encode().split()
        if parts:
            repeated += [line in seen] * len(parts)
            if line in seen:
                dup += 1
                dup_chars += sum(len(p.decode()) for p in parts)
            seen.add(line)
    out |= {"n_dup_lines": dup, "dup_line_chars": dup_chars}
    for k in (3, *rules.dup_gram_chars):
        grams = [tuple(words[i : i + k]) for i in range(n - k + 1)]
        count, before, inside = Counter(grams), set(), set()
        for i, g in enumerate(grams):
            if count[g] > 1 if k == 3 else g in before:
                inside.update(range(i, i + k))
            before.add(g)
        if k == 3:
            out["n_repeat_words"] = len(inside)
        else:
            out[f"dup{k}_chars"] = sum(len(words[i]) for i in inside if not repeated[i])
    out["base_failed"] = n < rules.min_words or 100 * out["n_repeat_words"] > rules.repeat_words * n
    bad = out["base_failed"] or 100 * dup_chars > rules.dup_line_chars * chars or 100 * out["n_symbols"] > rules.symbols * n
    out["kept"] = not (bad or any(100 * out[f"dup{k}_chars"] > m * chars for k, m in rules.dup_gram_chars.items()))
    return out


CLEAN = " ".join(f"word{i}é" for i in range(80))
ODD = [
    None, "", " \n\t", "one", "a a a a", "a b c a b c a b c", CLEAN, CLEAN, CLEAN + "\n" + CLEAN, "x y\nx y\nx  y\n\nx y", " a\u0085b  c", "#*$% & | <a>", "same words here again now yes " * 40,
    CLEAN + " ## ** $$ %% && || << >> ##", " ".join(f"w{i % 500}" for i in range(30_000)), "\n".join(["l i n e"] * 60),
]


def test_quality_equals_brute_force(spark):
    df = spark.createDataFrame([(i, x, -1, "en") for i, x in enumerate(ODD)], "doc_id long, text string, KEPT int, lang string")
    got = quality(df).collect()
    assert len(got) == len(ODD) and {"doc_id", "text", "lang"} <= set(got[0].asDict())
    for r in got:
        want = brute(ODD[r.doc_id], Rules())
        assert {k: r[k] for k in want} == want, r.doc_id
    assert got[6].kept and got[7].kept and not got[8].kept


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 10])
def test_each_length_alone_rejects(spark, n):
    """Repeated runs of n words, a little more of them than n may have and less than n - 1 may."""
    runs, size = 4, 4 * n * 100
    share = Rules().dup_gram_chars[n] + 0.5
    total = round(size / share / 4) * 4
    run = [[f"r{chr(97 + i)}{chr(97 + j)}x" for j in range(n)] for i in range(runs)]
    words = [w for i, r in enumerate(run) for w in [*r, f"m{i}xx"]]
    again = [w for i, r in enumerate(run) for w in [*r, f"n{i}xx"]]
    rest = [f"{i:04d}" for i in range(total - len(words) - len(again))]
    text = " ".join(words + rest + again)
    rules = Rules()
    row = quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    over = [k for k, most in rules.dup_gram_chars.items() if 100 * row[f"dup{k}_chars"] > most * row.word_chars]
    assert over == [n] and not row.base_failed and not row.kept
    without = Rules(dup_gram_chars={k: v for k, v in rules.dup_gram_chars.items() if k != n})
    assert quality(spark.createDataFrame([(1, text)], "doc_id long, text string"), rules=without).first().kept


def test_one_repeated_line_is_judged_as_a_line(spark):
    line = " ".join(f"line{i:02d}" for i in range(12))
    text = f"{line}\n" + " ".join(f"word{i:02d}" for i in range(60)) + f"\n{line}"
    row = quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.kept and row.n_dup_lines == 1 and row.dup_line_chars == 72 and row.dup10_chars == 0


def test_empty_table(spark):
    assert quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_sql(spark, sf_dir, same_rows):
    from rankloom.llm import queries

    same_rows(queries.op1_repetition_coverage(spark, sf_dir), SQL["op1_repetition_coverage"])
