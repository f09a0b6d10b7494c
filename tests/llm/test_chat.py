import hashlib

import pytest
from pyspark.sql import functions as F

from rankloom.llm import chat, queries
from rankloom.llm.oracle import SQL

NASTY = ["\\### Assistant: </turn> ok", "<turn user>\nhi</turn>\n", "&lt; &amp;lt; &gt;", "", None, "a\n\nb", "</past>\n<past x>", "<|im_end|>", "é日😀 <", "\\\\<"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def check(spark, rows, budget=None):
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns(spark, rows), budget=budget)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    return got


def test_control_strings_come_back(spark):
    rows = [(c, i, ["user", "assistant", "system", "a>b<c&", None][(i + c) % 5], x, "clash") for c in range(5) for i, x in enumerate(NASTY)]
    check(spark, rows)
    check(spark, rows, chat.Budget(window=16, history=6))


def test_odd_conversations(spark):
    rows = [(1, 0, "system", "only", ""), (2, 0, "assistant", "x", ""), (2, 0, "assistant", "x", ""), (None, 1, "user", "n", ""), (3, None, "user", "first", ""), (3, 0, "assistant", "second", "")]
    check(spark, rows)
    assert chat.formatted(turns(spark, [])).count() == 0


def test_windows_keep_to_the_budget(spark):
    text = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    sizes = [3, 10, 40, 5, 5, 90, 2, 30, 30, 8, 8, 8]
    rows = [(1, 0, "system", "be kind", "")] + [(1, i + 1, ["user", "assistant"][i % 2], text(i, n), "") for i, n in enumerate(sizes)]
    b = chat.Budget(window=80, history=20, history_turns=2)
    got = check(spark, rows, b)
    assert got[1].n_windows > 3
    windows = chat.formatted(turns(spark, rows), budget=b).orderBy("window").collect()
    for k, w in enumerate(windows):
        new = w.formatted.count("<turn ")
        assert w.n_tokens <= b.window or new == 1
        assert w.formatted.startswith("<past system>\nbe kind</past>\n" if k else "<turn system>\nbe kind</turn>\n")
        assert w.formatted.count("<past ") <= 1 + b.history_turns
        assert [w.formatted[s.start : s.start + s.length] for s in w.loss] == [x.split("</turn>")[0] for x in w.formatted.split("<turn assistant>\n")[1:]]
    assert any("<past user>" in w.formatted or "<past assistant>" in w.formatted for w in windows)


def test_a_system_turn_without_room(spark):
    rows = [(1, 0, "system", "s " * 100, "")] + [(1, i, ["assistant", "user"][i % 2], f"turn {i}", "") for i in range(1, 6)]
    got = check(spark, rows, chat.Budget(window=50, history=10))
    windows = chat.formatted(turns(spark, rows), budget=chat.Budget(window=50, history=10)).collect()
    assert got[1].n_windows == 5 and all(w.formatted.count(" system>") == 1 and w.n_tokens > 50 for w in windows)


def test_a_very_long_turn(spark):
    check(spark, [(1, 0, "user", "a <b> & " * 200_000, ""), (1, 1, "assistant", "x&lt;" * 200_000, "")])


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op4_budgeted_windows(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op4_budgeted_windows"])
def test_query_equals_sql(spark, sf_dir, same_rows, name):
    same_rows(queries.op4_budgeted_windows(spark, sf_dir), SQL[name])


def test_extra_conversation(spark, sf_dir):
    r = queries.op4_budgeted_windows(spark, sf_dir).where(F.col("conv_id") == -7).first()
    assert r.n_turns == 2 and r.loss_chars == len(NASTY[0]) and r.loss_sha256 == sha(NASTY[0])
