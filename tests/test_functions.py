import hashlib
import json

import pytest
from pyspark.sql import functions as F

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import stats as S
from rankloom.functions import text as X

WIDE = chr(0x3000)


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("text", ["", " a ", f"{WIDE}a b{WIDE}\n", "\xa0\x85\x1c a\t", "a", f" {chr(0x2028)}x{chr(0x200b)}"])
def test_strip_equals_python(spark, text):
    assert one(spark, text, X.strip) == text.strip()
    assert one(spark, text, X.rstrip) == text.rstrip()
    assert one(spark, text, X.collapse) == " ".join(text.split())


@pytest.mark.parametrize(("spelt", "role"), [("Human", "user"), (" GPT\n", "assistant"), ("sys", "system"), ("question", "user"), ("tool", None), ("", None), (None, None), ("responder", "assistant")])
def test_roles(spark, spelt, role):
    assert one(spark, spelt, X.role) == role


@pytest.mark.parametrize(
    ("text", "language"),
    [("日本語です", "ja"), ("hello there", "en"), ("short", "en"), ("", "unknown"), ("123", "unknown"), ("日", "ja"), ("a" * 40 + "日本", "ja"), ("a" * 60 + "日本", "en"), ("a" * 7 + "日", "en"), ("カナ and some English text of a length", "ja")],
)
def test_language(spark, text, language):
    assert one(spark, text, X.language) == language


def test_context(spark):
    rows = spark.createDataFrame([("do it now", "it"), ("do", "this"), ("", "c"), ("i", None), (None, None)], "i string, c string")
    got = [r[0] for r in rows.select(X.with_context(F.col("i"), F.col("c"))).collect()]
    assert got == ["do it now", "do\n\n### 追加情報\nthis", "c", "i", ""]


def test_strip_is_linear(spark):
    import time

    rows = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b")).alias("x"))
    rows.select(F.length(X.strip(F.col("x")))).first()
    began = time.time()
    assert rows.select(F.length(X.strip(F.col("x")))).first()[0] == 1_000_002 and time.time() - began < 2


def test_contents_may_be_lists(spark):
    schema = "messages array<struct<role:string,content:array<string>,value:string,text:long>>"
    turns = [("user", [" a", None, "b "], "v", 5), ("gpt", [], "v ", 0), ("user", None, "", 7), ("user", [None], "v", 1), ("system", None, None, 0)]
    df = spark.createDataFrame([(turns,)], schema)
    assert as_turns(df.select(M.from_list(df, "messages")).first()[0]) == [("user", "a\nb"), ("assistant", "v"), ("user", "7")]


def test_example_keys(spark):
    chat_type = "messages array<struct<role:string,content:string>>"
    rows = [("", None, "", None, None), ("", "s", "t", None, None), (None, "", None, None, None), (None, None, None, [("user", "q ")], " a "), (None, None, None, None, "a")]
    df = spark.createDataFrame(rows, f"prompt_hash string, sample_id string, text string, {chat_type}, response string")
    sha = lambda x: hashlib.sha1(x.encode()).hexdigest()
    want = [sha(""), "s", sha("\n<assistant>\n"), sha("<user>\nq\n<assistant>\na"), sha("\n<assistant>\na")]
    assert [r[0] for r in df.select(ids.example_key(df)).collect()] == want


def test_list_text_and_truthiness(spark):
    assert one(spark, [" a", None, "b "], X.clean_lines, "array<string>") == "a\nb"
    rows = spark.createDataFrame([("", "x"), (None, ""), ("a", "b")], "p string, q string")
    assert [r[0] for r in rows.select(X.first_said(F.col("p"), F.col("q"))).collect()] == ["x", "", "a"]


def chat(*turns):
    return [{"role": r, "content": c} for r, c in turns]


def as_turns(value):
    return None if value is None else [(m["role"], m["content"]) for m in value]


@pytest.mark.parametrize(
    ("turns", "want"),
    [
        ([("user", " q "), ("assistant", "a")], [("user", "q")]),
        ([("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "r"), ("system", "t")], [("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "r")]),
        ([("assistant", "a")], None),
        ([("system", "s")], None),
        ([("user", "  ")], None),
        ([("tool", "x"), ("user", "q"), ("gpt", "a")], [("user", "x"), ("user", "q")]),
        ([(" Human", "x "), ("GPT", "a"), (None, "y"), ("sys", "s")], [("user", "x"), ("assistant", "a"), ("user", "y")]),
        ([], None),
    ],
)
def test_trim(spark, turns, want):
    kind = "array<struct<role:string,content:string>>"
    assert as_turns(one(spark, chat(*turns), M.trim_to_prompt, kind)) == want


def test_extract_prefers_chats_and_puts_the_system_first(spark):
    schema = "messages array<struct<from:string,value:string>>, system string, question string, instruction string, context string, content string"
    rows = [
        ([("human", " hi "), ("gpt", "yo"), ("tool", "x"), ("human", "")], "S", "q", None, None, None),
        ([("sys", "own"), ("human", "hi")], "S", None, None, None, None),
        ([], None, None, "do", "with", None),
        (None, "S", "", None, None, "x" * 10_001),
        (None, None, None, None, None, "y"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [as_turns(r[0]) for r in df.select(M.extract(df)).collect()]
    assert got == [
        [("system", "S"), ("user", "hi"), ("assistant", "yo")], [("system", "own"), ("user", "hi")], [("user", "do\n\n### 追加情報\nwith")], None, [("user", "y")],
    ]


def test_full_chat_and_requests(spark):
    kind = "array<struct<role:string,content:string>>"
    turns = chat(("user", "q　"), ("assistant", " a "))
    assert as_turns(one(spark, turns, lambda x: M.full_chat(x, F.lit("a ")), kind)) == [("user", "q"), ("assistant", "a")]
    assert as_turns(one(spark, turns, lambda x: M.full_chat(x, F.lit("b")), kind))[-1] == ("assistant", "b")
    assert as_turns(one(spark, turns, M.ask_for_answer, kind))[0] == ("user", "q" + X.ANSWER_REQUEST)
    assert as_turns(one(spark, [], lambda x: M.with_response(x, F.lit("r")), kind)) == [("assistant", "r")]
    assert one(spark, [], M.last_user, kind) == ""


def test_texts_of_examples(spark):
    df = spark.createDataFrame([(" t ", None, None), (None, chat(("user", "q")), "r")], "text string, messages array<struct<role:string,content:string>>, response string")
    assert [r[0] for r in df.select(M.example_text(df)).collect()] == ["t", "<|user|>\nq\n<|assistant|>\nr\n"]
    bad = spark.createDataFrame([(None,)], "text string")
    with pytest.raises(Exception, match="needs a text"):
        bad.select(M.example_text(bad)).collect()
    record = spark.createDataFrame([("", "p", "r")], "text string, prompt string, response string")
    assert record.select(M.record_text(record)).first()[0] == "<|user|>\np\n<|assistant|>\nr\n"


def test_hashes_equal_python(spark):
    kind = "array<struct<role:string,content:string>>"
    turns = chat(("user", " a  b "), ("assistant", 'é"\\\n😀'))
    stripped = [{"content": m["content"].strip(), "role": m["role"]} for m in turns]
    want = json.dumps(stripped, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert one(spark, turns, ids.canonical, kind) == want
    assert one(spark, turns, ids.prompt_hash, kind) == hashlib.sha1(want.encode()).hexdigest()
    key = json.dumps([{"role": m["role"], "content": " ".join(m["content"].split())} for m in turns], ensure_ascii=False, separators=(",", ":"))
    assert one(spark, turns, ids.dedup_key, kind) == key


def test_splits_equal_python(spark):
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = df.select("k", ids.split_by_fraction(F.col("k"), 0.3, 7).alias("a"), ids.split_by_bucket(F.col("k"), 0.29, 100).alias("b"), ids.split_by_bucket(F.col("k"), 0, 100).alias("c")).collect()
    for r in got:
        digest = hashlib.sha1(f"7:{r.k}".encode()).digest()
        assert r.a == ("validation" if int.from_bytes(digest[:8], "big") / 2**64 < 0.3 else "train")
        assert r.b == ("validation" if int(hashlib.sha1(r.k.encode()).hexdigest()[:8], 16) % 100 < int(0.29 * 100) else "train")
        assert r.c == "train"


def test_shards(spark):
    df = spark.range(10).select(S.contiguous_shard(F.col("id"), 10, 4).alias("s"))
    assert [r[0] for r in df.collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
    few = spark.range(2).select(S.contiguous_shard(F.col("id"), 2, 4).alias("s"))
    assert [r[0] for r in few.collect()] == [0, 1]


def test_constant_scores_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(S.pearson(F.col("x"), F.col("y"))).first()[0] == 0.0
    assert df.limit(1).agg(S.pearson(F.col("y"), F.col("y"))).first()[0] == 0.0
    assert df.select(S.normalised(F.lit(float("nan")), 0.0, 1.0, clip=2.0)).first()[0] == 2.0
