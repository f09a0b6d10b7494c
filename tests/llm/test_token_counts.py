import math
import random

import pytest
import regex

from rankloom.llm import queries
from rankloom.llm import token_counts as T


def best(word, costs):
    """Least (cost, tokens) of a segmentation, straight."""
    table, longest = [(0, 0)] + [None] * len(word), max(map(len, costs))
    for end in range(1, len(word) + 1):
        table[end] = min((table[a][0] + costs[word[a:end]], table[a][1] + 1) for a in range(max(0, end - longest), end) if word[a:end] in costs)
    return table[-1][1]


def small_vocabulary():
    r = random.Random(3)
    costs = {bytes([i]): 9000 for i in range(256)}
    for _ in range(300):
        token = bytes(r.choice(b"abcd ") for _ in range(r.randint(2, 5)))
        costs[token] = r.choice([9000, 12000, 18000, r.randint(5000, 20000)])
    return costs


def test_trie_equals_brute_force():
    costs, r = small_vocabulary(), random.Random(4)
    words = {bytes(r.choice(b"abcd e") for _ in range(r.randint(0, 14))) for _ in range(500)} | {b"", b"a" * 300, "日é".encode()}
    assert T.Unigram(costs).counts(words) == {w: best(w, costs) for w in words}


def test_zipf_is_a_distribution():
    costs = T.zipf_costs(queries.vocabulary("byte_bpe_50k.tiktoken"))
    assert len(costs) == 50_256 and sum(math.exp(-c / 1000) for c in costs.values()) == pytest.approx(1, abs=0.01)


def test_counts_of_texts(spark):
    ranks = queries.vocabulary("byte_bpe_50k.tiktoken")
    costs = T.zipf_costs(ranks)
    texts = [None, "", " ", "Hello, world's 123 end\n\n  x", "naïve 日本語", "same", "same", "ab" * 20_000 + " tail", "'s 't"]
    df = spark.createDataFrame([(i, x, 7) for i, x in enumerate(texts)], "doc_id long, text string, N_tokens int")
    got = T.token_counts(df, ranks).collect()
    assert len(got) == len(texts)
    for r in got:
        split = regex.findall(T.PATTERN, texts[r.doc_id] or "")
        assert r.n_pretokens == len(split)
        assert r.n_tokens == sum(best(w.encode(), costs) for w in split)
    assert T.token_counts(df.limit(0), ranks).count() == 0


def test_query(spark, sf_dir):
    costs = T.zipf_costs(queries.vocabulary("byte_bpe_50k.tiktoken"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op5_trie_token_counts(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts)
    memo = {}
    for r in got:
        split = [w.encode() for w in regex.findall(T.PATTERN, texts[r.doc_id])]
        assert r.n_tokens == sum(memo.get(w) or memo.setdefault(w, best(w, costs)) for w in split)
