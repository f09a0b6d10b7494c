import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rankloom.llm import kernels as K
from rankloom.llm.common import pieces

TEXTS = st.lists(st.text(alphabet="ab \n\t\x0b\xa0é日1A", max_size=30), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_bytes(texts):
    w = K.words(pa.array(texts, pa.large_string()), lower=True)
    want = [x.encode().lower().split() for x in texts]
    got = [[bytes(w.data[w.start[i] : w.end[i]]) for i in range(w.first[t], w.first[t + 1])] for t in range(len(texts))]
    assert got == want
    hashes, names = w.hashes(), [x for y in want for x in y]
    assert len(set(zip(names, hashes.tolist(), strict=True))) == len(set(names)) == len(set(hashes.tolist()))


def test_grams_and_repeats():
    values = K.mix(np.array([1, 2, 3, 1, 2, 3, 4, 1, 2], np.uint64))
    grams = K.Rolling(values).grams(2)
    found = K.repeats(grams)
    assert found.tolist() == [0, 1, 3, 4, 7] and K.later(grams, found).tolist() == [3, 4, 7]
    assert K.covered(np.array([0, 3]), 2, 6).tolist() == [True, True, False, True, True, False]
    assert len(K.Rolling(values).grams(20)) == 0 and len(K.repeats(values[:0])) == 0


def test_a_text_longer_than_a_block_is_whole():
    r = random.Random(1)
    long = " ".join(r.choice(["alpha", "b", "ce"]) for _ in range(400_000))
    texts = pa.array(["a b", long, "", "c"], pa.large_string())
    assert len(long) > K.BLOCK and list(pieces(texts, K.BLOCK))[-1][1] == 4
    w = K.words(texts.slice(1, 1))
    assert w.counts.tolist() == [400_000] and len(set(w.hashes().tolist())) == 3


def test_slices_of_arrays():
    texts = pa.array(["x y", "z", "p q r"], pa.large_string()).slice(1)
    assert K.words(texts).counts.tolist() == [1, 3]
