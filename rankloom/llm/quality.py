"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find, in each text, the characters inside n-grams and
lines that occurred before in the same text. Characters of repeated lines count for the rule of
lines alone, so that one repeated line is not counted against a text seven times. The longer an
n-gram, the less of a text may lie in repeated ones. Defined results: a null or empty text has no
words and fails the base rule; a table without rows gives none; repeated rows are judged alike and
all returned; extra columns pass through unless named like a result, then the result replaces them.
A text is held in memory whole, so the longest text bounds the memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm import kernels as K
from rankloom.llm.common import giving_back, pieces, small_batches, text_column

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Rules:
    """Largest allowed percentages; duplicated characters are those of later occurrences, for n-grams outside repeated lines."""

    min_words: int = 50
    repeat_words: int = 50
    dup_line_chars: int = 20
    symbols: int = 10
    dup_gram_chars: dict[int, int] = field(default_factory=lambda: {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10})


def measures(rules: Rules) -> list[str]:
    return ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup{n}_chars" for n in rules.dup_gram_chars)]


def measure(texts: pa.Array, lengths: list[int]) -> dict[str, np.ndarray]:
    """The measures of each text of a block."""
    w = K.words(texts)
    chars = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum((w.data & 0xC0) != 0x80, out=chars[1:])
    word_chars = chars[w.end] - chars[w.start]
    text_of, n = w.text_of, len(w.start)
    salt = K.mix(np.arange(1, len(texts) + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    out = {"n_words": w.counts, "word_chars": K.sums(word_chars, w.first), "n_symbols": K.sums(_SYMBOL[w.data], w.offsets)}

    breaks = np.flatnonzero(w.data == 10)
    line_start = np.union1d(w.offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(w.data)]
    line_end = np.append(line_start[1:], len(w.data))[: len(line_start)]
    line_end = line_end - (w.data[line_end - 1] == 10)
    from_word, to_word = np.searchsorted(w.start, line_start), np.searchsorted(w.start, line_end)
    keep = to_word > from_word
    line_start, line_end, from_word, to_word = (x[keep] for x in (line_start, line_end, from_word, to_word))
    line_text = np.searchsorted(w.offsets, line_start, "right") - 1
    keys = w.rolling.runs(line_start, line_end) ^ salt[line_text]
    again = K.later(keys, K.repeats(keys))
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=len(texts))
    so_far = np.zeros(n + 1, np.int64)
    np.cumsum(word_chars, out=so_far[1:])
    out["dup_line_chars"] = np.bincount(line_text[again], so_far[to_word[again]] - so_far[from_word[again]], len(texts)).astype(np.int64)

    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, from_word[again], 1)
    np.add.at(edges, to_word[again], -1)
    own_chars = np.where(np.cumsum(edges[:-1]) > 0, 0, word_chars)

    rolling = K.Rolling(w.hashes())
    for k in [3, *lengths]:
        keys = rolling.grams(k)
        whole = text_of[k - 1 :] == text_of[: n - k + 1] if n >= k else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        keys = keys[at] ^ salt[text_of[at]] if len(at) else keys[:0]
        found = K.repeats(keys)
        if k == 3:
            out["n_repeat_words"] = K.sums(K.covered(at[found], k, n), w.first) if len(found) else np.zeros(len(texts), np.int64)
        if k in lengths:
            found = K.later(keys, found)
            out[f"dup{k}_chars"] = K.sums(np.where(K.covered(at[found], k, n), own_chars, 0), w.first) if len(found) else np.zeros(len(texts), np.int64)
    return out


def judge(m: dict[str, np.ndarray], rules: Rules) -> dict[str, np.ndarray]:
    failed = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.repeat_words * m["n_words"])
    bad = failed | (100 * m["dup_line_chars"] > rules.dup_line_chars * m["word_chars"]) | (100 * m["n_symbols"] > rules.symbols * m["n_words"])
    for n, most in rules.dup_gram_chars.items():
        bad = bad | (100 * m[f"dup{n}_chars"] > most * m["word_chars"])
    return {"base_failed": failed, "kept": ~bad}


def quality(docs: DataFrame, text: str = "text", rules: Rules | None = None) -> DataFrame:
    """docs with the measures, base_failed and kept; one pass, no shuffle."""
    rules = rules or Rules()
    small_batches(docs.sparkSession)
    names = measures(rules)
    lengths = sorted(rules.dup_gram_chars)
    added = [*names, "base_failed", "kept"]
    passed = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    docs = docs.select(*(F.col(f"`{c}`") for c in passed))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in names), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, text)
            for a, b in pieces(texts, K.BLOCK):
                m = measure(texts.slice(a, b - a), lengths)
                m |= judge(m, rules)
                part = batch.slice(a, b - a)
                made = [pa.array(m[c], pa.int64()) for c in names] + [pa.array(m[c], pa.bool_()) for c in ("base_failed", "kept")]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *added])

    return docs.mapInArrow(giving_back(run), schema)
