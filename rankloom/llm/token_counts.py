"""Token counts of texts under a unigram vocabulary, by dynamic programming over a trie.

The distinct pre-tokens of a block of texts, in byte order, are the leaves of a trie. The best
score of a prefix depends on that prefix alone, so walking the trie in order keeps the scores of
the current path and computes each node once, whatever number of pre-tokens share it; the count at
a pre-token's end is stored and added up by text. Scores are whole thousandths of a nat, so sums
and ties are exact; of equally good segmentations the one with fewer tokens counts.
Defined results: a null or empty text has 0 pre-tokens and 0 tokens; repeated rows count alike;
of columns named like a result the result stays; an empty table gives an empty result. A block holds
whole texts, so the longest bounds the memory.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import pieces, small_batches, text_column, uncollected

#: Fixed value: the pattern that goes with the byte-level rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rows of an Arrow batch, and bytes of text whose pre-tokens share a trie.
ROWS, BLOCK = 1000, 4 << 20
#: A score and a token count in one number: the score's weight.
_SCORE = 1 << 32


def zipf_costs(ranks: str) -> dict[bytes, int]:
    """Costs, in thousandths of a nat, of the tokens of a rank file under Zipf's law by rank."""
    with open(ranks, "rb") as f:
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    total = math.log(sum(1 / (r + 2.7) for r in tokens.values()))
    return {t: round(1000 * (math.log(r + 2.7) + total)) for t, r in tokens.items()}


class Unigram:
    """costs must cover every single byte, so that any text can be segmented."""

    def __init__(self, costs: dict[bytes, int]) -> None:
        # Tokens from their last byte on: a node is [weight of the token that starts here or None, children].
        self.root: list = [None, {}]
        for token, cost in costs.items():
            node = self.root
            for byte in reversed(token):
                node = node[1].setdefault(byte, [None, {}])
            node[0] = cost * _SCORE + 1

    def counts(self, words: Iterable[bytes]) -> dict[bytes, int]:
        """Token count of each distinct word, through their trie."""
        path, best, out = b"", [0], {}
        top = self.root[1]
        for word in sorted(words):
            shared, most = 0, min(len(word), len(path))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                at, children, least = end - 1, top, None
                while True:
                    node = children.get(word[at])
                    if node is None:
                        break
                    weight, children = node
                    if weight is not None and (least is None or best[at] + weight < least):
                        least = best[at] + weight
                    if not at:
                        break
                    at -= 1
                best.append(least)
            path = word
            out[word] = best[-1] % _SCORE
        return out


@lru_cache(2)
def unigram(ranks: str) -> Unigram:
    """One for each worker process."""
    with uncollected():
        return Unigram(zipf_costs(ranks))


@lru_cache(4)
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def token_counts(docs: DataFrame, ranks: str, text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """docs with n_pretokens and n_tokens; one pass, no shuffle. The rank file is read by each worker at the same path."""
    small_batches(docs.sparkSession, ROWS)
    added = ["n_pretokens", "n_tokens"]
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in added))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _pattern(pattern).findall
        for batch in batches:
            texts = text_column(batch, text)
            for a, b in pieces(texts, BLOCK):
                with uncollected():
                    split = [find(x) for x in texts.slice(a, b - a).to_pylist()]
                    distinct = {w.encode(): w for w in set(chain.from_iterable(split))}
                    counts = {distinct[w]: n for w, n in unigram(ranks).counts(distinct).items()}
                    made = [pa.array(map(len, split), pa.int64()), pa.array([sum(map(counts.__getitem__, x)) for x in split], pa.int64())]
                    del split, distinct, counts
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *added])

    return docs.mapInArrow(run, schema)
