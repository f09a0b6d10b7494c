"""Text rules as column expressions: white space, truthiness, roles, languages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 white-space code points that stripping and collapsing know (Java's \s is ASCII only).
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters, for trimming.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Spellings of the three roles.
ROLES = {
    "system": "system", "sys": "system",
    "user": "user", "human": "user", "prompter": "user", "instruction": "user", "question": "user",
    "assistant": "assistant", "gpt": "assistant", "bot": "assistant", "model": "assistant", "responder": "assistant",
}
#: Letters that count as Japanese and as English.
JAPANESE, ENGLISH = r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]", "[A-Za-z]"
#: Fixed value: what stands between an instruction and its context.
CONTEXT_HEADING = "\n\n### 追加情報\n"
#: Fixed value: the request appended to English prompts.
ANSWER_REQUEST = "\n\nPlease answer in Japanese.\n日本語で回答してください。"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANKS))


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(BLANKS))


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once, however often f uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def collapse(x: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(x, f"{BLANK}+", " "))


def clean(x: Column) -> Column:
    """Stripped text; null is empty."""
    return F.coalesce(strip(x.cast("string")), F.lit(""))


def clean_lines(items: Column) -> Column:
    """A list's texts as lines, without nulls, stripped; a null list is empty."""
    kept = F.transform(F.filter(items, lambda x: x.isNotNull()), lambda x: x.cast("string"))
    return F.coalesce(strip(F.array_join(kept, "\n")), F.lit(""))


def first_said(*options: Column) -> Column:
    """The first option that isn't null or empty; if all are, the last as it is."""
    return F.coalesce(*(F.nullif(x.cast("string"), F.lit("")) for x in options), options[-1].cast("string"))


def role(x: Column) -> Column:
    """user, assistant or system for a known spelling, else null."""
    pairs = reduce(lambda a, b: [*a, F.lit(b[0]), F.lit(b[1])], ROLES.items(), [])
    return F.element_at(F.create_map(*pairs), F.lower(strip(x.cast("string"))))


def language(x: Column) -> Column:
    """ja, en or unknown, by counts of letters."""
    ja, en = F.regexp_count(x, F.lit(JAPANESE)), F.regexp_count(x, F.lit(ENGLISH))
    least = F.greatest(F.lit(1), F.floor(en * 0.05))
    return F.when((ja >= 2) & (ja >= least), "ja").when((en >= 8) & (ja == 0), "en").when(ja > en, "ja").when(en > ja, "en").otherwise("unknown")


def prompt_language(text: Column, default: Column) -> Column:
    """The source's language where it is declared, else a guess."""
    return F.when(default.isin("ja", "en"), default).otherwise(language(text))


def with_context(instruction: Column, context: Column) -> Column:
    """An instruction and its context under a heading, unless the one holds the other or either is empty."""
    i, c = clean(instruction), clean(context)
    both = F.when(F.contains(i, c), i).otherwise(F.concat(i, F.lit(CONTEXT_HEADING), c))
    return F.when((i != "") & (c != ""), both).when(i != "", i).otherwise(c)


def file_key(x: Column) -> Column:
    """A model name as a file name."""
    return F.regexp_replace(F.replace(x, F.lit("/"), F.lit("__")), r"[^A-Za-z0-9._-]+", "_")


def preview(x: Column, n: int = 80) -> Column:
    return F.substring(F.replace(x, F.lit("\n"), F.lit(" ")), 1, n)
