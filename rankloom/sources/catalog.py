"""Declared prompt sources and their quotas."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


@dataclass(frozen=True)
class Source:
    """Where a source lies, its language (ja, en or auto), the prompt languages that it may give, and whether
    its English prompts ask for a Japanese answer."""

    alias: str
    path: str
    split: str = "train"
    config: str = ""
    data_dir: str = ""
    language: str = "ja"
    allowed: tuple[str, ...] | None = None
    ask_for_japanese: bool = False


#: The sources in order of priority. Paths are folders below a data root.
SOURCES = {
    s.alias: s
    for s in (
        Source("magpie_ja", "magpie_ja"),
        Source("extraction_wiki_ja", "extraction_wiki_ja", config="v0.3"),
        Source("wizard_math_code_ja", "wizard_math_code_ja"),
        Source("oasst2_ja", "oasst2_ja"),
        Source("oasst1_ja", "oasst1_ja"),
        Source("synthetic_jp_en_coding_ja_only", "synthetic_jp_en_coding_ja_only", language="auto", allowed=("ja",)),
        Source("dolly_ja", "dolly_ja"),
        Source("llm_jp_instructions_v1_train", "llm_jp_instructions_v1_train", data_dir="v1.0"),
        Source("oasst2_en_to_ja", "oasst2_en_to_ja", language="en", ask_for_japanese=True),
        Source("oasst1_en_to_ja", "oasst1_en_to_ja", language="en", ask_for_japanese=True),
        Source("daring_anteater_en_to_ja", "daring_anteater_en_to_ja", language="en", ask_for_japanese=True),
    )
}

#: Rows asked of each source.
QUOTAS = {
    "trial": {
        "magpie_ja": 15_000, "extraction_wiki_ja": 10_000, "wizard_math_code_ja": 8_000, "oasst2_ja": 6_000,
        "oasst1_ja": 3_000, "synthetic_jp_en_coding_ja_only": 3_000, "dolly_ja": 2_000, "llm_jp_instructions_v1_train": 1_000,
        "oasst2_en_to_ja": 2_000, "oasst1_en_to_ja": 2_000, "daring_anteater_en_to_ja": 0,
    },
    "prod_like": {
        "magpie_ja": 30_000, "extraction_wiki_ja": 20_000, "wizard_math_code_ja": 15_000, "oasst2_ja": 10_000,
        "oasst1_ja": 6_000, "synthetic_jp_en_coding_ja_only": 6_000, "dolly_ja": 4_000, "llm_jp_instructions_v1_train": 1_000,
        "oasst2_en_to_ja": 4_000, "oasst1_en_to_ja": 4_000, "daring_anteater_en_to_ja": 0,
    },
}


def quotas(preset: str = "trial", override: str | Mapping[str, int] | None = None, sources: Mapping[str, Source] = SOURCES) -> dict[str, int]:
    """A preset's quotas with those of a mapping, JSON text or JSON file in their place."""
    if preset not in QUOTAS:
        raise ValueError(f"unknown preset {preset!r}: use one of {sorted(QUOTAS)}")
    found = dict(QUOTAS[preset])
    given = override if isinstance(override, Mapping) else json_or_file(override) if override else {}
    for alias, n in given.items():
        if alias not in sources:
            raise ValueError(f"unknown source {alias!r}")
        if isinstance(n, bool) or not isinstance(n, int):
            raise ValueError(f"the quota of {alias} must be a whole number, not {n!r}")
        if n < 0:
            raise ValueError(f"the quota of {alias} must not be negative")
        found[alias] = n
    return found


def json_or_file(value: str) -> object:
    """JSON from a file of that name if there is one, else from the text itself."""
    try:
        if (path := Path(value)).is_file():
            return json.loads(path.read_text(encoding="utf-8"))
    except OSError:
        pass  # too long to be a name
    return json.loads(value)


def places(source: Source, root: str) -> Sequence[str]:
    """Folders in which a source may lie, the most specific first. A named subset, by config or data folder, is never replaced by the whole."""
    subsets = [(source.config, source.data_dir), (source.config,), (source.data_dir,)] if source.config or source.data_dir else [()]
    found = ["/".join([root.rstrip("/"), source.path, *(x for x in parts if x)]) for parts in subsets if all(parts) or not parts]
    return list(dict.fromkeys(found))


def _read(spark: SparkSession, place: str, split: str, file_format: str) -> DataFrame:
    """The split in a folder of its own, or the part of a table by split, or, for train, a table without splits."""
    last: AnalysisException | None = None
    for path in (f"{place}/{split}", f"{place}/split={split}", place):
        try:
            found = spark.read.format(file_format).load(path)
        except AnalysisException as e:
            last = e
            continue
        if not found.columns:
            continue
        if path != place:
            return found
        if "split" in found.columns:
            own = found.where(F.col("split") == split).drop("split")
            if own.head(1):
                return own
        elif split == "train":
            return found
    raise FileNotFoundError(f"no split {split!r} in {place}") from last


def read_source(spark: SparkSession, source: Source, root: str, file_format: str = "json") -> DataFrame:
    """The source's split from the first place that has it; an error names the last failure."""
    last: Exception | None = None
    for place in places(source, root):
        try:
            return _read(spark, place, source.split, file_format)
        except FileNotFoundError as e:
            last = e
    raise FileNotFoundError(f"source {source.alias} can't be read below {root}: {last}")
