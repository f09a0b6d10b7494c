"""Candidate responses of prompts, and their scores, through models that a caller plugs in.

A generator takes a frame of requests (messages as JSON, a seed, a model name, settings) and gives
for each its response and token count; a scorer takes texts and gives a score for each. Both see
Arrow batches and are made once in each worker by the factory that is passed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions import ids
from rankloom.functions import messages as M
from rankloom.functions import text as X
from rankloom.sources.tables import require

#: Requests (columns messages, generator_model, seed) to a frame of response and response_token_len in the same order.
Generator = Callable[[pd.DataFrame], pd.DataFrame]
Scorer = Callable[[list[str]], list[float]]
#: Prompt columns that candidates take over where they exist.
PROMPT_COLUMNS = (
    "prompt_raw", "prompt_language", "answer_language", "source_alias", "source_dataset", "source_split", "source_config_name", "source_data_dir", "source_example_id",
    "source_row_number", "wrapped_for_japanese_answer", "num_prompt_messages", "prompt_char_len",
)


@dataclass(frozen=True)
class Generation:
    """Settings of a run; without sampling a model has one answer to give, so one candidate."""

    models: Sequence[str] = ("stub-a",)
    candidates: int = 4
    teacher: str = "stub-teacher"
    seed: int = 42
    sample: bool = True
    settings: dict[str, float] = field(default_factory=lambda: {"temperature": 0.8, "top_p": 0.95, "repetition_penalty": 1.0, "max_new_tokens": 512})

    def __post_init__(self) -> None:
        if not self.models or self.candidates < 1:
            raise ValueError("needs a model and a candidate at least")
        if not self.sample and self.candidates > 1:
            raise ValueError("without sampling there is one candidate")


def hashed(text: str) -> int:
    """The first 32 bits of a text's hash."""
    return int(hashlib.sha1(text.encode()).hexdigest()[:8], 16)


def stub_generator() -> Generator:
    """Answers that depend on the prompt and the seed alone; for tests and dry runs."""

    def answer(requests: pd.DataFrame) -> pd.DataFrame:
        said = [f"{m} answers {hashed(x) % 9973} in way {s % 7}" for m, x, s in zip(requests["generator_model"], requests["messages"], requests["seed"], strict=True)]
        return pd.DataFrame({"response": said, "response_token_len": [len(x.split()) for x in said]})

    return answer


def stub_scorer() -> Scorer:
    return lambda texts: [hashed(t) / 2**32 for t in texts]


def fan_out(prompts: DataFrame, g: Generation, index: str = "global_prompt_index") -> DataFrame:
    """A request for each prompt, model and candidate, with a seed of its own."""
    models = F.array(*(F.struct(F.lit(i).cast("long").alias("generator_model_index"), F.lit(m).alias("generator_model")) for i, m in enumerate(g.models)))
    rows = prompts.withColumn("_model", F.explode(models)).withColumn("candidate_index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g.candidates - 1).cast("long"))))
    rows = rows.select(*prompts.columns, "_model.*", "candidate_index")
    return rows.withColumn("generator_key", X.file_key(F.col("generator_model"))).withColumn("generation_seed", ids.bucket(F.concat_ws("|", F.lit(g.seed), ids.prompt_hash(F.col("messages")), "generator_model", "candidate_index"), 2**31))


def generate(requests: DataFrame, make: Callable[[], Generator] = stub_generator) -> DataFrame:
    """requests with response, response_token_len and response_char_len."""
    columns = requests.columns
    asked = requests.withColumn("_asked", F.to_json("messages"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema if f.name != "messages")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = make()
        for frame in batches:
            said = answer(pd.DataFrame({"messages": frame["_asked"], "generator_model": frame["generator_model"], "seed": frame["generation_seed"]}))
            if len(said) != len(frame):
                raise ValueError(f"{len(frame)} requests gave {len(said)} responses")
            frame["response"], frame["response_token_len"] = said["response"].tolist(), said["response_token_len"].tolist()
            yield frame

    made = asked.select(*(c for c in columns if c != "messages"), "_asked").mapInPandas(run, f"{kept}, _asked string, response string, response_token_len long")
    made = made.withColumn("messages", F.from_json("_asked", M.MESSAGES)).withColumn("response", X.clean(F.col("response"))).withColumn("response_char_len", F.length("response").cast("long"))
    return made.select(*columns, "response", "response_token_len", "response_char_len")


def scored(df: DataFrame, text, name: str, make: Callable[[], Scorer] = stub_scorer) -> DataFrame:
    """df with a column of scores of a text expression, by Arrow batch."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        judge = make()
        for texts in batches:
            found = judge(texts.tolist())
            if len(found) != len(texts):
                raise ValueError(f"{len(texts)} texts gave {len(found)} scores")
            yield pd.Series(found, dtype="float64")

    return df.withColumn(name, score(text))


def candidate_rows(answers: DataFrame, g: Generation) -> DataFrame:
    """Scored candidate rows with their hashes, prompt columns and settings."""
    prompt, response = ids.prompt_hash(F.col("messages")), ids.response_hash(F.col("response"))
    rows = answers.withColumn("prompt_hash", prompt).withColumn("response_hash", response).withColumn("teacher_model", F.lit(g.teacher))
    rows = rows.withColumn("sample_id", ids.sample_id(F.col("prompt_hash"), F.col("generator_model"), F.col("candidate_index"), F.col("response_hash")))
    if "prompt_raw" not in rows.columns:
        rows = rows.withColumn("prompt_raw", M.last_user(F.col("messages")))
    for name, value in g.settings.items():
        rows = rows.withColumn(f"generation_{name}", F.lit(value))
    kept = [c for c in PROMPT_COLUMNS if c in rows.columns and c != "prompt_raw"]
    return rows.select(
        "messages", "prompt_hash", "response_hash", "sample_id", "prompt_raw", "response", "teacher_score", "teacher_model", "generator_model", "generator_key", "generator_model_index", "candidate_index",
        "global_prompt_index", "response_token_len", "response_char_len", "generation_seed", F.lit(g.sample).alias("generation_do_sample"), *(f"generation_{c}" for c in g.settings), *kept,
    )


def build_candidates(prompts: DataFrame, g: Generation | None = None, generator: Callable[[], Generator] = stub_generator, scorer: Callable[[], Scorer] = stub_scorer) -> DataFrame:
    """From prompts (messages, global_prompt_index) to scored candidates."""
    g = g or Generation()
    require(prompts, ["messages", "global_prompt_index"])
    answers = generate(fan_out(prompts, g), generator)
    answers = scored(answers, M.render(M.full_chat(F.col("messages"), F.col("response"))), "teacher_score", scorer)
    return candidate_rows(answers, g)


def score_records(records: DataFrame, stats: tuple[str, float, float], scorer: Callable[[], Scorer] = stub_scorer) -> DataFrame:
    """Records with student_score_norm (of float precision) and student_score_denorm."""
    mode, mean, std = stats
    out = scored(records, M.record_text(records), "student_score_norm", scorer).withColumn("student_score_norm", F.col("student_score_norm").cast("float").cast("double"))
    return out.withColumn("student_score_denorm", F.col("student_score_norm") * std + mean if mode == "train_zscore" else F.col("student_score_norm"))

