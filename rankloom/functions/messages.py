"""Chats as array<struct<role, content>> columns: extraction from raw records, trimming, rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions import text as X

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
#: Names under which raw records keep chats, roles, contents, system texts and plain texts, in order of preference.
CHATS = ("messages", "conversations", "conversation", "dialog", "dialogue", "chat")
ROLE_KEYS = ("role", "from", "speaker", "author", "turn_role")
CONTENT_KEYS = ("content", "value", "text", "message", "prompt")
SYSTEM_KEYS = ("system", "system_prompt", "system_message", "instruction_system")
LONG_KEYS = ("content", "text", "task")
ID_KEYS = ("id", "sample_id", "uuid", "idx")
#: Fixed value: characters above which a plain content, text or task isn't a prompt.
LONGEST_PLAIN = 10_000


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def none() -> Column:
    return F.lit(None).cast(MESSAGES)


def _or_null(messages: Column) -> Column:
    return F.when(F.size(messages) > 0, messages)


def _fields(df: DataFrame, column: str) -> dict[str, T.DataType]:
    kind = df.schema[column].dataType
    inner = kind.elementType if isinstance(kind, T.ArrayType) else None
    return {f.name: f.dataType for f in inner.fields} if isinstance(inner, T.StructType) else {}


def _said(x: Column, kind: T.DataType) -> Column:
    """The stripped text of a value, a list's by lines; null for null and for what counts as nothing: "", 0, false and []."""
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(x) > 0, X.clean_lines(x))
    something = x if isinstance(kind, T.BooleanType) else x != F.lit(0) if isinstance(kind, T.NumericType) else x.cast("string") != ""
    return F.when(something, X.clean(x))


def from_list(df: DataFrame, column: str) -> Column:
    """Messages of a list of records with any known key for role and content; null if none is left."""
    have = _fields(df, column)
    roles, contents = [k for k in ROLE_KEYS if k in have], [k for k in CONTENT_KEYS if k in have]
    if not roles or not contents:
        return none()
    said = lambda m: F.coalesce(*(_said(m[k], have[k]) for k in contents), F.lit(""))
    made = F.transform(F.filter(F.col(column), lambda m: m.isNotNull()), lambda m: message(X.role(X.first_said(*(m[k] for k in roles))), said(m)))
    return _or_null(F.filter(made, lambda m: m["role"].isNotNull() & (m["content"] != "")))


def _plain(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("")
    return X.clean_lines(F.col(name)) if isinstance(df.schema[name].dataType, T.ArrayType) else X.clean(F.col(name))


def system_message(df: DataFrame) -> Column:
    """The first system text as a list of one message, or an empty list."""
    found = F.coalesce(*(F.nullif(_plain(df, k), F.lit("")) for k in SYSTEM_KEYS))
    return F.when(found.isNotNull(), F.array(message("system", found))).otherwise(F.array().cast(MESSAGES))


def from_fields(df: DataFrame) -> Column:
    """A prompt from plain columns, after the system text; null if there is none."""
    said = lambda c: F.nullif(c, F.lit(""))
    context = F.coalesce(said(_plain(df, "context")), _plain(df, "input"))
    short = [F.when(F.length(_plain(df, k)) <= LONGEST_PLAIN, said(_plain(df, k))) for k in LONG_KEYS]
    user = F.coalesce(said(_plain(df, "question")), said(X.with_context(_plain(df, "instruction"), context)), said(_plain(df, "prompt")), said(_plain(df, "query")), *short)
    return F.when(user.isNotNull(), F.concat(system_message(df), F.array(message("user", user))))


def extract(df: DataFrame) -> Column:
    """Messages of a raw record: its first usable chat, led by its system text, or its plain columns."""
    lists = [from_list(df, c) for c in CHATS if c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType)]
    chat = F.coalesce(*lists) if lists else none()
    system = system_message(df)
    led = X.bound(chat, lambda c: F.when(F.get(c, F.lit(0))["role"] == "system", c).otherwise(F.concat(system, c)))
    return F.coalesce(led, from_fields(df))


def trim_to_prompt(messages: Column) -> Column:
    """Messages with a content, up to the last user's; a role of no known spelling is the user's. Null without a user's."""
    known = F.transform(messages, lambda m: message(F.coalesce(X.role(m["role"]), F.lit("user")), X.clean(m["content"])))

    def cut(kept: Column) -> Column:
        last = F.array_max(F.transform(kept, lambda m, i: F.when(m["role"] == "user", i + 1)))
        return F.when(last.isNotNull(), F.slice(kept, F.lit(1), last))

    return X.bound(F.filter(known, lambda m: m["content"] != ""), cut)


def last_user(messages: Column) -> Column:
    said = F.filter(messages, lambda m: m["role"] == "user")
    return X.clean(F.try_element_at(said, F.lit(-1))["content"])


def ask_for_answer(messages: Column, suffix: str = X.ANSWER_REQUEST) -> Column:
    """messages with the request appended to the last user's."""
    last = F.array_max(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)))
    return F.transform(messages, lambda m, i: F.when(i == last, message(m["role"], F.concat(X.rstrip(m["content"]), F.lit(suffix)))).otherwise(message(m["role"], m["content"])))


def with_response(messages: Column, response: Column) -> Column:
    """messages and the response as the assistant's; a missing role is the user's."""
    known = F.transform(messages, lambda m: message(F.coalesce(m["role"], F.lit("user")), F.coalesce(m["content"], F.lit(""))))
    return F.concat(known, F.array(message("assistant", response)))


def full_chat(messages: Column, response: Column) -> Column:
    """messages with stripped contents, and the response unless they end in it already."""
    kept = F.transform(messages, lambda m: message(F.coalesce(m["role"], F.lit("")), X.clean(m["content"])))
    last, said = F.try_element_at(kept, F.lit(-1)), X.clean(response)
    ends = F.coalesce((last["role"] == "assistant") & (last["content"] == said), F.lit(False))
    return F.when(ends, kept).otherwise(F.concat(kept, F.array(message("assistant", said))))


def render(messages: Column, head: str = "<|{role}|>\n", tail: str = "\n", generation_head: str | None = None) -> Column:
    """A chat as text by a simple template; generation_head opens the answer to come."""
    before, after = head.split("{role}")
    joined = F.array_join(F.transform(messages, lambda m: F.concat(F.lit(before), m["role"], F.lit(after), m["content"], F.lit(tail))), "")
    return joined if generation_head is None else F.concat(joined, F.lit(generation_head))


def example_text(df: DataFrame, text: str | None = "text", messages: str = "messages", response: str = "response") -> Column:
    """Training text of an example: its text column where not null, else its rendered chat; an error without either."""
    chat = render(full_chat(F.col(messages), F.col(response))) if {messages, response} <= set(df.columns) else F.lit(None).cast("string")
    own = X.strip(F.col(text).cast("string")) if text and text in df.columns else F.lit(None).cast("string")
    return F.coalesce(own, chat, F.raise_error(F.lit("an example needs a text, or messages and a response")).cast("string"))


def record_text(df: DataFrame) -> Column:
    """Text of a scoring record: its text if not empty, else its messages or prompt with the response; an error without either."""
    own = F.nullif(X.clean(F.col("text")), F.lit("")) if "text" in df.columns else F.lit(None).cast("string")
    chats: Sequence[Column] = []
    if "response" in df.columns:
        if "messages" in df.columns:
            chats = [*chats, F.when(F.col("messages").isNotNull() & F.col("response").isNotNull(), render(full_chat(F.col("messages"), F.col("response"))))]
        if "prompt" in df.columns:
            chats = [*chats, F.when(F.col("prompt").isNotNull() & F.col("response").isNotNull(), render(full_chat(F.array(message("user", X.clean(F.col("prompt")))), F.col("response"))))]
    return F.coalesce(own, *chats, F.raise_error(F.lit("a record needs a text, or messages or a prompt with a response")).cast("string"))
