"""Canonical forms, content hashes and the deterministic splits that rest on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import text as X
from rankloom.functions.messages import message


def dedup_key(messages: Column) -> Column:
    """Chats that differ in white space alone share this key."""
    return F.to_json(F.transform(messages, lambda m: message(F.coalesce(m["role"], F.lit("user")), X.collapse(X.clean(m["content"])))))


def canonical(messages: Column) -> Column:
    """Compact JSON with sorted keys and stripped contents."""
    return F.to_json(F.transform(messages, lambda m: F.struct(X.clean(m["content"]).alias("content"), F.coalesce(m["role"], F.lit("user")).alias("role"))))


def plain(messages: Column) -> Column:
    """Roles in brackets above contents; the fallback form of example keys."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<"), F.coalesce(m["role"], F.lit("")), F.lit(">\n"), X.clean(m["content"]))), "\n")


def sha1(x: Column) -> Column:
    return F.sha1(x.cast("binary"))


def prompt_hash(messages: Column) -> Column:
    return sha1(canonical(messages))


def response_hash(response: Column) -> Column:
    return sha1(response)


def joined_hash(*parts: Column) -> Column:
    """Hash of the parts with bars between them; a null part is empty, and keeps its bars."""
    return sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def sample_id(prompt: Column, generator: Column, candidate: Column, response: Column) -> Column:
    return joined_hash(prompt, generator, candidate, response)


def pair_id(prompt: Column, chosen: Column, rejected: Column, strategy: Column) -> Column:
    return joined_hash(prompt, chosen, rejected, strategy)


def fraction(key: Column) -> Column:
    """The first 64 bits of a key's hash as a share of 2^64."""
    return F.conv(F.substring(sha1(key), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def split_by_fraction(key: Column, ratio: float, seed: int = 42) -> Column:
    """validation for the share `ratio` of keys, by a seeded hash; else train."""
    if ratio <= 0:
        return F.lit("train")
    return F.when(fraction(F.concat(F.lit(f"{seed}:"), key)) < F.lit(ratio), "validation").otherwise("train")


def bucket(key: Column, base: int) -> Column:
    """The first 32 bits of a key's hash modulo base."""
    return F.conv(F.substring(sha1(key), 1, 8), 16, 10).cast("long") % F.lit(base)


def example_key(df: DataFrame) -> Column:
    """Stable key of an example: its prompt hash or sample id if not empty, its hashed text if not null, else its hashed chat; a null chat or response is empty."""
    options = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("prompt_hash", "sample_id") if c in df.columns]
    if "text" in df.columns:
        options.append(sha1(F.col("text").cast("string")))
    if {"messages", "response"} <= set(df.columns):
        options.append(sha1(F.concat(F.coalesce(plain(F.col("messages")), F.lit("")), F.lit("\n<assistant>\n"), X.clean(F.col("response")))))
    return F.coalesce(*options)


def split_by_bucket(key: Column, ratio: float, base: int = 10_000) -> Column:
    """validation for keys in the first int(ratio * base) buckets; else train."""
    if ratio <= 0:
        return F.lit("train")
    return F.when(bucket(key, base) < F.lit(int(ratio * base)), "validation").otherwise("train")
