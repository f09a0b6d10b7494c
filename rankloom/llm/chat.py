"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens deal the turns of a conversation into spans: a turn whose sum of earlier
tokens passes the next half of the room begins a span, and a turn of more than half the room has
one to itself. So a span of several turns never exceeds the room, no turn is cut, and a single turn
that exceeds the room makes a longer window. A system turn that leaves no room for others makes every
window longer than the budget: each holds it and one other turn that has words. The room is the budget less the system turn and the
history; every window but the first repeats the leading system turn and up to `history_turns`
turns before it. Repeated turns have a marker of their own and no loss, so each assistant text is a
target once.

`&` and `<` of texts become `&amp;` and `&lt;` (in roles `>` also becomes `&gt;`), which undoing in
the reverse order restores; the only `<` of an output are those of its markers.

Defined results: null texts and roles are empty; turns are in order of turn (null first), role and
text; a null conversation is a conversation; repeated rows are turns; an empty table gives an empty
result; columns of other names don't matter. A turn is held whole, so the longest bounds the memory. Windows stay within the budget, so only the reading back in `digests` puts a whole
conversation in one row, as its digest demands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.mixing import word_count

TARGET, SYSTEM = "assistant", "system"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window and of its repeated history; a turn costs its words and `per_turn` for its markers."""

    window: int = 512
    history: int = 96
    history_turns: int = 2
    per_turn: int = 4


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _head(kind: str, role: Column) -> Column:
    return F.concat(F.lit(f"<{kind} "), F.replace(escaped(role), F.lit(">"), F.lit("&gt;")), F.lit(">\n"))


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: Budget | None = None) -> DataFrame:
    """A row for each window: conv, window, formatted, loss (array of start and length in code points), n_tokens."""
    b = budget or Budget()
    rows = turns.select(F.col(conv), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("_tokens", word_count(F.col("_text")) + b.per_turn)
    by_turn = Window.partitionBy(conv).orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    up_to = by_turn.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_pos", F.row_number().over(by_turn)).withColumn("_first", F.first(F.struct("_role", "_text", "_tokens")).over(up_to))
    has_system = F.col("_first._role") == SYSTEM
    is_system = has_system & (F.col("_pos") == 1)
    system_tokens = F.when(has_system, F.col("_first._tokens")).otherwise(0)
    half = F.greatest(F.floor((F.lit(b.window - b.history) - system_tokens) / 2), F.lit(1))
    rows = rows.withColumn("_system", is_system).withColumn("_half", half.cast("long"))
    rows = rows.withColumn("_own", F.when(F.col("_system"), 0).otherwise(F.col("_tokens"))).withColumn("_bucket", F.floor((F.sum("_own").over(up_to) - F.col("_own")) / F.col("_half")))
    first_turn = F.col("_pos") == F.when(has_system, 2).otherwise(1)
    begins = ~F.col("_system") & (first_turn | (F.col("_bucket") != F.lag("_bucket").over(by_turn)) | (F.col("_own") > F.col("_half")) | (F.lag("_own").over(by_turn) > F.col("_half")))
    rows = rows.withColumn("_begins", begins).withColumn("_window", F.greatest(F.sum(F.col("_begins").cast("long")).over(up_to) - 1, F.lit(0)))

    # Turns before a window, the nearest first, while they stay in the history's budget.
    used, past = F.lit(0), []
    for k in range(1, b.history_turns + 1):
        used = used + F.lag("_own", k).over(by_turn)
        fits = F.col("_begins") & (F.col("_window") > 0) & ~F.coalesce(F.lag("_system", k).over(by_turn), F.lit(True)) & (used <= b.history)
        past.append(F.when(fits, F.struct(F.lag("_role", k).over(by_turn).alias("role"), F.lag("_text", k).over(by_turn).alias("text"), F.lag("_own", k).over(by_turn).alias("tokens"))))
    system = F.when(F.col("_begins") & (F.col("_window") > 0) & has_system, F.struct(F.col("_first._role").alias("role"), F.col("_first._text").alias("text"), F.col("_first._tokens").alias("tokens")))
    # A nearer turn that doesn't fit ends the history: the sum only grows.
    rows = rows.withColumn("_past", F.filter(F.array(system, *reversed(past)), lambda x: x.isNotNull()))

    piece = lambda kind, role_, text_, new: F.struct(_head(kind, role_).alias("head"), escaped(text_).alias("body"), F.lit(f"</{kind}>\n").alias("tail"), new.alias("loss"))
    rows = rows.select(
        conv, "_window", "_pos", piece("turn", F.col("_role"), F.col("_text"), F.col("_role") == TARGET).alias("_piece"),
        F.transform("_past", lambda x: piece("past", x["role"], x["text"], F.lit(False))).alias("_past"),
        (F.col("_tokens") + F.aggregate("_past", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])).alias("_tokens"),
    )
    spans = rows.groupBy(conv, "_window").agg(F.array_sort(F.collect_list(F.struct("_pos", "_piece", "_past"))).alias("_rows"), F.sum("_tokens").alias("n_tokens"))
    pieces = F.concat(F.flatten(F.transform("_rows", lambda x: x["_past"])), F.transform("_rows", lambda x: x["_piece"]))
    spans = spans.select(conv, F.col("_window").alias("window"), "n_tokens", pieces.alias("_pieces"))
    joined = F.array_join(F.transform("_pieces", lambda x: F.concat(x["head"], x["body"], x["tail"])), "")
    none = F.expr("cast(array() AS array<struct<start: int, length: int>>)")
    step = lambda s, x: F.struct(
        (s["at"] + F.length(x["head"]) + F.length(x["body"]) + F.length(x["tail"])).alias("at"),
        F.when(x["loss"], F.concat(s["loss"], F.array(F.struct((s["at"] + F.length(x["head"])).alias("start"), F.length(x["body"]).alias("length"))))).otherwise(s["loss"]).alias("loss"),
    )
    loss = F.aggregate("_pieces", F.struct(F.lit(0).alias("at"), none.alias("loss")), step, lambda s: s["loss"])
    return spans.select(conv, "window", joined.alias("formatted"), loss.alias("loss"), "n_tokens")


_TURN = r"<(turn|past) ([^>]*)>\n([^<]*)</(?:turn|past)>\n"


def turns_of(windows: DataFrame) -> DataFrame:
    """windows with turns: the new turns read back from formatted, as role and text, and targets: the texts under the loss."""
    found = [F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(k)) for k in (1, 2, 3)]
    zipped = F.arrays_zip(*(x.alias(n) for x, n in zip(found, ("kind", "role", "text"), strict=True)))
    turns = F.transform(F.filter(zipped, lambda x: x["kind"] == "turn"), lambda x: F.struct(unescaped(x["role"]).alias("role"), unescaped(x["text"]).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return windows.withColumn("turns", turns).withColumn("targets", targets)


def digests(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the windows of each conversation hold, read back in order: turns, digests of turns and targets, and sizes."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    rows = turns_of(windows).select(conv, "window", F.size("turns").cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"), said.alias("said"), F.array_join("targets", "").alias("loss"))
    whole = rows.groupBy(conv).agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("_all"))
    text = lambda name: F.array_join(F.transform("_all", lambda x: x[name]), "")
    return whole.select(
        conv, "n_turns", F.sha2(text("said"), 256).alias("turns_sha256"), F.length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"), "formatted_chars", "n_windows"
    )
