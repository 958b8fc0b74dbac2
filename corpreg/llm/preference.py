"""Preference formatting with DataFrame functions only.

A pair of conversations, the chosen and the rejected one, is rendered as one
prompt (their longest common prefix of turns) and two completions (what
follows it in each), with the character spans of the completions that are
trained on: the assistant's text and its end marker.

Edge cases: turns are ordered by (turn, role, text), nulls first, so ties and
repeated turns have a fixed order; a null role is rendered as ``unknown``, a
null text as empty, and nulls are equal when turns are compared; ``<|`` inside
a text is rendered as ``< |``, so that no text can forge a marker; where one
conversation is a prefix of the other its completion is empty; a pair whose
conversation is missing has that side empty; empty tables give no rows. A
conversation is gathered in one row, as is the string it is rendered to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<role:string,text:string>>"


def gather_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (role, text)."""
    turns = conversations.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).alias("t"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return held.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("unknown")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _spans(turns: Column) -> Column:
    """``start-end`` of what is trained on, joined by ``;``."""

    def step(acc: Column, turn: Column) -> Column:
        start = acc["at"] + F.length(_head(turn))
        end = start + F.length(_body(turn))
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(turn["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, zero, step, lambda acc: F.array_join(acc["spans"], ";"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs``: pair_id, chosen and rejected (arrays of role and text).
    Returns pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans."""
    none = F.array().cast(TURN)
    both = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differs = F.array_position(same, False).cast("int")
    both = both.withColumn("n", F.when(differs > 0, differs - 1).otherwise(shorter))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side), F.lit(1)))
    return both.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _render(rest("c")).alias("chosen"),
        _render(rest("r")).alias("rejected"),
        _spans(rest("c")).alias("chosen_spans"),
        _spans(rest("r")).alias("rejected_spans"),
    )


def swapped_reply_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs made from plain conversations: chosen is the conversation itself;
    rejected is the same up to its last assistant turn, which is replaced by
    the last assistant turn of its neighbour (conv_id with the lowest bit
    flipped), or left out if the neighbour has none, with what follows it dropped.
    Without an assistant turn both are the conversation."""
    held = gather_turns(conversations)
    replies = F.filter("turns", lambda t: t["role"] == "assistant")
    reply = held.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice(replies, F.greatest(F.size(replies), F.lit(1)), 1).alias("other"))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False)))), True).cast("int")
    joined = held.join(reply, "conv_id", "left").withColumn("last", last)
    swapped = F.concat(F.slice("turns", F.lit(1), F.col("last")), F.coalesce("other", F.array().cast(TURN)))
    rejected = F.when(F.size(replies) > 0, swapped).otherwise(F.col("turns"))
    return joined.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
