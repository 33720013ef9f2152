"""Preference formatting of conversation pairs.

A pair has a chosen and a rejected conversation. Their longest common prefix of equal turns (role and text) is rendered
once as the prompt; the turns that follow on each side are rendered as completions. With each completion goes its mask:
the code point ranges of what assistants say in it, end marker included, which alone are trained on.

Turns are gathered by conversation, whose size a model's context bounds; everything is built-in functions.

Defined results: null texts and roles are empty; a turn number that repeats keeps all its distinct rows, ordered by role
and text; exact repeats count once; pairs that lack one side are left out; equal sides give two empty completions; an empty
table gives no pairs; other columns, whatever their names, are ignored. Very long: a conversation is one row. contrasted()
goes round the conversations by their numbers: conv_id must be one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let
from .syncmers import with_next

#: The ChatML form.
OPEN, CLOSE, AFTER = "<|im_start|>", "<|im_end|>", "\n"


def head(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit(CLOSE + AFTER))), "")


def mask(turns: Column) -> Column:
    """Ranges start-end of assistants' texts with their end marker in the rendered turns, joined by commas."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        s = acc["at"] + F.length(head(t))
        e = s + F.length(t["text"]) + len(CLOSE)
        own = F.when(t["role"] == "assistant", F.array(F.concat_ws("-", s.cast("string"), e.cast("string")))).otherwise(F.array().cast("array<string>"))
        return F.struct((e + len(AFTER)).alias("at"), F.concat(acc["out"], own).alias("out"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["out"], ","))


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns a and b share from the start."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(a, i)["role"], F.element_at(a, i)["text"]) != F.struct(F.element_at(b, i)["role"], F.element_at(b, i)["text"]))
    return let(differ, lambda d: F.when(F.size(d) > 0, F.element_at(d, 1) - 1).otherwise(n))


def preference(turns: DataFrame) -> DataFrame:
    """turns: pair_id, side ('chosen' or 'rejected'), turn, role, text. One row for each pair with both sides."""
    clean = turns.where(F.col("pair_id").isNotNull()).select("pair_id", "side", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    row = F.struct("turn", "role", "text")
    sides = clean.groupBy("pair_id").agg(*(F.array_sort(F.collect_set(F.when(F.col("side") == s, row))).alias(s) for s in ("chosen", "rejected")))
    sides = sides.where((F.size("chosen") > 0) & (F.size("rejected") > 0)).withColumn("n", common_prefix(F.col("chosen"), F.col("rejected")))
    rest = {s: F.slice(F.col(s), F.col("n") + 1, F.size(s)) for s in ("chosen", "rejected")}
    return sides.select(
        "pair_id", F.col("n").cast("long").alias("prompt_turns"), render(F.slice("chosen", F.lit(1), F.col("n"))).alias("prompt"),
        *(render(rest[s]).alias(s) for s in rest), *(mask(rest[s]).alias(f"{s}_mask") for s in rest),
    )


def contrasted(conversations: DataFrame) -> DataFrame:
    """Pairs from a table of conversations (conv_id, turn, role, text).

    Chosen is a conversation up to its last assistant turn; rejected is the same, but for the last assistant turn, which
    is that of the conversation with the next conv_id that has one, the first after the last. Conversations without
    such turns give no pair, nor does one that has no other beside it.
    """
    blocks = 4 * int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = conversations.where("conv_id is not null and turn is not null")
    down = F.bitwise_not(F.col("conv_id").cast("long")).alias("doc_id")  # with_next() goes by descending doc_id
    said = own.where("role = 'assistant'")
    last = said.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("x")).select("conv_id", down, F.col("x.turn").alias("last"), F.col("x.text").alias("text"))
    other = with_next(last, said.select(down), ["conv_id", "text"], blocks).where("next_conv_id <> conv_id").select("conv_id", "last", F.col("next_text").alias("wrong"))
    joined = own.select("conv_id", "turn", "role", "text").join(other, "conv_id").where("turn <= last")
    is_last = (F.col("turn") == F.col("last")) & (F.col("role") == "assistant")
    two = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
        F.struct(F.lit("rejected").alias("side"), F.when(is_last, F.col("wrong")).otherwise(F.col("text")).alias("text")),
    )
    return joined.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(two).alias("s")).select("pair_id", "s.side", "turn", "role", "s.text")
