"""Chat formatting as a relation: turns are collected, sorted, merged and concatenated by Spark expressions.

Template, for a conversation of blocks of adjacent turns with one role:

    <s><|role|>\\nfirst text<|+|>second text</s><|role|>\\n ... </s>

Control strings all contain "<" or "[". In texts and roles a backslash is put after every "<", "["
and "|", so no control string, of this template or of the usual others ("</s>", "[INST]",
"<|...|>"), survives inside a text; taking one backslash away after each of the three characters
restores the text exactly.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text), nulls first;
repeated rows are turns of their own; the rows without a conv_id are one conversation; an empty
table gives an empty result; texts of any length are written whole; other columns are not looked at. A
conversation is one output row, so it must fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, HEAD, HEAD_END, NEXT = "<s>", "</s>", "<|", "|>\n", "<|+|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|])\\", "$1")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merge_turns(turns: Column) -> Column:
    """Sorted turns as array<struct<role, texts>>: adjacent turns of one role are one block, their texts an array."""
    places = F.sequence(F.lit(0), F.size(turns))
    changes = lambda i: (i == 0) | (F.get(turns, i - 1)["role"] != F.get(turns, i)["role"])
    starts = F.filter(places, lambda i: (i < F.size(turns)) & changes(i))

    def block(start: Column, end: Column) -> Column:
        texts = F.transform(F.slice(turns, start + 1, end - start), lambda t: t["text"])
        return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

    def blocks(at: Column) -> Column:
        return F.transform(at, lambda start, i: block(start, F.coalesce(F.get(at, i + 1), F.size(turns))))

    return _let(starts, blocks)


def _pieces(blocks: Column) -> Column:
    """What is written before each text, the escaped text, and whether the loss counts there."""

    def of(block: Column, number: Column) -> Column:
        before = F.when(number == 0, F.lit(BEGIN)).otherwise(F.lit(END))
        opening = F.concat(before, F.lit(HEAD), escape(block["role"]), F.lit(HEAD_END))

        def piece(text: Column, i: Column) -> Column:
            head = F.when(i == 0, opening).otherwise(F.lit(NEXT))
            return F.struct(head.alias("head"), escape(text).alias("body"), (block["role"] == TRAINED_ROLE).alias("loss"))

        return F.transform(block["texts"], piece)

    return F.flatten(F.transform(blocks, of))


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, formatted, loss_runs): one row per conversation.

    loss_runs covers `formatted` from left to right: runs of n_chars code points, and whether the loss
    counts there, which is so for the texts of TRAINED_ROLE and nothing else.
    """
    prepared = rows.select(
        F.col(conv),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = prepared.groupBy(conv).agg(F.sort_array(F.collect_list("t")).alias("turns"))

    made = turns.select(F.col(conv), _let(_let(F.col("turns"), merge_turns), _pieces).alias("pieces"))
    text_parts = F.flatten(F.transform("pieces", lambda p: F.array(p["head"], p["body"])))

    def run(length: Column, loss: Column) -> Column:
        return F.struct(length.alias("n_chars"), loss.alias("loss"))

    runs = F.flatten(
        F.transform(
            "pieces",
            lambda p: F.array(run(F.length(p["head"]), F.lit(False)), run(F.length(p["body"]), p["loss"])),
        )
    )
    last = F.array(run(F.lit(len(END)), F.lit(False)))
    return made.select(
        F.col(conv),
        F.concat(F.array_join(text_parts, ""), F.lit(END)).alias("formatted"),
        F.concat(runs, last).alias("loss_runs"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: array<struct<role, text>>."""
    body = F.substring(formatted, len(BEGIN) + 1, 1 << 30)
    blocks = F.filter(F.split(body, "</s>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = F.split(block, r"\|>\n", 2)
        name = unescape(F.substring(F.get(parts, F.lit(0)), len(HEAD) + 1, 1 << 30))
        texts = F.split(F.get(parts, F.lit(1)), r"<\|\+\|>")
        return _let(name, lambda n: F.transform(texts, lambda t: F.struct(n.alias("role"), unescape(t).alias("text"))))

    return F.flatten(F.transform(blocks, turns))


def masked_texts(formatted: Column, loss_runs: Column) -> Column:
    """The stretches of a formatted conversation where the loss counts, unescaped, in order."""

    def step(seen: Column, run: Column) -> Column:
        here = F.array(unescape(F.substring(formatted, seen["at"], run["n_chars"])))
        return F.struct(
            (seen["at"] + run["n_chars"]).alias("at"),
            F.when(run["loss"], F.concat(seen["texts"], here)).otherwise(seen["texts"]).alias("texts"),
        )

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("texts"))
    return F.aggregate(loss_runs, start, step, lambda seen: seen["texts"])


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def formatting_report(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation, and of conversation -1, read back from the formatted strings."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(TRAINED_ROLE)).alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    read = format_conversations(rows).select(
        "conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
        masked_texts(F.col("formatted"), F.col("loss_runs")).alias("masked"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("masked", "")  # nothing but what the mask covers
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
