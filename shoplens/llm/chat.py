"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and only
its reply is trainable. Built-in functions only.

Defined results: turns are ordered by (turn, role, text), nulls first, so that repeated turn
numbers have one order; null text and null role count as empty; a null ``conv_id`` is a
conversation of its own; turns after the last reply form one more example without trainable text,
so that no turn is lost; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Reversible: no mark of the template can remain in the result."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order. A conversation is bounded by what one
    training example may hold, as its last example repeats all of it."""
    filled = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    turn = F.struct("turn", *filled)
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def prefix_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length, is_last) per assistant turn.

    ``text`` is the formatted prefix up to and including the reply; the loss mask covers
    ``loss_length`` code points from ``loss_start`` (from 0), which is the escaped reply alone.
    """
    rendered = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(f"{END}\n")),
    )
    n = F.size("turns")
    ends = F.transform("turns", lambda t, i: F.struct(i.alias("at"), (t["role"] == TRAINED_ROLE).alias("trained"), t["text"].alias("reply")))
    wanted = F.filter(ends, lambda e: e["trained"] | (e["at"] == n - 1))
    examples = (
        conversations(turns)
        .select("conv_id", n.alias("n"), rendered.alias("rendered"), wanted.alias("wanted"))
        .select("conv_id", "n", "rendered", F.posexplode("wanted").alias("example", "e"))
        .select(
            "conv_id", "example", F.array_join(F.slice("rendered", 1, F.col("e.at") + 1), "").alias("text"),
            F.when(F.col("e.trained"), F.length(escape(F.col("e.reply")))).otherwise(0).alias("loss_length"),
            (F.col("e.at") == F.col("n") - 1).alias("is_last"),
        )
    )
    start = F.length("text") - F.lit(len(END) + 1) - F.col("loss_length")
    return examples.withColumn("loss_start", start)


def read_back(text: Column) -> Column:
    """Turns of a formatted text as array<struct<role, text>>: the inverse of the template."""
    pieces = F.split(text, r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, len(START) + 1, 2147483647))
    return F.transform(
        bodies,
        lambda b: F.struct(
            _unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substring(b, F.locate("\n", b) + 1, F.lit(2147483647))).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """Digest per conversation, read back from the formatted examples alone."""
    reply = unescape(F.expr("substring(text, loss_start + 1, loss_length)"))
    light = examples.select(
        "conv_id", "example", F.length("text").cast("long").alias("chars"), reply.alias("reply"),
        F.when(F.col("is_last"), F.col("text")).alias("whole"),
    )
    replies = F.sort_array(F.collect_list(F.struct("example", "reply")))
    grouped = light.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(replies, lambda r: r["reply"]), "").alias("loss"),
        F.max("whole").alias("whole"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return grouped.withColumn("turns", read_back(F.col("whole"))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
