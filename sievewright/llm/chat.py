"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, only the
reply is trainable. A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so that no text can open or close a
turn; a line feed in a role is preceded by a backslash. ``unescape`` undoes all of it.

Defined results: null texts are empty, null roles are the role ``unknown``; turns are ordered by
turn number (nulls first), then role, then text, repeated rows are repeated turns; a conversation
without assistant turn, or with turns after the last one, gets one more example that trains
nothing and carries the whole conversation; an empty table gives no rows; other columns are
ignored. One row holds one conversation, the unit that an example can never split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
_ID = "__conv"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turn: Column) -> Column:
    return F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"), escape(turn["text"]), F.lit(END))


def expand(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn to one row per example: conv, example (0, 1, ..), examples (in the conversation),
    n_turns (in this example), formatted, loss_start (code points before the reply), loss_len
    (0 where nothing is trained)."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    whole = turns.select(F.col(conv).alias(_ID), one.alias("one")).groupBy(_ID).agg(F.sort_array(F.collect_list("one")).alias("all"))
    last = F.size("all")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("all", i)["role"] == TRAINED)
    ends = F.when(F.coalesce(F.element_at("all", -1)["role"] != TRAINED, F.lit(True)), F.concat(ends, F.array(last))).otherwise(ends)
    parts = whole.withColumn("shown", F.transform("all", render)).withColumn("ends", ends)
    each = parts.select(_ID, "all", "shown", F.size("ends").alias("examples"), F.posexplode("ends").alias("example", "upto"))
    head = F.array_join(F.slice("shown", F.lit(1), F.col("upto") - 1), "")
    final = F.element_at("all", F.col("upto"))
    opened = F.concat(head, F.lit(START), escape_role(final["role"]), F.lit("\n"))
    trained = final["role"] == TRAINED
    return (
        each.withColumn("prefix", opened)
        .withColumn("reply", escape(final["text"]))
        .select(
            F.col(_ID).alias(conv),
            F.col("example").cast("long").alias("example"),
            F.col("examples").cast("long").alias("examples"),
            F.col("upto").cast("long").alias("n_turns"),
            F.concat("prefix", "reply", F.lit(END)).alias("formatted"),
            F.length("prefix").cast("long").alias("loss_start"),
            F.when(trained, F.length("reply")).otherwise(0).cast("long").alias("loss_len"),
        )
    )


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, start.cast("int") + 1, length.cast("int")))


def parse(formatted: Column) -> Column:
    """A formatted example back to an array of (role, text)."""
    closed = F.split(formatted, r"<\|im_end\|>\n")
    shown = F.slice(closed, F.lit(1), F.size(closed) - 1)
    opening = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)$"
    return F.transform(shown, lambda t: F.struct(unescape(F.regexp_extract(t, opening, 1)).alias("role"), unescape(F.regexp_extract(t, opening, 2)).alias("text")))


def digests(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Read formatted examples back: one row per conversation."""
    mask = loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_len"))
    per = examples.select(
        F.col(conv),
        F.col("example"),
        F.when(F.col("example") == F.col("examples") - 1, F.col("formatted")).alias("longest"),
        F.length("formatted").cast("long").alias("chars"),
        mask.alias("loss"),
    )
    back = per.groupBy(conv).agg(
        F.max("longest").alias("longest"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
    )
    turns = parse(F.col("longest"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        conv,
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
