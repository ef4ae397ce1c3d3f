"""Conversations as training examples: one per assistant turn, with everything before it as context.

DataFrame functions only.  The template writes each turn as ``<|im_start|>role``, a line end, the text,
``<|im_end|>`` and a line end.  In texts and roles every ``<`` that backslashes and then a bar follow gets one more
backslash, so that no text holds a marker and ``unescaped`` gives it back unchanged.  In a role, a backslash and a
line end are written out as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    plain = F.replace(role, F.lit("\\"), F.lit("\\b"))
    return escaped(F.replace(plain, F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    # "\b" is a backslash and "\n" a line end; neither can begin inside the other.
    plain = F.replace(unescaped(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\b"), F.lit("\\"))


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, trainable, formatted, loss_start, loss_length``: one row per assistant turn.

    ``formatted`` holds all turns up to and with the target; the loss mask is the span of code points
    ``[loss_start, loss_start + loss_length)`` of it and covers the escaped text of the target alone.  If a
    conversation does not end with an assistant turn, a last row that is not ``trainable`` (an empty mask) holds all
    its turns, so that none is lost.

    Turns are ordered by turn, then role, then text; a null turn comes first, a repeated row is a turn of its own.
    Null roles and texts are empty.  Rows without conv_id are one conversation.  Other columns are ignored.  No turns
    give no rows.

    An example is one string with all its context, so a conversation must fit into a task.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def piece(t: Column) -> Column:
        head = F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"))
        body = escaped(t["text"])
        return F.struct(
            F.concat(head, body, F.lit(END)).alias("all"),
            F.char_length(head).cast("long").alias("head"),
            F.char_length(body).cast("long").alias("body"),
            (t["role"] == "assistant").alias("target"),
        )

    pieces = whole.select("conv_id", F.transform("turns", piece).alias("pieces"))
    numbered = F.transform("pieces", lambda p, i: F.struct(i.alias("i"), p["target"].alias("target")))
    wanted = F.filter(numbered, lambda x: x["target"] | (x["i"] == F.size("pieces") - 1))
    each = pieces.select("conv_id", "pieces", F.posexplode(wanted).alias("example", "at"))
    last = F.element_at("pieces", F.col("at.i") + 1)
    formatted = F.array_join(F.transform(F.slice("pieces", 1, F.col("at.i") + 1), lambda p: p["all"]), "")
    total = F.char_length("formatted")
    return each.select(
        "conv_id",
        "example",
        F.col("at.target").alias("trainable"),
        formatted.alias("formatted"),
        last.alias("last"),
    ).select(
        "conv_id",
        "example",
        "trainable",
        "formatted",
        (total - F.lit(len(END)) - F.col("last.body")).cast("long").alias("loss_start"),
        F.when(F.col("trainable"), F.col("last.body")).otherwise(F.lit(0)).cast("long").alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``role, text``, unescaped."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        at = F.locate("\n", p)
        role = F.substring(p, F.lit(len(START) + 1), at - F.lit(len(START) + 1))
        text = F.substring(p, at + 1, F.char_length(p))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(turns, turn)


def read_loss(examples: DataFrame) -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescaped(F.substring("formatted", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int")))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: turns, trainable text and formatted length, read from them alone."""
    parts = examples.select(
        "conv_id",
        "example",
        "trainable",
        F.when(F.col("trainable"), read_loss(examples)).alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
        F.struct("example", "formatted").alias("longest"),
    )
    each = parts.groupBy("conv_id").agg(
        F.max("longest").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("trainable"), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
        F.count_if("trainable").alias("n_examples"),
    )
    each = each.withColumn("turns", read_turns(F.col("longest.formatted"))).withColumn(
        "loss", F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    )
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return each.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
