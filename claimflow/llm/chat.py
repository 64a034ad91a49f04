"""Chat formatting: one training example for every assistant turn.

Each turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (and a line break inside
a role ``&#10;``), so no control string can be forged and the original is got back
exactly. An example holds all turns up to and including one assistant turn; only
the text of that last turn is trainable.

Defined cases: a null text or role is empty; rows are ordered by turn, then role,
then text, nulls first, so repeated turn numbers have one order and repeated rows
stay repeated; rows without conversation id form one conversation; a conversation
that ends in other turns, or has no assistant turn at all, gets one more example
over all its turns with nothing trainable, so no turn is lost; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Text in which no control string can occur."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    return F.replace(plain, F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def examples(conversations: DataFrame) -> DataFrame:
    """Training examples: conv_id, example, text, loss_start, loss_chars, trainable.

    ``example`` counts from 1 in a conversation. The trainable span starts after
    ``loss_start`` characters of ``text`` and is ``loss_chars`` long. Offsets are
    running sums over the turns, so a conversation is rendered once and its prefixes
    are cut from that; one shuffle on the conversation serves it all.
    """
    said = escape(F.col("text"))
    turns = conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"), said, F.lit(END + "\n")).alias("_turn"),
        F.length(said).cast("long").alias("_said"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.withColumn("_end", F.sum(F.length("_turn")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = placed.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("_end").alias("end"),
                    F.col("_turn").alias("turn"),
                    F.col("_said").alias("said"),
                    F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False)).alias("trained"),
                )
            )
        ).alias("_parts")
    )
    last = F.element_at("_parts", -1)
    nothing = F.struct(
        last["end"].alias("end"), last["end"].alias("start"), F.lit(0).cast("long").alias("chars"), F.lit(False).alias("trained")
    )
    trained = F.transform(
        F.filter("_parts", lambda p: p["trained"]),
        lambda p: F.struct(
            p["end"].alias("end"),
            (p["end"] - len(END + "\n") - p["said"]).alias("start"),
            p["said"].alias("chars"),
            F.lit(True).alias("trained"),
        ),
    )
    spans = F.when(last["trained"], trained).otherwise(F.concat(trained, F.array(nothing)))
    rendered = parts.select(
        "conv_id", F.array_join(F.transform("_parts", lambda p: p["turn"]), "").alias("_text"), spans.alias("_spans")
    )
    rows = rendered.select("conv_id", "_text", F.posexplode("_spans").alias("_at", "_span"))
    return rows.select(
        "conv_id",
        (F.col("_at") + 1).alias("example"),
        F.substring(F.col("_text"), F.lit(1), F.col("_span.end").cast("int")).alias("text"),
        F.col("_span.start").alias("loss_start"),
        F.col("_span.chars").alias("loss_chars"),
        F.col("_span.trained").alias("trainable"),
    )


def trainable_text(text: Column, loss_start: Column, loss_chars: Column) -> Column:
    """What an example trains on, unescaped."""
    return unescape(F.substring(text, (loss_start + 1).cast("int"), loss_chars.cast("int")))


def parse(text: Column) -> Column:
    """The turns in a formatted text, as an array of (role, text)."""
    parts = F.split(text, START.replace("|", r"\|"))
    bodies = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.substring(p, F.lit(1), F.length(p) - len(END + "\n")),
    )

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        said = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(_unescape_role(role).alias("role"), unescape(said).alias("text"))

    return F.transform(bodies, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """Conversations got back from their examples.

    Returns conv_id, turns (array of role and text), trained (all trainable text
    in order) and formatted_chars (characters of all examples).
    """
    reply = F.struct("example", trainable_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("said"))
    found = formatted.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("_longest"),
        F.sort_array(F.collect_list(reply)).alias("_replies"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    return found.select(
        "conv_id",
        parse(F.col("_longest")).alias("turns"),
        F.array_join(F.transform("_replies", lambda r: r["said"]), "").alias("trained"),
        "formatted_chars",
    )
