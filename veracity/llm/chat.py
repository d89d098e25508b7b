"""Chat formatting with a grammar round trip.

A turn is written as ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed, and a
conversation as its turns in order. Rendered text is parsed again by a deterministic parser: it
splits at every start mark, takes a turn's text up to its first end mark, and undoes escapes. A
turn whose parse differs from its source has conflicting content, which is then escaped: within
it, ``<``, any backslashes and ``|`` get one backslash more before the bar, so no mark is left and
undoing it takes one away. This is repeated until the parse is identical; the second form always
is, and a conversation that still differs stops the job rather than pass on.

The loss mask is a list of code-point ranges of the formatted text: the assistant's texts.

Everything is DataFrame functions. Turns are rendered and checked row by row where they are read;
only then are a conversation's rows brought together, since the result has it as one text. A
conversation must fit a row for that; many equal conversations or turns share nothing.

Defined cases: null role or text counts as empty; rows without a conversation id form one
conversation; equal turn numbers are ordered by role and text, a missing one comes first; repeated
rows are turns like any other; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<role:string,text:string>"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def _role_escaped(c: Column) -> Column:
    # A role ends at the line feed: one inside it becomes a mark that escaped text cannot contain.
    return F.replace(escaped(c), F.lit("\n"), F.lit("<|n|>"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parsed(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` of formatted text, escapes undone."""
    parts = F.split(formatted, r"<\|im_start\|>")

    def turn(part: Column) -> Column:
        body = F.substring_index(part, END, 1)
        head = F.substring_index(body, "\n", 1)
        return F.struct(
            unescaped(F.replace(head, F.lit("<|n|>"), F.lit("\n"))).alias("role"),
            unescaped(F.substring(body, F.length(head) + 2, F.length(body))).alias("text"))

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted`` and ``loss_spans`` (start from 0 and
    length of each text of the role ``learn``, in code points of ``formatted``)."""
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = F.struct("role", "text")
    plain = rendered(F.col("role"), F.col("text"))
    rows = rows.withColumn("same", (F.size(parsed(plain)) == 1) & (F.element_at(parsed(plain), 1) == source))
    rows = rows.select(
        "*", F.when(F.col("same"), F.col("role")).otherwise(_role_escaped(F.col("role"))).alias("r"),
        F.when(F.col("same"), F.col("text")).otherwise(escaped(F.col("text"))).alias("t"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    size = F.length("r") + F.length("t") + len(START) + len(END) + 2
    rows = (rows.withColumn("k", F.row_number().over(order))
            .withColumn("before", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("start", F.coalesce("before", F.lit(0)) + len(START) + F.length("r") + 1))
    turns = rows.groupBy("conv").agg(F.array_sort(F.collect_list(
        F.struct("k", "start", "role", "text", "r", "t"))).alias("turns"))
    out = turns.select(
        "conv", "turns",
        F.array_join(F.transform("turns", lambda x: rendered(x["r"], x["t"])), "").alias("formatted"))
    fits = parsed(F.col("formatted")) == F.transform("turns", lambda x: F.struct(x["role"], x["text"]))
    spans = F.transform(F.filter("turns", lambda x: x["role"] == learn),
                        lambda x: F.struct(x["start"].alias("start"), F.length(x["t"]).alias("length")))
    return out.select(
        F.col("conv").alias(conv_col),
        F.when(fits, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation differs after its round trip")))
        .alias("formatted"), spans.alias("loss_spans"))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, escapes undone, nothing between."""
    return F.array_join(F.transform(spans, lambda x: unescaped(
        F.substring(F.col(formatted), x["start"].cast("int") + 1, x["length"].cast("int")))), "")
