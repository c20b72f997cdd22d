"""Chat formatting from event logs, DataFrame functions only.

A log is partitioned by conversation and sorted by sequence number; streamed
deltas, edits and regenerations fold into final messages, which are rendered
with a template whose control strings cannot occur inside texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
#: Escapes of the characters that control strings need, backslash first.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(c: Column) -> Column:
    for plain, safe in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    """Inverse of ``escape``: between doubled backslashes, each escape stands alone."""

    def part(x: Column) -> Column:
        for plain, safe in ESCAPES[1:]:
            x = F.replace(x, F.lit(safe), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log.

    ``events``: conv_id, seq, kind, message (its place in the conversation),
    role, text.  ``message`` starts a message, ``delta`` appends to it,
    ``edit`` replaces its text, ``regenerate`` does so and drops all that was
    logged before for later messages.  Deltas without a start count from the
    first.  Ties of seq fold in the order of kind (message, edit, regenerate,
    delta), then text, so repeated deltas are kept and order does not matter.
    Null texts are empty, a null role is ``unknown``, a null message number
    is 0, a null seq comes first, a null kind is ``message``; a null conv_id
    is a conversation.  An empty log gives an empty result.
    """
    e = events.select(
        "conv_id", F.coalesce(F.col("message").cast("long"), F.lit(0)).alias("message"),
        F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 62))).alias("seq"),
        F.coalesce("kind", F.lit(MESSAGE)).alias("kind"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    earlier = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("conv_id", "message")
    dropped = F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).over(earlier)
    e = e.withColumn("dropped", dropped).where("dropped is null or seq >= dropped")
    reset = F.max(F.when(F.col("kind") != DELTA, F.col("seq"))).over(own)
    rank = (F.when(F.col("kind") == MESSAGE, 0).when(F.col("kind") == EDIT, 1)
            .when(F.col("kind") == REGENERATE, 2).otherwise(3))
    e = e.withColumn("reset", reset).where("reset is null or seq >= reset").withColumn("rank", rank)
    # of several resets with one seq, the last of their order stays
    last = F.max(F.when(F.col("rank") < 3, F.struct("rank", "text"))).over(own)
    e = e.withColumn("last", last).where(
        "rank = 3 or (rank = last.rank and text = last.text)")
    parts = F.array_sort(F.collect_list(F.struct("seq", "rank", "text", "role")))
    starts = F.array_distinct(F.filter(F.col("parts"), lambda x: x["rank"] < 3))
    return (e.groupBy("conv_id", "message").agg(parts.alias("parts"))
            .withColumn("parts", F.concat(F.slice(starts, 1, 1), F.filter("parts", lambda x: x["rank"] == 3)))
            .select("conv_id", "message", F.element_at("parts", -1)["role"].alias("role"),
                    F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): each conversation as one string and
    the code point ranges ``[start, end)`` of its assistant texts."""
    turns = F.array_sort(F.collect_list(F.struct("message", "role", "text")))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE))
    piece = F.transform("turns", lambda t: F.struct(
        F.char_length(head(t)).alias("before"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss"),
        head(t).alias("head")))
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["before"] + F.char_length(p["body"]) + len(CLOSE)).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["before"]).alias("start"),
                (acc["at"] + p["before"] + F.char_length(p["body"])).alias("end"))))).otherwise(acc["spans"]).alias("spans")))
    return (messages.groupBy("conv_id").agg(turns.alias("turns"))
            .withColumn("pieces", piece)
            .select("conv_id",
                    F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
                    .alias("formatted"),
                    spans["spans"].alias("loss_spans")))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, losses): the turns (role, text) and the texts under
    the loss mask, unescaped, from rendered conversations."""
    marks = F.split("formatted", CLOSE, -1)
    body = F.transform(F.slice(marks, 1, F.size(marks) - 1), lambda x: F.substring(x, len(OPEN) + 1, 1 << 30))
    at = lambda x: F.instr(x, MIDDLE)
    turns = F.transform(body, lambda x: F.struct(
        unescape(F.substring(x, F.lit(1), at(x) - 1)).alias("role"),
        unescape(F.substring(x, at(x) + len(MIDDLE), F.lit(1 << 30))).alias("text")))
    losses = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), losses.alias("losses"))
