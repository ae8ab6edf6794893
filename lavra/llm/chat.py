"""Chat formatting from every participant's side.

For each speaker of a conversation the whole dialogue is rendered with that speaker as the
assistant and all others as named users; the mask holds the spans the assistant is trained on.
Only built-in functions. Messages are numbered within their conversation, which spreads over tasks
however long it is: ranges of messages are counted each by itself, and only their counts meet. A
dialogue is one row up to `segment_messages` messages, a longer one goes on in further rows, which
start without the messages before.

Null text is empty, a null role is the speaker "unknown". Messages stand in order of turn, then role,
then text, a null turn before all others; rows that agree in all of them are as many equal messages.
Roles in `narrators` set the scene: they are shown as they are and get no side of their own, so a
conversation of narrators alone gives no row. Markers inside a text are broken up by a blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import let
from lavra.session import stage

# The markers around a message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(side: Column, role: Column, narrators: tuple[str, ...]) -> Column:
    name = F.when(role == side, F.lit("assistant")).when(role.isin(*narrators), role)
    return F.concat(F.lit(OPEN), F.coalesce(name, F.concat(F.lit("user name="), role)), F.lit("\n"))


def _numbered(messages: DataFrame) -> DataFrame:
    """Each different message with its times and the number of its first one in the conversation, from 0."""
    order = ["turn", "role", "body"]
    ranged = stage(
        messages.groupBy("conversation", *order).agg(F.count("*").alias("times"))
        .repartitionByRange("conversation", *order)
        .withColumn("part", F.spark_partition_id()),
        "messages",
    )
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("conversation", "part").agg(F.sum("times").alias("n"))
    before = F.sum("n").over(earlier.partitionBy("conversation").orderBy("part"))
    starts = parts.select(F.col("conversation").alias("c"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum("times").over(earlier.partitionBy("conversation", "part").orderBy(*order))
    same = F.col("conversation").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    counted = ranged.withColumn("inside", F.coalesce(inside, F.lit(0)))
    return counted.join(starts, same).select("conversation", *order, "times", (F.col("start") + F.col("inside")).alias("place"))


def _segments(messages: DataFrame, length: int) -> DataFrame:
    """The messages of each conversation and segment, in order."""
    first, last = F.col("place"), F.col("place") + F.col("times") - 1
    cut = _numbered(messages).withColumn(
        "segment", F.explode(F.sequence(F.floor(first / length), F.floor(last / length)))
    )
    start = F.greatest(first, F.col("segment") * length)
    end = F.least(last, F.col("segment") * length + length - 1)
    held = F.struct(start.alias("place"), "role", "body", (end - start + 1).cast("int").alias("times"))
    grouped = cut.groupBy("conversation", "segment").agg(F.array_sort(F.collect_list(held)).alias("ms"))
    each = F.flatten(F.transform("ms", lambda m: F.array_repeat(F.struct(m["role"], m["body"]), m["times"])))
    return grouped.withColumn("ms", each)


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    narrators: tuple[str, ...] = ("system",),
    segment_messages: int = 1024,
) -> DataFrame:
    """One row per conversation, speaker and segment: the text and its trained spans.

    A span counts code points from the start of the segment; it covers a reply and its end marker.
    """
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"<\|", "< |")
    rows = turns.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.regexp_replace(F.col(role), r"[\n<|]", " "), F.lit("unknown")).alias("role"),
        body.alias("body"),
    )
    sides = rows.where(~F.col("role").isin(*narrators)).select(
        F.col("conversation").alias("c"), F.col("role").alias("side")
    ).distinct()
    seen = _segments(rows, segment_messages).join(sides, F.col("conversation").eqNullSafe(F.col("c")))
    shown = F.transform(
        "ms",
        lambda m: F.struct(
            m["role"].alias("role"),
            F.concat(_head(F.col("side"), m["role"], narrators), m["body"], F.lit(CLOSE + "\n")).alias("shown"),
        ),
    )
    return seen.withColumn("ms", shown).select(
        F.col("conversation").alias(conversation),
        F.col("side").alias("participant"),
        "segment",
        F.size("ms").alias("n_messages"),
        F.array_join(F.transform("ms", lambda m: m["shown"]), "").alias("text"),
        let(_starts(F.col("ms")), lambda at: _spans(F.col("ms"), at, F.col("side"))).alias("trained"),
    )


def _starts(ms: Column) -> Column:
    """Where each message begins."""
    return F.aggregate(
        ms,
        F.array(F.lit(0)),
        lambda a, m: F.concat(a, F.array(F.element_at(a, -1) + F.length(m["shown"]))),
    )


def _spans(ms: Column, at: Column, side: Column) -> Column:
    own = F.transform(
        ms,
        lambda m, i: F.when(
            m["role"] == side,
            F.struct(
                (F.get(at, i) + F.lit(len(OPEN) + len("assistant") + 1)).alias("start"),
                (F.get(at, i + 1) - F.lit(1)).alias("end"),
            ),
        ),
    )
    return F.filter(own, lambda x: x.isNotNull())
