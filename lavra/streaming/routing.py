"""Split one batch of events into valid, invalid and duplicate ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.operators.keys import ROW_ID, left_lookup, semi, with_row_id
from lavra.operators.uniqueness import first_marks, flag_marked, row_order
from lavra.streaming.events import DUPLICATE, EventSpec


def _valid(events: DataFrame) -> DataFrame:
    return events.where(F.size("errors") == 0)


def _route(events: DataFrame, touched: DataFrame, spec: EventSpec, order_by: Sequence[str]) -> DataFrame:
    """Route by `touched`: the ids that occur again, with `_seen` for those known before.

    Events of all other ids are the only ones of theirs. Only for touched ids
    is the first event looked for, with a minimum before the shuffle.
    """
    key = [spec.id_column]
    good = _valid(events)
    narrow = good.select(*key, row_order(order_by).alias("_order"))
    firsts = semi(narrow, touched, key).groupBy(*key).agg(F.min("_order").alias("_first"))
    firsts = left_lookup(firsts, touched.select(*key, "_seen"), key)
    alone = F.col("_first").isNull()
    first = alone | (~F.col("_seen") & (F.col("_first") == row_order(order_by)))
    routed = left_lookup(good, firsts, key).withColumn("route", F.when(first, F.lit("valid")).otherwise(F.lit("duplicate")))
    errors = F.when(F.col("route") == "duplicate", F.array(F.lit(DUPLICATE))).otherwise(F.col("errors"))
    # invalid events need no look-up: however many there are without an id, they meet in no join
    bad = events.where(F.size("errors") > 0).withColumn("route", F.lit("invalid"))
    return routed.withColumn("errors", errors).drop("_first", "_seen", ROW_ID).unionByName(bad.drop(ROW_ID))


def _flag(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Whether the id is among the known ones."""
    ids = known.select(key).distinct().withColumn("_known", F.lit(True))
    return left_lookup(df, ids, [key]).withColumn("_known", F.coalesce("_known", F.lit(False)))


def route_events(
    events: DataFrame, spec: EventSpec, seen: DataFrame | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Add `route` to validated events.

    The first valid event of an id is valid, unless `seen` holds the id; later
    ones are duplicates. Invalid events do not count as seen. Ids are counted
    before the shuffle, so an id that floods the batch is one row per task.
    """
    events = with_row_id(events)
    counts = _valid(events).groupBy(spec.id_column).agg(F.count("*").alias("_copies"))
    if seen is None:
        touched = counts.where("_copies > 1").withColumn("_seen", F.lit(False))
    else:
        touched = _flag(counts, seen, spec.id_column).where("_copies > 1 OR _known")
        touched = touched.withColumnRenamed("_known", "_seen")
    return _route(events, touched, spec, order_by)


def route_marks(events: DataFrame, spec: EventSpec, known: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Marks of the events that `route_marked` finds valid: the first valid one of each id that is not `known`."""
    return first_marks(_valid(events), [spec.id_column], order_by, known)


def route_marked(events: DataFrame, marks: DataFrame) -> DataFrame:
    """The same as `route_events`, by staged marks: the two sinks of a batch look up bits and shuffle no events."""
    good = flag_marked(_valid(events), marks, "_later")
    route = F.when(F.col("_later"), F.lit("duplicate")).otherwise(F.lit("valid"))
    errors = F.when(F.col("_later"), F.array(F.lit(DUPLICATE))).otherwise(F.col("errors"))
    good = good.withColumn("errors", errors).withColumn("route", route).drop("_later", ROW_ID)
    bad = events.where(F.size("errors") > 0).withColumn("route", F.lit("invalid")).drop(ROW_ID)
    return good.unionByName(bad)


def new_events(
    events: DataFrame, id_column: str, seen: DataFrame | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Add `is_new`: the first event of an id that `seen` does not hold.

    No other check is made; an event without an id is never new.
    """
    filled = F.col(id_column).isNotNull() & (F.col(id_column).cast("string") != "")
    plain = EventSpec((), list, id_column)
    no_id = F.when(filled, F.array()).otherwise(F.array(F.lit(""))).cast("array<string>")
    routed = route_events(events.withColumn("errors", no_id), plain, seen, order_by)
    return routed.withColumn("is_new", F.col("route") == "valid").drop("errors", "route")
