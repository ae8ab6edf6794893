"""Exact median per group with bounded state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.operators.keys import left_lookup
from lavra.session import stage

# Ranges into which the values of a group are cut at a time.
RANGES = 1000


def exact_median(
    df: DataFrame, group: str, value: str, name: str = "median", accuracy: int = 10_000, most: int = 100_000
) -> DataFrame:
    """Mean of the two middle values of each group, nulls left out.

    The built-in median keeps every distinct value of a group in one buffer.
    Here a percentile sketch, whose rank error is at most 1/accuracy, brackets
    the middle; rows below the bracket are only counted, and equal values inside
    it are counted before the shuffle. Where a bracket misses the middle all are
    widened and looked at again. Of the values inside, counts per value range
    tell which range holds the middle, again and again until it has at most
    `most` values; only those are sorted, so no task holds more of a group.
    """
    values = df.select(F.col(group).alias("_g"), F.col(value).alias("_v")).where("_v is not null")
    edge = 2.0 / accuracy
    inside, counts = _bracketed(values, edge, accuracy)
    while not counts.where("not _hit").isEmpty():
        edge *= 8
        inside, counts = _bracketed(values, edge, accuracy)
    ranks = counts.select(
        "_g", F.explode(F.array(F.floor((F.col("_n") - 1) / 2) + 1, F.floor(F.col("_n") / 2) + 1)).alias("_rank"), "_below"
    ).distinct()
    rows = inside.join(ranks.withColumnRenamed("_g", "_k"), F.col("_g").eqNullSafe(F.col("_k"))).select(
        "_g", "_rank", "_v", "_c", (F.col("_rank") - F.col("_below")).alias("_left")
    )
    rows = _narrowed(stage(rows, "median"), most)
    upto = F.sum("_c").over(Window.partitionBy("_g", "_rank").orderBy("_v"))
    found = rows.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_left")).groupBy("_g", "_rank").agg(
        F.min("_v").alias("_v")
    )
    # one rank for an odd number of values, two for an even one
    return found.groupBy(F.col("_g").alias(group)).agg(((F.min("_v") + F.max("_v")) / 2).alias(name))


def _bracketed(values: DataFrame, edge: float, accuracy: int) -> tuple[DataFrame, DataFrame]:
    """Distinct values in the bracket of each group with their counts, and (n, below, hit) per group.

    `values` is read once for the brackets and once for the rest.
    """
    shares = [max(0.0, 0.5 - edge), min(1.0, 0.5 + edge)]
    bracket = values.groupBy("_g").agg(
        F.percentile_approx("_v", shares, accuracy).alias("_edges"), F.count("*").alias("_n")
    )
    # the widest bracket is all there is
    low = F.lit(True) if shares[0] == 0.0 else F.col("_v") >= F.col("_edges")[0]
    high = F.lit(True) if shares[1] == 1.0 else F.col("_v") <= F.col("_edges")[1]
    marked = left_lookup(values, stage(bracket, "brackets"), ["_g"]).where(high)
    counted = stage(
        marked.select("_g", "_n", F.when(low, F.col("_v")).alias("_v"), low.alias("_in"))
        .groupBy("_g", "_n", "_in", "_v")
        .agg(F.count("*").alias("_c")),
        "median-values",
    )
    below = F.coalesce(F.sum(F.when(~F.col("_in"), F.col("_c"))), F.lit(0))
    held = F.coalesce(F.sum(F.when(F.col("_in"), F.col("_c"))), F.lit(0))
    counts = counted.groupBy("_g", "_n").agg(below.alias("_below"), held.alias("_held"))
    middle = F.floor((F.col("_n") - 1) / 2) + 1
    hit = (middle > F.col("_below")) & (F.floor(F.col("_n") / 2) + 1 <= F.col("_below") + F.col("_held"))
    return counted.where("_in").select("_g", "_v", "_c"), stage(counts.withColumn("_hit", hit), "median-counts")


def _narrowed(rows: DataFrame, most: int) -> DataFrame:
    """Rows of the value range that holds the rank `_left`, which counts from the range's start."""
    keys = ["_g", "_rank"]

    def with_range(df: DataFrame, ends: DataFrame) -> DataFrame:
        joined = left_lookup(df, ends, keys)
        v, lo, hi = (F.col(c).cast("double") for c in ("_v", "_lo", "_hi"))
        share = F.nanvl(F.try_divide(v - lo, hi - lo), F.lit(1.0))
        return joined.withColumn("_range", _whole(share)).drop("_lo", "_hi", "_kinds")

    while True:
        ends = stage(rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_kinds")), "median-ends")
        widest = ends.agg(F.max("_kinds")).first()[0] or 0
        if widest <= most:
            return rows
        ranged = with_range(rows, ends)
        sums = ranged.groupBy(*keys, "_range", "_left").agg(F.sum("_c").alias("_sum"))
        upto = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_range"))
        picked = (
            sums.withColumn("_upto", upto)
            .where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_sum") < F.col("_left")))
            .select(*keys, F.col("_range").alias("_of"), (F.col("_upto") - F.col("_sum")).alias("_before"))
        )
        rows = stage(
            left_lookup(ranged, picked, keys)
            .where(F.col("_range") == F.col("_of"))
            .select(*keys, "_v", "_c", (F.col("_left") - F.col("_before")).alias("_left")),
            "median",
        )
        if rows.groupBy(*keys).agg(F.count("*").alias("_kinds")).agg(F.max("_kinds")).first()[0] == widest:
            # values a double cannot tell apart are not many
            return rows


def _whole(share: Column) -> Column:
    """Number of the range, from 0 on; it never falls as the share grows."""
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * RANGES), F.lit(RANGES - 1)).cast("int")
