"""Referential integrity between tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.numbers import percent, to_number
from lavra.operators.keys import left_lookup, semi
from lavra.operators.uniqueness import repeated_keys
from lavra.session import stage


def _shared(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in left.columns and k in right.columns]


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key is not in `right`; all of them without a shared key."""
    present = _shared(left, right, keys)
    if not present:
        return left
    return semi(left, right.select(*present).distinct(), present, "left_anti")


def match_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: `total` rows of `left` and how many are `matched` in `right`.

    `left` is counted per key first, so a hot key is one row in the join.
    """
    present = _shared(left, right, keys)
    if not present:
        return left.agg(F.count("*").alias("total"), F.lit(0).cast("long").alias("matched"))
    known = right.select(*present).distinct().withColumn("_known", F.lit(True))
    per_key = left.groupBy(*present).agg(F.count("*").alias("n"))
    return left_lookup(per_key, known, present).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))), F.lit(0)).alias("matched"),
    )


def match_percentage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: percentage of `left` rows with a match, 0.0 for an empty `left`."""
    return match_counts(left, right, keys).select(
        percent(F.col("matched"), F.col("total")).alias("match_pct")
    )


def incompatible_periods(left: DataFrame, right: DataFrame, period: str) -> DataFrame:
    """Whole periods of `left` that `right` does not have, one row each."""
    if period not in left.columns or period not in right.columns:
        return left.sparkSession.createDataFrame([], f"`{period}` bigint")

    def periods(df: DataFrame) -> DataFrame:
        value = to_number(F.col(period))
        return df.select(value.alias(period)).where(F.col(period).isNotNull()).distinct()

    return periods(left).subtract(periods(right)).select(F.col(period).cast("bigint").alias(period))


@dataclass(frozen=True)
class IntegrityCheck:
    """One line of the report.

    `kind` is `orphans`, `match`, `duplicates` or `periods`. A missing table
    makes counts zero and the period list empty.
    """

    name: str
    kind: str
    left: DataFrame | None
    right: DataFrame | None = None
    keys: Sequence[str] = ()


def _check_row(check: IntegrityCheck, counted: dict[tuple, DataFrame]) -> DataFrame | None:
    left, right, keys = check.left, check.right, check.keys
    if left is None or (right is None and check.kind != "duplicates"):
        return None
    if check.kind in ("orphans", "match"):
        counts = counted.get(_pair(check))
        counts = match_counts(left, right, keys) if counts is None else counts
        return counts.select(
            (F.col("total") - F.col("matched")).alias("failed_rows"),
            F.when(F.lit(check.kind == "match"), percent(F.col("matched"), F.col("total"))).alias("match_pct"),
        )
    if check.kind == "duplicates":
        present = [k for k in keys if k in left.columns]
        if not present:
            return None
        return repeated_keys(left, present).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("failed_rows"))
    if check.kind == "periods":
        period = keys[0]
        return incompatible_periods(left, right, period).agg(
            F.count("*").alias("failed_rows"), F.sort_array(F.collect_set(period)).alias("periods")
        )
    raise ValueError(f"unknown integrity check: {check.kind}")


def _pair(check: IntegrityCheck) -> tuple:
    return id(check.left), id(check.right), tuple(check.keys)


def _counted_once(checks: Sequence[IntegrityCheck]) -> dict[tuple, DataFrame]:
    """Match counts, one row each, of the pairs that more than one check asks for."""
    asked = Counter(
        _pair(c) for c in checks if c.kind in ("orphans", "match") and c.left is not None and c.right is not None
    )
    once = {_pair(c): c for c in checks}
    return {
        pair: stage(match_counts(once[pair].left, once[pair].right, once[pair].keys), "matches")
        for pair, times in asked.items()
        if times > 1
    }


def integrity_report(checks: Sequence[IntegrityCheck]) -> DataFrame:
    """One row per check: rows that fail it, match percentage, missing periods.

    A pair of tables that several checks compare is counted once.
    """
    counted = _counted_once(checks)
    spark = next(c.left for c in checks if c.left is not None).sparkSession
    schema = "failed_rows bigint, match_pct double, periods array<bigint>"
    lines = []
    for check in checks:
        row = _check_row(check, counted)
        if row is None:
            row = spark.createDataFrame([(0, 0.0 if check.kind == "match" else None, [])], schema)
        empty = {"match_pct": F.lit(None).cast("double"), "periods": F.array().cast("array<bigint>")}
        row = row.withColumns({c: v for c, v in empty.items() if c not in row.columns})
        lines.append(
            row.select(
                F.lit(check.name).alias("check"),
                F.lit(check.kind).alias("kind"),
                F.col("failed_rows").cast("bigint").alias("failed_rows"),
                "match_pct",
                F.col("periods").cast("array<bigint>").alias("periods"),
            )
        )
    return reduce(DataFrame.unionByName, lines)
