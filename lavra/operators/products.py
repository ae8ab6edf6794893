"""Indicator products: a measure per entity and period against its targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions import numbers as N
from lavra.operators.keys import ROW_ID, left_lookup, with_row_id
from lavra.operators.median import exact_median

# Most rows of one entity and period that one task sorts.
STRETCH_ROWS = 1_000_000


def _typed(period: str, value: str) -> dict[str, Column]:
    """Period as a whole number and value as a double, bad values as null."""
    return {period: N.to_year(F.col(period)), value: N.to_number(F.col(value))}


def _target(df: DataFrame, keys: Sequence[str], period: str, value: str, name: str) -> DataFrame:
    typed = df.withColumns(_typed(period, value))
    return typed.select(*keys, F.col(value).alias(name))


def target_comparison(
    measure: DataFrame,
    target: DataFrame | None,
    dim: DataFrame,
    *,
    entity: str,
    period: str,
    value: str,
    target_value: str,
    dim_columns: Mapping[str, str],
    region: DataFrame | None = None,
    region_key: str | None = None,
    as_of: Column | None = None,
    null_safe: bool = True,
    target_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Measure with its dimension, target, gap, attainment and status.

    `dim_columns` maps dimension columns to output names. `region` is a lookup
    on `region_key` (an output name) with one further column. Without a target
    table the target is null and every status says so. Set `null_safe` off
    where no entity or period is null.

    A target is looked up by period and entity, or by `target_keys`, which may
    name dimension columns: a target per nation is then one row per nation.

    The region is looked up for the dimension, so the measure is joined with
    one table for both.
    """
    base = measure.select(period, entity, value).withColumns(_typed(period, value))
    named = dim.select(entity, *[F.col(c).alias(out) for c, out in dim_columns.items()])
    lookup_columns = []
    if region is not None:
        lookup_columns = [c for c in region.columns if c != region_key]
        named = left_lookup(named, region, [region_key], null_safe)
    result = left_lookup(base, named, [entity], null_safe)
    if target is not None:
        keys = list(target_keys or (period, entity))
        wanted = _target(target, keys, period, target_value, "target")
        result = left_lookup(result, wanted, keys, null_safe)
    else:
        result = result.withColumn("target", F.lit(None).cast("double"))
    v, t = F.col(value), F.col("target")
    return result.select(
        period,
        entity,
        *dim_columns.values(),
        *lookup_columns,
        value,
        "target",
        (v - t).alias("target_gap"),
        N.attainment(v, t).alias("attainment_pct"),
        N.target_status(v, t).alias("status"),
        (F.current_date() if as_of is None else as_of).cast("string").alias("updated_on"),
    )


@dataclass(frozen=True)
class TargetLevel:
    """A coarser target: its name, table, join keys and value column."""

    name: str
    table: DataFrame | None
    on: Sequence[str]
    value: str


def multi_level_targets(
    compared: DataFrame, levels: Sequence[TargetLevel], *, period: str, value: str, null_safe: bool = True
) -> DataFrame:
    """Add `target_<level>` and `gap_<level>` for each level, null without a table."""
    result = compared
    for level in levels:
        name = f"target_{level.name}"
        if level.table is None:
            result = result.withColumn(name, F.lit(None).cast("double"))
        else:
            wanted = _target(level.table, level.on, period, level.value, name)
            result = left_lookup(result, wanted, level.on, null_safe)
        result = result.withColumn(f"gap_{level.name}", F.col(value) - F.col(name))
    return result


def _evolution_columns(
    df: DataFrame, entity: str, period: str, value: str, kind: str, name_col: str | None
) -> DataFrame:
    known = F.col(entity).isNotNull()
    previous = F.when(known, F.col("_previous"))
    start = F.when(known, F.col("_start"))
    return df.select(
        F.lit(kind).alias("entity_kind"),
        F.col(entity).alias("entity_code"),
        F.col(name_col or entity).alias("entity_name"),
        period,
        value,
        previous.alias("previous_value"),
        (F.col(value) - previous).alias("period_change"),
        (F.col(value) - start).alias("cumulative_change"),
    )


def time_evolution(
    measure: DataFrame,
    *,
    entity: str,
    period: str,
    value: str,
    kind: str,
    name_col: str | None = None,
    unique_periods: bool = False,
) -> DataFrame:
    """Value of the previous row of the entity, and changes since it and the start.

    The previous row is the one before in period order (nulls last), not the
    period minus one. The start is the entity's first value that is not null.
    A null entity has neither.

    Set `unique_periods` where (entity, period) is a key of `measure`, as the
    key rule of a checked table ensures: an entity then has at most one row per
    period, and one window does. Otherwise rows of one period follow in input
    order, and an entity may have any number of them; its rows are cut into
    stretches of the input, and only one row per stretch meets in a window.
    """
    typed = measure.withColumns(_typed(period, value))
    in_order = F.col(period).asc_nulls_last()
    if unique_periods:
        by_entity = Window.partitionBy(entity).orderBy(in_order)
        whole = by_entity.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = typed.withColumns(
            {
                "_previous": F.lag(value).over(by_entity),
                "_start": F.first(value, ignorenulls=True).over(whole),
            }
        )
        return _evolution_columns(rows, entity, period, value, kind, name_col)

    stretch = [entity, period, "_file", "_block"]
    rows = with_row_id(typed).withColumns(
        {
            "_file": F.col(f"{ROW_ID}.file"),
            "_row": F.col(f"{ROW_ID}.row"),
            "_block": F.floor(F.col(f"{ROW_ID}.row") / STRETCH_ROWS),
        }
    )
    filled = F.col(value).isNotNull()
    ends = rows.groupBy(*stretch).agg(
        F.min("_row").alias("_first_row"),
        F.max_by(value, "_row").alias("_last_value"),
        F.min_by(F.when(filled, F.col(value)), F.when(filled, F.col("_row"))).alias("_first_value"),
    )
    by_entity = Window.partitionBy(entity).orderBy(in_order, "_file", "_block")
    whole = by_entity.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        *stretch,
        "_first_row",
        F.lag("_last_value").over(by_entity).alias("_before"),
        F.first("_first_value", ignorenulls=True).over(whole).alias("_start"),
    )
    within = Window.partitionBy(*stretch).orderBy("_row")
    joined = left_lookup(rows.withColumn("_lag", F.lag(value).over(within)), ends, stretch)
    first = F.col("_row") == F.col("_first_row")
    joined = joined.withColumn("_previous", F.when(first, F.col("_before")).otherwise(F.col("_lag")))
    return _evolution_columns(joined, entity, period, value, kind, name_col)


def group_summary(
    compared: DataFrame,
    group: str,
    *,
    value: str,
    status: str = "status",
    group_target: DataFrame | None = None,
    target_value: str | None = None,
) -> DataFrame:
    """Statistics per group; `row_count` counts rows, not distinct entities.

    Rows without a group are left out. The two target columns are null without
    a target table. `compared` is read three times: pass a written table.
    """
    rows = compared.where(F.col(group).isNotNull())
    v = F.col(value)
    stats = rows.groupBy(group).agg(
        N.round2(F.avg(v)).alias("mean"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        F.count("*").alias("row_count"),
        F.count(v).alias("with_value"),
        F.count_if(v.isNull()).alias("without_value"),
        F.count_if(F.col(status) == N.REACHED).alias("reached"),
    )
    summary = left_lookup(stats, exact_median(rows, group, value), [group])
    if group_target is not None:
        means = group_target.groupBy(group).agg(
            F.avg(N.to_number(F.col(target_value))).alias("group_target")
        )
        summary = left_lookup(summary, means, [group])
    else:
        summary = summary.withColumn("group_target", F.lit(None).cast("double"))
    return summary.select(
        group,
        "mean",
        N.round2(F.col("median")).alias("median"),
        "minimum",
        "maximum",
        "row_count",
        "with_value",
        "without_value",
        "reached",
        N.percent(F.col("reached"), F.col("row_count")).alias("reached_pct"),
        "group_target",
        (F.col("mean") - F.col("group_target")).alias("gap_mean_to_target"),
    )


def feature_table(
    compared: DataFrame,
    evolution: DataFrame,
    *,
    entity: str,
    period: str,
    value: str,
    columns: Sequence[str | Column],
    null_safe: bool = True,
) -> DataFrame:
    """Chosen columns, the change since the previous period and a 0/1 label."""
    change = evolution.select(period, F.col("entity_code").alias(entity), "period_change")
    label = N.reached_label(F.col(value), F.col("target")).alias("reached")
    joined = left_lookup(compared, change, [period, entity], null_safe)
    return joined.select(*columns, "period_change", label)


def status_counts(compared: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status, and in the row without a status their total."""
    return compared.rollup(status).agg(F.count("*").alias("row_count"))


def group_means(compared: DataFrame, group: str, value: str) -> DataFrame:
    """Mean value per group, highest first."""
    return (
        compared.groupBy(group)
        .agg(N.round2(F.avg(value)).alias("mean"))
        .orderBy(F.desc("mean"), F.asc(group))
    )


def top_groups(compared: DataFrame, group: str, value: str, status: str = "status", n: int = 5) -> DataFrame:
    """The `n` groups with the highest mean."""
    return (
        compared.groupBy(group)
        .agg(
            N.round2(F.avg(value)).alias("mean"),
            F.count("*").alias("row_count"),
            N.percent(F.count_if(F.col(status) == N.REACHED), F.count("*")).alias("reached_pct"),
        )
        .orderBy(F.desc("mean"), F.asc(group))
        .limit(n)
    )
