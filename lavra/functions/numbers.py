"""Number coercion, ratios, rounding and target status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")
NUMERIC_TYPES = (*WHOLE_TYPES, "float", "double", "decimal")
NUMERIC_TEXT = r"^\s*[+-]?(((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)|(?i:inf|infinity))\s*$"

# The status names of the products.
REACHED = "ATINGIDA"
NOT_REACHED = "NAO_ATINGIDA"
NO_TARGET = "SEM_META"
NO_RESULT = "SEM_RESULTADO"


def missing_nan(c: Column) -> Column:
    """NaN means missing here, and Spark would rank it above every number."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Double, or null where the value is no number.

    The type test is folded away, so a numeric column never goes through text.
    """
    text = c.cast("string")
    numeric = F.substring_index(F.typeof(c), "(", 1).isin(*NUMERIC_TYPES)
    return F.when(numeric, missing_nan(c.try_cast("double"))).otherwise(
        F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))
    )


def to_year(c: Column) -> Column:
    """Whole number, or null."""
    number = to_number(c)
    return F.when(F.typeof(c).isin(*WHOLE_TYPES), c.try_cast("int")).otherwise(
        F.when(number == F.floor(number), number.try_cast("int"))
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def round2(c: Column) -> Column:
    """Two decimals, halves of the scaled value to the even neighbour."""
    return F.rint(c * 100) / 100


def attainment(value: Column, target: Column) -> Column:
    """Value as a percentage of the target; null without a target or at zero."""
    return round2(safe_ratio(value, target) * 100)


def target_status(value: Column, target: Column) -> Column:
    """A missing target is reported before a missing result."""
    return (
        F.when(target.isNull(), F.lit(NO_TARGET))
        .when(value.isNull(), F.lit(NO_RESULT))
        .when(value >= target, F.lit(REACHED))
        .otherwise(F.lit(NOT_REACHED))
    )


def reached_label(value: Column, target: Column) -> Column:
    """1 where the target is reached, else 0, also when either side is missing."""
    return F.coalesce(value >= target, F.lit(False)).cast("int")


def percent(part: Column, whole: Column) -> Column:
    """Rounded percentage; 0.0 for an empty whole."""
    return F.coalesce(round2(F.try_divide(part * F.lit(100.0), whole)), F.lit(0.0))
