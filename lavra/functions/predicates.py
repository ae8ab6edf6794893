"""Row predicates. Each gives true or false, never null: unknown fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions.numbers import to_number
from lavra.functions.text import VISIBLE


def holds(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def not_null(c: Column) -> Column:
    """Neither null nor blank."""
    return holds(c.cast("string").rlike(VISIBLE))


def matches_regex(c: Column, pattern: str) -> Column:
    """The whole value matches; digits of any script are digits."""
    return holds(c.cast("string").rlike(rf"(?U)\A(?:{pattern})\z"))


def in_set(c: Column, allowed: Sequence[str]) -> Column:
    """Membership as text in a fixed short list."""
    return holds(c.cast("string").isin(*allowed))


def numeric_between(c: Column, low: float, high: float) -> Column:
    """A number in the closed range."""
    return holds(to_number(c).between(low, high))


def is_numeric(c: Column) -> Column:
    return to_number(c).isNotNull()


def year_valid(c: Column, low: int = 1990, high: int = 2100) -> Column:
    return numeric_between(c, low, high)
