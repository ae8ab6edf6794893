"""ISO-8601 times and durations, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date (extended, basic or week form), any one separator, time, offset.
DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-?W\d{2}(?:-?[1-7])?)"
TIME = r"(\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?)"
OFFSET = r"([+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)"
USUAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
ISO = rf"^{DATE}(?:.{TIME}{OFFSET}?)?$"


def _week_date(text: Column) -> Column:
    """Day of an ISO week: week 1 is the one that holds 4 January."""
    year = F.substring(text, 1, 4)
    week = F.regexp_extract(text, r"W(\d{2})", 1).try_cast("int")
    day = F.regexp_extract(text, r"W\d{2}-?([1-7])$", 1).try_cast("int")
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    monday = F.date_sub(fourth, F.weekday(fourth))
    found = F.date_add(monday, (week - 1) * 7 + F.coalesce(day, F.lit(1)) - 1)
    return F.when((F.extract(F.lit("WEEK"), found) == week) & (week > 0), found.cast("string"))


def _rarer_form(text: Column) -> Column:
    """Basic and week dates, short times, other separators, long fractions."""
    date, time, offset = (F.regexp_extract(text, ISO, i) for i in (1, 2, 3))
    day = (
        F.when(date.contains("W"), _week_date(date))
        .when(F.length(date) == 8, F.regexp_replace(date, r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3"))
        .otherwise(date)
    )
    digits = F.regexp_replace(time, r"[:]|[.,].*$", "")
    clock = F.concat_ws(
        ":",
        F.substring(digits, 1, 2),
        *[F.when(F.length(digits) >= n, F.substring(digits, n - 1, 2)).otherwise("00") for n in (4, 6)],
    )
    # Spark keeps six decimals.
    fraction = F.regexp_extract(time, r"[.,](\d{1,6})", 1)
    zone_digits = F.regexp_replace(offset, r"[:]", "")
    zone = F.when(
        offset != "",
        F.concat(
            F.substring(zone_digits, 1, 3),
            F.lit(":"),
            F.when(F.length(zone_digits) >= 5, F.substring(zone_digits, 4, 2)).otherwise("00"),
        ),
    ).otherwise("+00:00")
    full = F.concat(
        day,
        F.lit("T"),
        F.when(time == "", F.lit("00:00:00")).otherwise(clock),
        F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(F.lit("")),
        zone,
    )
    return F.when(text.rlike(ISO), full.try_cast("timestamp"))


def parse_iso(c: Column) -> Column:
    """Timestamp of an ISO-8601 text, null where it is none.

    A trailing Z is the zero offset; a time without offset counts as UTC. Spark
    reads the usual form by itself. The rarer ones go through a lambda, which
    keeps their long expression out of the generated code of every row.
    """
    text = F.replace(c, F.lit("Z"), F.lit("+00:00"))
    return F.when(c.rlike(USUAL), c.try_cast("timestamp")).otherwise(
        F.transform(F.array(text), _rarer_form)[0]
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from `start` to `end`, three decimals, halves to the even one."""
    return F.rint((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e3)) / F.lit(1e3)


def iso_text(c: Column) -> Column:
    """ISO-8601 text of a timestamp with its UTC offset."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
