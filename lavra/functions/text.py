"""Text normalisation and hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators U+001C to U+001F.
WHITE_SPACE = r"(?U)[\s\x1C-\x1F]+"
VISIBLE = r"(?U)[^\s\x1C-\x1F]"


def strip_text(c: Column) -> Column:
    """Trim and turn every run of white space into one blank."""
    return F.btrim(F.regexp_replace(c.cast("string"), WHITE_SPACE, " "))


def upper_text(c: Column) -> Column:
    return F.upper(strip_text(c))


def hash_text(c: Column) -> Column:
    """SHA-256 of the text; a null hashes like the empty text."""
    return F.sha2(F.coalesce(c.cast("string"), F.lit("")), 256)


def _rarer_number(text: Column) -> Column:
    """Text of a very small or large number, from `1.5E10` form."""
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    positional = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    scientific = F.concat(
        F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    return F.when(exponent.between(-4, 15), positional).when(exponent.isNotNull(), scientific).otherwise(text)


def number_text(c: Column) -> Column:
    """Text of a floating number: shortest digits, positional from 1e-4 to 1e16.

    Null for NaN. Spark writes numbers of the usual size that way by itself;
    others go through a lambda, out of the generated code of every row.
    """
    size, text = F.abs(c), c.cast("string")
    usual = ((size >= 1e-3) & (size < 1e7)) | (c == 0)
    return F.when(usual, text).when(~F.isnan(c), F.transform(F.array(text), _rarer_number)[0])


def record_hash(*columns: Column) -> Column:
    """SHA-256 over the values joined by a bar, a null being the empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Record hash over columns of `df`, floating numbers written alike at any size."""
    kinds = dict(df.dtypes)
    return record_hash(
        *[number_text(F.col(c)) if kinds[c] in ("double", "float") else F.col(c) for c in columns]
    )
