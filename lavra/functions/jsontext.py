"""Nested columns as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Every struct, array or map column becomes JSON text; others stay."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
