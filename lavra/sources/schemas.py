"""One schema for runs whose schemas differ: the widest type of each column, and casts to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers from narrow to wide, with their digits.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
# Digits of the widest decimal.
DIGITS = 38
TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _whole_or_decimal(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both exactly, if there is one."""

    def digits(t: T.DataType) -> tuple[int, int]:
        return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE[type(t)], 0)

    if type(a) in WHOLE and type(b) in WHOLE:
        return max(a, b, key=lambda t: WHOLE[type(t)])
    (left, scale), (more, fine) = digits(a), digits(b)
    scale, left = max(scale, fine), max(left, more)
    return T.DecimalType(left + scale, scale) if left + scale <= DIGITS else None


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both fit into.

    Numbers widen to numbers, exactly where a type can (a double beside a whole number stays a
    double), dates to times, nested types part by part. Whatever else differs meets as text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, T.FractionalType) != isinstance(b, T.FractionalType) and not (
            isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType)
        ):
            return T.DoubleType()
        exact = not isinstance(a, (T.FloatType, T.DoubleType)) and not isinstance(b, (T.FloatType, T.DoubleType))
        return (_whole_or_decimal(a, b) if exact else None) or T.DoubleType()
    if isinstance(a, TIMES) and isinstance(b, TIMES):
        return max(a, b, key=lambda t: TIMES.index(type(t)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas in order of appearance, each with its widest type; names match without case."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema.fields):
        seen = fields.get(field.name.lower())
        kind = widest(seen.dataType, field.dataType) if seen else field.dataType
        fields[field.name.lower()] = T.StructField(seen.name if seen else field.name, kind, True)
    return T.StructType(list(fields.values()))


def _as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_columns(have, want, value.getField)))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        values = F.transform_values(value, lambda k, v: _as(v, have.valueType, want.valueType))
        return F.transform_keys(values, lambda k, v: _as(k, have.keyType, want.keyType))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def _columns(have: T.StructType, want: T.StructType, get) -> list[Column]:
    present = {f.name.lower(): f for f in have.fields}
    made = []
    for field in want.fields:
        old = present.get(field.name.lower())
        value = _as(get(old.name), old.dataType, field.dataType) if old else F.lit(None).cast(field.dataType)
        made.append(value.alias(field.name))
    return made


def fit(df: DataFrame, want: T.StructType) -> DataFrame:
    """The frame with the columns and types of a merged schema; absent columns are null. Its other columns stay behind."""
    names = {f.name.lower() for f in want.fields}
    have = T.StructType([f for f in df.schema.fields if f.name.lower() in names])
    rest = [c for c in df.columns if c.lower() not in names]
    return df.select(*_columns(have, want, lambda name: F.col(f"`{name}`")), *[f"`{c}`" for c in rest])


def union_of(frames: list[DataFrame], want: T.StructType) -> DataFrame:
    """The frames one after the other, with the columns of a merged schema first."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [fit(df, want) for df in frames])
