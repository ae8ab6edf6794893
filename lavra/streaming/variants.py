"""Events kept as VARIANT: one parse, typed fields, and whatever else they carry with its nesting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _path(name: str) -> str:
    """The path of a field, whatever characters its name has but both kinds of quotes at once."""
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"a field name with both kinds of quotes: {name}")


def decode_variant_events(
    raw: DataFrame, fields: Mapping[str, str], value: str = "value", keep: Sequence[str] = ("_partition", "_offset", "_time")
) -> DataFrame:
    """Fields in the types given for them, all others in the VARIANT `_extra`, the text in `_raw`.

    The text is parsed once; nested fields stay nested, so `extra_field` finds what lies in them. A
    field that is missing, null or not of its type is null. Text that is no JSON is `_bad_json`, and
    so is JSON that is no object, and null. Text after the first JSON value is not read, as in `from_json`;
    `_raw` has it. An event without further fields has a null `_extra`. Columns in `keep` that the input has stay, others go.
    """
    kept = [c for c in keep if c in raw.columns]
    text = F.col(value).cast("string")
    parsed = raw.select(*kept, text.alias("_raw"), F.try_parse_json(text).alias("_v"))
    members = F.when(F.schema_of_variant("_v").startswith("OBJECT<"), F.col("_v").cast("map<string,variant>"))
    known = parsed.withColumn("_m", members)
    rest = F.map_filter("_m", lambda k, v: ~k.isin(*fields))
    return known.select(
        *kept,
        *[F.try_variant_get("_v", _path(name), kind).alias(name) for name, kind in fields.items()],
        F.when(F.size(rest) > 0, F.to_variant_object(rest)).alias("_extra"),
        "_raw",
        F.col("_m").isNull().alias("_bad_json"),
    )


def extra_field(path: str, kind: str, extra: str = "_extra") -> Column:
    """What lies at a path (`$.a.b[0]`) of the further fields; null where it is missing or not of that type."""
    return F.try_variant_get(extra, path, kind)


def extra_names(extra: str = "_extra") -> Column:
    """The names of the further fields, sorted; empty where there are none."""
    names = F.array_sort(F.map_keys(F.col(extra).cast("map<string,variant>")))
    return F.coalesce(names, F.array().cast("array<string>"))
