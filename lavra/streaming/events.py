"""Event decoding and validation as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.predicates import holds

# Error texts in quarantine.
MISSING = "campo obrigatório ausente: "
DUPLICATE = "evento duplicado"
BAD_JSON = "json inválido"


@dataclass(frozen=True)
class EventSpec:
    """What an event must satisfy.

    `checks` gives (error text, predicate) pairs, a predicate being true for a
    good event. They are looked at only when no required field is missing.
    """

    required: Sequence[str]
    checks: Callable[[], list[tuple[Column, Column]]]
    id_column: str = "event_id"
    time_column: str = "event_time"


def decode_events(
    raw: DataFrame, fields: Sequence[str], value: str = "value", keep: Sequence[str] = ("_partition", "_offset", "_time")
) -> DataFrame:
    """Event fields as text, further fields in `_extra`, the text in `_raw`.

    Columns in `keep` that the input has, such as a record's position, stay. Numbers stay text here, so a bad one fails its rule and not the record.
    """
    schema = ", ".join(f"`{f}` string" for f in fields)
    text = F.col(value).cast("string")
    parsed = F.from_json(
        text, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    every = F.from_json(text, "map<string,string>")
    kept = [c for c in keep if c in raw.columns]
    return raw.select(*kept, text.alias("_raw"), parsed.alias("_p"), every.alias("_m")).select(
        *kept,
        *[F.col(f"_p.{f}").alias(f) for f in fields],
        F.map_filter("_m", lambda k, v: ~k.isin(*fields)).alias("_extra"),
        "_raw",
        (F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()).alias("_bad_json"),
    )


def _listed(errors: list[Column]) -> Column:
    """The errors that are not null. An array is built for a bad event only."""
    some = reduce(Column.__or__, [e.isNotNull() for e in errors], F.lit(False))
    return F.when(some, F.array_compact(F.array(*errors))).otherwise(F.array().cast("array<string>"))


def event_errors(spec: EventSpec, bad_json: Column | None = None) -> Column:
    """All errors of an event, in order; an empty array for a good one."""
    absent = [F.col(f).isNull() | (F.col(f).cast("string") == "") for f in spec.required]
    missing = [F.when(a, F.lit(MISSING + f)) for f, a in zip(spec.required, absent)]
    failed = [F.when(~holds(good), F.coalesce(text, F.lit(""))) for text, good in spec.checks()]
    errors = F.when(reduce(Column.__or__, absent, F.lit(False)), _listed(missing)).otherwise(_listed(failed))
    if bad_json is None:
        return errors
    return F.when(bad_json, F.array(F.lit(BAD_JSON))).otherwise(errors)


def validate_events(events: DataFrame, spec: EventSpec) -> DataFrame:
    """Events with their `errors`."""
    bad_json = F.col("_bad_json") if "_bad_json" in events.columns else None
    return events.withColumn("errors", event_errors(spec, bad_json))
