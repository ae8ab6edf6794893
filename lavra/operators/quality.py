"""Declarative quality: standardise, check rows, check keys, split."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.predicates import holds
from lavra.functions.text import hash_text
from lavra.operators.keys import ROW_ID, with_row_id
from lavra.operators.uniqueness import flag_repeats, row_order

FAILS = "_fails"
FAILED = "_failed_rules"


class CriticalSchemaError(RuntimeError):
    """A required column is missing."""


@dataclass(frozen=True)
class Rule:
    """A named row predicate, true for a valid row."""

    name: str
    predicate: Column
    column: str | None = None
    severity: str = "ERROR"


@dataclass(frozen=True)
class QualitySpec:
    """What a table must satisfy.

    `pseudonymise` columns are hashed after the row rules and before the
    uniqueness check, so a missing id is still seen as missing.
    """

    entity: str
    required: Sequence[str]
    rules: Sequence[Rule] = ()
    unique_keys: Sequence[str] = ()
    order_by: Sequence[str] = ()
    standardizers: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    pseudonymise: Sequence[str] = ()

    def present_keys(self, df: DataFrame) -> list[str]:
        return [k for k in self.unique_keys if k in df.columns]

    def all_rules(self, df: DataFrame) -> list[tuple[str, str | None, str]]:
        """Name, column and severity of every check, the key check last."""
        found = [(r.name, r.column, r.severity) for r in self.rules]
        keys = self.present_keys(df)
        if keys:
            found.append((f"unique.{'_'.join(keys)}", ",".join(keys), "ERROR"))
        return found


@dataclass(frozen=True)
class QualityResult:
    """Lazy frames of one quality run."""

    tagged: DataFrame
    valid: DataFrame
    invalid: DataFrame
    report: DataFrame


def require_columns(df: DataFrame, spec: QualitySpec) -> None:
    missing = sorted(set(spec.required) - set(df.columns))
    if missing:
        raise CriticalSchemaError(f"{spec.entity}: required columns missing: {missing}")


def standardize(df: DataFrame, standardizers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Apply each column's function where the column exists."""
    return df.withColumns({c: f(F.col(c)) for c, f in standardizers.items() if c in df.columns})


def check_rows(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Standardised rows with one boolean per row rule in `_fails`."""
    require_columns(df, spec)
    fails = [(~holds(r.predicate)).alias(f"r{i}") for i, r in enumerate(spec.rules)]
    checked = standardize(df, spec.standardizers).withColumn(FAILS, F.struct(F.lit(False).alias("none"), *fails))
    return standardize(checked, {c: hash_text for c in spec.pseudonymise})


def check_keys(checked: DataFrame, spec: QualitySpec, marks: DataFrame | None = None) -> DataFrame:
    """Add the uniqueness rule. It looks at all rows, also those that fail others."""
    keys = spec.present_keys(checked)
    if not keys:
        return checked
    flagged = flag_repeats(checked, keys, spec.order_by, marks=marks)
    return flagged.withColumn(FAILS, F.col(FAILS).withField(f"r{len(spec.rules)}", F.col("_repeat"))).drop("_repeat")


def _failing(i: int) -> Column:
    return F.col(f"{FAILS}.r{i}")


def any_failure(rules: Sequence[tuple]) -> Column:
    """Whether a checked row fails a rule: plain booleans, no array per row."""
    return reduce(Column.__or__, [_failing(i) for i in range(len(rules))], F.lit(False))


def failed_names(rules: Sequence[tuple]) -> Column:
    """Names of the rules that a checked row fails, in rule order."""
    return F.array_compact(
        F.array(F.lit(None).cast("string"), *[F.when(_failing(i), F.lit(r[0])) for i, r in enumerate(rules)])
    )


def split(checked: DataFrame, spec: QualitySpec) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with the names of the rules they fail."""
    rules = spec.all_rules(checked)
    bad = any_failure(rules)
    valid = checked.where(~bad).drop(FAILS, ROW_ID)
    invalid = checked.where(bad).withColumn(FAILED, failed_names(rules)).drop(FAILS, ROW_ID)
    return valid, invalid


def rule_counts(invalid: DataFrame) -> DataFrame:
    """Failed rows per rule, for the rules that failed at all."""
    return invalid.select(F.explode(FAILED).alias("rule")).groupBy("rule").agg(
        F.count("*").alias("failed_count")
    )


def count_failures(checked: DataFrame, spec: QualitySpec) -> DataFrame:
    """One row: rows read, valid rows, and rows that fail each rule."""
    rules = spec.all_rules(checked)
    return checked.agg(
        F.count("*").alias("total_read"),
        F.count_if(~any_failure(rules)).alias("valid_count"),
        *[F.count_if(_failing(i)).alias(f"c{i}") for i in range(len(rules))],
    )


def count_by_key(checked: DataFrame, spec: QualitySpec) -> DataFrame:
    """The same row from checked rows without the key rule: one shuffle, of one row per key and task.

    Of a key's rows the first one is valid if it passes the other rules, and the rest fail the key rule.
    """
    keys, n = spec.present_keys(checked), len(spec.rules)
    good = ~any_failure(spec.rules)
    first = F.min(F.struct(row_order(spec.order_by).alias("order"), good.alias("good")))
    per_key = checked.groupBy(*keys).agg(F.count("*").alias("copies"), first["good"].alias("good"))
    by_key = per_key.agg(F.count_if("good").alias("valid_count"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(f"c{n}"))
    by_row = checked.agg(F.count("*").alias("total_read"), *[F.count_if(_failing(i)).alias(f"c{i}") for i in range(n)])
    return by_row.crossJoin(by_key).select("total_read", "valid_count", *[f"c{i}" for i in range(n + 1)])  # a row each


def count_written(invalid: DataFrame, rules: Sequence[tuple], total: int, valid: int) -> DataFrame:
    """The same row from the invalid rows alone: a valid row fails no rule."""
    return invalid.agg(
        F.lit(total).cast("bigint").alias("total_read"),
        F.lit(valid).cast("bigint").alias("valid_count"),
        *[F.count_if(F.array_contains(FAILED, r[0])).alias(f"c{i}") for i, r in enumerate(rules)],
    )


def _message(rule: str, column: str | None) -> str:
    """The two message texts of a report."""
    if rule.startswith("unique."):
        return f" registro(s) duplicado(s) em {column.split(',')}."
    return f" registro(s) reprovado(s) na regra {rule}."


def report(
    counts: DataFrame,
    entity: str,
    rules: Sequence[tuple[str, str | None, str]],
    run_id: str = "",
    started_at: str = "",
    finished_at: str = "",
    duration_seconds: float = 0.0,
    layer: str = "silver",
    silver_path: str | None = None,
    quarantine_path: str | None = None,
) -> DataFrame:
    """One row: totals, count per rule and status, made from the counts."""
    results = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(column).cast("string").alias("column"),
                F.lit(severity).alias("severity"),
                F.col(f"c{i}").alias("failed_count"),
                F.concat(F.col(f"c{i}").cast("string"), F.lit(_message(name, column))).alias("message"),
            )
            for i, (name, column, severity) in enumerate(rules)
        ]
    )
    if not rules:
        results = results.cast(
            "array<struct<rule:string,column:string,severity:string,failed_count:bigint,message:string>>"
        )
    invalid = F.col("total_read") - F.col("valid_count")
    failures = F.map_from_entries(
        F.transform(
            F.filter(results, lambda r: r["failed_count"] > 0),
            lambda r: F.struct(r["rule"], r["failed_count"]),
        )
    )
    return counts.select(
        F.lit(run_id).alias("quality_run_id"),
        F.lit(f"quality_{entity}").alias("pipeline"),
        F.lit(entity).alias("entity"),
        F.lit(layer).alias("layer"),
        report_status(invalid).alias("status"),
        F.lit(started_at).alias("started_at"),
        F.lit(finished_at).alias("finished_at"),
        F.lit(float(duration_seconds)).alias("duration_seconds"),
        "total_read",
        "valid_count",
        invalid.alias("invalid_count"),
        failures.alias("failures_by_rule"),
        results.alias("rule_results"),
        F.when(F.col("valid_count") > 0, F.lit(silver_path)).cast("string").alias("silver_path"),
        F.when(invalid > 0, F.lit(quarantine_path)).cast("string").alias("quarantine_path"),
        F.lit(None).cast("string").alias("error_message"),
    )


def report_status(invalid: Column) -> Column:
    """The status names. A failed run raises and leaves no report."""
    return F.when(invalid > 0, F.lit("PASSED_WITH_WARNINGS")).otherwise(F.lit("PASSED"))


def run_quality(df: DataFrame, spec: QualitySpec, run_id: str = "", layer: str = "silver") -> QualityResult:
    """Check `df` against `spec`; raises when a required column is missing."""
    rows = check_rows(df, spec)
    keyed = bool(spec.present_keys(rows))
    rows = with_row_id(rows) if keyed else rows
    checked = check_keys(rows, spec)
    valid, invalid = split(checked, spec)
    rules = spec.all_rules(checked)
    counts = count_by_key(rows, spec) if keyed else count_failures(checked, spec)
    lines = report(counts, spec.entity, rules, run_id, layer=layer)
    tagged = checked.withColumn(FAILED, failed_names(rules)).drop(FAILS, ROW_ID)
    return QualityResult(tagged, valid, invalid, lines)
