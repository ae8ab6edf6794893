"""Source contracts: what a source must deliver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Contract type names and their Spark types.
TYPES = {"STRING": "string", "INTEGER": "int", "FLOAT": "double", "TIMESTAMP": "timestamp"}


class ContractError(RuntimeError):
    """A source breaks its contract."""


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str = "STRING"
    nullable: bool = True


@dataclass(frozen=True)
class Source:
    """A declared source: where it comes from, its columns and its key."""

    name: str
    table_id: str
    columns: tuple[ColumnContract, ...]
    keys: tuple[str, ...]
    schema_version: str = "1.0"

    @property
    def selected(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> str:
        """DDL of the declared schema."""
        return ", ".join(f"`{c.name}` {TYPES[c.type]}" for c in self.columns)


def check_contract(df: DataFrame, source: Source) -> DataFrame:
    """`df` itself, or an error when it is empty or lacks a declared column."""
    if df.isEmpty():
        raise ContractError(f"{source.name}: the source gave no rows")
    missing = [c for c in source.selected if c not in df.columns]
    if missing:
        raise ContractError(f"{source.name}: columns missing: {missing}")
    return df


def contract_report(df: DataFrame, source: Source) -> DataFrame:
    """One row per declared column: present, of its type, nulls where none may be.

    The nulls of all columns are counted in one pass.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(
        *[
            (F.count_if(F.col(c.name).isNull()) if c.name in types else F.lit(None).cast("bigint")).alias(c.name)
            for c in source.columns
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("column"),
                F.lit(c.name in types).alias("present"),
                F.lit(TYPES[c.type]).alias("declared_type"),
                F.lit(types.get(c.name)).cast("string").alias("actual_type"),
                F.lit(types.get(c.name) == TYPES[c.type]).alias("type_ok"),
                F.col(c.name).alias("null_count"),
                (F.lit(c.nullable) | (F.col(c.name) == 0)).alias("nulls_ok"),
            )
            for c in source.columns
        ]
    )
    return counts.select(F.inline(rows))
