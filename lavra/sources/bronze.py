"""Bronze: source rows plus lineage columns, one folder per run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import row_hash
from lavra.sources.contracts import Source
from lavra.sources.published import Publication

# The lineage columns, in order.
LINEAGE = (
    "_ingestion_id",
    "_ingestion_timestamp",
    "_source_project",
    "_source_dataset",
    "_source_table",
    "_load_type",
    "_record_hash",
    "_schema_version",
)


def split_table_id(table_id: str) -> tuple[str, str]:
    """Project and dataset of `project.dataset.table`; empty where absent."""
    parts = table_id.split(".")
    return (parts[0] if len(parts) > 1 else "", parts[1] if len(parts) > 2 else "")


def to_bronze(
    df: DataFrame,
    source: Source,
    ingestion_id: str,
    ingestion_timestamp: datetime,
    load_type: str = "BATCH",
) -> DataFrame:
    """Add the eight lineage columns; the hash covers the declared columns."""
    project, dataset = split_table_id(source.table_id)
    return df.withColumns(
        {
            "_ingestion_id": F.lit(ingestion_id),
            "_ingestion_timestamp": F.lit(ingestion_timestamp.astimezone(timezone.utc).isoformat()),
            "_source_project": F.lit(project),
            "_source_dataset": F.lit(dataset),
            "_source_table": F.lit(source.table_id),
            "_load_type": F.lit(load_type),
            "_record_hash": row_hash(df, source.selected),
            "_schema_version": F.lit(source.schema_version),
        }
    )


def write_bronze(
    df: DataFrame, path: str, ingestion_id: str, ingestion_timestamp: datetime, run: Publication | None = None
) -> int:
    """Write one run under its date and run id; repeating the run replaces it.

    Within a publication the run is seen once that is published, else at once.
    """
    if run is None:
        with Publication(df.sparkSession) as alone:
            return write_bronze(df, path, ingestion_id, ingestion_timestamp, alone)
    day = ingestion_timestamp.astimezone(timezone.utc).date().isoformat()
    return run.write(df, path, ingestion_timestamp, ingestion_date=day, _ingestion_id=ingestion_id)
