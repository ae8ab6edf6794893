"""Layer flows: source to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lavra.operators import quality as Q
from lavra.operators.keys import with_row_id
from lavra.operators.uniqueness import first_marks
from lavra.session import stage
from lavra.sources import audit
from lavra.sources import tables as tb
from lavra.sources.bronze import to_bronze, write_bronze
from lavra.sources.contracts import Source, check_contract
from lavra.sources.published import Publication

Reader = Callable[[SparkSession, Source], DataFrame]
Loader = Callable[[DataFrame, str], int]


@dataclass(frozen=True)
class Layout:
    """Folders of the layers below one base folder."""

    base: str

    def bronze(self, entity: str) -> str:
        return f"{self.base}/bronze/batch/{entity}"

    def silver(self, entity: str) -> str:
        return f"{self.base}/silver/{entity}"

    def quarantine(self, entity: str) -> str:
        return f"{self.base}/quarantine/{entity}"

    def gold(self, product: str) -> str:
        return f"{self.base}/gold/{product}"

    @property
    def audit(self) -> str:
        return f"{self.base}/audit"

    @property
    def audit_tables(self) -> str:
        return f"{self.base}/audit_tables"


@dataclass(frozen=True)
class IngestResult:
    source: str
    ingestion_id: str
    records_read: int
    records_loaded: int | None


@dataclass(frozen=True)
class SilverResult:
    entity: str
    run_id: str
    status: str
    bronze_count: int
    valid_count: int
    invalid_count: int
    loaded_count: int | None


def table_loader(base: str) -> Loader:
    """A loader that fully refreshes one Parquet table per name."""
    return lambda df, name: tb.full_refresh(df, f"{base}/{name}")


def ingest(
    spark: SparkSession,
    source: Source,
    reader: Reader,
    layout: Layout,
    loader: Loader | None = None,
    ingestion_id: str | None = None,
    at: datetime | None = None,
) -> IngestResult:
    """Check the contract, add lineage, write bronze, load, log the run.

    The run is seen in bronze once the rows written, and those loaded, are as many as the reader gave.
    """
    started = audit.utc_now()
    ingestion_id, at = ingestion_id or str(uuid4()), at or started
    delivered = Observation()
    df = check_contract(reader(spark, source), source).observe(delivered, F.count(F.lit(1)).alias("rows"))
    path = layout.bronze(source.name)
    loaded = None
    with Publication(spark) as publication:
        written = write_bronze(to_bronze(df, source, ingestion_id, at), path, ingestion_id, at, publication)
        # counted as the reader gave them, in the pass that wrote them
        read = delivered.get["rows"]
        tb.require_equal(f"bronze write of {source.name}", read, written)
        if loader is not None:
            loaded = loader(publication.read(path).drop("ingestion_date"), source.name)
            tb.require_equal(f"bronze load of {source.name}", read, loaded)
    run = audit.pipeline_run(
        spark,
        f"batch_{source.name}",
        source.table_id,
        "bronze",
        "SUCCESS",
        started,
        records_read=read,
        records_written=written,
    )
    audit.append_audit(run, layout.audit, "pipeline_runs")
    return IngestResult(source.name, ingestion_id, read, loaded)


def silver_columns(df: DataFrame, status: str, processed: str) -> DataFrame:
    """Silver metadata; lineage that the input lacks is null."""
    absent = {c: F.lit(None).cast("string") for c in ("_ingestion_id", "_record_hash") if c not in df.columns}
    return df.withColumns(
        {
            "_quality_status": F.lit(status),
            "_silver_processed_timestamp": F.lit(processed),
            **absent,
        }
    )


def build_silver(
    bronze: DataFrame,
    spec: Q.QualitySpec,
    layout: Layout,
    run_id: str | None = None,
    at: datetime | None = None,
    loader: Loader | None = None,
) -> SilverResult:
    """Check `bronze` and write its valid and invalid rows; no row may be lost.

    Silver and quarantine are published together, once their rows add up to those of bronze and
    those loaded are as many as the valid ones.

    The rows are marked once for each of the two sinks. Marking is a scan plus
    a look-up of the row's bit among the staged marks of first rows, so whole rows
    are neither shuffled nor kept as a marked copy, and both passes agree.
    """
    spark = bronze.sparkSession
    started = at or audit.utc_now()
    run_id = run_id or str(uuid4())
    Q.require_columns(bronze, spec)
    rows = with_row_id(bronze)
    bronze_count = rows.count()
    checked = Q.check_rows(rows, spec)
    keys = spec.present_keys(checked)
    marks = stage(first_marks(checked, keys, spec.order_by), "first-marks") if keys else None
    marked = Q.check_keys(checked, spec, marks)
    rules = spec.all_rules(marked)
    valid, invalid = Q.split(marked, spec)

    day, processed = started.date().isoformat(), started.isoformat()
    paths = {"VALID": layout.silver(spec.entity), "INVALID": layout.quarantine(spec.entity)}
    counts, loaded = {}, None
    with Publication(spark) as publication:
        for status, part in (("VALID", valid), ("INVALID", invalid)):
            out = silver_columns(part.drop("ingestion_date"), status, processed)
            counts[status] = publication.write(out, paths[status], started, processing_date=day, _quality_run_id=run_id)
        valid_count, invalid_count = counts["VALID"], counts["INVALID"]
        tb.require_equal(f"quality split of {spec.entity}", bronze_count, valid_count + invalid_count)
        written = {status: publication.read(path) for status, path in paths.items() if counts[status]}
        if loader is not None and valid_count:
            loaded = loader(written["VALID"].drop("processing_date", "_quality_run_id"), spec.entity)
            tb.require_equal(f"silver load of {spec.entity}", valid_count, loaded)

    # Valid rows fail no rule, so the counts per rule come from quarantine alone.
    failed = (
        written["INVALID"].select(Q.FAILED)
        if invalid_count
        else spark.createDataFrame([], f"{Q.FAILED} array<string>")
    )
    finished = audit.utc_now()
    lines = Q.report(
        Q.count_written(failed, rules, bronze_count, valid_count),
        spec.entity,
        rules,
        run_id,
        processed,
        finished.isoformat(),
        round((finished - started).total_seconds(), 3),
        silver_path=paths["VALID"],
        quarantine_path=paths["INVALID"],
    )
    audit.append_audit(lines, layout.audit, "quality_results")

    status = "PASSED_WITH_WARNINGS" if invalid_count else "PASSED"
    run = audit.pipeline_run(
        spark,
        f"silver_{spec.entity}",
        spec.entity,
        "silver",
        status,
        started,
        records_read=bronze_count,
        records_written=valid_count,
        records_valid=valid_count,
        records_rejected=invalid_count,
    )
    audit.append_audit(run, layout.audit, "pipeline_runs")
    return SilverResult(spec.entity, run_id, status, bronze_count, valid_count, invalid_count, loaded)


def silver_from_bronze(
    spark: SparkSession, spec: Q.QualitySpec, layout: Layout, loader: Loader | None = None
) -> SilverResult | None:
    """Silver of the newest bronze run; None where there is no bronze."""
    path = layout.bronze(spec.entity)
    if not tb.partition_values(spark, path, "ingestion_date"):
        return None
    return build_silver(tb.read_latest_snapshot(spark, path, positions=True), spec, layout, loader=loader)


def read_silver(spark: SparkSession, layout: Layout, entity: str) -> DataFrame | None:
    """Newest silver run of an entity; None where it was never written."""
    path = layout.silver(entity)
    if not tb.partition_values(spark, path, "processing_date"):
        return None
    return tb.read_latest_snapshot(spark, path).drop("processing_date", "_quality_run_id")


def write_gold(df: DataFrame, layout: Layout, product: str, day: str, loader: Loader | None = None) -> DataFrame | None:
    """Write a product under its day, and give the written rows back.

    The day's product of before is seen until the new one is whole and loaded. An empty product
    writes nothing and gives None.
    """
    spark = df.sparkSession
    path = layout.gold(product)
    with Publication(spark) as publication:
        count = publication.write(df, path, processing_date=day)
        written = publication.read(path).drop("processing_date")
        if not count:
            publication.drop()
        elif loader is not None:
            tb.require_equal(f"gold load of {product}", count, loader(written, product))
    return written if count else None


def run_all(
    spark: SparkSession,
    sources: Mapping[str, Source],
    specs: Mapping[str, Callable[[], Q.QualitySpec]],
    reader: Reader,
    layout: Layout,
    gold: Callable[[SparkSession, Layout], dict],
    bronze_loader: Loader | None = None,
    silver_loader: Loader | None = None,
) -> dict[str, int]:
    """Ingest, silver, gold, run record, audit tables; gives the audit counts."""
    started = audit.utc_now()
    for source in sources.values():
        ingest(spark, source, reader, layout, bronze_loader)
    for spec in specs.values():
        silver_from_bronze(spark, spec(), layout, silver_loader)
    gold(spark, layout)
    run = audit.pipeline_run(spark, "all", "orchestrator", "all", "SUCCESS", started)
    audit.append_audit(run, layout.audit, "pipeline_runs")
    return audit.sync_audit(spark, layout.audit, layout.audit_tables)
