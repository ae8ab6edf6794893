from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lavra.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def rows(spark):
    """Sorted rows of a frame as plain tuples."""

    def read(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return read


@pytest.fixture
def municipio_bronze(spark):
    data = [
        ("3550308", "  São Paulo ", "sp"),
        ("3304557", "Rio de Janeiro", "RJ"),
        ("2927408", "Salvador", "ba"),
        ("1100205", " Porto Velho", "ro"),
    ]
    lineage = ("ing-1", "2026-07-13T00:00:00+00:00", "tabela", "BATCH", "h")
    return spark.createDataFrame(
        [r + lineage for r in data],
        "id_municipio string, nome string, sigla_uf string, _ingestion_id string,"
        " _ingestion_timestamp string, _source_table string, _load_type string, _record_hash string",
    )
