"""Publication: whole or not at all, swaps under readers, history over changed types, packing."""

from __future__ import annotations

import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.folders import folder_names
from lavra.operators import quality as Q
from lavra.plans import layers
from lavra.plans import literacy as lit
from lavra.sources import published as pub
from lavra.sources import tables as tb
from lavra.sources.published import LoadError, Publication, markers
from lavra.sources.schemas import merged, widest

AT = datetime(2026, 7, 13, 12, 0, tzinfo=timezone.utc)


@pytest.fixture
def layout(tmp_path):
    return layers.Layout(str(tmp_path / "lake"))


def states(spark, source=None):
    return spark.createDataFrame(lit.STATES[:3], "codigo_uf string, sigla_uf string, nome string, regiao string")


# ---- nothing is seen before it is whole


def test_a_refused_ingest_is_never_seen(spark, layout, monkeypatch):
    """The reader gave five rows, three were written."""
    path = layout.bronze("uf")
    layers.ingest(spark, lit.SOURCES["uf"], states, layout, ingestion_id="good", at=AT)
    written = layers.write_bronze
    monkeypatch.setattr(layers, "write_bronze", lambda df, *rest: written(df.limit(2), *rest) and 2)
    with pytest.raises(LoadError, match="bronze write of uf: expected"):
        layers.ingest(spark, lit.SOURCES["uf"], states, layout, ingestion_id="bad", at=AT.replace(hour=13))
    assert [m.partition["_ingestion_id"] for m in markers(spark, path)] == ["good"]
    assert tb.read_latest_snapshot(spark, path).count() == 3
    assert folder_names(spark, f"{path}/ingestion_date=2026-07-13/_ingestion_id=bad") == []


def test_an_ingest_whose_load_differs_is_never_seen(spark, layout):
    with pytest.raises(LoadError, match="bronze load"):
        layers.ingest(spark, lit.SOURCES["uf"], states, layout, lambda df, name: df.count() - 1, at=AT)
    assert markers(spark, layout.bronze("uf")) == []


def bad_and_good(spark):
    return spark.createDataFrame(
        [("11", "RO", "Rondônia"), ("12", "AC", "Acre"), ("xx", "ZZ", "none")], "codigo_uf string, sigla_uf string, nome string"
    )


@pytest.mark.parametrize("way", ["split", "load"])
def test_a_refused_silver_run_is_never_seen(spark, layout, monkeypatch, way):
    spec = lit.SPECS["uf"]()
    layers.build_silver(bad_and_good(spark), spec, layout, "first", AT)
    loader = None
    if way == "split":
        monkeypatch.setattr(Q, "split", lambda marked, s: (marked.limit(1), marked.limit(1)))
    else:
        loader = lambda df, name: df.count() + 1
    with pytest.raises(LoadError):
        layers.build_silver(bad_and_good(spark), spec, layout, "second", AT.replace(hour=15), loader)
    for path in (layout.silver("uf"), layout.quarantine("uf")):
        assert tb.partition_values(spark, path, "_quality_run_id") == ["first"]
    assert layers.read_silver(spark, layout, "uf").count() == 2


@pytest.mark.parametrize("made", [0, 1, 2])
def test_silver_and_quarantine_are_seen_together(spark, layout, monkeypatch, made):
    """The driver is killed before, between and after the markers of the two; only the commit counts."""
    create, files = pub.create_file, []

    def failing(spark, path, **more):
        if len(files) == made:
            raise RuntimeError("killed")
        files.append(path)
        create(spark, path, **more)

    with monkeypatch.context() as patch:
        patch.setattr(pub, "create_file", failing)
        patch.setattr(Publication, "drop", lambda self: None)
        with pytest.raises(RuntimeError, match="killed"):
            layers.build_silver(bad_and_good(spark), lit.SPECS["uf"](), layout, "run", AT)
    assert layers.read_silver(spark, layout, "uf") is None and markers(spark, layout.quarantine("uf")) == []
    result = layers.build_silver(bad_and_good(spark), lit.SPECS["uf"](), layout, "run", AT)
    assert (result.valid_count, result.invalid_count) == (2, 1)
    assert layers.read_silver(spark, layout, "uf").count() == 2 and tb.read_history(spark, layout.quarantine("uf")).count() == 1
    commit = markers(spark, layout.silver("uf"))[0].info["_commit"]
    assert markers(spark, layout.quarantine("uf"))[0].info["_commit"] == commit
    assert pub.sweep(spark, layout.silver("uf"), 0) == 1 and pub.sweep(spark, layout.quarantine("uf"), 0) == 1
    tables = [layout.silver("uf"), layout.quarantine("uf")]
    assert pub.sweep_commits(spark, layout.base, tables) == 0 and layers.read_silver(spark, layout, "uf").count() == 2


def test_a_repeated_silver_run_without_rejects_takes_the_old_ones_back(spark, layout):
    spec = lit.SPECS["uf"]()
    layers.build_silver(bad_and_good(spark), spec, layout, "run", AT)
    layers.build_silver(bad_and_good(spark).where("sigla_uf <> 'ZZ'"), spec, layout, "run", AT)
    assert markers(spark, layout.quarantine("uf")) == [] and layers.read_silver(spark, layout, "uf").count() == 2


# ---- a partition is replaced by a swap


def product(spark, n):
    return spark.range(n).withColumn("n", F.lit(n))


def test_a_failed_second_write_leaves_the_first(spark, layout):
    layers.write_gold(product(spark, 3), layout, "p", "2024-01-01")
    broken = product(spark, 5).withColumn("n", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        layers.write_gold(broken, layout, "p", "2024-01-01")
    with pytest.raises(LoadError, match="gold load"):
        layers.write_gold(product(spark, 5), layout, "p", "2024-01-01", lambda df, name: 4)
    assert tb.read_latest_snapshot(spark, layout.gold("p")).count() == 3
    assert layers.write_gold(product(spark, 0), layout, "p", "2024-01-01") is None
    assert tb.read_latest_snapshot(spark, layout.gold("p")).count() == 3


def test_old_readers_keep_their_files(spark, layout):
    layers.write_gold(product(spark, 3), layout, "p", "2024-01-01")
    old = tb.read_latest_snapshot(spark, layout.gold("p"))
    layers.write_gold(product(spark, 5), layout, "p", "2024-01-01")
    assert old.count() == 3 and tb.read_latest_snapshot(spark, layout.gold("p")).count() == 5
    layers.write_gold(product(spark, 7), layout, "p", "2024-01-01")
    folder = f"{layout.gold('p')}/processing_date=2024-01-01"
    assert len([n for n in folder_names(spark, folder) if n.startswith("_copy=")]) == 2
    assert tb.read_history(spark, layout.gold("p")).count() == 7
    assert pub.sweep(spark, layout.gold("p"), 3600) == 0 and pub.sweep(spark, layout.gold("p"), 0) == 1
    assert tb.read_history(spark, layout.gold("p")).count() == 7


def test_the_newest_copy_counts_whatever_the_clock_says(spark, layout, monkeypatch):
    path = f"{layout.base}/t"
    tb.write_partition(product(spark, 1), path, day="1")
    monkeypatch.setattr(pub.time, "time_ns", lambda: 5)
    tb.write_partition(product(spark, 2), path, day="1")
    assert tb.read_history(spark, path).count() == 2


def test_tables_without_a_common_folder_are_refused(spark):
    with pytest.raises(ValueError, match="below one folder"):
        pub._common(["s3a://one/a", "s3a://two/b"])
    assert pub._common(["s3a://one/a/x", "s3a://one/a/y/z"]) == "s3a://one/a"


def test_an_empty_table_is_a_table(spark, layout):
    path = f"{layout.base}/t"
    assert tb.full_refresh(product(spark, 2), path) == 2 and tb.full_refresh(product(spark, 0), path) == 0
    assert tb.read_table(spark, path).count() == 0


# ---- history over changed types

B, I, L, D, S = T.ByteType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        (I, L, L),
        (B, I, I),
        (I, D, D),
        (T.FloatType(), I, D),
        (I, S, S),
        (T.BooleanType(), I, S),
        (T.DecimalType(10, 2), I, T.DecimalType(12, 2)),
        (T.DecimalType(10, 2), T.DecimalType(5, 4), T.DecimalType(12, 4)),
        (T.DecimalType(38, 0), T.DecimalType(38, 10), D),
        (T.DecimalType(10, 2), D, D),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.DateType(), S, S),
        (T.ArrayType(I), T.ArrayType(S), T.ArrayType(S)),
        (T.MapType(S, I), T.MapType(S, L), T.MapType(S, L)),
        (T.StructType().add("a", I), T.ArrayType(I), S),
        (T.NullType(), I, I),
    ],
)
def test_widest_type(a, b, both):
    assert widest(a, b) == both and widest(b, a) == both


def test_merged_schemas_match_names_without_case():
    one = T.StructType().add("Id", I).add("s", T.StructType().add("x", I))
    two = T.StructType().add("id", S).add("s", T.StructType().add("y", D)).add("z", D)
    got = merged([one, two])
    assert [f.name for f in got] == ["Id", "s", "z"] and got["Id"].dataType == S
    assert [f.name for f in got["s"].dataType] == ["x", "y"]


def test_history_over_changed_types(spark, layout):
    path = f"{layout.base}/t"
    tb.write_partition(spark.sql("SELECT 1 AS id, 10 AS n, named_struct('x', 1) AS s, array(1) AS a, date'2024-01-02' AS d"), path, run="1")
    tb.write_partition(spark.sql("SELECT 'two' AS id, 2.5D AS n, named_struct('y', 'q') AS s, array('z') AS a"), path, run="2")
    tb.write_partition(spark.sql("SELECT 3L AS id, timestamp'2024-01-02 03:04:05' AS d, named_struct('x', 7L) AS N"), path, run="3")
    got = {r["run"]: r.asDict(recursive=True) for r in tb.read_history(spark, path).collect()}
    assert [got[k]["id"] for k in "123"] == ["1", "two", "3"]
    assert [got[k]["n"] for k in "123"] == ["10", "2.5", '{"x":7}']
    assert got["1"]["s"] == {"x": 1, "y": None} and got["2"]["s"] == {"x": None, "y": "q"} and got["3"]["s"] is None
    assert got["1"]["a"] == ["1"] and got["2"]["a"] == ["z"]
    assert got["1"]["d"] == datetime(2024, 1, 2) and got["3"]["d"] == datetime(2024, 1, 2, 3, 4, 5)


def test_runs_of_one_schema_are_one_scan(spark, layout):
    path = f"{layout.base}/t"
    for k in range(5):
        tb.write_partition(product(spark, k + 1).withColumn("n", F.col("n").cast("int" if k < 4 else "string")), path, run=str(k))
    assert len(folder_names(spark, f"{path}/{pub.SCHEMAS}")) == 2
    history = tb.read_history(spark, path)
    assert history.count() == 15
    assert history._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


# ---- packing


def batches(spark, path, first, last, per=50):
    for k in range(first, last):
        df = spark.range(per * k, per * k + per).withColumn("v", F.col("id") * 2)
        tb.write_partition(df, path, day="2024-01-01" if k % 2 else "2024-01-02", batch=str(k))


def content(spark, path):
    return sorted(tuple(r) for r in tb.read_history(spark, path).select("id", "v", "day", "batch").collect())


def test_packing_keeps_rows_and_leaves_fewer_files(spark, layout):
    path = f"{layout.base}/t"
    batches(spark, path, 0, 6)
    before = content(spark, path)
    old = tb.read_history(spark, path)
    assert pub.pack(spark, path, ["batch"]) == 6
    assert content(spark, path) == before and len(tb.read_history(spark, path).inputFiles()) == 2
    assert pub.pack(spark, path, ["batch"]) == 0
    batches(spark, path, 6, 8)
    assert pub.pack(spark, path, ["batch"]) == 4
    assert len(content(spark, path)) == 400 and len(markers(spark, path)) == 2
    assert old.count() == 300  # a reader that had begun
    assert pub.sweep(spark, path, 3600) == 0 and pub.sweep(spark, path, 0) == 10
    assert len(content(spark, path)) == 400 and len(markers(spark, path)) == 2


def test_packing_fills_files_to_the_target(spark, layout):
    path = f"{layout.base}/t"
    batches(spark, path, 0, 12, per=2000)
    size = max(pub.folder_bytes(spark, m.folder) for m in markers(spark, path))
    assert pub.pack(spark, path, ["batch"], target_bytes=size * 2 + 1000) == 12
    assert len(tb.read_history(spark, path).inputFiles()) == 6 and tb.read_history(spark, path).count() == 24_000
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"


@pytest.mark.parametrize("at", ["write", "swap"])
def test_a_packing_that_crashed_changes_nothing(spark, layout, monkeypatch, at):
    path = f"{layout.base}/t"
    batches(spark, path, 0, 4)
    before = content(spark, path)

    write = pub.write_text

    def lost(spark, path, *rest):
        if at == "write" or f"/{pub.MARKERS}/" in path:
            raise RuntimeError("killed")
        write(spark, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(pub, "write_text" if at == "swap" else "read_copies", lost)
        with pytest.raises(RuntimeError, match="killed"):
            pub.pack(spark, path, ["batch"])
    assert content(spark, path) == before
    assert pub.sweep(spark, path, 0) == (1 if at == "swap" else 0)
    assert pub.pack(spark, path, ["batch"]) == 4 and content(spark, path) == before


def test_a_writer_goes_on_while_batches_are_packed(spark, layout, monkeypatch):
    path = f"{layout.base}/t"
    batches(spark, path, 0, 4)
    read = pub.read_copies

    def meanwhile(*args):
        monkeypatch.setattr(pub, "read_copies", read)
        batches(spark, path, 4, 6)
        return read(*args)

    monkeypatch.setattr(pub, "read_copies", meanwhile)
    assert pub.pack(spark, path, ["batch"]) == 4
    assert len(content(spark, path)) == 300 and len(markers(spark, path)) == 4


def test_one_packer_at_a_time(spark, layout):
    path = f"{layout.base}/t"
    batches(spark, path, 0, 2)
    with pub._claim(spark, path, 3600):
        with pytest.raises(LoadError, match="packed by another"):
            pub.pack(spark, path, ["batch"])
    claim = f"{path}/{pub.MARKERS}/{pub._CLAIM}"
    pub.create_file(spark, claim)  # of one that crashed
    time.sleep(0.1)
    batches(spark, path, 2, 4)
    assert pub.pack(spark, path, ["batch"], stale_seconds=0.01) == 4


def test_packing_over_changed_types(spark, layout):
    path = f"{layout.base}/t"
    tb.write_partition(spark.range(3), path, day="1", batch="a")
    tb.write_partition(spark.sql("SELECT 'x' AS id, 1 AS more"), path, day="1", batch="b")
    assert pub.pack(spark, path, ["batch"]) == 2
    got = {(r["id"], r["more"], r["batch"]) for r in tb.read_history(spark, path).collect()}
    assert got == {("0", None, "a"), ("1", None, "a"), ("2", None, "a"), ("x", 1, "b")}
