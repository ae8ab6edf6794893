"""The operators on sales, event and document tables.

Each function takes a session and the folder of the tables and gives a frame.
Money is summed as decimals, so a sum does not depend on the order of rows.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.folders import folder_bytes
from lavra.functions import numbers as N
from lavra.functions import predicates as P
from lavra.functions.jsontext import flatten_nested
from lavra.functions.text import hash_text, row_hash, strip_text, upper_text
from lavra.functions.times import iso_text, parse_iso, seconds_between
from lavra.operators import integrity as I
from lavra.operators import products as prod
from lavra.operators import quality as Q
from lavra.operators.median import exact_median
from lavra.operators.uniqueness import duplicated_keys, keep_first
from lavra.plans import layers, literacy
from lavra.session import apply_settings, new_folder, stage
from lavra.sources import audit
from lavra.sources import tables as tb
from lavra.sources.bronze import to_bronze, write_bronze
from lavra.sources.bucketed import buckets_for, read_bucketed, write_bucketed
from lavra.sources.contracts import ColumnContract, Source, contract_report
from lavra.sources.events import read_event_file, topic_records
from lavra.sources.extraction import directory_scan, observed_scan, ordered_sample, target_scan
from lavra.sources.published import Publication, pack
from lavra.streaming.events import EventSpec, decode_events, validate_events
from lavra.streaming.ingest import StreamPaths, read_batches, run_session
from lavra.streaming.routing import new_events, route_events
from lavra.streaming.seen import SeenIndex
from lavra.streaming.variants import decode_variant_events, extra_field, extra_names

# Times that stand for two runs, so that no result holds the current time.
FIRST_RUN = datetime(2024, 1, 1, 6, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 1, 2, 6, tzinfo=timezone.utc)
MONEY = "decimal(18,2)"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- scans -----------------------------------------------------------------


def explicit_column_scan(spark, d):
    apply_settings(spark)
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return tb.scan(spark, f"{d}/orders.parquet", columns, ["o_orderkey"], ordered=True)


def customer_directory(spark, d):
    columns = {"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "segment"}
    return directory_scan(table(spark, d, "customer"), "c_custkey", columns, "customer_id")


def nation_directory(spark, d):
    columns = {"n_nationkey": "nation_code", "n_name": "nation", "n_regionkey": "region_key"}
    return directory_scan(table(spark, d, "nation"), "n_nationkey", columns, "nation")


def _wide_targets(df: DataFrame, *keys: str) -> DataFrame:
    """One target column per order status, null where a key has no such order."""
    amount = F.col("o_totalprice").cast(MONEY)
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("o_orderstatus") == s, amount)).cast("double").alias(f"target_{s.lower()}")
            for s in ("F", "O", "P")
        ]
    )


def _dated_orders(spark, d):
    return table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))


def national_target(spark, d):
    return target_scan(_wide_targets(_dated_orders(spark, d), "year"), ["year"], "target_p", "target", True)


def nation_target(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = _dated_orders(spark, d).join(customers, "o_custkey")
    wide = _wide_targets(orders, "year", "c_nationkey")
    return target_scan(wide, ["year", "c_nationkey"], "target_o", "target", True)


def customer_target(spark, d):
    wide = _wide_targets(_dated_orders(spark, d), "year", "o_custkey")
    return target_scan(wide, ["year", "o_custkey"], "target_f", "target", True)


def observed_orders(spark, d):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    condition = F.col("o_orderstatus") == "F"
    return observed_scan(table(spark, d, "orders"), columns, condition, "o_totalprice", ["o_orderkey"])


def ordered_purchase_sample(spark, d):
    columns = ["event_id", "user_id", "event_type", "value"]
    condition = F.col("event_type") == "purchase"
    return ordered_sample(table(spark, d, "events"), columns, condition, "user_id", ["event_id"], 100)


# --- contracts, bronze, loads ----------------------------------------------

ORDERS = Source(
    "orders",
    "shop.sales.orders",
    (
        ColumnContract("o_orderkey", "INTEGER", False),
        ColumnContract("o_custkey", "INTEGER", False),
        ColumnContract("o_orderstatus", "STRING", False),
        ColumnContract("o_totalprice", "FLOAT", True),
        ColumnContract("o_channel", "STRING", True),
    ),
    ("o_orderkey",),
)
CUSTOMERS = Source(
    "customer",
    "shop.sales.customer",
    tuple(ColumnContract(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    ("c_custkey",),
    "1.0",
)


def contract_check(spark, d):
    return contract_report(table(spark, d, "orders"), ORDERS)


def _two_runs(spark, d) -> str:
    """Customers ingested twice, the first time without the segment."""
    customers = table(spark, d, "customer")
    path = new_folder(spark, "bronze")
    short = Source("customer", CUSTOMERS.table_id, CUSTOMERS.columns[:4], ("c_custkey",), "0.9")
    first = to_bronze(customers.drop("c_mktsegment"), short, "run-a", FIRST_RUN)
    write_bronze(first, path, "run-a", FIRST_RUN)
    write_bronze(to_bronze(customers, CUSTOMERS, "run-b", SECOND_RUN), path, "run-b", SECOND_RUN)
    return path


def latest_snapshot(spark, d):
    return tb.read_latest_snapshot(spark, _two_runs(spark, d)).drop("ingestion_date")


def bronze_history(spark, d):
    return (
        tb.read_history(spark, _two_runs(spark, d))
        .groupBy("_ingestion_id", "_schema_version", "_load_type")
        .agg(F.count("*").alias("row_count"), F.count("c_mktsegment").alias("with_segment"))
    )


def history_over_types(spark, d):
    """Orders in three runs: keys as numbers, as text, and again as numbers with decimal prices and a status."""
    path = new_folder(spark, "changing")
    orders = table(spark, d, "orders").withColumn("part", F.pmod(F.col("o_custkey"), F.lit(3)))
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    runs = [
        (key.cast("int"), price.cast("double"), []),
        (F.concat(F.lit("k"), key.cast("string")), F.round(price).cast("int"), []),
        (key.cast("bigint"), price.cast("double"), [F.col("o_orderstatus")]),
    ]
    for n, (id_, amount, more) in enumerate(runs):
        tb.write_partition(orders.where(F.col("part") == n).select(id_.alias("id"), amount.alias("amount"), *more), path, run=str(n))
    return tb.read_history(spark, path).select("id", "amount", "o_orderstatus", "run")


def packed_batches(spark, d):
    """Orders in a batch per month of the year, packed into few files and read back by batch."""
    path = new_folder(spark, "batches")
    orders = _dated_orders(spark, d).withColumn("month", F.month("o_orderdate"))
    for month in range(1, 13):
        rows = orders.where(F.col("month") == month).select("o_orderkey", "o_custkey", "year")
        tb.write_partition(rows, path, half="first" if month < 7 else "second", batch=str(month))
    pack(spark, path, ["batch"])
    return tb.read_history(spark, path).groupBy("half", "batch").agg(
        F.count("*").alias("order_count"), F.sum("o_custkey").cast("bigint").alias("customer_sum")
    )


def full_refresh_load(spark, d):
    parts, path = table(spark, d, "part"), new_folder(spark, "part")
    tb.full_refresh(parts, path)
    tb.require_equal("second load of part", parts.count(), tb.full_refresh(parts, path))
    return tb.read_table(spark, path).groupBy("p_brand").agg(
        F.count("*").alias("row_count"), F.min("p_retailprice").alias("cheapest")
    )


def fixed_schema_load(spark, d):
    path = new_folder(spark, "supplier")
    fields = [("s_suppkey", T.StringType(), False), ("s_name", T.StringType(), True), ("s_nationkey", T.LongType(), True)]
    tb.load_fixed_schema(table(spark, d, "supplier"), path, T.StructType([T.StructField(*f) for f in fields]))
    return tb.read_table(spark, path)


# --- quality ---------------------------------------------------------------


def customer_spec() -> Q.QualitySpec:
    return Q.QualitySpec(
        entity="customer",
        required=["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
        rules=[
            Q.Rule("c_name.not_null", P.not_null(F.col("c_name")), "c_name"),
            Q.Rule("c_name.pattern", P.matches_regex(F.col("c_name"), r"CUSTOMER#\d{9}"), "c_name"),
            Q.Rule("c_acctbal.in_range", P.numeric_between(F.col("c_acctbal"), 0, 9000), "c_acctbal"),
            Q.Rule(
                "c_mktsegment.known",
                P.in_set(F.col("c_mktsegment"), ["AUTOMOBILE", "BUILDING", "MACHINERY"]),
                "c_mktsegment",
            ),
        ],
        unique_keys=["c_custkey"],
        standardizers={"c_name": upper_text, "c_mktsegment": strip_text},
    )


LINE_ORDER = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
LINE_KEYS = ("l_orderkey", "l_linenumber")


def lineitem_spec() -> Q.QualitySpec:
    return Q.QualitySpec(
        entity="lineitem",
        required=["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"],
        rules=[
            Q.Rule("l_quantity.in_range", P.numeric_between(F.col("l_quantity"), 1, 45), "l_quantity"),
            Q.Rule("l_returnflag.known", P.in_set(F.col("l_returnflag"), ["A", "N"]), "l_returnflag"),
            Q.Rule("l_shipdate.valid_year", P.year_valid(F.year("l_shipdate"), 1990, 2000), "l_shipdate"),
        ],
        unique_keys=LINE_KEYS,
        order_by=LINE_ORDER,
    )


def _lines(spark, d) -> DataFrame:
    return tb.with_positions(table(spark, d, "lineitem"))


def customer_valid_rows(spark, d):
    return Q.run_quality(tb.with_positions(table(spark, d, "customer")), customer_spec()).valid


def _reasons(df: DataFrame) -> DataFrame:
    return df.withColumn(Q.FAILED, F.array_join(Q.FAILED, ","))


def customer_quarantine(spark, d):
    return _reasons(Q.run_quality(tb.with_positions(table(spark, d, "customer")), customer_spec()).invalid)


def lineitem_valid_rows(spark, d):
    return Q.run_quality(_lines(spark, d), lineitem_spec()).valid


def lineitem_quarantine(spark, d):
    return _reasons(Q.run_quality(_lines(spark, d), lineitem_spec()).invalid)


def _report_columns(report: DataFrame) -> DataFrame:
    rule = F.explode("rule_results").alias("r")
    columns = ["entity", "status", "total_read", "valid_count", "invalid_count"]
    return report.select(
        *columns, F.coalesce(F.size("failures_by_rule"), F.lit(0)).alias("failing_rules"), rule
    ).select(*columns, "failing_rules", "r.rule", "r.column", "r.severity", "r.failed_count", "r.message")


def quality_report(spark, d):
    reports = [
        Q.run_quality(tb.with_positions(table(spark, d, "customer")), customer_spec()).report,
        Q.run_quality(_lines(spark, d), lineitem_spec()).report,
    ]
    return _report_columns(reduce(DataFrame.unionByName, reports))


def failures_by_rule(spark, d):
    return Q.rule_counts(Q.run_quality(_lines(spark, d), lineitem_spec()).invalid)


def first_line_per_key(spark, d):
    return keep_first(_lines(spark, d), LINE_KEYS, LINE_ORDER)


def duplicated_line_keys(spark, d):
    return duplicated_keys(table(spark, d, "lineitem"), LINE_KEYS)


def row_predicates(spark, d):
    """How many values satisfy each predicate, over whole columns."""
    c, v = F.col("column_name"), F.col("text")
    orders = table(spark, d, "orders").select(
        F.explode(
            F.array(
                F.struct(F.lit("priority").alias("column_name"), F.col("o_orderpriority").alias("text")),
                F.struct(F.lit("rank").alias("column_name"), F.substring_index("o_orderpriority", "-", 1).alias("text")),
                F.struct(F.lit("year").alias("column_name"), F.year("o_orderdate").cast("string").alias("text")),
                F.struct(F.lit("status").alias("column_name"), F.nullif("o_orderstatus", F.lit("P")).alias("text")),
            )
        ).alias("cell")
    ).select("cell.*")
    return orders.groupBy(c).agg(
        F.count("*").alias("row_count"),
        F.count_if(P.not_null(v)).alias("filled"),
        F.count_if(P.matches_regex(v, r"\d-[A-Z ]+")).alias("matching"),
        F.count_if(P.in_set(v, ["F", "1", "1999"])).alias("in_list"),
        F.count_if(P.numeric_between(v, 2, 1998)).alias("in_range"),
        F.count_if(P.is_numeric(v)).alias("numeric"),
        F.count_if(P.year_valid(v)).alias("plausible_years"),
    )


# --- integrity -------------------------------------------------------------


def _late_orders(spark, d):
    late = table(spark, d, "orders").where(F.year("o_orderdate") > 2000)
    return late.select(F.col("o_custkey").alias("c_custkey"))


def customers_without_late_order(spark, d):
    return I.anti_join(table(spark, d, "customer"), _late_orders(spark, d), ["c_custkey"])


def labelled_documents_pct(spark, d):
    return I.match_percentage(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


def _years(spark, d):
    shipped = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"))
    ordered = _dated_orders(spark, d).where("year < 2000").select("year")
    return shipped, ordered


def incompatible_years(spark, d):
    return I.incompatible_periods(*_years(spark, d), "year")


def integrity_report(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    shipped, ordered = _years(spark, d)
    report = I.integrity_report(
        [
            I.IntegrityCheck(
                "customers_without_late_order", "orphans", table(spark, d, "customer"), _late_orders(spark, d), ["c_custkey"]
            ),
            I.IntegrityCheck("orders_with_customer", "match", orders, table(spark, d, "customer"), ["c_custkey"]),
            I.IntegrityCheck("labelled_documents", "match", table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"]),
            I.IntegrityCheck("repeated_line_keys", "duplicates", table(spark, d, "lineitem"), keys=LINE_KEYS),
            I.IntegrityCheck("years_without_orders", "periods", shipped, ordered, ["year"]),
            I.IntegrityCheck("lines_without_plan", "orphans", table(spark, d, "lineitem"), None, ["l_orderkey"]),
        ]
    )
    return report.withColumn("periods", F.array_join("periods", ","))


# --- products --------------------------------------------------------------


def spend_per_year(spark, d) -> DataFrame:
    """The measure: what a customer spent in a year. (customer, year) is its key.

    It is far smaller than the orders and feeds several products, so it is
    staged and the orders are read once.
    """
    return stage(
        _dated_orders(spark, d)
        .groupBy(F.col("o_custkey").alias("c_custkey"), "year")
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("amount"))
        .select("c_custkey", "year", F.col("amount").cast("double").alias("spend")),
        "spend",
    )


def _mean_spend() -> Column:
    return (F.sum(F.col("spend").cast(MONEY)).cast("double") / F.count("*")).alias("target_spend")


def _nation_means(spark, d, spend: DataFrame) -> DataFrame:
    """Mean spend of a nation's customers, as the target of the year after."""
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (
        spend.join(customers, "c_custkey")
        .groupBy("c_nationkey", (F.col("year") + 1).alias("year"))
        .agg(_mean_spend())
    )


def _named_nation_means(spark, d, spend: DataFrame) -> DataFrame:
    names = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    return _nation_means(spark, d, spend).join(names, "c_nationkey")


def _customers_with_nation(spark, d) -> DataFrame:
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, d, "customer").join(nations, "c_nationkey", "left")


def _regions(spark, d) -> DataFrame:
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        table(spark, d, "nation")
        .join(names, "n_regionkey")
        .select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    )


def _comparison(spark, d, spend: DataFrame) -> DataFrame:
    """No key is null here, so joins are plain equalities."""
    return prod.target_comparison(
        spend,
        _named_nation_means(spark, d, spend),
        _customers_with_nation(spark, d),
        entity="c_custkey",
        period="year",
        value="spend",
        target_value="target_spend",
        target_keys=["year", "nation"],
        dim_columns={"c_name": "customer", "n_name": "nation"},
        region=_regions(spark, d),
        region_key="nation",
        as_of=F.lit("2002-01-01"),
        null_safe=False,
    )


def target_comparison(spark, d):
    return _comparison(spark, d, spend_per_year(spark, d))


def comparison_without_targets(spark, d):
    """The same without targets, and with joins that also match nulls."""
    return prod.target_comparison(
        spend_per_year(spark, d),
        None,
        _customers_with_nation(spark, d),
        entity="c_custkey",
        period="year",
        value="spend",
        target_value="target_spend",
        dim_columns={"n_name": "nation"},
        as_of=F.lit("2002-01-01"),
    )


def multi_level_targets(spark, d):
    spend = spend_per_year(spark, d)
    overall = spend.groupBy((F.col("year") + 1).alias("year")).agg(_mean_spend())
    return prod.multi_level_targets(
        _comparison(spark, d, spend),
        [
            prod.TargetLevel("nation", _named_nation_means(spark, d, spend), ["year", "nation"], "target_spend"),
            prod.TargetLevel("overall", overall, ["year"], "target_spend"),
            prod.TargetLevel("planned", None, ["year"], "target_spend"),
        ],
        period="year",
        value="spend",
        null_safe=False,
    )


def _evolution(spend: DataFrame) -> DataFrame:
    return prod.time_evolution(
        spend, entity="c_custkey", period="year", value="spend", kind="customer", unique_periods=True
    )


def time_evolution(spark, d):
    return _evolution(spend_per_year(spark, d))


def evolution_of_part_values(spark, d):
    """Quantity per part and year, where the operator is told of no key."""
    per_year = (
        table(spark, d, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("year"))
        .agg(F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("quantity"))
    )
    named = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return prod.time_evolution(
        per_year.join(named, "l_partkey"),
        entity="l_partkey",
        period="year",
        value="quantity",
        kind="part",
        name_col="p_name",
    )


def group_summary(spark, d):
    """Per nation. The comparison is written once, since the summary reads it more than once."""
    spend = spend_per_year(spark, d)
    compared = stage(_comparison(spark, d, spend).select("nation", "spend", "status"), "compared")
    targets = _named_nation_means(spark, d, spend)
    summary = prod.group_summary(
        compared, "nation", value="spend", group_target=targets, target_value="target_spend"
    )
    rounded = {c: F.round(c, 4) for c in ("group_target", "gap_mean_to_target")}
    return summary.withColumns(rounded)


def price_medians(spark, d):
    """Exact medians over all lines, with very large groups."""
    return exact_median(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")


def feature_table(spark, d):
    spend = spend_per_year(spark, d)
    return prod.feature_table(
        _comparison(spark, d, spend),
        _evolution(spend),
        entity="c_custkey",
        period="year",
        value="spend",
        columns=["year", "c_custkey", "nation", "region", "spend", "target", "target_gap"],
        null_safe=False,
    )


def mean_by_nation(spark, d):
    return prod.group_means(target_comparison(spark, d), "nation", "spend")


def status_counts(spark, d):
    return prod.status_counts(target_comparison(spark, d))


def top_nations(spark, d):
    return prod.top_groups(target_comparison(spark, d), "nation", "spend")


def written_product(spark, d):
    """The comparison written as a gold table twice on one day, and read back."""
    layout = layers.Layout(new_folder(spark, "lake"))
    product = target_comparison(spark, d).select("year", "c_custkey", "spend", "target", "status")
    layers.write_gold(product, layout, "comparison", "2024-01-01")
    return layers.write_gold(product, layout, "comparison", "2024-01-01")


# --- functions -------------------------------------------------------------


def normalised_documents(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", strip_text(F.col("text")).alias("stripped"), upper_text(F.col("text")).alias("upper_text")
    )


def record_hashes(spark, d):
    events = table(spark, d, "events")
    return events.select(
        "event_id",
        hash_text(F.col("user_id")).alias("user_hash"),
        row_hash(events, ["event_id", "user_id", "event_type", "value"]).alias("record_hash"),
    )


def safe_ratios(spark, d):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.safe_ratio(price, discount).alias("ratio"),
        N.attainment(F.col("l_quantity"), discount).alias("attainment_pct"),
        N.target_status(F.col("l_quantity"), N.safe_ratio(F.lit(1.0), discount)).alias("status"),
        N.reached_label(F.col("l_quantity"), N.safe_ratio(F.lit(1.0), discount)).alias("reached"),
    )


def coerced_numbers(spark, d):
    text = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey",
        N.to_number(F.substring_index(text, "-", 1)).alias("priority_rank"),
        N.to_number(text).alias("bad_number"),
        N.to_year(F.date_format("o_orderdate", "yyyy")).alias("order_year"),
    )


def iso_times(spark, d):
    written = iso_text(F.col("ts").cast("timestamp"))
    end = F.lit("2024-02-01T00:00:00Z")
    return table(spark, d, "events").select(
        "event_id",
        written.alias("written"),
        F.date_format(parse_iso(written), "yyyy-MM-dd").alias("day"),
        seconds_between(parse_iso(written), parse_iso(end)).alias("latency_s"),
    )


def decoded_properties(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("props").alias("value"))
    decoded = decode_events(events, ["k"], keep=["event_id"])
    return decoded.select("event_id", F.col("k").cast("bigint").alias("k"))


def variant_properties(spark, d):
    """Events as text with nested further fields, kept as VARIANT in a table and asked there."""
    user = F.struct(F.col("user_id").alias("id"), F.array(F.col("event_type"), F.lit("x")).alias("tags"))
    raw = table(spark, d, "events").select(
        F.to_json(F.struct("event_id", "event_type", user.alias("user"), F.from_json("props", "k bigint").alias("props"))).alias("value")
    )
    kept = stage(decode_variant_events(raw, {"event_id": "bigint", "event_type": "string"}), "variants")
    return kept.select(
        "event_id",
        "event_type",
        extra_field("$.user.id", "bigint").alias("user_id"),
        extra_field("$.user.tags[0]", "string").alias("tag"),
        extra_field("$.props.k", "bigint").alias("k"),
        F.array_join(extra_names(), ",").alias("further"),
        F.col("_bad_json").alias("bad_json"),
    )


def flattened_rows(spark, d):
    events = table(spark, d, "events").select(
        "event_id",
        F.struct("event_type", "user_id").alias("who"),
        F.array("event_type", F.lit("x")).alias("tags"),
        "value",
    )
    return flatten_nested(events)


# Bytes of packed lines in a bucket: one task sorts it, and a line takes some 20 times as much there.
LINE_BUCKET_BYTES = 16 << 20


def bucketed_order_lines(spark, d):
    """Orders and lines kept in buckets of the order, joined and grouped where they lie."""
    count = buckets_for(folder_bytes(spark, f"{d}/lineitem.parquet"), LINE_BUCKET_BYTES)
    kept = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"]}
    paths = {name: new_folder(spark, name) for name in kept}
    for name, keys in kept.items():
        write_bucketed(table(spark, d, name), paths[name], keys, count)
    orders, lines = (read_bucketed(spark, paths[name]) for name in kept)
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderkey", "o_custkey")
        .agg(F.count("*").alias("n_lines"), F.max("l_extendedprice").alias("top_price"))
    )


def event_files(spark, d):
    """All events written as JSON lines and as arrays to one folder, and read back."""
    folder = new_folder(spark, "event-files")
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    even = F.coalesce(F.col("event_id") % 2 == 0, F.lit(True))
    events.where(even).write.json(f"{folder}/lines")
    arrays = max(1, events.count() // 5000)  # some thousand events each
    bundles = events.where(~even).groupBy(F.pmod(F.xxhash64("event_id"), F.lit(arrays)).alias("b")).agg(
        F.to_json(F.collect_list(F.struct("event_id", "user_id", "event_type", "value"))).alias("value")
    )
    # a file holds one array on one line, as producers write them
    bundles.select("value", F.col("b").alias("bundle")).write.partitionBy("bundle").text(f"{folder}/arrays")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return read_event_file(spark, folder, schema)


def topic_messages(spark, d):
    return topic_records(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"))


# --- events ----------------------------------------------------------------


def _line_checks() -> list[tuple[Column, Column]]:
    return [
        (F.lit("quantity out of range"), P.numeric_between(F.col("quantity"), 1, 45)),
        (F.concat(F.lit("unknown flag: "), F.col("flag")), P.in_set(F.col("flag"), ["A", "N"])),
        (F.lit("bad time"), parse_iso(F.col("event_time")).isNotNull()),
    ]


LINE_EVENTS = EventSpec(("event_id", "event_time", "flag"), _line_checks)
# Orders the events of one id; the columns together are the whole event.
EVENT_ORDER = ("event_time", "quantity", "flag", "price")


def _line_events(lines: DataFrame) -> DataFrame:
    """Lines as events. Order and line number repeat, so ids do too."""
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").alias("price"),
    )


def routed_events(spark, d):
    events = stage(validate_events(_line_events(table(spark, d, "lineitem")), LINE_EVENTS), "events")
    routed = route_events(tb.with_positions(events), LINE_EVENTS, order_by=EVENT_ORDER)
    return routed.withColumn("errors", F.array_join("errors", "; "))


def routed_against_seen(spark, d):
    """Two batches, events before 1998 and from then on; the first one's valid ids are known to the second."""
    events = stage(validate_events(_line_events(table(spark, d, "lineitem")), LINE_EVENTS), "events")
    events = tb.with_positions(events)
    early = F.coalesce(F.col("event_time") < "1998", F.lit(True))
    first = route_events(events.where(early), LINE_EVENTS, order_by=EVENT_ORDER)
    known = events.where(early & (F.size("errors") == 0)).select("event_id")
    second = route_events(events.where(~early), LINE_EVENTS, known, EVENT_ORDER)
    both = [df.select(F.lit(name).alias("batch"), "route") for name, df in (("first", first), ("second", second))]
    return both[0].unionByName(both[1]).groupBy("batch", "route").agg(F.count("*").alias("event_count"))


def known_ids(spark, d):
    """Orders with a line from 1998 on whose key is in an index of earlier lines, added in two generations."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), "l_shipdate", "l_orderkey")
    index = SeenIndex(spark, new_folder(spark, "seen"))
    early = lines.where("l_shipdate < '1998-01-01'")
    for part in (1, 2):
        with Publication(spark) as run:
            index.add(run, early.where(F.pmod(F.col("l_orderkey"), F.lit(3)) == part).select("id").distinct(), str(part))
    return index.known(lines.where("l_shipdate >= '1998-01-01'").select("id").distinct())


def new_documents(spark, d):
    """The first of all documents with the same text, where the labelled ones are known."""
    documents = table(spark, d, "documents").withColumn("fingerprint", hash_text(strip_text(F.col("text"))))
    documents = stage(documents.select("doc_id", "lang", "source", "fingerprint"), "documents")
    labels = table(spark, d, "labels").select("doc_id").distinct()
    known = documents.join(labels, "doc_id", "left_semi").select("fingerprint")
    return new_events(tb.with_positions(documents), "fingerprint", known, ["doc_id"])


def _run_stream(spark, d) -> tuple[StreamPaths, DataFrame]:
    base = new_folder(spark, "stream")
    paths = StreamPaths.under(base, "lines")
    schema = table(spark, d, "lineitem").schema
    # A pattern, because the table may be one file or a folder of them.
    stream = _line_events(spark.readStream.schema(schema).parquet(f"{d}/lineitem.parque[t]"))
    metrics = run_session(
        stream,
        LINE_EVENTS,
        paths,
        f"{base}/checkpoint",
        f"{base}/audit",
        order_by=EVENT_ORDER,
    )
    return paths, metrics


def streamed_bronze(spark, d):
    paths, _ = _run_stream(spark, d)
    return read_batches(spark, paths.bronze).select("event_id", *EVENT_ORDER, "_load_type")


def stream_session(spark, d):
    _, metrics = _run_stream(spark, d)
    return metrics.select("consumed", "valid", "invalid", "duplicates", "flushed_batches")


def stream_quarantine(spark, d):
    paths, _ = _run_stream(spark, d)
    errors = F.explode("errors").alias("error")
    return read_batches(spark, paths.quarantine).select("route", errors).groupBy("route", "error").agg(
        F.count("*").alias("event_count")
    )


# --- layers and audit ------------------------------------------------------


def layer_counts(spark, d):
    """Lines from bronze to silver with loads; every count is checked on the way."""
    layout = layers.Layout(new_folder(spark, "lake"))
    source = Source(
        "lineitem",
        "shop.sales.lineitem",
        tuple(ColumnContract(c) for c in (*LINE_KEYS, *LINE_ORDER)),
        LINE_KEYS,
    )
    loader = layers.table_loader(f"{layout.base}/tables")
    layers.ingest(spark, source, lambda s, c: table(s, d, c.name), layout, loader, at=FIRST_RUN)
    layers.silver_from_bronze(spark, lineitem_spec(), layout, loader)
    runs = audit.read_audit(spark, layout.audit, "pipeline_runs")
    return runs.select(
        "pipeline_name", "source", "layer", "status", "records_read", "records_written", "records_valid", "records_rejected"
    )


def _literacy_reader(d):
    """The sources of the literacy data set, derived from all customers, nations and orders."""

    def read(spark, source: Source) -> DataFrame:
        orders = _dated_orders(spark, d).withColumn("ano", F.col("year").cast("int"))
        customers = table(spark, d, "customer")
        place = lambda key: F.lpad(F.col(key).cast("string"), 7, "0").alias("id_municipio")
        codes = F.array(*[F.lit(row[0]) for row in literacy.STATES])
        states = F.array(*[F.lit(row[1]) for row in literacy.STATES])
        none = F.lit(None).cast("string")
        if source.name == "municipio":
            # the last nation has no state
            state = F.when(F.col("c_nationkey") < 24, F.lower(F.get(states, "c_nationkey"))).otherwise(F.lit("xx"))
            return customers.select(place("c_custkey"), F.concat(F.lit(" "), "c_name").alias("nome"), state.alias("sigla_uf"))
        if source.name == "uf":
            return table(spark, d, "nation").select(
                F.get(codes, "n_nationkey").alias("codigo_uf"), F.get(states, "n_nationkey").alias("sigla_uf"),
                F.col("n_name").alias("nome"), F.col("n_regionkey").cast("string").alias("regiao"),
            )
        count = F.count("*")
        if source.name == "meta_brasil":
            return orders.groupBy("ano").agg((count % 101).cast("double").alias("valor_meta"))
        if source.name == "meta_uf":
            nations = customers.select(F.col("c_custkey").alias("o_custkey"), F.get(states, "c_nationkey").alias("sigla_uf"))
            return orders.join(nations, "o_custkey").groupBy("ano", "sigla_uf").agg((count % 101).cast("double").alias("valor_meta"))
        if source.name == "aluno":
            return orders.select(
                "ano", place("o_custkey"), F.col("o_orderkey").cast("string").alias("id_aluno"),
                F.col("o_orderstatus").alias("rede"), none.alias("serie"), none.alias("alfabetizado"),
            )
        by_place = orders.groupBy("ano", place("o_custkey"))
        if source.name == "meta_municipio":
            return by_place.agg((count * 30 % 130).cast("double").alias("valor_meta"))
        cents = F.sum(F.col("o_totalprice").cast(MONEY) * 100).cast("bigint")
        return by_place.agg((cents % 105).cast("double").alias("taxa_alfabetizacao")).select(
            "ano", "id_municipio", none.alias("serie"), none.alias("rede"), "taxa_alfabetizacao"
        )

    return lambda spark, source: read(spark, source).select(*source.selected)


def literacy_run(spark, d):
    """The literacy flow from its seven sources to gold: counts of every step, and results by status."""
    layout = layers.Layout(new_folder(spark, "literacy"))
    layers.run_all(spark, literacy.SOURCES, literacy.SPECS, _literacy_reader(d), layout, literacy.build_gold)
    counts = ("records_read", "records_written", "records_valid", "records_rejected")
    runs = audit.read_synced(spark, layout.audit_tables, "pipeline_runs").select(
        F.col("pipeline_name").alias("name"), "status", *counts
    )
    results = tb.read_latest_snapshot(spark, layout.gold("indicador_municipio_ano")).groupBy(
        F.lit("indicador_municipio_ano").alias("name"), F.col("status_meta").alias("status")
    ).agg(F.count("*").alias("records_written"))
    return runs.unionByName(results, allowMissingColumns=True)


def silver_and_quarantine(spark, d):
    """What the silver step wrote: rows per layer, status and first reason."""
    layout = layers.Layout(new_folder(spark, "lake"))
    layers.build_silver(_lines(spark, d), lineitem_spec(), layout, "run-1", FIRST_RUN)
    good = layers.read_silver(spark, layout, "lineitem").withColumn("reason", F.lit("none"))
    bad = tb.read_history(spark, layout.quarantine("lineitem")).withColumn("reason", F.array_join(Q.FAILED, ","))
    columns = ["_quality_status", "reason"]
    return good.select(*columns).unionByName(bad.select(*columns)).groupBy(*columns).agg(
        F.count("*").alias("row_count")
    )


def _write_logs(spark, d, path: str | None = None) -> str:
    """Audit logs derived from the tables: a run per order priority, two quality runs, a stream session per day."""
    path = path or new_folder(spark, "audit")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    when = iso_text(F.max("o_orderdate").cast("timestamp"))
    runs = (
        _dated_orders(spark, d)
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("records_read"), when.alias("end_time"), F.max("o_orderkey").alias("last_key"))
        .select(
            F.concat(F.lit("batch_"), "o_orderpriority").alias("pipeline_name"),
            F.col("o_orderpriority").alias("source"),
            F.lit("bronze").alias("layer"),
            F.lit("SUCCESS").alias("status"),
            "records_read",
            F.col("records_read").alias("records_written"),
            zero.alias("records_valid"),
            zero.alias("records_rejected"),
            zero.alias("bytes_processed"),
            none.alias("error_type"),
            none.alias("error_message"),
            F.col("o_orderpriority").alias("pipeline_run_id"),
            F.col("end_time").alias("start_time"),
            "end_time",
            F.lit(0.0).alias("duration_seconds"),
        )
    )
    quality = Q.run_quality(_lines(spark, d), lineitem_spec(), "q-1").report.unionByName(
        Q.run_quality(tb.with_positions(table(spark, d, "customer")), customer_spec(), "q-2").report
    )
    streams = (
        table(spark, d, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.count("*").alias("consumed"),
            F.count_if(F.col("value") <= 200).alias("valid"),
            (F.count("*") - F.count_distinct("user_id")).alias("duplicates"),
            F.floor(F.avg(F.second("ts"))).cast("double").alias("avg_latency_seconds"),
        )
        .select(
            "consumed",
            "valid",
            (F.col("consumed") - F.col("valid")).alias("invalid"),
            "duplicates",
            F.lit(1).cast("bigint").alias("flushed_batches"),
            "avg_latency_seconds",
            F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00+00:00")).alias("timestamp"),
        )
    )
    audit.append_audit(runs, path, "pipeline_runs")
    audit.append_audit(quality, path, "quality_results")
    audit.append_audit(streams, path, "streaming_metrics")
    return path


def monitoring_report(spark, d):
    path = _write_logs(spark, d)
    logs = [audit.read_audit(spark, path, log) for log in ("pipeline_runs", "quality_results", "streaming_metrics")]
    return audit.monitoring_report(*logs).select(
        "total_pipeline_runs",
        F.array_join("entities", ",").alias("entities"),
        "valid_rows",
        "rejected_rows",
        "rejection_pct",
        "stream_sessions",
        F.col("last_stream.consumed").alias("last_consumed"),
        F.col("last_stream.timestamp").alias("last_stream_time"),
        F.col("last_run.end_time").alias("last_run_time"),
        "stream_latency_seconds",
        "stream_duplicates",
    )


def synced_monitoring(spark, d):
    """The report from running totals, after one sync of the logs and another one of the same lines again."""
    path, target = _write_logs(spark, d), new_folder(spark, "audit-tables")
    audit.sync_audit(spark, path, target)
    _write_logs(spark, d, path)
    audit.sync_audit(spark, path, target)
    return audit.synced_report(spark, target).select(
        "total_pipeline_runs",
        F.array_join("entities", ",").alias("entities"),
        "valid_rows",
        "rejected_rows",
        "rejection_pct",
        "stream_sessions",
        F.col("last_stream.timestamp").alias("last_stream_time"),
    )


def audit_tables(spark, d):
    path, target = _write_logs(spark, d), new_folder(spark, "audit-tables")
    audit.sync_audit(spark, path, target)
    return audit.read_synced(spark, target, "quality_results").select(
        "quality_run_id", "pipeline", "entity", "status", "total_read", "failures_by_rule", "rule_results"
    )


QUERIES = {
    f.__name__: f
    for f in (
        explicit_column_scan,
        customer_directory,
        nation_directory,
        national_target,
        nation_target,
        customer_target,
        observed_orders,
        ordered_purchase_sample,
        contract_check,
        latest_snapshot,
        bronze_history,
        history_over_types,
        packed_batches,
        full_refresh_load,
        fixed_schema_load,
        customer_valid_rows,
        customer_quarantine,
        lineitem_valid_rows,
        lineitem_quarantine,
        quality_report,
        failures_by_rule,
        first_line_per_key,
        duplicated_line_keys,
        row_predicates,
        customers_without_late_order,
        labelled_documents_pct,
        incompatible_years,
        integrity_report,
        target_comparison,
        comparison_without_targets,
        multi_level_targets,
        time_evolution,
        evolution_of_part_values,
        group_summary,
        price_medians,
        feature_table,
        mean_by_nation,
        status_counts,
        top_nations,
        written_product,
        normalised_documents,
        record_hashes,
        safe_ratios,
        coerced_numbers,
        iso_times,
        decoded_properties,
        variant_properties,
        flattened_rows,
        bucketed_order_lines,
        event_files,
        topic_messages,
        routed_events,
        routed_against_seen,
        known_ids,
        new_documents,
        streamed_bronze,
        stream_session,
        stream_quarantine,
        layer_counts,
        literacy_run,
        silver_and_quarantine,
        monitoring_report,
        synced_monitoring,
        audit_tables,
    )
}
