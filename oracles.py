"""The SQL that each query on the driver's tables must agree with."""

from __future__ import annotations

_SPEND = """
spend AS (
  SELECT o_custkey AS c_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM orders GROUP BY 1, 2),
nation_means AS (
  SELECT c_nationkey, year + 1 AS year,
         CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS target_spend
  FROM spend JOIN customer USING (c_custkey) GROUP BY 1, 2)
"""

_COMPARED = f"""
{_SPEND},
cmp AS (
  SELECT s.year, s.c_custkey, c.c_name AS customer, n.n_name AS nation, r.r_name AS region,
         s.spend, m.target_spend AS target, s.spend - m.target_spend AS target_gap,
         round_even(s.spend / NULLIF(m.target_spend, 0) * 100 * 100, 0) / 100 AS attainment_pct,
         CASE WHEN m.target_spend IS NULL THEN 'SEM_META'
              WHEN s.spend IS NULL THEN 'SEM_RESULTADO'
              WHEN s.spend >= m.target_spend THEN 'ATINGIDA' ELSE 'NAO_ATINGIDA' END AS status,
         '2002-01-01' AS updated_on
  FROM spend s
  LEFT JOIN customer c ON s.c_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN nation_means m ON m.c_nationkey = c.c_nationkey AND m.year = s.year)
"""

_EVOLUTION = """
SELECT '{kind}' AS entity_kind, {entity} AS entity_code, {name} AS entity_name, year, {value},
       lag({value}) OVER w AS previous_value,
       {value} - lag({value}) OVER w AS period_change,
       {value} - first_value({value} IGNORE NULLS) OVER (
         PARTITION BY {entity} ORDER BY year
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS cumulative_change
FROM {table}
WINDOW w AS (PARTITION BY {entity} ORDER BY year)
"""

_CUSTOMER_CHECK = """
checked AS (
  SELECT c_custkey, upper(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))) AS c_name, c_nationkey, c_acctbal,
         trim(regexp_replace(c_mktsegment, '\\s+', ' ', 'g')) AS c_mktsegment,
         row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) > 1 AS f5
  FROM customer),
flagged AS (
  SELECT *, c_name IS NULL OR trim(c_name) = '' AS f1,
         NOT coalesce(regexp_full_match(c_name, 'CUSTOMER#[0-9]{9}'), false) AS f2,
         NOT coalesce(c_acctbal BETWEEN 0 AND 9000, false) AS f3,
         NOT coalesce(c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), false) AS f4
  FROM checked)
"""
_CUSTOMER_FAILED = """concat_ws(',',
  CASE WHEN f1 THEN 'c_name.not_null' END, CASE WHEN f2 THEN 'c_name.pattern' END,
  CASE WHEN f3 THEN 'c_acctbal.in_range' END, CASE WHEN f4 THEN 'c_mktsegment.known' END,
  CASE WHEN f5 THEN 'unique.c_custkey' END)"""

_LINE_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_LINE_COLUMNS = f"l_orderkey, l_linenumber, {_LINE_ORDER}"
_LINE_CHECK = f"""
lines AS (
  SELECT *, NOT coalesce(l_quantity BETWEEN 1 AND 45, false) AS g1,
         NOT coalesce(l_returnflag IN ('A', 'N'), false) AS g2,
         NOT coalesce(year(l_shipdate) BETWEEN 1990 AND 2000, false) AS g3,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) > 1 AS g4
  FROM lineitem)
"""
_LINE_FAILED = """concat_ws(',',
  CASE WHEN g1 THEN 'l_quantity.in_range' END, CASE WHEN g2 THEN 'l_returnflag.known' END,
  CASE WHEN g3 THEN 'l_shipdate.valid_year' END, CASE WHEN g4 THEN 'unique.l_orderkey_l_linenumber' END)"""

_RULES = {
    "customer": [
        ("c_name.not_null", "c_name", "f1"),
        ("c_name.pattern", "c_name", "f2"),
        ("c_acctbal.in_range", "c_acctbal", "f3"),
        ("c_mktsegment.known", "c_mktsegment", "f4"),
        ("unique.c_custkey", "c_custkey", "f5"),
    ],
    "lineitem": [
        ("l_quantity.in_range", "l_quantity", "g1"),
        ("l_returnflag.known", "l_returnflag", "g2"),
        ("l_shipdate.valid_year", "l_shipdate", "g3"),
        ("unique.l_orderkey_l_linenumber", "l_orderkey,l_linenumber", "g4"),
    ],
}
_SOURCE = {"customer": "flagged", "lineitem": "lines"}


def _message(rule: str, column: str) -> str:
    if rule.startswith("unique."):
        names = ", ".join(f"''{c}''" for c in column.split(","))
        return f"' registro(s) duplicado(s) em [{names}].'"
    return f"' registro(s) reprovado(s) na regra {rule}.'"


def _totals(entity: str) -> str:
    flags = [flag for _, _, flag in _RULES[entity]]
    bad = " OR ".join(flags)
    counts = ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in flags)
    some = " + ".join(f"CASE WHEN count(*) FILTER ({f}) > 0 THEN 1 ELSE 0 END" for f in flags)
    return (
        f"SELECT '{entity}' AS entity, count(*) AS total_read, count(*) FILTER (NOT ({bad})) AS valid_count,"
        f" count(*) FILTER ({bad}) AS invalid_count, CAST({some} AS INTEGER) AS failing_rules, {counts}"
        f" FROM {_SOURCE[entity]}"
    )


_STATUS = "CASE WHEN invalid_count > 0 THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END"


def _report_lines() -> str:
    lines = [
        f"""SELECT entity, {_STATUS} AS status, total_read, valid_count, invalid_count, failing_rules,
            '{rule}' AS rule, '{column}' AS "column", 'ERROR' AS severity, {flag} AS failed_count,
            CAST({flag} AS VARCHAR) || {_message(rule, column)} AS message FROM {entity}_totals"""
        for entity, rules in _RULES.items()
        for rule, column, flag in rules
    ]
    return (
        f"WITH {_CUSTOMER_CHECK}, {_LINE_CHECK}, customer_totals AS ({_totals('customer')}),"
        f" lineitem_totals AS ({_totals('lineitem')}) " + " UNION ALL ".join(lines)
    )


def _audit_rows() -> str:
    lines = []
    for entity, run in (("lineitem", "q-1"), ("customer", "q-2")):
        failures = ", ".join(
            f"""CASE WHEN {flag} > 0 THEN '"{rule}":' || {flag} END""" for rule, _, flag in _RULES[entity]
        )
        results = " || ',' || ".join(
            f"""'{{"rule":"{rule}","column":"{column}","severity":"ERROR","failed_count":' || {flag}"""
            f""" || ',"message":"' || {flag} || {_message(rule, column)} || '"}}'"""
            for rule, column, flag in _RULES[entity]
        )
        lines.append(
            f"""SELECT '{run}' AS quality_run_id, 'quality_' || entity AS pipeline, entity, {_STATUS} AS status, total_read,
            '{{' || concat_ws(',', {failures}) || '}}' AS failures_by_rule,
            '[' || {results} || ']' AS rule_results FROM {entity}_totals"""
        )
    return (
        f"WITH {_CUSTOMER_CHECK}, {_LINE_CHECK}, customer_totals AS ({_totals('customer')}),"
        f" lineitem_totals AS ({_totals('lineitem')}) " + " UNION ALL ".join(lines)
    )


_EVENTS = """
raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
         CAST(l_quantity AS VARCHAR) AS quantity, l_returnflag AS flag, l_extendedprice AS price,
         l_quantity AS n
  FROM lineitem),
events_checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN NOT coalesce(n BETWEEN 1 AND 45, false) THEN 'quantity out of range' END,
    CASE WHEN NOT coalesce(flag IN ('A', 'N'), false) THEN 'unknown flag: ' || flag END) AS errors
  FROM raw),
routed AS (
  SELECT *, CASE WHEN errors <> '' THEN 'invalid'
    WHEN row_number() OVER (PARTITION BY event_id, errors = '' ORDER BY event_time, quantity, flag, price) = 1
    THEN 'valid' ELSE 'duplicate' END AS route
  FROM events_checked)
"""

_WIDE = {
    s: f"CAST(sum(CASE WHEN o_orderstatus = '{s}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)"
    for s in "FOP"
}


def _hash(columns: str) -> str:
    parts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split(", "))
    return f"sha256({parts})"


_LINEAGE = """'shop' AS _source_project, 'sales' AS _source_dataset, 'shop.sales.customer' AS _source_table,
  'BATCH' AS _load_type"""

_PREDICATES = """
cells AS (
  SELECT 'priority' AS column_name, o_orderpriority AS text FROM orders
  UNION ALL SELECT 'rank', split_part(o_orderpriority, '-', 1) FROM orders
  UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders
  UNION ALL SELECT 'status', NULLIF(o_orderstatus, 'P') FROM orders)
"""

_MEDIAN = """
SELECT {group}, (min({value}) + max({value})) / 2 AS median
FROM (SELECT {group}, {value}, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS rn,
             count(*) OVER (PARTITION BY {group}) AS n
      FROM {table} WHERE {value} IS NOT NULL)
WHERE rn IN ((n + 1) // 2, n // 2 + 1) GROUP BY {group}
"""

ORACLES = {
    "explicit_column_scan": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey",
    "customer_directory": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS segment
        FROM customer WHERE c_custkey IS NOT NULL ORDER BY customer_id""",
    "nation_directory": """SELECT CAST(n_nationkey AS VARCHAR) AS nation_code, n_name AS nation, n_regionkey AS region_key
        FROM nation WHERE n_nationkey IS NOT NULL ORDER BY nation""",
    "national_target": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_WIDE['P']} AS target
        FROM orders GROUP BY 1 HAVING {_WIDE['P']} IS NOT NULL ORDER BY 1""",
    "nation_target": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey, {_WIDE['O']} AS target
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 HAVING {_WIDE['O']} IS NOT NULL""",
    "customer_target": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, {_WIDE['F']} AS target
        FROM orders GROUP BY 1, 2 HAVING {_WIDE['F']} IS NOT NULL""",
    "observed_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL ORDER BY o_orderkey""",
    "ordered_purchase_sample": """SELECT event_id, user_id, event_type, value FROM events
        WHERE event_type = 'purchase' AND user_id IS NOT NULL ORDER BY event_id LIMIT 100""",
    "contract_check": """
        SELECT 'o_orderkey' AS "column", true AS present, 'int' AS declared_type, 'bigint' AS actual_type,
               false AS type_ok, count(*) - count(o_orderkey) AS null_count, count(*) = count(o_orderkey) AS nulls_ok
        FROM orders
        UNION ALL SELECT 'o_custkey', true, 'int', 'bigint', false, count(*) - count(o_custkey),
               count(*) = count(o_custkey) FROM orders
        UNION ALL SELECT 'o_orderstatus', true, 'string', 'string', true, count(*) - count(o_orderstatus),
               count(*) = count(o_orderstatus) FROM orders
        UNION ALL SELECT 'o_totalprice', true, 'double', 'double', true, count(*) - count(o_totalprice), true FROM orders
        UNION ALL SELECT 'o_channel', false, 'string', NULL, false, NULL, true""",
    "latest_snapshot": f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'run-b' AS _ingestion_id,
        '2024-01-02T06:00:00+00:00' AS _ingestion_timestamp, {_LINEAGE},
        {_hash('c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment')} AS _record_hash, '1.0' AS _schema_version
        FROM customer""",
    "bronze_history": """
        SELECT 'run-a' AS _ingestion_id, '0.9' AS _schema_version, 'BATCH' AS _load_type, count(*) AS row_count,
               CAST(0 AS BIGINT) AS with_segment FROM customer
        UNION ALL SELECT 'run-b', '1.0', 'BATCH', count(*), count(c_mktsegment) FROM customer""",
    "history_over_types": """
SELECT CASE o_custkey % 3 WHEN 1 THEN 'k' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id,
       CASE o_custkey % 3 WHEN 1 THEN CAST(CAST(round(o_totalprice) AS INTEGER) AS DOUBLE) ELSE o_totalprice END AS amount,
       CASE o_custkey % 3 WHEN 2 THEN o_orderstatus END AS o_orderstatus,
       CAST(o_custkey % 3 AS VARCHAR) AS run
FROM orders
""",
    "packed_batches": """
SELECT CASE WHEN month(o_orderdate) < 7 THEN 'first' ELSE 'second' END AS half, CAST(month(o_orderdate) AS VARCHAR) AS batch,
       count(*) AS order_count, CAST(sum(o_custkey) AS BIGINT) AS customer_sum
FROM orders GROUP BY 1, 2
""",
    "known_ids": """
SELECT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'
INTERSECT
SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_shipdate < DATE '1998-01-01' AND l_orderkey % 3 <> 0
""",
    "full_refresh_load": """SELECT p_brand, count(*) AS row_count, min(p_retailprice) AS cheapest FROM part GROUP BY 1""",
    "fixed_schema_load": """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey
        FROM supplier""",
    "customer_valid_rows": f"""WITH {_CUSTOMER_CHECK} SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM flagged WHERE NOT (f1 OR f2 OR f3 OR f4 OR f5)""",
    "customer_quarantine": f"""WITH {_CUSTOMER_CHECK} SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
        {_CUSTOMER_FAILED} AS _failed_rules FROM flagged WHERE f1 OR f2 OR f3 OR f4 OR f5""",
    "lineitem_valid_rows": f"WITH {_LINE_CHECK} SELECT {_LINE_COLUMNS} FROM lines WHERE NOT (g1 OR g2 OR g3 OR g4)",
    "lineitem_quarantine": f"""WITH {_LINE_CHECK} SELECT {_LINE_COLUMNS}, {_LINE_FAILED} AS _failed_rules
        FROM lines WHERE g1 OR g2 OR g3 OR g4""",
    "quality_report": _report_lines(),
    "failures_by_rule": f"""WITH {_LINE_CHECK}, counts AS (
        SELECT 'l_quantity.in_range' AS rule, count(*) FILTER (g1) AS failed_count FROM lines
        UNION ALL SELECT 'l_returnflag.known', count(*) FILTER (g2) FROM lines
        UNION ALL SELECT 'l_shipdate.valid_year', count(*) FILTER (g3) FROM lines
        UNION ALL SELECT 'unique.l_orderkey_l_linenumber', count(*) FILTER (g4) FROM lines)
        SELECT * FROM counts WHERE failed_count > 0""",
    "first_line_per_key": f"WITH {_LINE_CHECK} SELECT {_LINE_COLUMNS} FROM lines WHERE NOT g4",
    "duplicated_line_keys": f"""SELECT {_LINE_COLUMNS} FROM (
        SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1""",
    "row_predicates": f"""WITH {_PREDICATES} SELECT column_name, count(*) AS row_count,
        count(*) FILTER (trim(text) <> '') AS filled,
        count(*) FILTER (regexp_full_match(text, '[0-9]-[A-Z ]+')) AS matching,
        count(*) FILTER (text IN ('F', '1', '1999')) AS in_list,
        count(*) FILTER (TRY_CAST(text AS DOUBLE) BETWEEN 2 AND 1998) AS in_range,
        count(*) FILTER (TRY_CAST(text AS DOUBLE) IS NOT NULL) AS "numeric",
        count(*) FILTER (TRY_CAST(text AS DOUBLE) BETWEEN 1990 AND 2100) AS plausible_years
        FROM cells GROUP BY 1""",
    "customers_without_late_order": """SELECT * FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o_orderdate) > 2000)""",
    "labelled_documents_pct": """SELECT coalesce(round_even(count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) * 100.0
        / CAST(count(*) AS DOUBLE) * 100, 0) / 100, 0.0) AS match_pct FROM documents""",
    "incompatible_years": """SELECT year(l_shipdate) AS year FROM lineitem
        EXCEPT SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) < 2000""",
    "integrity_report": """
        SELECT 'customers_without_late_order' AS "check", 'orphans' AS kind, count(*) AS failed_rows,
               CAST(NULL AS DOUBLE) AS match_pct, '' AS periods
        FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) > 2000)
        UNION ALL SELECT 'orders_with_customer', 'match', count(*) FILTER (c_custkey IS NULL),
               round_even(count(c_custkey) * 100.0 / CAST(count(*) AS DOUBLE) * 100, 0) / 100, ''
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT 'labelled_documents', 'match', count(*) FILTER (l.doc_id IS NULL),
               round_even(count(l.doc_id) * 100.0 / CAST(count(*) AS DOUBLE) * 100, 0) / 100, ''
        FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
        UNION ALL SELECT 'repeated_line_keys', 'duplicates', CAST(coalesce(sum(n), 0) AS BIGINT), NULL, ''
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'years_without_orders', 'periods', count(*), NULL, coalesce(string_agg(CAST(y AS VARCHAR), ',' ORDER BY y), '')
        FROM (SELECT year(l_shipdate) AS y FROM lineitem EXCEPT
              SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) < 2000)
        UNION ALL SELECT 'lines_without_plan', 'orphans', 0, NULL, ''""",
    "target_comparison": f"WITH {_COMPARED} SELECT * FROM cmp",
    "comparison_without_targets": f"""WITH {_COMPARED} SELECT year, c_custkey, nation, spend, CAST(NULL AS DOUBLE) AS target,
        CAST(NULL AS DOUBLE) AS target_gap, CAST(NULL AS DOUBLE) AS attainment_pct, 'SEM_META' AS status, updated_on FROM cmp""",
    "multi_level_targets": f"""WITH {_COMPARED}, overall AS (
        SELECT year + 1 AS year, CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS t FROM spend GROUP BY 1),
        per_nation AS (SELECT n_name AS nation, year, target_spend AS t FROM nation_means JOIN nation ON c_nationkey = n_nationkey)
        SELECT cmp.*, p.t AS target_nation, spend - p.t AS gap_nation, o.t AS target_overall, spend - o.t AS gap_overall,
               CAST(NULL AS DOUBLE) AS target_planned, CAST(NULL AS DOUBLE) AS gap_planned
        FROM cmp LEFT JOIN per_nation p ON cmp.nation = p.nation AND cmp.year = p.year
        LEFT JOIN overall o ON cmp.year = o.year""",
    "time_evolution": f"WITH {_SPEND} "
    + _EVOLUTION.format(kind="customer", entity="c_custkey", name="c_custkey", value="spend", table="spend"),
    "evolution_of_part_values": """WITH per_year AS (
        SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS year, p_name,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) """
    + _EVOLUTION.format(kind="part", entity="l_partkey", name="p_name", value="quantity", table="per_year"),
    "group_summary": f"""WITH {_COMPARED}, medians AS ({_MEDIAN.format(group="nation", value="spend", table="cmp")}),
        goals AS (SELECT n_name AS nation, avg(target_spend) AS t FROM nation_means JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
        stats AS (SELECT nation, round_even(avg(spend) * 100, 0) / 100 AS mean, min(spend) AS minimum, max(spend) AS maximum,
          count(*) AS row_count, count(spend) AS with_value, count(*) - count(spend) AS without_value,
          count(*) FILTER (status = 'ATINGIDA') AS reached FROM cmp WHERE nation IS NOT NULL GROUP BY 1)
        SELECT nation, mean, round_even(median * 100, 0) / 100 AS median, minimum, maximum, row_count, with_value,
          without_value, reached, round_even(reached * 100.0 / CAST(row_count AS DOUBLE) * 100, 0) / 100 AS reached_pct,
          round(t, 4) AS group_target, round(mean - t, 4) AS gap_mean_to_target
        FROM stats LEFT JOIN medians USING (nation) LEFT JOIN goals USING (nation)""",
    "price_medians": _MEDIAN.format(group="l_returnflag", value="l_extendedprice", table="lineitem"),
    "feature_table": f"""WITH {_COMPARED}, evo AS (SELECT c_custkey, year,
          spend - lag(spend) OVER (PARTITION BY c_custkey ORDER BY year) AS period_change FROM spend)
        SELECT cmp.year, cmp.c_custkey, nation, region, spend, target, target_gap, period_change,
               CAST(coalesce(spend >= target, false) AS INTEGER) AS reached
        FROM cmp LEFT JOIN evo ON cmp.c_custkey = evo.c_custkey AND cmp.year = evo.year""",
    "mean_by_nation": f"""WITH {_COMPARED} SELECT nation, round_even(avg(spend) * 100, 0) / 100 AS mean
        FROM cmp GROUP BY nation ORDER BY mean DESC, nation""",
    "status_counts": f"WITH {_COMPARED} SELECT status, count(*) AS row_count FROM cmp GROUP BY ROLLUP (status)",
    "top_nations": f"""WITH {_COMPARED} SELECT nation, round_even(avg(spend) * 100, 0) / 100 AS mean, count(*) AS row_count,
        round_even(count(*) FILTER (status = 'ATINGIDA') * 100.0 / CAST(count(*) AS DOUBLE) * 100, 0) / 100 AS reached_pct
        FROM cmp GROUP BY nation ORDER BY mean DESC, nation LIMIT 5""",
    "written_product": f"WITH {_COMPARED} SELECT year, c_custkey, spend, target, status FROM cmp",
    "normalised_documents": """SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS stripped,
        upper(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), 'ß', 'SS')) AS upper_text FROM documents""",
    "record_hashes": f"""SELECT event_id, {_hash('user_id')} AS user_hash,
        {_hash('event_id, user_id, event_type, value')} AS record_hash FROM events""",
    "safe_ratios": """SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS ratio,
        round_even(l_quantity / NULLIF(l_discount, 0) * 100 * 100, 0) / 100 AS attainment_pct,
        CASE WHEN l_discount = 0 THEN 'SEM_META' WHEN l_quantity >= 1.0 / l_discount THEN 'ATINGIDA'
             ELSE 'NAO_ATINGIDA' END AS status,
        CAST(CASE WHEN l_discount = 0 THEN false ELSE l_quantity >= 1.0 / l_discount END AS INTEGER) AS reached
        FROM lineitem""",
    "coerced_numbers": """SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority_rank,
        CAST(NULL AS DOUBLE) AS bad_number, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""",
    "iso_times": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS written,
        strftime(ts, '%Y-%m-%d') AS day,
        round_even(CAST(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts) AS DOUBLE) / 1000, 0) / 1000 AS latency_s
        FROM events""",
    "decoded_properties": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "variant_properties": """SELECT event_id, event_type, user_id, event_type AS tag,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'props,user' AS further, false AS bad_json FROM events""",
    "flattened_rows": """SELECT event_id,
        '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS who,
        '["' || event_type || '","x"]' AS tags, value FROM events""",
    "bucketed_order_lines": """SELECT o_orderkey, o_custkey, count(*) AS n_lines, max(l_extendedprice) AS top_price
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    "event_files": "SELECT event_id, user_id, event_type, value FROM events",
    "topic_messages": """SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id
        || ',"event_type":"' || event_type || '","value":' || value || '}' AS value FROM events""",
    "routed_events": f"""WITH {_EVENTS} SELECT event_id, event_time, quantity, flag, price,
        CASE WHEN route = 'duplicate' THEN 'evento duplicado' ELSE errors END AS errors, route FROM routed""",
    "routed_against_seen": f"""WITH {_EVENTS}, early AS (SELECT event_id FROM events_checked WHERE errors = '' AND event_time < '1998'),
        batches AS (
        SELECT *, CASE WHEN event_time < '1998' THEN 'first' ELSE 'second' END AS batch,
          row_number() OVER (PARTITION BY event_id, errors = '', event_time < '1998'
                             ORDER BY event_time, quantity, flag, price) AS rn
        FROM events_checked)
        SELECT batch, CASE WHEN errors <> '' THEN 'invalid'
          WHEN rn = 1 AND (batch = 'first' OR event_id NOT IN (SELECT event_id FROM early)) THEN 'valid'
          ELSE 'duplicate' END AS route, count(*) AS event_count FROM batches GROUP BY 1, 2""",
    "new_documents": """WITH d AS (
          SELECT doc_id, lang, source, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS fingerprint FROM documents)
        SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY doc_id) = 1 AND fingerprint NOT IN (
          SELECT fingerprint FROM d WHERE doc_id IN (SELECT doc_id FROM labels)) AS is_new FROM d""",
    "streamed_bronze": f"""WITH {_EVENTS} SELECT event_id, event_time, quantity, flag, price, 'STREAMING' AS _load_type
        FROM routed WHERE route = 'valid'""",
    "stream_session": f"""WITH {_EVENTS} SELECT count(*) AS consumed, count(*) FILTER (route = 'valid') AS valid,
        count(*) FILTER (route = 'invalid') AS invalid, count(*) FILTER (route = 'duplicate') AS duplicates,
        CAST(1 AS BIGINT) AS flushed_batches FROM routed""",
    "stream_quarantine": f"""WITH {_EVENTS}, bad AS (
        SELECT route, unnest(string_split(CASE WHEN route = 'duplicate' THEN 'evento duplicado' ELSE errors END, '; ')) AS error
        FROM routed WHERE route <> 'valid')
        SELECT route, error, count(*) AS event_count FROM bad GROUP BY 1, 2""",
    "layer_counts": f"""WITH {_LINE_CHECK}, c AS (SELECT count(*) AS n,
          count(*) FILTER (NOT (g1 OR g2 OR g3 OR g4)) AS ok FROM lines)
        SELECT 'batch_lineitem' AS pipeline_name, 'shop.sales.lineitem' AS source, 'bronze' AS layer, 'SUCCESS' AS status,
          n AS records_read, n AS records_written, CAST(0 AS BIGINT) AS records_valid, CAST(0 AS BIGINT) AS records_rejected FROM c
        UNION ALL SELECT 'silver_lineitem', 'lineitem', 'silver',
          CASE WHEN n > ok THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END, n, ok, ok, n - ok FROM c""",
    "silver_and_quarantine": f"""WITH {_LINE_CHECK}, tagged AS (SELECT {_LINE_FAILED} AS reason FROM lines)
        SELECT CASE WHEN reason = '' THEN 'VALID' ELSE 'INVALID' END AS _quality_status,
          CASE WHEN reason = '' THEN 'none' ELSE reason END AS reason, count(*) AS row_count FROM tagged GROUP BY 1, 2""",
    "monitoring_report": f"""WITH {_CUSTOMER_CHECK}, {_LINE_CHECK}, ct AS ({_totals('customer')}), lt AS ({_totals('lineitem')}),
        q AS (SELECT ct.valid_count + lt.valid_count AS ok, ct.invalid_count + lt.invalid_count AS bad FROM ct, lt),
        days AS (SELECT strftime(ts, '%Y-%m-%dT00:00:00+00:00') AS day, count(*) AS n, floor(avg(second(ts))) AS latency,
                   count(*) - count(DISTINCT user_id) AS again FROM events GROUP BY 1),
        newest AS (SELECT * FROM days ORDER BY day DESC LIMIT 1)
        SELECT (SELECT count(DISTINCT o_orderpriority) FROM orders) AS total_pipeline_runs, 'customer,lineitem' AS entities,
          ok AS valid_rows, bad AS rejected_rows,
          round_even(bad * 100.0 / CAST(ok + bad AS DOUBLE) * 100, 0) / 100 AS rejection_pct,
          (SELECT count(*) FROM days) AS stream_sessions,
          (SELECT n FROM days ORDER BY day DESC LIMIT 1) AS last_consumed, (SELECT max(day) FROM days) AS last_stream_time,
          (SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' FROM orders) AS last_run_time,
          (SELECT latency FROM newest) AS stream_latency_seconds, (SELECT again FROM newest) AS stream_duplicates
        FROM q""",
    "synced_monitoring": f"""WITH {_CUSTOMER_CHECK}, {_LINE_CHECK}, ct AS ({_totals('customer')}), lt AS ({_totals('lineitem')}),
        q AS (SELECT ct.valid_count + lt.valid_count AS ok, ct.invalid_count + lt.invalid_count AS bad FROM ct, lt)
        SELECT 2 * (SELECT count(DISTINCT o_orderpriority) FROM orders) AS total_pipeline_runs, 'customer,lineitem' AS entities,
          2 * ok AS valid_rows, 2 * bad AS rejected_rows,
          round_even(bad * 100.0 / CAST(ok + bad AS DOUBLE) * 100, 0) / 100 AS rejection_pct,
          2 * (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS stream_sessions,
          (SELECT strftime(max(ts), '%Y-%m-%dT00:00:00+00:00') FROM events) AS last_stream_time
        FROM q""",
    "literacy_run": """WITH o AS (SELECT *, year(o_orderdate) AS ano FROM orders),
        place_year AS (
          SELECT ano, o_custkey, (count(*) * 30 % 130)::DOUBLE AS goal,
                 ((sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100)::BIGINT % 105)::DOUBLE AS rate FROM o GROUP BY 1, 2),
        entities AS (
          SELECT 'municipio' AS entity, count(*) AS total, count(*) FILTER (c_nationkey < 24) AS ok FROM customer
          UNION ALL SELECT 'uf', count(*), count(*) FROM nation
          UNION ALL SELECT 'meta_brasil', count(DISTINCT ano), count(DISTINCT ano) FROM o
          UNION ALL SELECT 'meta_uf', count(*), count(*) FROM (
            SELECT DISTINCT ano, c_nationkey FROM o JOIN customer ON o_custkey = c_custkey)
          UNION ALL SELECT 'meta_municipio', count(*), count(*) FILTER (goal <= 100) FROM place_year
          UNION ALL SELECT 'indicador_alfabetizacao', count(*), count(*) FILTER (rate <= 100) FROM place_year
          UNION ALL SELECT 'aluno', count(*), count(*) FROM o)
        SELECT 'batch_' || entity AS name, 'SUCCESS' AS status, total AS records_read, total AS records_written,
               CAST(0 AS BIGINT) AS records_valid, CAST(0 AS BIGINT) AS records_rejected FROM entities
        UNION ALL SELECT 'silver_' || entity, CASE WHEN ok < total THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END,
               total, ok, ok, total - ok FROM entities
        UNION ALL SELECT 'all', 'SUCCESS', 0, 0, 0, 0
        UNION ALL SELECT 'indicador_municipio_ano', CASE WHEN goal > 100 THEN 'SEM_META' WHEN rate >= goal THEN 'ATINGIDA'
               ELSE 'NAO_ATINGIDA' END, NULL, count(*), NULL, NULL FROM place_year WHERE rate <= 100 GROUP BY 2""",
    "audit_tables": _audit_rows(),
}
