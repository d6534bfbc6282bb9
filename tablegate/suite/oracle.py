"""SQL that each registered query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

TRIPS = """
trips AS (
    SELECT event_id, event_type, user_id AS "VendorID",
           CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 7 AS INTEGER) END AS passenger_count,
           value - 5.0 AS total_amount,
           ts AS tpep_pickup_datetime,
           ts + to_minutes(CAST(event_id % 61 AS INTEGER) - 1) AS tpep_dropoff_datetime,
           strftime(date_trunc('week', ts), '%Y-%m-%d') AS week
    FROM events
)"""

UNKNOWN = """
unknown AS (
    SELECT * REPLACE (CASE WHEN event_id % 1000 != 1 THEN total_amount END AS total_amount) FROM trips
)"""


def flagged(source: str) -> str:
    return f"""
flagged AS (
    SELECT *,
           total_amount <= 0 AS f1,
           passenger_count IS NULL OR passenger_count = 0 AS f2,
           tpep_dropoff_datetime < tpep_pickup_datetime AS f3,
           tpep_pickup_datetime < TIMESTAMP '2024-01-03' OR tpep_dropoff_datetime >= TIMESTAMP '2024-01-29' AS f4
    FROM {source}
)"""


FLAGGED = flagged("trips")
ANY = "(f1 OR f2 OR f3 OR f4)"
KEPT = f"kept AS (SELECT * FROM flagged WHERE NOT {ANY})"
BASE = f"WITH {TRIPS}, {FLAGGED}, {KEPT}"
BASE_UNKNOWN = f"WITH {TRIPS}, {UNKNOWN}, {flagged('unknown')}"

RULES = {
    "f1": "total_amount_negative_or_zero",
    "f2": "passenger_count_null_or_zero",
    "f3": "dropoff_before_pickup",
    "f4": "out_of_range_dates",
}
OUTSIDE = """NOT (tpep_pickup_datetime >= TIMESTAMP '2024-01-03' AND tpep_pickup_datetime < TIMESTAMP '2024-01-29'
    AND tpep_dropoff_datetime >= TIMESTAMP '2024-01-03' AND tpep_dropoff_datetime < TIMESTAMP '2024-01-29')"""

LANDED = """
landed AS (
    SELECT *, 'slice=' || wk AS _source_file
    FROM (
        SELECT *, event_id % 6 + 1 AS rate, CAST(CASE WHEN event_id % 10 = 0 THEN 1.25 ELSE 0 END AS DOUBLE) AS fee,
               unnest(list_distinct([week, strftime(date_trunc('week', tpep_pickup_datetime - INTERVAL 1 DAY),
                                                    '%Y-%m-%d')])) AS wk
        FROM trips
    )
)"""
SLICES = f"WITH {TRIPS}, {LANDED}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def counted_rules(source: str, rules: dict[str, tuple[str, str]], by: str = "") -> str:
    """One row per rule: id, policy, failures, rows read."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return union(
        [
            f"SELECT {lead}'{rule}' AS rule_id, '{policy}' AS policy, count(*) FILTER ({flag}) AS failed_count, "
            f"count(*) AS rows_read FROM {source}{group}"
            for flag, (rule, policy) in rules.items()
        ]
    )


DROP_RULES = {flag: (rule, "drop") for flag, rule in RULES.items()}

TOTALS = f"""
SELECT count(*) AS rows_read, count(*) FILTER ({ANY}) AS total_dropped, count(*) FILTER (NOT {ANY}) AS rows_written,
       count(*) FILTER ({ANY} IS NULL) AS undetermined_count
FROM flagged"""

METRICS_JSON = (
    "'{' || "
    + " || ',' || ".join(f"'\"{rule}_count\":' || count(*) FILTER ({flag})" for flag, rule in RULES.items())
    + f" || ',\"total_dropped\":' || count(*) FILTER ({ANY})"
    + f" || ',\"undetermined_count\":' || count(*) FILTER ({ANY} IS NULL) || '}}'"
)
ALERT_LIST = ", ".join(
    f"CASE WHEN count(*) FILTER ({flag}) / count(*) > 0.01 "
    f"THEN printf('{rule}_count: %.2f%% > 1%% threshold', 100.0 * count(*) FILTER ({flag}) / count(*)) END"
    for flag, rule in RULES.items()
)

# Columns and type families of the given tables.
COLUMNS = {
    "region": "r_regionkey:integer r_name:string",
    "nation": "n_nationkey:integer n_name:string n_regionkey:integer",
    "customer": "c_custkey:integer c_name:string c_nationkey:integer c_acctbal:floating c_mktsegment:string",
    "supplier": "s_suppkey:integer s_name:string s_nationkey:integer s_acctbal:floating",
    "part": "p_partkey:integer p_name:string p_brand:string p_type:string p_size:integer p_retailprice:floating",
    "orders": (
        "o_orderkey:integer o_custkey:integer o_orderstatus:string o_totalprice:floating "
        "o_orderdate:timestamp_or_date o_orderpriority:string"
    ),
    "lineitem": (
        "l_orderkey:integer l_partkey:integer l_suppkey:integer l_linenumber:integer l_quantity:floating "
        "l_extendedprice:floating l_discount:floating l_tax:floating l_returnflag:string l_linestatus:string "
        "l_shipdate:timestamp_or_date"
    ),
    "events": (
        "event_id:integer ts:timestamp_or_date user_id:integer event_type:string value:floating props:string"
    ),
    "documents": "doc_id:integer text:string lang:string source:string n_chars:integer",
    "embeddings": "vec_id:integer embedding:other label:integer",
    "pages": "page_id:integer url:string html:string",
    "benchmark": "item_id:integer text:string",
    "labels": "doc_id:integer quality:integer toxic:integer",
    "conversations": "conv_id:integer turn:integer role:string text:string",
}


def leave_one_out(keyed: str, key: str, measure: str, tolerance: float, columns: str) -> str:
    """Brute force: the median over all other rows."""
    return f"""
WITH keyed AS ({keyed}),
others AS (
    SELECT a.{key}, median(b.{measure}) AS m
    FROM keyed a LEFT JOIN keyed b ON a.{key} != b.{key}
    GROUP BY a.{key}
)
SELECT {columns}, CAST(m AS DOUBLE) AS median_of_others,
       m = 0 OR abs({measure} - m) > {tolerance} * m AS is_outlier
FROM keyed JOIN others USING ({key})"""


ORACLE: dict[str, str] = {}

# --- quality gate ---------------------------------------------------------------------------------

ORACLE["rule_flags"] = (
    f"{BASE} SELECT event_id, " + ", ".join(f"{flag} AS _fails_{rule}" for flag, rule in RULES.items()) + " FROM flagged"
)
ORACLE["rule_counts"] = f"{BASE} {counted_rules('flagged', DROP_RULES)}"
ORACLE["rule_totals"] = f"{BASE} {TOTALS}"
ORACLE["rule_totals_undetermined"] = f"{BASE_UNKNOWN} {TOTALS}"
ORACLE["rule_totals_not_null"] = f"""{BASE_UNKNOWN},
strict AS (
    SELECT {ANY} OR "VendorID" IS NULL OR passenger_count IS NULL OR total_amount IS NULL
        OR tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL AS bad FROM flagged
)
SELECT count(*) AS rows_read, count(*) FILTER (bad) AS total_dropped, count(*) FILTER (NOT bad) AS rows_written,
       count(*) FILTER (bad IS NULL) AS undetermined_count
FROM strict"""
ORACLE["rule_overlap"] = f"""{BASE}
SELECT CAST(f1 AS INTEGER) + CAST(f2 AS INTEGER) + CAST(f3 AS INTEGER) + CAST(f4 AS INTEGER) AS rules_failed,
       count(*) AS row_count
FROM flagged GROUP BY 1"""
ORACLE["rule_counts_by_slice"] = f"""{BASE}
SELECT week, rule_id, failed_count, rows_read, 2 * failed_count > rows_read AS over_limit
FROM ({counted_rules('flagged', DROP_RULES, by='week')})"""
ORACLE["policy_flags"] = f"""{BASE}
SELECT event_id, concat_ws(',', CASE WHEN total_amount > 100 THEN 'large_amount' END,
                           CASE WHEN passenger_count >= 5 THEN 'crowded' END) AS flags
FROM kept"""
ORACLE["policy_counts"] = f"""{BASE} {counted_rules('flagged', {
    **DROP_RULES,
    "total_amount > 100": ("large_amount", "flag"),
    "event_type = 'error'": ("errors_kept", "keep"),
    "total_amount > 300": ("huge_amount", "drop"),
})}"""
ORACLE["silver_build"] = f"""{BASE}
SELECT "VendorID", passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime FROM kept"""
ORACLE["audit_columns"] = f"{BASE} SELECT count(*) AS row_count, count(*) AS stamped, TRUE AS one_stamp FROM kept"
ORACLE["quarantine"] = (
    f"{BASE} SELECT event_id, total_amount, concat_ws(',', "
    + ", ".join(f"CASE WHEN {flag} THEN '{rule}' END" for flag, rule in RULES.items())
    + f") AS failed_rules FROM flagged WHERE {ANY}"
)
ORACLE["undetermined_rows"] = f"""{BASE_UNKNOWN}
SELECT event_id, passenger_count, tpep_pickup_datetime FROM flagged WHERE {ANY} IS NULL"""
ORACLE["silver_violations"] = f"""{BASE}
SELECT rule_id, failed_count, rows_read FROM ({counted_rules('kept', DROP_RULES)})"""
ORACLE["rule_alerts"] = f"""{BASE}
SELECT rule_id, failed_count, rows_read,
       printf('%s_count: %.2f%% > 1%% threshold', rule_id, 100.0 * failed_count / rows_read) AS alert
FROM ({counted_rules('flagged', {**DROP_RULES, "total_amount > 250": ("rare_amount", "drop")})})
WHERE failed_count / rows_read > 0.01"""
ORACLE["unparseable_counts"] = f"""WITH {TRIPS},
typed AS (
    SELECT CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN ''
                ELSE CAST(passenger_count AS VARCHAR) END AS passenger_text,
           CAST(event_id AS VARCHAR) AS id_text, event_type
    FROM trips
)
""" + union(
    [
        f"SELECT count(*) AS rows_read, '{c}' AS column_name, '{t}' AS expected_type, "
        f"count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {d}) IS NULL) AS unparseable_count FROM typed"
        for c, t, d in (
            ("passenger_text", "int", "INTEGER"),
            ("id_text", "bigint", "BIGINT"),
            ("event_type", "double", "DOUBLE"),
        )
    ]
)

# --- analytics ------------------------------------------------------------------------------------

ORACLE["avg_by_month"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(avg(o_totalprice), 2) AS avg_o_totalprice,
       count(*) AS trip_count
FROM orders GROUP BY 1 ORDER BY 1"""
ORACLE["avg_by_month_clean"] = f"""{BASE}
SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, round(avg(total_amount), 2) AS avg_total_amount,
       count(*) AS trip_count
FROM kept GROUP BY 1 ORDER BY 1"""
BY_HOUR = """
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       round(avg(passenger_count), 2) AS avg_passenger_count, count(*) AS trip_count
FROM kept WHERE year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = 1
GROUP BY 1"""
ORACLE["avg_by_hour"] = f"{BASE} {BY_HOUR} ORDER BY 1"
ORACLE["daily_counts"] = f"""{BASE}
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, count(*) AS trip_count FROM kept GROUP BY 1 ORDER BY 1"""
ORACLE["total_revenue"] = f"{BASE} SELECT round(sum(total_amount), 2) AS total_revenue FROM kept"
ORACLE["avg_one_month"] = """
SELECT round(avg(o_totalprice), 4) AS avg_totalprice FROM orders
WHERE extract(month FROM o_orderdate) = 12 AND extract(year FROM o_orderdate) = 1996"""
ORACLE["calendar_filter"] = """
SELECT count(*) AS by_range, count(*) AS by_parts FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 12"""
ORACLE["avg_of_period_totals"] = """
SELECT
  round((SELECT avg(t) FROM (SELECT sum(o_totalprice) AS t FROM orders GROUP BY strftime(o_orderdate, '%Y-%m'))), 2)
    AS avg_monthly_total,
  round((SELECT avg(t) FROM (SELECT sum(o_totalprice) AS t FROM orders GROUP BY CAST(o_orderdate AS DATE))), 2)
    AS avg_daily_total"""
ORACLE["hour_extremes"] = f"""{BASE}, by_hour AS ({BY_HOUR}),
lo AS (SELECT * FROM by_hour ORDER BY avg_passenger_count, pickup_hour LIMIT 1),
hi AS (SELECT * FROM by_hour ORDER BY avg_passenger_count DESC, pickup_hour LIMIT 1)
SELECT lo.pickup_hour AS lowest_pickup_hour, lo.avg_passenger_count AS lowest_avg_passenger_count,
       hi.pickup_hour AS highest_pickup_hour, hi.avg_passenger_count AS highest_avg_passenger_count
FROM lo, hi"""
ORACLE["threshold_count"] = f"{BASE} SELECT count(*) AS trip_count FROM kept WHERE passenger_count > 4"
ORACLE["busiest_hour"] = f"""{BASE}
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, count(*) AS trip_count
FROM kept GROUP BY 1 ORDER BY trip_count DESC, pickup_hour LIMIT 1"""
ORACLE["result_preview"] = f"SELECT *, count(*) OVER () AS total_rows FROM ({ORACLE['avg_by_month']}) ORDER BY month LIMIT 50"
ORACLE["report_format"] = """
SELECT o_orderpriority, translate(format('{:,.2f}', sum(o_totalprice)), ',.', '.,') AS total_text
FROM orders GROUP BY 1"""

# --- slices and schemas ---------------------------------------------------------------------------

ORACLE["slice_scan"] = f"""{SLICES}
SELECT _source_file AS slice, count(*) AS row_count, min(tpep_pickup_datetime) AS first_pickup,
       max(tpep_pickup_datetime) AS last_pickup, CAST(sum(event_id) AS BIGINT) AS sum_event_id
FROM landed GROUP BY 1"""
ORACLE["lineage_counts"] = union(
    [f"SELECT '{t}.parquet' AS _source_file, count(*) AS row_count FROM {t}" for t in COLUMNS]
)
ORACLE["schema_families"] = union(
    [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{family}' AS type_family, "
        f"count({c}) AS non_null_count FROM {t}"
        for t, columns in COLUMNS.items()
        for c, family in (entry.split(":") for entry in columns.split())
    ]
)
ORACLE["schema_drift"] = f"""{SLICES}, names AS (SELECT DISTINCT _source_file AS s FROM landed),
spread AS (
    SELECT string_agg(s, ',' ORDER BY s) AS slices_present,
           string_agg(s || ':' || CASE WHEN s < 'slice=2024-01-01' THEN 'floating' ELSE 'integer' END, ',' ORDER BY s)
               AS families
    FROM names
)
SELECT 'passenger_count' AS column_name, slices_present, families, TRUE AS is_required, 'critical' AS severity,
       (SELECT count(passenger_count) FROM landed) AS non_null_count
FROM spread
UNION ALL
SELECT 'ratecodeid', slices_present, families, FALSE, 'informational', (SELECT count(rate) FROM landed) FROM spread"""
ORACLE["schema_gate_ok"] = f"""{SLICES}
SELECT _source_file AS slice, count(*) AS row_count, 'pass' AS gate FROM landed GROUP BY 1"""
ORACLE["contract_compat"] = f"WITH {TRIPS} " + union(
    [
        f"""SELECT '{c}' AS column_name, count("{c}") AS non_null_count, '{declared}' AS declared_type,
            '{family}' AS expected_family, '{family}' AS found_family, TRUE AS compatible FROM trips"""
        for c, declared, family in (
            ("VendorID", "integer", "integer"),
            ("passenger_count", "integer", "integer"),
            ("total_amount", "decimal", "floating"),
            ("tpep_pickup_datetime", "timestamp", "timestamp_or_date"),
            ("tpep_dropoff_datetime", "timestamp", "timestamp_or_date"),
        )
    ]
)
ORACLE["contract_columns"] = f"{BASE} " + union(
    [
        f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, TRUE AS described,
            count(*) AS non_null_count FROM kept"""
        for i, (c, t) in enumerate(
            (
                ("VendorID", "bigint"),
                ("passenger_count", "int"),
                ("total_amount", "double"),
                ("tpep_pickup_datetime", "timestamp_ntz"),
                ("tpep_dropoff_datetime", "timestamp_ntz"),
                ("_silver_processed_at", "timestamp"),
            )
        )
    ]
)
ORACLE["conform_drift"] = f"""{SLICES}
SELECT event_id, _source_file, passenger_count, CAST(rate AS INTEGER) AS "RatecodeID", 0 AS _cast_loss FROM landed"""
ORACLE["cast_loss"] = """
SELECT 'orders' AS table_name, count(*) AS rows_read,
       count(*) FILTER (o_totalprice != trunc(o_totalprice)) AS cast_loss_count
FROM orders
UNION ALL
SELECT 'lineitem', count(*),
       count(*) FILTER (l_quantity != trunc(l_quantity)) + count(*) FILTER (l_extendedprice != trunc(l_extendedprice))
       + count(*) FILTER (l_tax != trunc(l_tax))
FROM lineitem"""
ORACLE["union_slices"] = f"""{SLICES}
SELECT event_id, event_type, passenger_count, fee AS airport_fee, tpep_pickup_datetime, _source_file FROM landed"""
ORACLE["ingest_dedup"] = f"""{SLICES}
SELECT event_id, "VendorID", CAST(rate AS INTEGER) AS "RatecodeID", min(_source_file) AS _source_file,
       count(*) AS copies
FROM landed GROUP BY 1, 2, 3"""
ORACLE["ingest_accounting"] = f"""{SLICES}
SELECT count(*) AS rows_read, count(DISTINCT event_id) AS rows_written,
       count(*) - count(DISTINCT event_id) AS duplicates_removed
FROM landed"""
ORACLE["distinct_documents"] = """
SELECT min(doc_id) AS doc_id, lang, source, n_chars, count(*) AS copies
FROM documents GROUP BY text, lang, source, n_chars"""
ORACLE["bronze_build"] = f"""{SLICES}
SELECT event_id, event_type, "VendorID", passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
       CAST(rate AS INTEGER) AS "RatecodeID", fee AS airport_fee, min(_source_file) AS _source_file
FROM landed GROUP BY ALL"""

ORACLE["incremental_dedup"] = ORACLE["bronze_build"]
ORACLE["slice_replace"] = f"""WITH {TRIPS}, first AS (SELECT min(week) AS week FROM trips)
SELECT t.week, count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS sum_event_id, t.week = first.week AS replaced
FROM trips t, first WHERE t.week <> first.week OR passenger_count IS NOT NULL GROUP BY t.week, first.week"""

# --- profile --------------------------------------------------------------------------------------

REQUIRED = ["VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime"]
MATCHED = (
    ("passenger_count_null_or_zero", "passenger_count IS NULL OR passenger_count = 0"),
    ("total_amount_negative_or_zero", "total_amount <= 0"),
    ("out_of_window", OUTSIDE),
)
ORACLE["profile_volume"] = f"WITH {TRIPS} SELECT week AS slice, count(*) AS row_count FROM trips GROUP BY 1"
ORACLE["profile_nulls"] = (
    f"WITH {TRIPS} "
    + union(
        [
            f"""SELECT week AS slice, '{c}' AS column_name, TRUE AS present, count(*) FILTER ("{c}" IS NULL) AS null_count,
            round(100.0 * count(*) FILTER ("{c}" IS NULL) / count(*), 4) AS null_pct FROM trips GROUP BY 1"""
            for c in REQUIRED
        ]
    )
    + """
UNION ALL SELECT DISTINCT week, 'fare_amount', FALSE, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM trips"""
)
ORACLE["profile_conditions"] = f"WITH {TRIPS} " + union(
    [
        f"""SELECT week AS slice, '{name}' AS condition, count(*) FILTER ({condition}) AS matched_count,
        round(100.0 * count(*) FILTER ({condition}) / count(*), 4) AS matched_pct FROM trips GROUP BY 1"""
        for name, condition in MATCHED
    ]
)
ORACLE["out_of_window"] = f"""WITH {TRIPS}
SELECT event_id, tpep_pickup_datetime, tpep_dropoff_datetime FROM trips WHERE {OUTSIDE}"""
ORACLE["profile_stats"] = union(
    [
        f"SELECT CAST(year(l_shipdate) AS INTEGER) AS slice, '{m}' AS measure, min({m}) AS min_value, "
        f"max({m}) AS max_value, round(avg({m}), 6) AS mean_value FROM lineitem GROUP BY 1"
        for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ]
)
QUANTILE_NAMES = "unnest(['p25', 'p50', 'p75', 'p95', 'p99'])"
ORACLE["profile_quantiles_approx"] = f"WITH {TRIPS} " + union(
    [
        f"SELECT slice, measure, {QUANTILE_NAMES} AS quantile, TRUE AS rank_holds "
        f"FROM (SELECT DISTINCT {key} AS slice, '{m}' AS measure FROM {source})"
        for key, m, source in [("week", m, "trips") for m in ("total_amount", "passenger_count")]
        + [("CAST(year(l_shipdate) AS VARCHAR)", m, "lineitem") for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    ]
)
FINDINGS = [("rows", "count", "count(*)")]
for subject, kind, condition in [(c, "null", f'"{c}" IS NULL') for c in REQUIRED] + [(n, "match", c) for n, c in MATCHED]:
    FINDINGS.append((subject, f"{kind}_count", f"count(*) FILTER ({condition})"))
    FINDINGS.append((subject, f"{kind}_pct", f"100.0 * count(*) FILTER ({condition}) / count(*)"))
for m in ("total_amount", "passenger_count"):
    FINDINGS += [(m, "min", f"min({m})"), (m, "max", f"max({m})"), (m, "mean", f"avg({m})")]
ORACLE["profile_findings"] = f"WITH {TRIPS} " + union(
    [
        f"SELECT week AS slice, '{subject}' AS subject, '{metric}' AS metric, round(CAST({value} AS DOUBLE), 4) AS value, "
        "CAST(NULL AS BOOLEAN) AS rank_holds FROM trips GROUP BY 1"
        for subject, metric, value in FINDINGS
    ]
    + [
        f"SELECT slice, '{m}', {QUANTILE_NAMES}, CAST(NULL AS DOUBLE), TRUE FROM (SELECT DISTINCT week AS slice FROM trips)"
        for m in ("total_amount", "passenger_count")
    ]
)
ORACLE["profile_quantiles_exact"] = union(
    [
        f"SELECT CAST(year(l_shipdate) AS INTEGER) AS slice, '{m}' AS measure, "
        + ", ".join(f"round(quantile_cont({m}, {q}), 6) AS p{int(100 * q)}" for q in (0.25, 0.5, 0.75, 0.95, 0.99))
        + " FROM lineitem GROUP BY 1"
        for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ]
)
ORACLE["profile_duplicates"] = """
WITH copies AS (SELECT source, count(*) AS c FROM documents GROUP BY source, text, lang, n_chars)
SELECT source AS slice, CAST(sum(c) AS BIGINT) AS row_count, CAST(sum(c - 1) AS BIGINT) AS duplicate_count,
       round(100.0 * sum(c - 1) / sum(c), 4) AS duplicate_pct
FROM copies GROUP BY 1"""

# --- run log and sinks ----------------------------------------------------------------------------

ORACLE["overwrite_idempotent"] = """
SELECT count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS sum_event_id FROM events"""
ORACLE["run_log_append"] = f"""{BASE}
SELECT 'silver' AS pipeline_stage, 'pass' AS status, 'pass' AS schema_check_status, count(*) AS rows_read,
       count(*) FILTER (NOT {ANY}) AS rows_written, {METRICS_JSON} AS metrics,
       concat_ws('; ', {ALERT_LIST}) AS alerts, TRUE AS no_error, TRUE AS timed
FROM flagged"""
ORACLE["run_log_latest"] = f"""{SLICES}
SELECT 'bronze' AS pipeline_stage, 'pass' AS status, 'pass' AS schema_check_status, count(*) AS rows_read,
       CAST(NULL AS VARCHAR) AS error
FROM landed
UNION ALL
SELECT 'silver', 'failed', 'failed', NULL,
       'column ''total_amount'': declared ''decimal'' (family ''floating''), found family ''None'''"""
GATE_METRICS = [(f"{rule}_count", flag) for flag, rule in RULES.items()]
GATE_METRICS += [("total_dropped", ANY), ("undetermined_count", f"{ANY} IS NULL")]
ORACLE["run_log_metrics"] = f"""{SLICES}, {UNKNOWN}, {flagged('unknown')}, {FLAGGED.replace('flagged AS', 'known AS')},
counted AS (""" + union(
    [
        f"""SELECT '{metric}' AS metric, count(*) AS n, (SELECT count(*) FROM flagged WHERE {condition}) AS first_value,
        count(*) FILTER ({condition}) AS second_value FROM known"""
        for metric, condition in GATE_METRICS
    ]
) + """),
history AS (
    SELECT 'silver' AS pipeline_stage, metric, n AS rows_read, first_value AS value,
           CAST(NULL AS BIGINT) AS previous_value FROM counted
    UNION ALL
    SELECT 'silver', metric, n, second_value, first_value FROM counted
    UNION ALL
    SELECT 'bronze', 'duplicates_removed', count(*), count(*) - count(DISTINCT event_id), NULL FROM landed
    UNION ALL
    SELECT 'bronze', 'cast_loss_count', count(*), 0, NULL FROM landed
)
SELECT pipeline_stage, metric, rows_read, value, previous_value, value - previous_value AS change,
       round(value / rows_read, 8) AS share
FROM history"""
ORACLE["run_log_prune"] = f"""{SLICES}, {UNKNOWN}, {flagged('unknown')}, {FLAGGED.replace('flagged AS', 'known AS')}
SELECT 'bronze' AS pipeline_stage, 'pass' AS status, count(*) AS rows_read, count(DISTINCT event_id) AS rows_written
FROM landed
UNION ALL SELECT 'silver', 'pass', count(*), count(*) FILTER (NOT {ANY}) FROM flagged
UNION ALL SELECT 'silver', 'pass', count(*), count(*) FILTER (NOT {ANY}) FROM known"""

# --- manifests and reconciliation -----------------------------------------------------------------

ORACLE["slice_readability"] = union(
    [
        f"SELECT '{t}.parquet' AS slice, CAST(1 AS BIGINT) AS files_listed, CAST(1 AS BIGINT) AS files_decoded, "
        f"count(*) AS rows_declared, count(*) AS rows_decoded, TRUE AS is_readable FROM {t}"
        for t in COLUMNS
    ]
)
# Sizes on disk follow the row counts closely enough to give the same outliers.
ORACLE["manifest_status"] = f"""{SLICES},
keyed AS (SELECT _source_file AS slice, count(*) AS n FROM landed GROUP BY 1),
others AS (SELECT a.slice, median(b.n) AS m FROM keyed a JOIN keyed b ON a.slice != b.slice GROUP BY 1)
SELECT slice, TRUE AS size_agrees, n AS row_count, abs(n - m) > 0.5 * m AS is_outlier, TRUE AS is_readable,
       CASE WHEN abs(n - m) > 0.5 * m THEN 'incomplete' ELSE 'verified' END AS verification_status
FROM keyed JOIN others USING (slice)
UNION ALL
SELECT 'slice=' || strftime(CAST(substr(max(_source_file), 7) AS DATE) + INTERVAL 7 DAY, '%Y-%m-%d'), TRUE, 0, NULL, FALSE, 'incomplete'
FROM landed"""
ORACLE["file_manifest"] = union([f"SELECT '{t}.parquet' AS file_name, TRUE AS filled, TRUE AS size_agrees" for t in COLUMNS])
ORACLE["bytes_per_row_outliers"] = f"""{SLICES}
SELECT _source_file AS slice, count(*) AS row_count, TRUE AS is_size_by_rows, TRUE AS verdict_follows FROM landed GROUP BY 1"""
ORACLE["bytes_per_row_documents"] = """
WITH sizes AS (
    SELECT source AS slice, count(*) AS row_count, CAST(sum(n_chars) AS BIGINT) AS size_bytes, sum(n_chars) / count(*) AS bytes_per_row FROM documents GROUP BY 1
), others AS (
    SELECT a.slice, median(b.bytes_per_row) AS m FROM sizes a JOIN sizes b ON a.slice <> b.slice GROUP BY 1
)
SELECT slice, row_count, size_bytes, round(bytes_per_row, 6) AS bytes_per_row, round(m, 6) AS median_of_others,
       m = 0 OR abs(bytes_per_row - m) > 0.25 * m AS is_outlier
FROM sizes JOIN others USING (slice)"""
ORACLE["loo_outliers"] = leave_one_out(
    "SELECT source, CAST(sum(n_chars) AS BIGINT) AS total_chars FROM documents GROUP BY 1",
    "source",
    "total_chars",
    0.25,
    "source, total_chars",
)
ORACLE["loo_outliers_even_odd"] = leave_one_out(
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1", "event_type", "n", 0.01, "event_type, n"
)
for name, kept in (("loo_outliers_orders", "TRUE"), ("loo_outliers_orders_odd", "o_orderkey <> 1")):
    ORACLE[name] = f"""
WITH v AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r, count(*) OVER () AS n
           FROM orders WHERE {kept}),
m AS (SELECT o_orderkey, o_totalprice, CASE WHEN n % 2 = 1
          THEN ((SELECT o_totalprice FROM v b WHERE b.r = CASE WHEN v.r <= (n - 1) // 2 THEN (n - 1) // 2 + 1 ELSE (n - 1) // 2 END)
              + (SELECT o_totalprice FROM v b WHERE b.r = CASE WHEN v.r <= (n - 1) // 2 + 1 THEN (n - 1) // 2 + 2 ELSE (n - 1) // 2 + 1 END)) / 2
          ELSE (SELECT o_totalprice FROM v b WHERE b.r = CASE WHEN v.r <= n // 2 THEN n // 2 + 1 ELSE n // 2 END) END AS median_of_others
      FROM v)
SELECT o_orderkey, o_totalprice, median_of_others,
       median_of_others = 0 OR abs(o_totalprice - median_of_others) > 0.5 * median_of_others AS is_outlier FROM m"""
ORACLE["verified_copy"] = f"""{SLICES}
SELECT _source_file AS slice, count(*) AS left_rows, count(*) AS right_rows, TRUE AS matches, TRUE AS safe_to_drop
FROM landed GROUP BY 1"""
COMPARED = f"""
SELECT week, count(*) AS left_rows, count(*) FILTER (NOT ({OUTSIDE})) AS right_rows,
       count(*) FILTER ({OUTSIDE}) AS only_left, 0 AS only_right, count(*) FILTER ({OUTSIDE}) = 0 AS matches
FROM trips GROUP BY 1"""
ORACLE["reconcile_tables"] = f"WITH {TRIPS} SELECT * REPLACE (CAST(only_right AS BIGINT) AS only_right) FROM ({COMPARED})"
ORACLE["reconcile_by_fingerprint"] = f"WITH {TRIPS} SELECT week, left_rows, right_rows, matches FROM ({COMPARED})"
ORACLE["row_differences"] = f"""{SLICES}
SELECT event_id, count(*) AS left_copies, CAST(1 AS BIGINT) AS right_copies FROM landed GROUP BY 1 HAVING count(*) > 1"""
ORACLE["reconcile_metrics"] = f"""{BASE}, sides AS (
    SELECT count(*) FILTER (f1) AS c1, count(*) FILTER (f2) AS c2, count(*) FILTER (f3) AS c3, count(*) FILTER (f4) AS c4,
           count(*) FILTER ({OUTSIDE}) AS outside
    FROM flagged
)
SELECT 'total_amount_negative_or_zero' AS metric, c1 AS left_value, c1 AS right_value, TRUE AS matches FROM sides
UNION ALL SELECT 'passenger_count_null_or_zero', c2, c2, TRUE FROM sides
UNION ALL SELECT 'dropoff_before_pickup', NULL, c3, FALSE FROM sides
UNION ALL SELECT 'out_of_range_dates', NULL, c4, FALSE FROM sides
UNION ALL SELECT 'out_of_window', outside, NULL, FALSE FROM sides"""

# --- time series ----------------------------------------------------------------------------------

ORACLE["missing_days"] = """
WITH daily AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders),
calendar AS (
    SELECT o_orderpriority, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d
    FROM daily GROUP BY 1
)
SELECT o_orderpriority, d AS missing_day FROM calendar ANTI JOIN daily USING (o_orderpriority, d)"""
ORACLE["weekly_decomposition"] = """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS y FROM events GROUP BY 1, 2),
numbered AS (
    SELECT *, date_diff('day', min(day) OVER (PARTITION BY event_type), day) AS x, dayofweek(day) AS wd FROM daily
),
line AS (SELECT event_type, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM numbered GROUP BY 1),
detrended AS (
    SELECT event_type, day, y, wd, intercept + slope * x AS trend, y - (intercept + slope * x) AS rest
    FROM numbered JOIN line USING (event_type)
),
effects AS (SELECT event_type, wd, avg(rest) AS effect FROM detrended GROUP BY 1, 2),
centres AS (SELECT event_type, avg(effect) AS centre FROM effects GROUP BY 1)
SELECT event_type, day, y, round(trend, 6) AS trend, round(effect - centre, 6) AS weekly,
       round(rest - (effect - centre), 6) AS remainder
FROM detrended JOIN effects USING (event_type, wd) JOIN centres USING (event_type)"""

ORACLE["month_extremes"] = """
WITH m AS (
    SELECT strftime(o_orderdate, '%Y-%m') AS month, round(avg(o_totalprice), 2) AS v FROM orders GROUP BY 1
)
SELECT (SELECT month FROM m ORDER BY v, month LIMIT 1) AS lowest_month, (SELECT min(v) FROM m) AS "lowest_avg_o_totalprice",
       (SELECT month FROM m ORDER BY v DESC, month LIMIT 1) AS highest_month, (SELECT max(v) FROM m) AS "highest_avg_o_totalprice"
"""
ORACLE["many_slices"] = """
SELECT * EXCLUDE (month), 'orders ' || month AS _source_file FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders)
"""

ORACLE["trend_breaks"] = """
WITH daily AS (
    SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, count(*) AS y FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT event_type, CAST(ts AS DATE), count(*) FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
), numbered AS (
    SELECT series, day, y, count(*) OVER w AS n, row_number() OVER (w ORDER BY day) AS i, avg(y) OVER w AS mean,
           CAST(date_diff('day', min(day) OVER w, day) AS DOUBLE) AS d
    FROM daily WINDOW w AS (PARTITION BY series)
), centred AS (
    SELECT *, d - avg(d) OVER (PARTITION BY series) AS x, y - mean AS z FROM numbered
), straight AS (
    SELECT series, sum(x * x) AS xx, sum(x * z) AS xy, sum(z * z) AS yy FROM centred GROUP BY series
), hinges AS (
    SELECT series, k.x AS k, k.day AS break_day, any_value(k.i) AS i, any_value(k.n) AS n, avg(greatest(c.x - k.x, 0)) AS mean_h,
           sum(greatest(c.x - k.x, 0) * greatest(c.x - k.x, 0)) - count(*) * avg(greatest(c.x - k.x, 0)) * avg(greatest(c.x - k.x, 0)) AS hh,
           sum(c.x * greatest(c.x - k.x, 0)) AS xh, sum(c.z * greatest(c.x - k.x, 0)) AS hy
    FROM centred k JOIN centred c USING (series) WHERE k.i >= 7 AND k.n - k.i >= 7 GROUP BY series, k.x, k.day
), fitted AS (
    SELECT *, (hh * xy - xh * hy) / (xx * hh - xh * xh) AS slope, (xx * hy - xh * xy) / (xx * hh - xh * xh) AS bend
    FROM hinges JOIN straight USING (series)
), gained AS (
    SELECT *, round((slope * xy + bend * hy - xy / xx * xy) / (yy - xy / xx * xy), 9) AS gain FROM fitted WHERE yy - xy / xx * xy > 1e-9 * yy
), best AS (
    SELECT * FROM gained QUALIFY row_number() OVER (PARTITION BY series ORDER BY gain DESC, k) = 1
)
SELECT series, day, y, CASE WHEN gain >= 0.001 THEN break_day END AS break_day, round(gain, 5) AS gain,
       round(mean + CASE WHEN gain >= 0.001 THEN slope * x + bend * (greatest(x - k, 0) - mean_h) ELSE coalesce(s.xy / s.xx, 0) * x END, 5) AS trend
FROM centred JOIN straight s USING (series) LEFT JOIN best USING (series)"""
