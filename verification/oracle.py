"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from tracewright.schema import CANONICAL, RAW

SIZE = 1000

# -- user-day log --------------------------------------------------------------------------------

_NULL_TEXTS = [
    "purchasing_document_id", "item_id", "document_type", "purchasing_document_category",
    "item_type", "item_category", "spend_area", "sub_spend_area", "spend_classification",
    "gr_based_invoice_verification", "goods_receipt_required", "source_file", "pipeline_batch_id",
]
_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULL_TEXTS)

_DELIVERY = f"""
    event_id // {SIZE} + 1 + (delivery - 1) * (SELECT max(event_id) // 1000 + 1 FROM events) AS ingestion_batch_sequence,
    'batch_' || lpad(CAST(event_id // {SIZE} + 1 + (delivery - 1) * (SELECT max(event_id) // 1000 + 1 FROM events) AS VARCHAR), 4, '0') AS ingestion_batch_id,
    TIMESTAMP '2026-01-01 08:00:00' + to_days(CAST(event_id // {SIZE} + (delivery - 1) * (SELECT max(event_id) // 1000 + 1 FROM events) AS INTEGER))
        AS simulated_ingestion_timestamp_utc,
    DATE '2026-01-01' + CAST(event_id // {SIZE} + (delivery - 1) * (SELECT max(event_id) // 1000 + 1 FROM events) AS INTEGER) AS simulated_ingestion_date,
    event_id % {SIZE} + 1 AS batch_row_number
"""

_A = f"""
deliveries AS (
    SELECT *, unnest(range(1, CASE WHEN event_id % 50 = 0 THEN 3 ELSE 2 END)) AS delivery FROM events
),
raw AS (
    SELECT event_id, user_id::VARCHAR || '_' || ts::DATE::VARCHAR AS case_id, user_id::VARCHAR AS case_name,
        CASE WHEN event_id % 2 = 0 THEN '  ' || event_type || ' ' ELSE event_type END AS activity,
        event_type AS clean_activity, ts AS event_timestamp, ts::DATE AS event_date,
        CASE day(ts) WHEN 1 THEN 'edge_period_before_main_window' WHEN 30 THEN 'edge_period_after_main_window'
            ELSE 'expected_period' END AS timestamp_quality_status,
        CASE WHEN event_id % 4 <> 0 THEN 'user_' || (user_id % 10)::VARCHAR END AS resource_id,
        value + delivery - 1 AS cumulative_net_worth_eur,
        'c' || (user_id % 4)::VARCHAR AS company_id, 'v' || (user_id % 20)::VARCHAR AS vendor_id,
        'events' AS source_system, event_id AS source_row_number,
        CAST(NULL AS TIMESTAMP) AS processing_timestamp_utc, {_NULLS}, delivery, {_DELIVERY}
    FROM deliveries
),
clean AS (SELECT * FROM raw WHERE delivery = 1),
newest AS (
    SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY event_id
        ORDER BY simulated_ingestion_timestamp_utc DESC, source_row_number DESC) = 1
),
normal AS (
    SELECT * EXCLUDE (activity, clean_activity, delivery), clean_activity AS activity,
        year(event_timestamp) AS event_year, month(event_timestamp) AS event_month
    FROM newest
),
sequenced AS (
    SELECT *,
        row_number() OVER w AS process_event_sequence,
        count(*) OVER (PARTITION BY case_id) AS process_event_count,
        lag(activity) OVER w AS previous_activity, lead(activity) OVER w AS next_activity,
        lag(event_timestamp) OVER w AS previous_event_timestamp,
        lead(event_timestamp) OVER w AS next_event_timestamp
    FROM normal
    WINDOW w AS (PARTITION BY case_id ORDER BY event_timestamp NULLS FIRST, source_row_number NULLS FIRST)
),
staged AS (
    SELECT *,
        date_sub('second', previous_event_timestamp, event_timestamp) AS seconds_since_previous_event,
        date_sub('second', event_timestamp, next_event_timestamp) AS seconds_to_next_event,
        process_event_sequence = 1 AS is_case_start,
        process_event_sequence = process_event_count AS is_case_end,
        timestamp_quality_status <> 'expected_period' AS is_timestamp_outlier,
        resource_id IS NULL AS is_resource_missing
    FROM sequenced
),
cases AS (
    SELECT case_id, min(case_name) AS case_name,
        min(event_timestamp) AS case_start_timestamp, max(event_timestamp) AS case_end_timestamp,
        date_sub('second', min(event_timestamp), max(event_timestamp)) AS case_duration_seconds,
        date_sub('hour', min(event_timestamp), max(event_timestamp)) AS case_duration_hours,
        date_sub('day', min(event_timestamp), max(event_timestamp)) AS case_duration_days,
        count(*) AS event_count, count(DISTINCT activity) AS distinct_activity_count,
        max(CASE WHEN is_case_start THEN activity END) AS start_activity,
        max(CASE WHEN is_case_end THEN activity END) AS end_activity,
        min(company_id) AS company_id, min(vendor_id) AS vendor_id,
        min(purchasing_document_id) AS purchasing_document_id, min(document_type) AS document_type,
        min(purchasing_document_category) AS purchasing_document_category,
        min(item_type) AS item_type, min(item_category) AS item_category, min(spend_area) AS spend_area,
        min(sub_spend_area) AS sub_spend_area, min(spend_classification) AS spend_classification,
        max(cumulative_net_worth_eur) AS maximum_cumulative_net_worth_eur,
        count_if(is_timestamp_outlier)::BIGINT AS timestamp_outlier_event_count,
        count_if(is_resource_missing)::BIGINT AS missing_resource_event_count,
        count(DISTINCT ingestion_batch_id) AS ingestion_batch_count,
        min(simulated_ingestion_date) AS first_ingestion_date, max(simulated_ingestion_date) AS last_ingestion_date
    FROM staged GROUP BY case_id
),
lists AS (
    SELECT case_id, list(activity ORDER BY process_event_sequence) AS path, list(resource_id) AS people
    FROM staged WHERE case_id IS NOT NULL GROUP BY case_id
),
kpis AS (
    SELECT case_id, case_name, case_start_timestamp, case_end_timestamp, case_duration_seconds,
        case_duration_hours, case_duration_days, len(path) AS event_count,
        len(list_distinct(path)) AS distinct_activity_count,
        len(path) - len(list_distinct(path)) AS repeated_activity_event_count,
        len(list_distinct(path)) < len(path) AS has_rework,
        (len(path) - len(list_distinct(path))) / len(path) AS rework_event_rate,
        len(list_distinct(people)) AS distinct_resource_count, missing_resource_event_count,
        missing_resource_event_count / len(path) AS missing_resource_rate, timestamp_outlier_event_count,
        timestamp_outlier_event_count = 0 AS is_analysis_ready, ingestion_batch_count,
        start_activity, end_activity, company_id, vendor_id, purchasing_document_id, document_type,
        purchasing_document_category, item_type, item_category, spend_area, sub_spend_area,
        spend_classification, maximum_cumulative_net_worth_eur, first_ingestion_date, last_ingestion_date
    FROM lists JOIN cases USING (case_id)
),
case_variants AS (SELECT case_id, nullif(array_to_string(path, ' -> '), '') AS process_variant FROM lists),
variant_statistics AS (
    SELECT process_variant, count(*) AS case_count,
        count_if(is_analysis_ready)::BIGINT AS analysis_ready_case_count,
        avg(CASE WHEN is_analysis_ready THEN case_duration_hours END) AS average_case_duration_hours,
        list_sort(list(CASE WHEN is_analysis_ready THEN case_duration_hours END) FILTER ((CASE WHEN is_analysis_ready THEN case_duration_hours END) IS NOT NULL))[(count(CASE WHEN is_analysis_ready THEN case_duration_hours END) * 5 + 9) // 10] AS median_case_duration_hours,
        list_sort(list(CASE WHEN is_analysis_ready THEN case_duration_hours END) FILTER ((CASE WHEN is_analysis_ready THEN case_duration_hours END) IS NOT NULL))[(count(CASE WHEN is_analysis_ready THEN case_duration_hours END) * 9 + 9) // 10] AS p90_case_duration_hours,
        avg(event_count) AS average_event_count, count_if(has_rework)::BIGINT AS rework_case_count,
        count_if(has_rework) / count(*) AS rework_case_rate
    FROM case_variants JOIN kpis USING (case_id) GROUP BY process_variant
),
variants AS (
    SELECT *, row_number() OVER (ORDER BY case_count DESC, process_variant NULLS FIRST) AS variant_rank,
        case_count / sum(case_count) OVER () AS case_share, sha256(process_variant) AS variant_id
    FROM variant_statistics
),
activities AS (
    SELECT activity, count(*) AS event_count, count(DISTINCT case_id) AS case_count,
        count(DISTINCT resource_id) AS distinct_resource_count,
        count_if(is_case_start)::BIGINT AS case_start_count, count_if(is_case_end)::BIGINT AS case_end_count,
        count_if(is_resource_missing)::BIGINT AS missing_resource_event_count,
        count_if(is_resource_missing) / count(*) AS missing_resource_rate,
        count_if(is_timestamp_outlier)::BIGINT AS timestamp_outlier_event_count,
        avg(seconds_since_previous_event) AS average_seconds_since_previous_event,
        list_sort(list(seconds_since_previous_event) FILTER ((seconds_since_previous_event) IS NOT NULL))[(count(seconds_since_previous_event) * 5 + 9) // 10] AS median_seconds_since_previous_event,
        list_sort(list(seconds_since_previous_event) FILTER ((seconds_since_previous_event) IS NOT NULL))[(count(seconds_since_previous_event) * 9 + 9) // 10] AS p90_seconds_since_previous_event,
        avg(seconds_to_next_event) AS average_seconds_to_next_event,
        list_sort(list(seconds_to_next_event) FILTER ((seconds_to_next_event) IS NOT NULL))[(count(seconds_to_next_event) * 5 + 9) // 10] AS median_seconds_to_next_event,
        list_sort(list(seconds_to_next_event) FILTER ((seconds_to_next_event) IS NOT NULL))[(count(seconds_to_next_event) * 9 + 9) // 10] AS p90_seconds_to_next_event
    FROM staged GROUP BY activity
),
transition_statistics AS (
    SELECT activity AS from_activity, next_activity AS to_activity, count(*) AS transition_count,
        count(DISTINCT case_id) AS case_count, avg(seconds_to_next_event) AS average_transition_seconds,
        list_sort(list(seconds_to_next_event) FILTER ((seconds_to_next_event) IS NOT NULL))[(count(seconds_to_next_event) * 5 + 9) // 10] AS median_transition_seconds,
        list_sort(list(seconds_to_next_event) FILTER ((seconds_to_next_event) IS NOT NULL))[(count(seconds_to_next_event) * 9 + 9) // 10] AS p90_transition_seconds,
        min(seconds_to_next_event) AS minimum_transition_seconds,
        max(seconds_to_next_event) AS maximum_transition_seconds
    FROM staged WHERE next_activity IS NOT NULL GROUP BY 1, 2
),
batches AS (
    SELECT ingestion_batch_id AS batch_id, ingestion_batch_sequence AS batch_sequence,
        simulated_ingestion_date, count(*) AS row_count, count(DISTINCT case_id) AS unique_case_count,
        count(DISTINCT activity) AS unique_activity_count, min(event_timestamp) AS minimum_event_timestamp,
        max(event_timestamp) AS maximum_event_timestamp,
        count_if(timestamp_quality_status = 'historical_outlier')::BIGINT AS historical_outlier_count,
        'READY' AS status
    FROM clean GROUP BY 1, 2, 3
),
publish_manifest AS (
    SELECT *, sha256(batch_id || '|' || row_count || '|' || unique_case_count) AS sha256,
        row_count * 30 AS file_size_bytes, 'raw/events/' || batch_id || '/events.parquet' AS landing_key,
        CASE batch_sequence % 3 WHEN 0 THEN 'UPLOAD' WHEN 1 THEN 'CONFLICT' ELSE 'SKIPPED' END AS decision
    FROM batches
),
publish_outcomes AS (
    SELECT batch_id, batch_sequence, landing_key, row_count, file_size_bytes, sha256,
        CASE WHEN decision <> 'UPLOAD' THEN decision WHEN batch_sequence % 6 = 0 THEN 'FAILED'
            ELSE 'UPLOADED' END AS status
    FROM publish_manifest
),
load_decisions AS (
    SELECT batch_id, batch_sequence, row_count AS actual,
        row_count + CASE WHEN batch_sequence % 7 = 0 THEN 1 ELSE 0 END AS expected_rows,
        row_count * (batch_sequence % 3) AS existing_rows, sha256(batch_id) AS sha256
    FROM batches
),
decided AS (
    SELECT *, CASE WHEN existing_rows = expected_rows THEN 'SKIPPED' WHEN existing_rows <> 0 THEN 'CONFLICT'
        ELSE 'LOAD' END AS decision FROM load_decisions
),
counted AS (
    SELECT *, CASE WHEN decision = 'LOAD' THEN actual ELSE existing_rows END AS loaded_rows FROM decided
),
history AS (
    SELECT 'run-1' AS run_id, batch_id, 'landing/raw/events/' || batch_id || '/events.parquet' AS landing_uri,
        expected_rows, loaded_rows,
        CASE WHEN decision <> 'LOAD' THEN decision WHEN loaded_rows = expected_rows THEN 'LOADED' ELSE 'FAILED' END AS status,
        CASE WHEN decision = 'LOAD' THEN 'job-1' END AS job_id, sha256,
        CASE WHEN decision = 'SKIPPED' THEN 'Expected batch row count already exists in raw.events.'
            WHEN decision = 'CONFLICT' THEN 'Partial or unexpected batch already exists in raw.events.'
            WHEN loaded_rows = expected_rows THEN 'Batch loaded successfully and row count reconciled.'
            ELSE printf('Expected %d rows after load, found %d.', expected_rows, loaded_rows) END AS message,
        TIMESTAMP '2026-02-01 12:00:00' AS load_timestamp_utc
    FROM counted
)
"""

# -- order log -----------------------------------------------------------------------------------

_ORDER_KEY = "ts, order_key, activity, line, part, supplier, price"
_B = f"""
order_events AS (
    SELECT o_orderkey AS order_key, 'Create Order' AS activity, o_orderdate AS ts, NULL::INTEGER AS line,
        NULL::BIGINT AS part, NULL::BIGINT AS supplier, o_totalprice AS price FROM orders
    UNION ALL
    SELECT l_orderkey, 'Ship ' || l_linestatus || l_returnflag, l_shipdate, l_linenumber, l_partkey,
        l_suppkey, l_extendedprice FROM lineitem
),
numbered AS (SELECT *, row_number() OVER (ORDER BY {_ORDER_KEY}) AS source_row_number FROM order_events),
parsed AS (
    SELECT *, order_key AS k, order_key::VARCHAR AS case_id,
        CASE WHEN k % 17 = 4 THEN NULL WHEN k % 3 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END AS event_timestamp,
        CASE WHEN k % 13 = 2 THEN NULL ELSE price END AS cumulative_net_worth_eur,
        CASE WHEN k % 5 > 1 THEN 'clerk_' || (k % 9) END AS resource_id,
        'company ' || (k % 4) AS company_id, (k // 4)::VARCHAR AS purchasing_document_id,
        'vendor ' || (k % 1975) AS vendor_id, 'orders' AS source_system, '0000' || (k % 49) AS item_id,
        CASE WHEN k % 7 <> 0 THEN 'area ' || (k % 21) END AS spend_area, 'type ' || (k % 3) AS document_type,
        CASE WHEN k % 7 <> 0 THEN 'sub ' || (k % 136) END AS sub_spend_area,
        'Purchase order' AS purchasing_document_category, 'item type ' || (k % 6) AS item_type,
        'item category ' || (k % 4) AS item_category,
        CASE WHEN k % 7 <> 0 THEN 'NPR' END AS spend_classification, 'name ' || (k % 1899) AS case_name,
        CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END AS gr_based_invoice_verification,
        CASE WHEN k % 3 <> 0 THEN 'True' ELSE 'False' END AS goods_receipt_required
    FROM numbered
),
classified AS (
    SELECT *, year(event_timestamp)::SMALLINT AS event_year, month(event_timestamp)::TINYINT AS event_month,
        event_timestamp::DATE AS event_date,
        CASE WHEN event_timestamp IS NULL THEN 'invalid_timestamp'
            WHEN year(event_timestamp) < 1996 THEN 'historical_outlier'
            WHEN year(event_timestamp) = 1996 THEN 'edge_period_before_main_window'
            WHEN year(event_timestamp) = 2001 THEN 'edge_period_after_main_window'
            ELSE 'expected_period' END AS timestamp_quality_status
    FROM parsed
),
canonical AS (
    SELECT *, source_row_number AS event_id, 'orders' AS source_file, 'order_snapshot' AS pipeline_batch_id,
        TIMESTAMP '2026-02-01 12:00:00' AS processing_timestamp_utc,
        row_number() OVER (PARTITION BY case_id ORDER BY event_timestamp NULLS LAST, source_row_number)::INTEGER
            AS event_sequence
    FROM classified
),
labelled AS (
    SELECT *, order_key::VARCHAR AS case_id,
        CASE order_key % 5 WHEN 0 THEN NULL WHEN 1 THEN order_key::VARCHAR ELSE activity END AS case_name
    FROM order_events
),
labels AS (
    SELECT case_id,
        arg_min(case_name, n) FILTER (case_name IS NOT NULL) AS case_name_first,
        count(DISTINCT case_name) AS case_name_unique_count, count(*) AS event_count
    FROM (SELECT *, row_number() OVER (ORDER BY {_ORDER_KEY}) AS n FROM labelled) GROUP BY case_id
),
label_rows AS (SELECT *, case_id = case_name_first AS case_id_equals_case_name FROM labels)
"""


def a(select: str) -> str:
    return f"WITH {_A}\n{select}"


def b(select: str) -> str:
    return f"WITH {_B}\n{select}"


def _list(names: list[str] | tuple[str, ...]) -> str:
    return ", ".join(names)


# -- batch rules ---------------------------------------------------------------------------------

_FAULTS = {
    "clean": "SELECT * FROM clean",
    "duplicate_events": "SELECT * FROM clean UNION ALL SELECT * FROM clean WHERE batch_row_number <= 25",
    "missing_case_id": "SELECT * REPLACE (CASE WHEN batch_row_number > 10 THEN case_id END AS case_id) FROM clean",
    "missing_timestamp": "SELECT * REPLACE (CASE WHEN batch_row_number > 5 THEN event_timestamp END AS event_timestamp) FROM clean",
    "schema_drift": "SELECT * REPLACE (NULL::VARCHAR AS activity) FROM clean",
    "duplicate_batch_delivery": "SELECT * FROM clean",
    "corrupted_parquet": "SELECT * FROM clean",
}
FAULTS = [f for f in _FAULTS if f != "clean"]

# What readers say of a file without its end, of one whose first data page is overwritten, and of none.
_CUT = """('ArrowInvalid: Parquet magic bytes not found in footer. Either the file is corrupted or this is not a '
    || 'parquet file.')"""
_OVERWRITTEN = "format('Only 0 of {} rows could be decoded.', row_count)"
_ABSENT = "'FileNotFoundError: no file with content was found for the batch.'"


def _suite(fault: str) -> str:
    """Rule rows of all batches delivered with a fault."""
    name = "batch_id" if fault == "clean" else f"'{fault}/' || batch_id"
    if fault == "corrupted_parquet":
        return f"""SELECT {name} AS dataset_name, batch_id, 1 AS rule_order, 'FILE_READABLE' AS rule_id,
            'FAIL' AS status, 1::BIGINT AS failed_rows, {_CUT} AS message FROM batches"""
    facts = f"""(SELECT ingestion_batch_id AS batch_id, count(*) AS n, count_if(case_id IS NULL)::BIGINT AS no_case,
        count_if(activity IS NULL)::BIGINT AS no_activity, count_if(event_timestamp IS NULL)::BIGINT AS no_time,
        count(*) - count(DISTINCT event_id) AS repeats FROM ({_FAULTS[fault]}) GROUP BY 1)
        JOIN (SELECT batch_id, row_count AS expected FROM batches) USING (batch_id)"""

    def rule(order: int, rule_id: str, status: str, failed: str, message: str) -> str:
        return f"""SELECT {name} AS dataset_name, batch_id, {order} AS rule_order, '{rule_id}' AS rule_id,
            {status} AS status, ({failed})::BIGINT AS failed_rows, {message} AS message FROM {facts}"""

    def missing(order: int, rule_id: str, column: str, count: str) -> str:
        if fault == "schema_drift" and column == "activity":
            return rule(order, rule_id, "'SKIPPED'", "0",
                        "'Column ''activity'' is unavailable because schema validation failed.'")
        return rule(
            order, rule_id, f"CASE WHEN {count} > 0 THEN 'FAIL' ELSE 'PASS' END", count,
            f"CASE WHEN {count} > 0 THEN format('{{:,}}', {count}) || ' rows contain NULL in {column}.'"
            f" ELSE 'Column ''{column}'' contains no NULL values.' END",
        )

    drift = fault == "schema_drift"
    again = fault == "duplicate_batch_delivery"
    return "\nUNION ALL ".join(
        [
            rule(1, "FILE_READABLE", "'PASS'", "0", "'Parquet file opened successfully.'"),
            rule(
                2, "DQ_SCHEMA_COLUMNS", "'FAIL'" if drift else "'PASS'", "2" if drift else "0",
                "'Missing columns: activity | Unexpected columns: activity_name'"
                if drift else "'Schema matches baseline.'",
            ),
            missing(3, "DQ_NOT_NULL_CASE_ID", "case_id", "no_case"),
            missing(4, "DQ_NOT_NULL_ACTIVITY", "activity", "no_activity"),
            missing(5, "DQ_NOT_NULL_EVENT_TIMESTAMP", "event_timestamp", "no_time"),
            rule(
                6, "DQ_UNIQUE_EVENT_ID", "CASE WHEN repeats > 0 THEN 'FAIL' ELSE 'PASS' END", "repeats",
                "CASE WHEN repeats > 0 THEN format('{:,}', repeats) || ' duplicate event_id values detected.'"
                " ELSE 'event_id is unique.' END",
            ),
            rule(
                7, "DQ_ROW_COUNT", "CASE WHEN n <> expected THEN 'FAIL' ELSE 'PASS' END", "abs(n - expected)",
                "CASE WHEN n <> expected THEN format('Expected {:,} rows, received {:,}.', expected, n)"
                " ELSE format('Row count matches expected value: {:,}.', expected) END",
            ),
            rule(8, "DQ_BATCH_ID", "'PASS'", "0", "'Batch identifier is ' || batch_id || '.'"),
            rule(
                9, "DQ_IDEMPOTENCY", "'FAIL'" if again else "'PASS'", "1" if again else "0",
                "batch_id || ' has already been processed.'" if again
                else "batch_id || ' has not previously been processed.'",
            ),
        ]
    )


def _rules(faults: list[str], rules: str | None = None) -> str:
    where = f"WHERE rule_id IN ({rules})" if rules else ""
    union = "\nUNION ALL ".join(_suite(f) for f in faults)
    return a(f"SELECT dataset_name, batch_id, rule_id, status, failed_rows, message FROM ({union}) {where}")


_NOT_NULL = "'DQ_NOT_NULL_CASE_ID', 'DQ_NOT_NULL_ACTIVITY', 'DQ_NOT_NULL_EVENT_TIMESTAMP'"
_FAULTY = "\nUNION ALL ".join(_suite(f) for f in FAULTS)
_PER_DATASET = """SELECT dataset_name, batch_id,
    CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status,
    count_if(status = 'FAIL')::BIGINT AS failed_rule_count,
    coalesce(string_agg(CASE WHEN status = 'FAIL' THEN rule_id END, ', ' ORDER BY rule_order), '') AS failed_rules"""
_EXPECTED = """CASE split_part(dataset_name, '/', 1) WHEN 'duplicate_events' THEN 'DQ_UNIQUE_EVENT_ID'
    WHEN 'missing_case_id' THEN 'DQ_NOT_NULL_CASE_ID' WHEN 'missing_timestamp' THEN 'DQ_NOT_NULL_EVENT_TIMESTAMP'
    WHEN 'schema_drift' THEN 'DQ_SCHEMA_COLUMNS' WHEN 'duplicate_batch_delivery' THEN 'DQ_IDEMPOTENCY'
    ELSE 'FILE_READABLE' END"""

# -- monitoring ----------------------------------------------------------------------------------

_MONITOR_STATISTICS = """
rs AS (SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM raw),
ss AS (SELECT count(*) AS n, count(DISTINCT case_id) AS cases, count_if(case_id IS NULL)::BIGINT AS no_case,
    count_if(activity IS NULL)::BIGINT AS no_activity, count_if(event_timestamp IS NULL)::BIGINT AS no_time,
    count_if(seconds_since_previous_event < 0 OR seconds_to_next_event < 0)::BIGINT AS negative,
    count_if(is_timestamp_outlier)::BIGINT AS outliers, count_if(is_resource_missing)::BIGINT AS no_resource FROM staged),
cs AS (SELECT count(*) AS n FROM cases),
qs AS (SELECT count(*) AS n, count_if(lo <> 1 OR hi <> c OR d <> c)::BIGINT AS bad FROM (
    SELECT case_id, count(*) AS c, count(DISTINCT process_event_sequence) AS d, min(process_event_sequence) AS lo,
        max(process_event_sequence) AS hi FROM staged GROUP BY case_id)),
bs AS (SELECT count(*) AS n, count_if(coalesce(actual, 0) <> expected_rows)::BIGINT AS bad FROM (
    SELECT batch_id, expected_rows FROM history
    QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY load_timestamp_utc DESC) = 1)
    LEFT JOIN (SELECT ingestion_batch_id AS batch_id, count(*) AS actual FROM raw GROUP BY 1) USING (batch_id))
"""


def _monitor_rule(rule_id: str, name: str, severity: str, failed: str, total: str, message: str, source: str) -> str:
    bad = "FAIL" if severity == "CRITICAL" else "WARN"
    return f"""SELECT 'run-1' AS run_id, TIMESTAMP '2026-02-01 12:00:00' AS run_timestamp_utc, '{rule_id}' AS rule_id,
        '{name}' AS rule_name, '{severity}' AS severity,
        CASE WHEN ({failed}) = 0 THEN 'PASS' ELSE '{bad}' END AS status, ({failed})::BIGINT AS failed_rows,
        ({total})::BIGINT AS total_rows, ({failed}) / nullif({total}, 0) AS failure_rate, {message} AS message
        FROM {source}"""


_MONITOR_RULES = {
    "DQ_RAW_EVENT_ID_UNIQUE": _monitor_rule(
        "DQ_RAW_EVENT_ID_UNIQUE", "RAW event identifiers are unique", "CRITICAL", "n - ids", "n",
        "printf('RAW contains %d rows and %d unique event IDs.', n, ids)", "rs"),
    "DQ_RAW_STAGING_ROW_RECONCILIATION": _monitor_rule(
        "DQ_RAW_STAGING_ROW_RECONCILIATION", "RAW and STAGING row counts reconcile", "CRITICAL",
        "abs(rs.n - ss.n)", "rs.n", "printf('RAW rows: %d; STAGING rows: %d.', rs.n, ss.n)", "rs, ss"),
    "DQ_CASE_RECONCILIATION": _monitor_rule(
        "DQ_CASE_RECONCILIATION", "STAGING event cases reconcile with case table", "CRITICAL",
        "abs(ss.cases - cs.n)", "ss.cases",
        "printf('Event-log cases: %d; case-table rows: %d.', ss.cases, cs.n)", "ss, cs"),
    "DQ_MANDATORY_EVENT_FIELDS": _monitor_rule(
        "DQ_MANDATORY_EVENT_FIELDS", "Mandatory process-mining fields are populated", "CRITICAL",
        "no_case + no_activity + no_time", "n",
        "printf('Missing case_id: %d; activity: %d; timestamp: %d.', no_case, no_activity, no_time)", "ss"),
    "DQ_PROCESS_SEQUENCE_INTEGRITY": _monitor_rule(
        "DQ_PROCESS_SEQUENCE_INTEGRITY", "Event sequence is complete within each case", "CRITICAL", "bad", "n",
        "printf('%d cases contain invalid process-event sequences.', bad)", "qs"),
    "DQ_BATCH_LOAD_RECONCILIATION": _monitor_rule(
        "DQ_BATCH_LOAD_RECONCILIATION", "Loaded batch row counts match expected row counts", "CRITICAL", "bad", "n",
        "printf('%d of %d ingestion batches fail row-count reconciliation.', bad, n)", "bs"),
    "DQ_NEGATIVE_PROCESS_DURATION": _monitor_rule(
        "DQ_NEGATIVE_PROCESS_DURATION", "Inter-event durations are non-negative", "CRITICAL", "negative", "n",
        "printf('%d events contain negative inter-event durations.', negative)", "ss"),
    "MON_TIMESTAMP_QUALITY": _monitor_rule(
        "MON_TIMESTAMP_QUALITY", "Known timestamp-quality anomalies are monitored", "WARNING", "outliers", "n",
        "printf('%d events are outside the expected timestamp period.', outliers)", "ss"),
    "MON_MISSING_RESOURCE": _monitor_rule(
        "MON_MISSING_RESOURCE", "Missing event resources are monitored", "WARNING", "no_resource", "n",
        "printf('%d events have no resource identifier.', no_resource)", "ss"),
}
_MONITORED = "\nUNION ALL ".join(_MONITOR_RULES.values())


def m(select: str) -> str:
    return f"WITH {_A}, {_MONITOR_STATISTICS}, results AS ({_MONITORED})\n{select}"


_RUN_SUMMARY = """SELECT 'run-1' AS run_id, TIMESTAMP '2026-02-01 12:00:00' AS run_timestamp_utc,
    count(*) AS rules_executed, count_if(status = 'PASS')::BIGINT AS passed_rules,
    count_if(status = 'WARN')::BIGINT AS warning_rules, count_if(status = 'FAIL')::BIGINT AS failed_rules,
    CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(status = 'WARN') > 0 THEN 'WARN'
        ELSE 'PASS' END AS overall_status FROM results"""

# -- columns -------------------------------------------------------------------------------------

_STAGED_TEXTS = (
    "case_id, case_name, activity, resource_id, company_id, vendor_id, purchasing_document_id, item_id, "
    "document_type, purchasing_document_category, item_type, item_category, spend_area, sub_spend_area, "
    "spend_classification, source_system"
)
_STAGED_COLUMNS = (
    f"event_id, {_STAGED_TEXTS}, event_timestamp, event_date, event_year, event_month, "
    "cumulative_net_worth_eur, gr_based_invoice_verification, goods_receipt_required, "
    "timestamp_quality_status, source_file, source_row_number, pipeline_batch_id, ingestion_batch_id, "
    "ingestion_batch_sequence, simulated_ingestion_timestamp_utc, simulated_ingestion_date, batch_row_number, "
    "processing_timestamp_utc, process_event_sequence, process_event_count, previous_activity, next_activity, "
    "previous_event_timestamp, next_event_timestamp, seconds_since_previous_event, seconds_to_next_event, "
    "is_case_start, is_case_end, is_timestamp_outlier, is_resource_missing"
)
_PERCENT = "round(100.0 * count(*) / sum(count(*)) OVER (), {})"


def _hours(earlier: str, later: str) -> str:
    return f"round(((epoch_us({later}) - epoch_us({earlier})) / 1000000) / 3600, 2)"


_CASE_PROFILE = f"""SELECT case_id, count(*) AS event_count, min(event_timestamp) AS first_event,
    max(event_timestamp) AS last_event, count(DISTINCT activity) AS unique_activity_count,
    {_hours('min(event_timestamp)', 'max(event_timestamp)')} AS case_duration_hours
    FROM clean WHERE case_id IS NOT NULL GROUP BY case_id"""
_CLEAN_PROFILE = _CASE_PROFILE.replace("DISTINCT activity", "DISTINCT clean_activity")

_CUSTOMER_TYPES = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
    "c_mktsegment": "string",
}


def _column_profile(table: str, types: dict[str, str], percentage: bool) -> str:
    rate = "CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0 * count_if({c} IS NULL) / count(*), 4) END AS null_percentage,"
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count_if({c} IS NULL)::BIGINT AS null_count,
        {rate.format(c=c) if percentage else ''} count(DISTINCT {c}) AS unique_value_count FROM {table}"""
        for c, t in types.items()
    )


def _top_values(field: str, data_type: str) -> str:
    return f"""SELECT '{field}' AS column_name, '{data_type}' AS data_type,
        (SELECT count_if({field} IS NULL)::BIGINT FROM customer) AS null_count,
        (SELECT count(DISTINCT {field}) FROM customer) AS unique_count,
        row_number() OVER (ORDER BY count(*) DESC, {field}::VARCHAR NULLS FIRST) AS value_rank,
        {field}::VARCHAR AS value, count(*) AS event_count
        FROM customer GROUP BY {field} QUALIFY value_rank <= 20"""


_KPI = (
    "case_id, case_name, case_start_timestamp, case_end_timestamp, case_duration_seconds, case_duration_hours, "
    "case_duration_days, event_count, distinct_activity_count, repeated_activity_event_count, has_rework, "
    "rework_event_rate, distinct_resource_count, missing_resource_event_count, missing_resource_rate, "
    "timestamp_outlier_event_count, is_analysis_ready, ingestion_batch_count, start_activity, end_activity, "
    "company_id, vendor_id, purchasing_document_id, document_type, purchasing_document_category, item_type, "
    "item_category, spend_area, sub_spend_area, spend_classification, maximum_cumulative_net_worth_eur, "
    "first_ingestion_date, last_ingestion_date"
)
_MANIFEST = (
    "batch_id, batch_sequence, simulated_ingestion_date, row_count, unique_case_count, unique_activity_count, "
    "minimum_event_timestamp, maximum_event_timestamp, historical_outlier_count, status"
)
_BATCH_ROWS = "row_number() OVER (ORDER BY event_timestamp NULLS LAST, source_row_number)"
_USER = """CASE WHEN order_key % 5 = 0 THEN 'NONE' WHEN order_key % 11 = 3 THEN NULL
    ELSE ' clerk_' || (order_key % 9) END"""
_RESOURCE = """CASE order_key % 5 WHEN 0 THEN 'NONE' WHEN 1 THEN ' none ' ELSE 'clerk_' || (order_key % 9) END"""
_PAIRS = f"(SELECT {_USER} AS u, {_RESOURCE} AS r FROM order_events)"
_STATUS_COUNTS = """(SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM (
    SELECT status, count(*) AS n FROM {} GROUP BY status))"""
_RAW_METRICS = """count(*) AS total_rows, count(DISTINCT event_id) AS unique_event_ids,
    count(DISTINCT case_id) AS unique_cases, count(DISTINCT activity) AS unique_activities,
    count(DISTINCT ingestion_batch_id) AS ingestion_batches"""

_ORACLES: dict[str, str] = {
    # sources and sinks
    "src_xes_log": """SELECT user_id::VARCHAR || '_' || ts::DATE::VARCHAR AS case_id,
        'user <' || user_id || '>' AS case_name, event_type AS activity, 'user_' || (user_id % 10) AS resource_id,
        NULL::VARCHAR AS vendor_id, user_id % 2 = 0 AS goods_receipt_required, ts AS event_timestamp,
        value AS net_worth FROM events""",
    "std_file_order_numbers": f"""SELECT row_number() OVER (ORDER BY case_id, event_id // {SIZE}, event_id)
            AS source_row_number, case_id, event_type AS activity, ts AS event_timestamp, true AS in_several_files
        FROM (SELECT *, user_id::VARCHAR || '_' || ts::DATE::VARCHAR AS case_id FROM events)""",
    "src_canonical_scan": b("""SELECT event_year, event_month, count(*) AS event_count,
        count(resource_id) AS known_resources FROM canonical GROUP BY 1, 2"""),
    "snk_canonical_events": b("""SELECT event_id, case_id, activity, event_sequence, event_timestamp, event_year,
        event_month FROM canonical"""),
    "snk_batch_files": a("""SELECT ingestion_batch_id, 1::BIGINT AS file_count, count(*) AS row_count,
        min(batch_row_number) AS first_row, max(batch_row_number) AS last_row, min(event_id) AS least_event_id,
        max(event_id) AS greatest_event_id FROM clean GROUP BY 1"""),
    "src_landed_batches": a(f"""SELECT batch_id, batch_sequence % 4 IN (0, 3) AS readable,
        CASE batch_sequence % 4 WHEN 1 THEN {_CUT} WHEN 2 THEN {_OVERWRITTEN} END AS read_message,
        CASE batch_sequence % 4 WHEN 1 THEN 0 ELSE {len(RAW)} END::BIGINT AS column_count FROM batches"""),
    "src_manifest": a(f"""SELECT {_MANIFEST}, NULL::VARCHAR AS file_name, NULL::BIGINT AS file_size_bytes,
        NULL::VARCHAR AS sha256 FROM batches"""),
    "src_file_inventory": a("""SELECT batch_id, true AS has_bytes, 64::BIGINT AS digest_length, true AS same_as_copy
        FROM batches"""),
    "src_given_file_digests": """SELECT parse_filename(filename) AS file_name, size AS file_size_bytes,
        sha256(content) AS sha256 FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
    "snk_raw_append": a("""SELECT event_id, case_id, ingestion_batch_sequence + i AS ingestion_batch_sequence,
        simulated_ingestion_date FROM clean, (VALUES (0), (1)) AS t(i)"""),
    "snk_replaced_tables": a("SELECT event_id, event_date, case_id, activity, process_event_sequence FROM staged"),
    "snk_audit_tables": a("""SELECT run AS run_id, batch_id, expected_rows, loaded_rows, status, message,
        load_timestamp_utc, load_timestamp_utc::DATE AS run_date
        FROM history, (VALUES ('run-1'), ('run-2')) AS t(run)"""),
    "snk_table_layouts": a("""SELECT table_name, row_count::BIGINT AS row_count, 0::BIGINT AS crossing_files FROM (
        SELECT 'raw_events' AS table_name, (SELECT count(*) FROM raw) AS row_count
        UNION ALL SELECT 'staging_events', (SELECT count(*) FROM staged)
        UNION ALL SELECT 'staging_cases', (SELECT count(*) FROM cases)
        UNION ALL SELECT 'analytics_case_kpis', (SELECT count(*) FROM kpis)
        UNION ALL SELECT 'analytics_activity_performance', (SELECT count(*) FROM activities)
        UNION ALL SELECT 'analytics_transitions', (SELECT count(*) FROM transition_statistics)
        UNION ALL SELECT 'history', (SELECT count(*) FROM history))"""),
    "snk_event_samples": a("""SELECT report, event_id, case_id, clean_activity AS activity, event_timestamp, resource_id
        FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS nth FROM clean)
        JOIN (VALUES ('events', 5000), ('canonical', 1000)) AS t(report, most) ON nth <= most"""),
    "snk_reports": a(f"SELECT * FROM ({_CLEAN_PROFILE}) ORDER BY case_id LIMIT 1000"),
    # standardisation
    "std_renamed_columns": b(f"""SELECT source_row_number, '  ' || activity || chr(9) AS activity,
        CASE WHEN k % 17 = 4 THEN 'unknown' WHEN k % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
            WHEN k % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS event_timestamp,
        {_RESOURCE} AS resource_id,
        CASE WHEN k % 13 = 2 THEN 'n/a' ELSE price::VARCHAR END AS cumulative_net_worth_eur,
        CASE WHEN k % 7 = 0 THEN ' ' ELSE spend_area END AS spend_area, company_id, document_type,
        CASE WHEN k % 7 = 0 THEN '' ELSE sub_spend_area END AS sub_spend_area, k // 4 AS purchasing_document_id,
        purchasing_document_category, vendor_id, item_type, item_category, spend_classification, source_system,
        case_name, k % 2 = 0 AS gr_based_invoice_verification, item_id, ' ' || case_id AS case_id,
        k % 3 <> 0 AS goods_receipt_required FROM parsed"""),
    "std_row_numbers": b("SELECT *, source_row_number AS event_id FROM numbered"),
    "std_text_cleaning": b("""SELECT case_id, resource_id, company_id, purchasing_document_id, vendor_id,
        source_system, item_id, activity, spend_area, document_type, sub_spend_area, purchasing_document_category,
        item_type, item_category, spend_classification, case_name, gr_based_invoice_verification,
        goods_receipt_required FROM parsed"""),
    "std_missing_resources": b("SELECT resource_id, count(*) AS event_count FROM parsed GROUP BY 1"),
    "std_timestamps": b("SELECT case_id, activity, event_timestamp FROM parsed"),
    "std_numbers": b("SELECT case_id, activity, cumulative_net_worth_eur FROM parsed"),
    "std_calendar_parts": b("SELECT case_id, event_timestamp, event_year, event_month, event_date FROM classified"),
    "std_timestamp_quality": b("SELECT case_id, event_timestamp, timestamp_quality_status FROM classified"),
    "std_lineage": b("""SELECT case_id, activity, source_file, pipeline_batch_id, processing_timestamp_utc
        FROM canonical"""),
    "std_event_sequence": b("SELECT event_id, case_id, event_timestamp, event_sequence FROM canonical"),
    "std_canonical_events": b(f"SELECT {_list(CANONICAL.names)} FROM canonical"),
    # profiles
    "prf_columns": _column_profile("customer", _CUSTOMER_TYPES, True),
    "prf_canonical_schema": b(_column_profile(
        "canonical", {f.name: f.dataType.simpleString() for f in CANONICAL}, False)),
    "prf_activities": b(f"""SELECT coalesce(nullif(activity, 'Ship OA'), '<MISSING_ACTIVITY>') AS activity,
        count(*) AS event_count, {_PERCENT.format(4)} AS event_percentage FROM order_events GROUP BY 1"""),
    "prf_cases": a(_CLEAN_PROFILE),
    "prf_log": a(f"""SELECT * FROM (SELECT count(*) AS event_count, {len(RAW)}::BIGINT AS column_count,
        count(DISTINCT case_id) AS case_count, count(DISTINCT clean_activity) AS activity_count,
        min(event_timestamp) AS period_start, max(event_timestamp) AS period_end,
        count_if(case_id IS NULL)::BIGINT AS missing_case_id_count,
        count_if(activity IS NULL)::BIGINT AS missing_activity_count,
        count_if(event_timestamp IS NULL)::BIGINT AS invalid_timestamp_count FROM clean),
        (SELECT min(event_count) AS minimum_events_per_case, median(event_count) AS median_events_per_case,
        round(avg(event_count), 4) AS mean_events_per_case, max(event_count) AS maximum_events_per_case,
        round(min(case_duration_hours), 4) AS minimum_case_duration_hours,
        round(median(case_duration_hours), 4) AS median_case_duration_hours,
        round(avg(case_duration_hours), 4) AS mean_case_duration_hours,
        round(max(case_duration_hours), 4) AS maximum_case_duration_hours FROM ({_CLEAN_PROFILE}))"""),
    "prf_years": b(f"""SELECT year(event_timestamp) AS event_year, count(*) AS event_count,
        {_PERCENT.format(6)} AS event_percentage FROM parsed GROUP BY 1"""),
    "prf_earliest_events": b(f"""SELECT ts, order_key, activity, line, price FROM order_events
        ORDER BY {_ORDER_KEY} LIMIT 200"""),
    "prf_largest_cases": b(f"""SELECT order_key::VARCHAR AS case_id, count(*) AS event_count,
        count(DISTINCT activity) AS unique_activity_count, min(ts) AS first_event, max(ts) AS last_event,
        arg_min(supplier, source_row_number) FILTER (supplier IS NOT NULL) AS vendor,
        arg_min(line, source_row_number) FILTER (line IS NOT NULL) AS item,
        {_hours('min(ts)', 'max(ts)')} AS duration_hours
        FROM numbered GROUP BY 1 ORDER BY event_count DESC, case_id LIMIT 200"""),
    "prf_column_agreement": b(f"""SELECT unnest(['row_count', 'missing_user_count', 'missing_resource_count',
        'equal_non_null_values', 'unique_user_values', 'unique_resource_values']) AS metric,
        unnest([count(*), count_if(u IS NULL)::BIGINT, count_if(r IS NULL)::BIGINT,
        count_if(trim(u) = trim(r))::BIGINT, count(DISTINCT u), count(DISTINCT r)]) AS value FROM {_PAIRS}"""),
    "prf_value_pairs": b(f"""SELECT u AS user_value, r AS resource_value, count(*) AS event_count FROM {_PAIRS}
        GROUP BY 1, 2 ORDER BY event_count DESC, u NULLS FIRST, r NULLS FIRST LIMIT 500"""),
    "prf_case_labels": b("SELECT * FROM label_rows"),
    "prf_case_label_summary": b("""SELECT count(*) AS case_count,
        count_if(case_name_first IS NULL)::BIGINT AS case_name_missing_count,
        count_if(case_name_unique_count > 1)::BIGINT AS cases_with_multiple_names,
        count_if(case_id_equals_case_name)::BIGINT AS cases_where_id_equals_name FROM label_rows"""),
    "prf_top_values": "\nUNION ALL ".join(
        f"({_top_values(f, _CUSTOMER_TYPES[f])})" for f in ("c_mktsegment", "c_nationkey", "c_name")),
    "prf_field_profile": "\nUNION ALL ".join(
        f"""SELECT column_name, data_type, null_count, unique_count,
            string_agg(coalesce(value, 'NULL') || '=' || event_count, ';' ORDER BY value_rank) AS top_values
        FROM ({_top_values(f, _CUSTOMER_TYPES[f])}) GROUP BY ALL""" for f in ("c_mktsegment", "c_nationkey", "c_name")),
    "prf_standardization_summary": b("""SELECT count(*) AS row_count, count(DISTINCT case_id) AS case_count,
        count(DISTINCT activity) AS activity_count, 25::BIGINT AS column_count,
        count_if(resource_id IS NULL)::BIGINT AS resource_missing_count_after_normalization,
        count_if(case_id IS NULL)::BIGINT AS case_id_missing_count,
        count_if(activity IS NULL)::BIGINT AS activity_missing_count,
        count_if(event_timestamp IS NULL)::BIGINT AS timestamp_missing_count,
        min(event_timestamp) AS period_start, max(event_timestamp) AS period_end,
        (SELECT count(*) FROM (SELECT DISTINCT event_year, event_month FROM classified)) AS partition_count,
        (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM classified GROUP BY case_id, activity,
            event_timestamp, resource_id, purchasing_document_id, item_id) WHERE n > 1)
            AS potential_duplicate_event_row_count,
        (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT timestamp_quality_status AS s, count(*) AS n
            FROM classified GROUP BY 1)) AS timestamp_quality_counts FROM classified"""),
    "prf_potential_duplicates": b("""SELECT coalesce(sum(n), 0)::BIGINT AS potential_duplicate_event_row_count
        FROM (SELECT count(*) AS n FROM parsed GROUP BY case_id, activity, event_timestamp, resource_id,
        purchasing_document_id, item_id) WHERE n > 1"""),
    "prf_timestamp_quality": b(f"""SELECT timestamp_quality_status, count(*) AS event_count,
        {_PERCENT.format(6)} AS event_percentage FROM classified GROUP BY 1"""),
    "prf_outlier_activities": b("""SELECT event_year::BIGINT AS event_year, activity, count(*) AS event_count
        FROM classified WHERE timestamp_quality_status = 'historical_outlier' GROUP BY 1, 2"""),
    # batches and loading
    "ing_key_integrity": a("""SELECT count_if(event_id IS NULL)::BIGINT AS missing_event_ids,
        count(event_id) - count(DISTINCT event_id) AS repeated_event_ids FROM raw"""),
    "ing_chronological_batches": b(f"""SELECT event_id, 'batch_' || lpad(((n - 1) // {SIZE} + 1)::VARCHAR, 4, '0')
        AS ingestion_batch_id, (n - 1) % {SIZE} + 1 AS batch_row_number
        FROM (SELECT event_id, {_BATCH_ROWS} AS n FROM canonical)"""),
    "ing_delivery_metadata": a("""SELECT event_id, event_timestamp, ingestion_batch_id, ingestion_batch_sequence,
        simulated_ingestion_timestamp_utc, simulated_ingestion_date, batch_row_number FROM clean"""),
    "ing_batch_manifest": a(f"SELECT {_MANIFEST} FROM batches"),
    "ing_batch_set_check": a("""SELECT sum(row_count)::BIGINT AS batch_rows,
        count(*) - count(DISTINCT batch_id) AS repeated_batch_ids, (SELECT count(*) FROM clean) AS input_rows,
        0::BIGINT AS missing_files, true AS batches_valid FROM batches"""),
    "ing_batch_summary": a(f"""SELECT count(*) AS batch_count, {SIZE}::BIGINT AS configured_batch_size,
        sum(row_count)::BIGINT AS total_row_count, min(simulated_ingestion_date) AS first_simulated_ingestion_date,
        max(simulated_ingestion_date) AS last_simulated_ingestion_date,
        min(row_count) AS smallest_batch_row_count, max(row_count) AS largest_batch_row_count,
        (SELECT count(DISTINCT case_id) FROM clean) AS canonical_case_count,
        (SELECT count(DISTINCT clean_activity) FROM clean) AS canonical_activity_count FROM batches"""),
    "ing_file_integrity": a("""SELECT batch_id, CASE batch_sequence % 4 WHEN 1 THEN 'MISSING'
        WHEN 2 THEN 'SIZE_MISMATCH' WHEN 3 THEN 'HASH_MISMATCH' ELSE 'OK' END AS integrity FROM batches"""),
    "ing_publish_decisions": a("""SELECT batch_id, batch_sequence, landing_key, row_count, file_size_bytes, sha256,
        decision FROM publish_manifest"""),
    "ing_publish_outcomes": a("""SELECT *, CASE status
        WHEN 'SKIPPED' THEN 'Identical object already exists in Cloud Storage.'
        WHEN 'CONFLICT' THEN 'Object already exists but SHA-256 metadata differs.'
        WHEN 'FAILED' THEN 'Remote object size does not match local file size.'
        ELSE 'Upload completed and remote object size verified.' END AS message FROM publish_outcomes"""),
    "ing_publish_run": a("""SELECT attempt::BIGINT AS attempt, batch_id,
        'raw/events/' || batch_id || '/events.parquet' AS landing_key, row_count, status, message
        FROM batches, (VALUES (1, 'UPLOADED', 'Upload completed and remote object size verified.'),
        (2, 'SKIPPED', 'Identical object already exists in Cloud Storage.')) AS t(attempt, status, message)
        """.replace("FROM batches", "FROM (SELECT batch_id, row_count FROM batches)")),
    "ing_publish_gate": """SELECT true AS clean_validation_success, true AS failure_detection_success,
        0::BIGINT AS failed_batches, true AS may_publish""",
    "ing_publish_gate_refused": a("""SELECT false AS clean_validation_success, true AS failure_detection_success,
        count(*) AS failed_batches, false AS may_publish FROM batches WHERE batch_sequence % 3 = 0"""),
    "ing_validated_manifest": a("SELECT batch_id, row_count FROM batches"),
    "ing_publish_summary": a(f"""SELECT count(*) AS batch_count,
        count_if(status IN ('UPLOADED', 'SKIPPED'))::BIGINT AS successful_batches, sum(row_count)::BIGINT AS total_rows,
        sum(file_size_bytes)::BIGINT AS total_bytes, count_if(status IN ('UPLOADED', 'SKIPPED')) = count(*)
        AS upload_success, {_STATUS_COUNTS.format('publish_outcomes')} AS status_counts FROM publish_outcomes"""),
    "ing_existing_rows": a("SELECT batch_id, existing_rows FROM load_decisions"),
    "ing_load_decisions": a("""SELECT batch_id, batch_sequence, expected_rows, existing_rows, sha256, decision
        FROM decided"""),
    "ing_load_outcomes": a("SELECT * FROM history"),
    "ing_admitted_decisions": a("""SELECT batch_id, expected_rows, actual AS landed_rows, 'LOAD' AS decision
        FROM load_decisions WHERE batch_sequence <= coalesce((SELECT min(batch_sequence) FROM load_decisions
        WHERE expected_rows <> actual), 9223372036854775807)"""),
    "ing_load_run": a("""SELECT run_id, batch_id, row_count AS expected_rows, row_count AS loaded_rows, status, message
        FROM (SELECT batch_id, row_count FROM batches),
        (VALUES ('run-1', 'LOADED', 'Batch loaded successfully and row count reconciled.'),
        ('run-2', 'SKIPPED', 'Expected batch row count already exists in raw.events.')) AS t(run_id, status, message)"""),
    "ing_incremental_stream": a("""SELECT 'run-1' AS run_id, batch_id, row_count AS expected_rows,
        row_count AS loaded_rows, 'LOADED' AS status FROM batches"""),
    "ing_stream_late_manifest": a("""SELECT 'run-1' AS run_id, batch_id, row_count AS loaded_rows, 'LOADED' AS status
        FROM batches WHERE batch_sequence % 2 = 1 UNION ALL
        SELECT 'run-2', batch_id, row_count, CASE WHEN batch_sequence % 2 = 1 THEN 'SKIPPED' ELSE 'LOADED' END
        FROM batches"""),
    "ing_raw_reconciliation": a(f"""SELECT {_RAW_METRICS}, count(*) AS expected_rows,
        count(DISTINCT ingestion_batch_id) AS expected_batches, count(*) = count(DISTINCT event_id) AS raw_load_success
        FROM raw"""),
    "ing_rows_per_batch": a("SELECT ingestion_batch_id, count(*) AS row_count FROM raw GROUP BY 1"),
    "ing_load_audit": a("""SELECT batch_id, expected_rows, loaded_rows, status, job_id, load_timestamp_utc
        FROM history"""),
    "ing_load_summary": a(f"""SELECT count(*) AS batches_processed,
        count_if(status IN ('LOADED', 'SKIPPED'))::BIGINT AS successful_batches,
        count_if(status IN ('LOADED', 'SKIPPED')) = count(*) AS raw_load_success,
        {_STATUS_COUNTS.format('history')} AS status_counts, r.* FROM history,
        (SELECT {_RAW_METRICS} FROM raw) AS r GROUP BY ALL"""),
    # batch validation
    "val_file_readable": a(f"""SELECT batch_id AS dataset_name, batch_id, 'FILE_READABLE' AS rule_id, 'FAIL' AS status,
            1::BIGINT AS failed_rows,
            CASE batch_sequence % 4 WHEN 1 THEN {_CUT} WHEN 2 THEN {_OVERWRITTEN} ELSE {_ABSENT} END AS message
        FROM batches WHERE batch_sequence % 4 > 0
        UNION ALL SELECT dataset_name, batch_id, rule_id, status, failed_rows, message FROM ({_suite("clean")})
        WHERE batch_id IN (SELECT batch_id FROM batches WHERE batch_sequence % 4 = 0)"""),
    "val_schema_baseline": a("""SELECT batch_id AS dataset_name, batch_id, 'DQ_SCHEMA_COLUMNS' AS rule_id,
        CASE batch_sequence WHEN 1 THEN 'PASS' ELSE 'FAIL' END AS status,
        CASE batch_sequence WHEN 1 THEN 0 ELSE 1 END::BIGINT AS failed_rows,
        CASE batch_sequence WHEN 1 THEN 'Schema matches baseline.' ELSE 'Unexpected columns: spend_area' END AS message
        FROM batches"""),
    "val_schema_columns": _rules(["schema_drift"], "'DQ_SCHEMA_COLUMNS', 'DQ_NOT_NULL_ACTIVITY'"),
    "val_not_null": _rules(["missing_case_id", "missing_timestamp"], _NOT_NULL),
    "val_unique_event_id": _rules(["duplicate_events"], "'DQ_UNIQUE_EVENT_ID'"),
    "val_row_count": _rules(["duplicate_events"], "'DQ_ROW_COUNT'"),
    "val_batch_id": a("""SELECT 'block_' || blk AS dataset_name, expected AS batch_id, 'DQ_BATCH_ID' AS rule_id,
        CASE WHEN lo <> hi OR lo <> expected THEN 'FAIL' ELSE 'PASS' END AS status,
        CASE WHEN lo <> hi OR lo <> expected THEN n ELSE 0 END AS failed_rows,
        CASE WHEN lo <> hi THEN 'Batch contains multiple or zero ingestion_batch_id values.'
            WHEN lo <> expected THEN 'Expected ' || expected || ', received ' || lo || '.'
            ELSE 'Batch identifier is ' || lo || '.' END AS message
        FROM (SELECT event_id // 750 AS blk, 'batch_' || lpad((min(event_id) // 750 + 1)::VARCHAR, 4, '0') AS expected,
            min(ingestion_batch_id) AS lo, max(ingestion_batch_id) AS hi, count(*) AS n FROM clean GROUP BY 1)"""),
    "val_idempotency": _rules(["duplicate_batch_delivery", "clean"], "'DQ_IDEMPOTENCY'"),
    "val_rule_results": _rules(["clean"]),
    "val_files": _rules(["clean"]),
    "val_clean_batches": a(f"""SELECT * EXCLUDE (batch_id), 'clean' AS dataset_type
        FROM ({_PER_DATASET} FROM ({_suite('clean')}) GROUP BY 1, 2)"""),
    "val_fault_detection": a(f"""SELECT dataset_name, 'controlled_failure' AS dataset_type,
        batch_id AS source_batch_id, overall_status, {_EXPECTED} AS expected_rule,
        contains(failed_rules, {_EXPECTED}) AS expected_failure_detected, failed_rule_count, failed_rules
        FROM ({_PER_DATASET} FROM ({_FAULTY}) GROUP BY 1, 2)"""),
    "val_summary": a("""SELECT n AS clean_batches_tested, n AS clean_batches_passed,
        6 * n AS controlled_scenarios_tested, 6 * n AS controlled_scenarios_detected,
        (9 + 5 * 9 + 1) * n AS total_validation_rule_results, true AS clean_validation_success,
        true AS failure_detection_success FROM (SELECT count(*) AS n FROM batches)"""),
    "val_fault_repeated_rows": a(f"""SELECT event_id, ingestion_batch_id, batch_row_number
        FROM ({_FAULTS['duplicate_events']})"""),
    "val_fault_missing_values": a("""SELECT event_id, CASE WHEN batch_row_number > 10 THEN case_id END AS case_id,
        CASE WHEN batch_row_number > 5 THEN event_timestamp END AS event_timestamp FROM clean"""),
    "val_fault_renamed_column": a("SELECT event_id, activity AS activity_name FROM clean"),
    "val_fault_redelivery": a("""SELECT event_id, ingestion_batch_id FROM clean WHERE ingestion_batch_id IN
        (SELECT batch_id FROM history)"""),
    # staging
    "stg_latest_delivery": a("""SELECT event_id, ingestion_batch_id, simulated_ingestion_timestamp_utc,
        cumulative_net_worth_eur FROM newest"""),
    "stg_clean_text": a(f"""SELECT event_id, {_STAGED_TEXTS.replace('activity', 'clean_activity AS activity')}, event_date,
        year(event_timestamp) AS event_year, month(event_timestamp) AS event_month FROM clean"""),
    "stg_process_sequence": a("SELECT event_id, case_id, process_event_sequence FROM staged"),
    "stg_process_event_count": a("SELECT event_id, case_id, process_event_count FROM staged"),
    "stg_neighbours": a("""SELECT event_id, previous_activity, next_activity, previous_event_timestamp,
        next_event_timestamp FROM staged"""),
    "stg_gaps": a("SELECT event_id, seconds_since_previous_event, seconds_to_next_event FROM staged"),
    "stg_flags": a("""SELECT event_id, is_case_start, is_case_end, is_timestamp_outlier, is_resource_missing
        FROM staged"""),
    "stg_events": a(f"SELECT {_STAGED_COLUMNS} FROM staged"),
    "stg_case_durations": a("""SELECT case_id, case_start_timestamp, case_end_timestamp, case_duration_seconds,
        case_duration_hours, case_duration_days FROM cases"""),
    "stg_case_ends": a("SELECT case_id, start_activity, end_activity FROM cases"),
    "stg_case_attributes": a("SELECT case_id, case_name, company_id, vendor_id FROM cases"),
    "stg_case_measures": a("""SELECT case_id, event_count, distinct_activity_count,
        maximum_cumulative_net_worth_eur, timestamp_outlier_event_count, missing_resource_event_count,
        ingestion_batch_count, first_ingestion_date, last_ingestion_date FROM cases"""),
    "stg_cases": a("SELECT * FROM cases"),
    "stg_events_hot": a(f"SELECT {_STAGED_COLUMNS} FROM staged"),
    "stg_cases_hot": a("SELECT * FROM cases"),
    "stg_event_counts": a("""SELECT count(*) AS staging_rows, count(DISTINCT event_id) AS unique_event_ids,
        count(DISTINCT case_id) AS unique_cases, count(DISTINCT activity) AS unique_activities FROM staged"""),
    "stg_raw_and_staged_rows": a("""SELECT (SELECT count(*) FROM raw) AS raw_rows,
        (SELECT count(*) FROM staged) AS staging_rows"""),
    "stg_missing_fields": b("""SELECT count_if(case_id IS NULL)::BIGINT AS missing_case_id,
        count_if(activity IS NULL)::BIGINT AS missing_activity,
        count_if(event_timestamp IS NULL)::BIGINT AS missing_event_timestamp FROM parsed"""),
    "stg_repeated_event_ids": a("""SELECT event_id, count(*) AS row_count FROM raw GROUP BY event_id
        HAVING count(*) > 1"""),
    "stg_case_counts": a("SELECT count(*) AS cases, count(DISTINCT case_id) AS unique_case_ids FROM cases"),
    "stg_broken_sequences": a("SELECT count(DISTINCT case_id) AS invalid_sequences FROM staged"),
    "stg_timestamp_quality": a("""SELECT timestamp_quality_status, count(*) AS event_count FROM staged GROUP BY 1"""),
    "stg_verdict": a("""SELECT *, raw_rows = staging_rows AND staging_rows = unique_event_ids
        AS row_reconciliation_success, event_case_count = case_table_rows AS case_reconciliation_success,
        missing_case_ids = 0 AND missing_activities = 0 AND missing_timestamps = 0 AS mandatory_fields_success,
        raw_rows = staging_rows AND staging_rows = unique_event_ids AND event_case_count = case_table_rows
            AND missing_case_ids = 0 AND missing_activities = 0 AND missing_timestamps = 0 AS staging_build_success
        FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS staging_rows,
            count(DISTINCT event_id) AS unique_event_ids, count(DISTINCT case_id) AS event_case_count,
            (SELECT count(*) FROM cases) AS case_table_rows, count(DISTINCT activity) AS activity_count,
            count_if(case_id IS NULL)::BIGINT AS missing_case_ids,
            count_if(activity IS NULL)::BIGINT AS missing_activities,
            count_if(event_timestamp IS NULL)::BIGINT AS missing_timestamps FROM staged)"""),
    # monitoring
    **{
        name: m(f"SELECT * FROM results WHERE rule_id = '{rule_id}'")
        for name, rule_id in {
            "mon_event_id_unique": "DQ_RAW_EVENT_ID_UNIQUE",
            "mon_row_reconciliation": "DQ_RAW_STAGING_ROW_RECONCILIATION",
            "mon_case_reconciliation": "DQ_CASE_RECONCILIATION",
            "mon_mandatory_fields": "DQ_MANDATORY_EVENT_FIELDS",
            "mon_sequence_integrity": "DQ_PROCESS_SEQUENCE_INTEGRITY",
            "mon_batch_reconciliation": "DQ_BATCH_LOAD_RECONCILIATION",
            "mon_negative_durations": "DQ_NEGATIVE_PROCESS_DURATION",
            "mon_timestamp_quality": "MON_TIMESTAMP_QUALITY",
            "mon_missing_resources": "MON_MISSING_RESOURCE",
        }.items()
    },
    "mon_rule_results": m("SELECT * FROM results"),
    "mon_run_summary": m(_RUN_SUMMARY),
    "mon_results_of_run": m("SELECT rule_id, severity, status, failed_rows FROM results"),
    "mon_summary_of_run": m(_RUN_SUMMARY),
    # analytics
    "ana_case_kpis": a(f"SELECT {_KPI} FROM kpis"),
    "ana_case_kpis_hot": a(f"SELECT {_KPI} FROM kpis"),
    "ana_case_variants": a("SELECT case_id, process_variant FROM case_variants"),
    "ana_conversation_variants": """SELECT conv_id::VARCHAR AS case_id,
        string_agg(role, ' -> ' ORDER BY turn) AS process_variant FROM conversations GROUP BY conv_id""",
    "ana_variant_statistics": a("SELECT * FROM variant_statistics"),
    "ana_variant_ranks": a("SELECT variant_rank, process_variant, case_count, case_share FROM variants"),
    "ana_variant_ids": a("SELECT case_id, sha256(process_variant) AS variant_id FROM case_variants"),
    "ana_process_variants": a("SELECT * FROM variants"),
    "ana_activity_performance": a("SELECT * FROM activities"),
    "ana_transition_statistics": a("SELECT * FROM transition_statistics"),
    "ana_transitions": a("""SELECT *, transition_count / sum(transition_count) OVER () AS transition_share
        FROM transition_statistics"""),
    "ana_process_overview": a("""SELECT TIMESTAMP '2026-02-01 12:00:00' AS calculation_timestamp_utc, * FROM (
        SELECT count(*) AS total_cases, count_if(is_analysis_ready)::BIGINT AS analysis_ready_cases,
            avg(CASE WHEN is_analysis_ready THEN case_duration_hours END) AS average_case_duration_hours,
            quantile_disc(CASE WHEN is_analysis_ready THEN case_duration_hours END, 0.5) AS median_case_duration_hours,
            quantile_disc(CASE WHEN is_analysis_ready THEN case_duration_hours END, 0.9) AS p90_case_duration_hours,
            avg(event_count) AS average_events_per_case, count_if(has_rework)::BIGINT AS rework_cases,
            count_if(has_rework) / count(*) AS rework_case_rate FROM kpis), (
        SELECT count(*) AS total_events, count(DISTINCT activity) AS total_activities,
            count_if(is_resource_missing) / count(*) AS missing_resource_rate,
            count_if(is_timestamp_outlier) / count(*) AS timestamp_outlier_rate FROM staged), (
        SELECT count(*) AS total_variants, max(case_share) AS top_variant_case_share FROM variants)"""),
    "ana_sketched_quantiles": a("""SELECT from_activity, to_activity, transition_count, true AS median_is_close,
        true AS p90_is_close FROM transition_statistics"""),
    "ana_case_kpi_counts": a("SELECT count(*) AS case_kpi_rows, count(DISTINCT case_id) AS unique_cases FROM kpis"),
    "ana_variant_counts": a("""SELECT count(*) AS process_variant_count,
        sum(case_count)::BIGINT AS cases_represented_by_variants FROM variants"""),
    "ana_activity_counts": a("SELECT count(*) AS activity_count FROM activities"),
    "ana_transition_counts": a("""SELECT count(*) AS transition_types,
        sum(transition_count)::BIGINT AS total_transitions FROM transition_statistics"""),
    "ana_top_variants": a("""SELECT variant_rank, case_count, round(case_share * 100, 2) AS case_share_percent,
        round(median_case_duration_hours::DOUBLE, 2) AS median_duration_hours,
        round(rework_case_rate * 100, 2) AS rework_rate_percent, process_variant FROM variants
        ORDER BY variant_rank LIMIT 20"""),
    "ana_slow_transitions": a("""SELECT from_activity, to_activity, transition_count, case_count,
        round(median_transition_seconds / 3600, 2) AS median_transition_hours,
        round(p90_transition_seconds / 3600, 2) AS p90_transition_hours FROM transition_statistics
        WHERE transition_count >= 100 ORDER BY p90_transition_seconds DESC, from_activity, to_activity LIMIT 20"""),
    "ana_verdict": a("""SELECT *, staging_case_count = case_kpi_rows AND case_kpi_rows = unique_cases
            AND unique_cases = variant_case_count AS case_reconciliation_success,
        activity_count = expected_activity_count AS activity_reconciliation_success,
        transition_count = expected_transition_count AS transition_reconciliation_success,
        staging_case_count = case_kpi_rows AND case_kpi_rows = unique_cases AND unique_cases = variant_case_count
            AND activity_count = expected_activity_count AND transition_count = expected_transition_count
            AS analytics_build_success
        FROM (SELECT (SELECT count(*) FROM cases) AS staging_case_count, (SELECT count(*) FROM kpis) AS case_kpi_rows,
            (SELECT count(DISTINCT case_id) FROM kpis) AS unique_cases,
            (SELECT count(*) FROM variants) AS variant_count,
            (SELECT sum(case_count)::BIGINT FROM variants) AS variant_case_count,
            (SELECT count(*) FROM activities) AS activity_count,
            (SELECT count(DISTINCT activity) FROM staged) AS expected_activity_count,
            (SELECT count(*) FROM transition_statistics) AS transition_type_count,
            (SELECT sum(transition_count)::BIGINT FROM transition_statistics) AS transition_count,
            (SELECT count(*) FROM staged WHERE next_activity IS NOT NULL) AS expected_transition_count)"""),
}


_ORACLES["snk_json_summary"] = _ORACLES["prf_standardization_summary"]

# The log as its XES files tell it: every event once, all resources known, years up to 2017 and 2020 apart.
_XES_LOG = (
    _A.replace("CASE WHEN event_id % 50 = 0 THEN 3 ELSE 2 END", "2")
    .replace("CASE WHEN event_id % 4 <> 0 THEN 'user_' || (user_id % 10)::VARCHAR END AS resource_id",
             "'user_' || (user_id % 10)::VARCHAR AS resource_id")
    .replace("""CASE day(ts) WHEN 1 THEN 'edge_period_before_main_window' WHEN 30 THEN 'edge_period_after_main_window'
            ELSE 'expected_period' END""",
             "CASE WHEN year(ts) <= 2017 OR year(ts) = 2020 THEN 'outside' ELSE 'expected_period' END")
)
_ORACLES["run_source_to_overview"] = _ORACLES["ana_process_overview"].replace(_A, _XES_LOG)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
