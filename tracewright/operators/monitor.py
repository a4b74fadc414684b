"""Data-quality rules over the loaded tables, and the summary of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.numbers import count_where, ratio
from tracewright.operators.ingest import PipelineError
from tracewright.schema import QUALITY_RESULTS, RUN_SUMMARY

CRITICAL, WARNING = "CRITICAL", "WARNING"

# Rule id, rule name and severity.
RULES = (
    ("DQ_RAW_EVENT_ID_UNIQUE", "RAW event identifiers are unique", CRITICAL),
    ("DQ_RAW_STAGING_ROW_RECONCILIATION", "RAW and STAGING row counts reconcile", CRITICAL),
    ("DQ_CASE_RECONCILIATION", "STAGING event cases reconcile with case table", CRITICAL),
    ("DQ_MANDATORY_EVENT_FIELDS", "Mandatory process-mining fields are populated", CRITICAL),
    ("DQ_PROCESS_SEQUENCE_INTEGRITY", "Event sequence is complete within each case", CRITICAL),
    ("DQ_BATCH_LOAD_RECONCILIATION", "Loaded batch row counts match expected row counts", CRITICAL),
    ("DQ_NEGATIVE_PROCESS_DURATION", "Inter-event durations are non-negative", CRITICAL),
    ("MON_TIMESTAMP_QUALITY", "Known timestamp-quality anomalies are monitored", WARNING),
    ("MON_MISSING_RESOURCE", "Missing event resources are monitored", WARNING),
)


def _rows() -> Column:
    return F.count(F.lit(1))


def raw_statistics(raw: DataFrame) -> DataFrame:
    return raw.agg(
        _rows().alias("raw_rows"), F.count_distinct("event_id").alias("raw_event_ids")
    )


def staging_statistics(events: DataFrame) -> DataFrame:
    negative = (F.col("seconds_since_previous_event") < 0) | (F.col("seconds_to_next_event") < 0)
    return events.agg(
        _rows().alias("staged_rows"),
        F.count_distinct("case_id").alias("staged_cases"),
        count_where(F.col("case_id").isNull()).alias("missing_cases"),
        count_where(F.col("activity").isNull()).alias("missing_activities"),
        count_where(F.col("event_timestamp").isNull()).alias("missing_times"),
        count_where(negative).alias("negative_gaps"),
        count_where(F.col("is_timestamp_outlier")).alias("outlier_events"),
        count_where(F.col("is_resource_missing")).alias("resourceless_events"),
    )


def case_statistics(cases: DataFrame) -> DataFrame:
    return cases.agg(_rows().alias("case_rows"))


def sequence_statistics(events: DataFrame) -> DataFrame:
    """Cases whose positions are not exactly 1..n."""
    sequence = "process_event_sequence"
    per_case = events.groupBy("case_id").agg(
        _rows().alias("n"),
        F.count_distinct(sequence).alias("values"),
        F.min(sequence).alias("least"),
        F.max(sequence).alias("greatest"),
    )
    invalid = (
        (F.col("least") != 1) | (F.col("greatest") != F.col("n")) | (F.col("values") != F.col("n"))
    )
    return per_case.agg(
        _rows().alias("sequenced_cases"), count_where(invalid).alias("invalid_cases")
    )


def batch_statistics(history: DataFrame, raw: DataFrame) -> DataFrame:
    """Batches whose loaded rows differ from the latest expectation; a batch without rows has 0."""
    latest = history.groupBy("batch_id").agg(
        F.max_by("expected_rows", F.struct("load_timestamp_utc", "expected_rows")).alias("expected")
    )
    loaded = raw.groupBy(F.col("ingestion_batch_id").alias("batch_id")).agg(_rows().alias("actual"))
    differs = F.coalesce("actual", F.lit(0)) != F.col("expected")
    return latest.join(loaded, "batch_id", "left").agg(
        _rows().alias("known_batches"), count_where(differs).alias("failed_batches")
    )


def _measures() -> dict[str, tuple[Column, Column, Column]]:
    """Failed rows, total rows and message of each rule, over the joined one-row statistics."""
    c = F.col
    repeated = c("raw_rows") - c("raw_event_ids")
    unreconciled = F.abs(c("raw_rows") - c("staged_rows"))
    case_gap = F.abs(c("staged_cases") - c("case_rows"))
    missing = c("missing_cases") + c("missing_activities") + c("missing_times")
    text = F.format_string
    # Rule messages.
    return {
        "DQ_RAW_EVENT_ID_UNIQUE": (
            repeated,
            c("raw_rows"),
            text("RAW contains %d rows and %d unique event IDs.", "raw_rows", "raw_event_ids"),
        ),
        "DQ_RAW_STAGING_ROW_RECONCILIATION": (
            unreconciled,
            c("raw_rows"),
            text("RAW rows: %d; STAGING rows: %d.", "raw_rows", "staged_rows"),
        ),
        "DQ_CASE_RECONCILIATION": (
            case_gap,
            c("staged_cases"),
            text("Event-log cases: %d; case-table rows: %d.", "staged_cases", "case_rows"),
        ),
        "DQ_MANDATORY_EVENT_FIELDS": (
            missing,
            c("staged_rows"),
            text(
                "Missing case_id: %d; activity: %d; timestamp: %d.",
                "missing_cases", "missing_activities", "missing_times",
            ),
        ),
        "DQ_PROCESS_SEQUENCE_INTEGRITY": (
            c("invalid_cases"),
            c("sequenced_cases"),
            text("%d cases contain invalid process-event sequences.", "invalid_cases"),
        ),
        "DQ_BATCH_LOAD_RECONCILIATION": (
            c("failed_batches"),
            c("known_batches"),
            text(
                "%d of %d ingestion batches fail row-count reconciliation.",
                "failed_batches", "known_batches",
            ),
        ),
        "DQ_NEGATIVE_PROCESS_DURATION": (
            c("negative_gaps"),
            c("staged_rows"),
            text("%d events contain negative inter-event durations.", "negative_gaps"),
        ),
        "MON_TIMESTAMP_QUALITY": (
            c("outlier_events"),
            c("staged_rows"),
            text("%d events are outside the expected timestamp period.", "outlier_events"),
        ),
        "MON_MISSING_RESOURCE": (
            c("resourceless_events"),
            c("staged_rows"),
            text("%d events have no resource identifier.", "resourceless_events"),
        ),
    }


def quality_results(
    raw: DataFrame,
    events: DataFrame,
    cases: DataFrame,
    history: DataFrame,
    *,
    run_id: str,
    run_at: datetime,
) -> DataFrame:
    """Nine rule rows. Each table is aggregated once to one row; the rules only read those rows."""
    statistics = (
        raw_statistics(raw)
        .crossJoin(staging_statistics(events))
        .crossJoin(case_statistics(cases))
        .crossJoin(sequence_statistics(events))
        .crossJoin(batch_statistics(history, raw))
    )
    measures = _measures()
    entries = []
    for rule_id, rule_name, severity in RULES:
        failed, total, message = measures[rule_id]
        bad = "FAIL" if severity == CRITICAL else "WARN"
        entries.append(
            F.struct(
                F.lit(rule_id).alias("rule_id"),
                F.lit(rule_name).alias("rule_name"),
                F.lit(severity).alias("severity"),
                F.when(failed == 0, "PASS").otherwise(bad).alias("status"),
                failed.alias("failed_rows"),
                total.alias("total_rows"),
                ratio(failed, total).alias("failure_rate"),
                message.alias("message"),
            )
        )
    rows = statistics.select(F.inline(F.array(*entries)))
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_at.isoformat()).cast("timestamp_ntz").alias("run_timestamp_utc"),
        "*",
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUALITY_RESULTS])


def run_summary(results: DataFrame, *, run_id: str, run_at: datetime) -> DataFrame:
    """Rules per status and the overall status (FAIL before WARN before PASS) of one run."""
    counts = {s: count_where(F.col("status") == s) for s in ("PASS", "WARN", "FAIL")}
    columns = {
        "run_id": F.lit(run_id),
        "run_timestamp_utc": F.lit(run_at.isoformat()),
        "rules_executed": _rows(),
        "passed_rules": counts["PASS"],
        "warning_rules": counts["WARN"],
        "failed_rules": counts["FAIL"],
        "overall_status": F.when(counts["FAIL"] > 0, "FAIL")
        .when(counts["WARN"] > 0, "WARN")
        .otherwise("PASS"),
    }
    return results.where(F.col("run_id") == run_id).agg(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in RUN_SUMMARY]
    )


def results_of_run(results: DataFrame, run_id: str) -> DataFrame:
    """Rule rows of a run, critical ones first."""
    weight = F.when(F.col("severity") == CRITICAL, 1).when(F.col("severity") == WARNING, 2)
    return (
        results.where(F.col("run_id") == run_id)
        .select(*QUALITY_RESULTS.names)
        .orderBy(weight.asc_nulls_last(), "rule_id")
    )


def summary_of_run(summaries: DataFrame, run_id: str) -> DataFrame:
    return summaries.where(F.col("run_id") == run_id).select(*RUN_SUMMARY.names).limit(1)


def require_no_failed_rule(summary: DataFrame) -> None:
    found = summary.first()
    if found is None:
        raise PipelineError("The monitoring run left no summary.")
    if found["failed_rules"]:
        raise PipelineError(f"{found['failed_rules']} data-quality rules failed.")
