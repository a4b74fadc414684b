"""Deduplicated, cleaned and sequenced events, and one row per case."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.fixed_values import CASE_ATTRIBUTES, EXPECTED_PERIOD, STAGED_TEXT_COLUMNS
from tracewright.functions.numbers import count_where
from tracewright.functions.text import blank_to_null
from tracewright.functions.time import elapsed_seconds, whole_units
from tracewright.operators.ordering import HotKeys, hot_keys, positions_in_group
from tracewright.schema import SkewPlan

EVENT_ORDER = ("event_timestamp", "source_row_number")

STAGED_EVENT_COLUMNS = (
    "event_id", "case_id", "case_name", "activity",
    "event_timestamp", "event_date", "event_year", "event_month",
    "resource_id", "company_id", "vendor_id", "purchasing_document_id", "item_id",
    "document_type", "purchasing_document_category", "item_type", "item_category",
    "spend_area", "sub_spend_area", "spend_classification", "source_system",
    "cumulative_net_worth_eur", "gr_based_invoice_verification", "goods_receipt_required",
    "timestamp_quality_status", "source_file", "source_row_number", "pipeline_batch_id",
    "ingestion_batch_id", "ingestion_batch_sequence", "simulated_ingestion_timestamp_utc",
    "simulated_ingestion_date", "batch_row_number", "processing_timestamp_utc",
)


def latest_delivery(raw: DataFrame) -> DataFrame:
    """One row per event_id: the latest delivery, then the greatest source row number.

    Spark ranks and cuts to one row per key before the shuffle as well as after it, so that an id
    with very many copies never travels as a whole.
    """
    newest_first = W.partitionBy("event_id").orderBy(
        F.desc("simulated_ingestion_timestamp_utc"),
        F.desc("source_row_number"),
        F.desc("ingestion_batch_sequence"),
        F.desc("batch_row_number"),
    )
    return (
        raw.withColumn("_delivery", F.row_number().over(newest_first))
        .where(F.col("_delivery") == 1)
        .drop("_delivery")
    )


def cleaned_events(events: DataFrame) -> DataFrame:
    """Trimmed texts, calendar parts from the event time; the delivered sequence is dropped."""
    replaced: dict[str, Column] = {
        c: blank_to_null(F.col(c).cast("string")) for c in STAGED_TEXT_COLUMNS
    }
    replaced["event_date"] = F.to_date("event_timestamp")
    replaced["event_year"] = F.year("event_timestamp").cast("bigint")
    replaced["event_month"] = F.month("event_timestamp").cast("bigint")
    return events.select(
        *[replaced.get(c, F.col(c)).alias(c) for c in STAGED_EVENT_COLUMNS]
    )


def sequenced_events(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Position in the case, events in the case, and the neighbouring activities and times."""
    return positions_in_group(
        events,
        "case_id",
        [F.col(c).asc_nulls_first() for c in EVENT_ORDER],
        position="process_event_sequence",
        total="process_event_count",
        previous={"previous_activity": "activity", "previous_event_timestamp": "event_timestamp"},
        following={"next_activity": "activity", "next_event_timestamp": "event_timestamp"},
        hot=hot,
    )


def flagged_events(events: DataFrame) -> DataFrame:
    """Gaps to the neighbours in whole seconds and the four event flags."""
    return events.select(
        "*",
        elapsed_seconds(F.col("event_timestamp"), F.col("previous_event_timestamp")).alias(
            "seconds_since_previous_event"
        ),
        elapsed_seconds(F.col("next_event_timestamp"), F.col("event_timestamp")).alias(
            "seconds_to_next_event"
        ),
        (F.col("process_event_sequence") == 1).alias("is_case_start"),
        (F.col("process_event_sequence") == F.col("process_event_count")).alias("is_case_end"),
        (F.col("timestamp_quality_status") != EXPECTED_PERIOD).alias("is_timestamp_outlier"),
        F.col("resource_id").isNull().alias("is_resource_missing"),
    )


def hot_cases(events: DataFrame, skew: SkewPlan = SkewPlan()) -> HotKeys | None:
    """Cases with very many rows, looked for in the case column of RAW or staged events.

    The only action of this module; it reads a sample of one column. On RAW events it also runs before
    the deduplication, so that nothing is shuffled for it.
    """
    cases = events.select(blank_to_null(F.col("case_id").cast("string")).alias("case_id"))
    return hot_keys(cases, "case_id", skew)


def staged_events(raw: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """raw.events -> staging.events in two shuffles (event_id, then case_id)."""
    return flagged_events(sequenced_events(cleaned_events(latest_delivery(raw)), hot))


# -- cases ---------------------------------------------------------------------------------------


def _first_last_order() -> Column:
    return F.struct(*EVENT_ORDER)


def distinct_by_set(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("bigint")


def case_aggregates(distinct: Callable[[str], Column] = distinct_by_set) -> dict[str, Column]:
    """Everything staging.cases needs from one grouping of the events by case.

    ``distinct`` counts the distinct values of a column.
    """
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    seconds = elapsed_seconds(last, first)
    return {
        **{c: F.min(c) for c in CASE_ATTRIBUTES},
        "case_start_timestamp": first,
        "case_end_timestamp": last,
        "case_duration_seconds": seconds,
        "case_duration_hours": whole_units(seconds, 3_600),
        "case_duration_days": whole_units(seconds, 86_400),
        "event_count": F.count(F.lit(1)),
        "distinct_activity_count": distinct("activity"),
        "start_activity": F.min_by("activity", _first_last_order()),
        "end_activity": F.max_by("activity", _first_last_order()),
        "maximum_cumulative_net_worth_eur": F.max("cumulative_net_worth_eur"),
        "timestamp_outlier_event_count": count_where(F.col("is_timestamp_outlier")),
        "missing_resource_event_count": count_where(F.col("is_resource_missing")),
        "ingestion_batch_count": distinct("ingestion_batch_id"),
        "first_ingestion_date": F.min("simulated_ingestion_date"),
        "last_ingestion_date": F.max("simulated_ingestion_date"),
    }


# Column names and order of staging.cases.
CASE_COLUMNS = (
    "case_id", "case_name", "case_start_timestamp", "case_end_timestamp",
    "case_duration_seconds", "case_duration_hours", "case_duration_days",
    "event_count", "distinct_activity_count", "start_activity", "end_activity",
    "company_id", "vendor_id", "purchasing_document_id", "document_type",
    "purchasing_document_category", "item_type", "item_category",
    "spend_area", "sub_spend_area", "spend_classification",
    "maximum_cumulative_net_worth_eur", "timestamp_outlier_event_count",
    "missing_resource_event_count", "ingestion_batch_count",
    "first_ingestion_date", "last_ingestion_date",
)


def grouped_by_case(
    events: DataFrame,
    aggregates: Callable[[Callable[[str], Column]], dict[str, Column]] = case_aggregates,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Group the events by case, with a way of counting distinct values that suits the case.

    A small set per case is the cheap way: one shuffle of partly aggregated rows. For hot cases, whose
    sets have no useful bound, distinct (case, value) pairs are spread over all tasks instead.
    """

    def grouped(part: DataFrame, distinct: Callable[[str], Column]) -> DataFrame:
        return part.groupBy("case_id").agg(
            *[column.alias(name) for name, column in aggregates(distinct).items()]
        )

    if hot is None:
        return grouped(events, distinct_by_set)
    calm, busy = hot.mark(events, "case_id")
    return grouped(calm, distinct_by_set).unionByName(grouped(busy, F.count_distinct))


def case_table(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """staging.events -> staging.cases, one row per case_id (NULL included)."""
    return grouped_by_case(events, hot=hot).select(*CASE_COLUMNS)


# -- checks --------------------------------------------------------------------------------------


def event_counts(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("staging_rows"),
        F.count_distinct("event_id").alias("unique_event_ids"),
        F.count_distinct("case_id").alias("unique_cases"),
        F.count_distinct("activity").alias("unique_activities"),
    )


def raw_and_staged_rows(raw: DataFrame, events: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("raw_rows")).crossJoin(
        events.agg(F.count(F.lit(1)).alias("staging_rows"))
    )


def missing_mandatory_fields(events: DataFrame) -> DataFrame:
    return events.agg(
        count_where(F.col("case_id").isNull()).alias("missing_case_id"),
        count_where(F.col("activity").isNull()).alias("missing_activity"),
        count_where(F.col("event_timestamp").isNull()).alias("missing_event_timestamp"),
    )


def repeated_event_ids(events: DataFrame) -> DataFrame:
    counted = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)


def case_counts(cases: DataFrame) -> DataFrame:
    return cases.agg(
        F.count(F.lit(1)).alias("cases"), F.count_distinct("case_id").alias("unique_case_ids")
    )


def broken_sequences(events: DataFrame) -> DataFrame:
    per_case = events.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max("process_event_sequence").alias("maximum_sequence"),
    )
    broken = per_case.where(F.col("event_count") != F.col("maximum_sequence"))
    return broken.agg(F.count(F.lit(1)).alias("invalid_sequences"))


def timestamp_quality_counts(events: DataFrame) -> DataFrame:
    counted = events.groupBy("timestamp_quality_status").agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counted.orderBy(F.desc("event_count"), F.asc_nulls_first("timestamp_quality_status"))


def staging_verdict(raw: DataFrame, events: DataFrame, cases: DataFrame) -> DataFrame:
    """Nine metrics, three reconciliation flags and their conjunction, as one row."""
    staged = events.agg(
        F.count(F.lit(1)).alias("staging_rows"),
        F.count_distinct("event_id").alias("unique_event_ids"),
        F.count_distinct("case_id").alias("event_case_count"),
        F.count_distinct("activity").alias("activity_count"),
        count_where(F.col("case_id").isNull()).alias("missing_case_ids"),
        count_where(F.col("activity").isNull()).alias("missing_activities"),
        count_where(F.col("event_timestamp").isNull()).alias("missing_timestamps"),
    )
    metrics = (
        raw.agg(F.count(F.lit(1)).alias("raw_rows"))
        .crossJoin(staged)
        .crossJoin(cases.agg(F.count(F.lit(1)).alias("case_table_rows")))
    )
    rows_agree = (F.col("raw_rows") == F.col("staging_rows")) & (
        F.col("staging_rows") == F.col("unique_event_ids")
    )
    cases_agree = F.col("event_case_count") == F.col("case_table_rows")
    nothing_missing = (
        F.col("missing_case_ids") + F.col("missing_activities") + F.col("missing_timestamps")
    ) == 0
    return metrics.select(
        "raw_rows", "staging_rows", "unique_event_ids", "event_case_count", "case_table_rows",
        "activity_count", "missing_case_ids", "missing_activities", "missing_timestamps",
        rows_agree.alias("row_reconciliation_success"),
        cases_agree.alias("case_reconciliation_success"),
        nothing_missing.alias("mandatory_fields_success"),
        (rows_agree & cases_agree & nothing_missing).alias("staging_build_success"),
    )
