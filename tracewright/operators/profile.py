"""Profiles of a source log and of the canonical events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.fixed_values import (
    DUPLICATE_KEY,
    HISTORICAL_OUTLIER,
    MISSING_ACTIVITY_LABEL,
)
from tracewright.functions import quantiles as Q
from tracewright.functions.numbers import count_where, percentage
from tracewright.functions.text import as_text
from tracewright.functions.time import elapsed_hours


def _rows() -> Column:
    return F.count(F.lit(1))


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def _value_text(df: DataFrame, column: str) -> Column:
    """Text by which equal values are counted together (-0.0 counts as 0.0)."""
    data_type = df.schema[column].dataType
    value = _named(column)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return as_text(value, data_type)


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value: ``column_name, value, event_count``.

    One scan; rows are counted per value before the shuffle, so frequent values cost nothing extra.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), _value_text(df, c).alias("value"))
                for c in columns
            ]
        )
    )
    return (
        df.select(pairs.alias("p"))
        .select("p.column_name", "p.value")
        .groupBy("column_name", "value")
        .agg(_rows().alias("event_count"))
    )


def _columns_with_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column names and types next to the row count, also for an empty frame."""
    listed = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                )
                for c in columns
            ]
        )
    )
    return df.agg(_rows().alias("_all")).select(listed.alias("c"), "_all").select("c.*", "_all")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, NULLs and distinct values of every column."""
    columns = list(columns or df.columns)
    counted = (
        value_frequencies(df, columns)
        .groupBy("column_name")
        .agg(
            F.sum(F.when(F.col("value").isNull(), F.col("event_count")).otherwise(0)).alias("_nulls"),
            F.count("value").alias("_values"),
        )
    )
    return (
        _columns_with_types(df, columns)
        .join(counted, "column_name", "left")
        .select(
            "column_name",
            "data_type",
            F.coalesce("_nulls", F.lit(0)).alias("null_count"),
            percentage(F.coalesce("_nulls", F.lit(0)), F.col("_all"), 4).alias("null_percentage"),
            F.coalesce("_values", F.lit(0)).alias("unique_value_count"),
        )
    )


def schema_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The column profile without percentages, as reported for canonical events."""
    return column_profile(df, columns).drop("null_percentage")


def top_values(df: DataFrame, fields: Sequence[str], limit: int = 20) -> DataFrame:
    """For each present field: type, NULLs, distinct values, and its most frequent values by rank.

    The ranking window is cut to ``limit`` rows per field before the shuffle.
    """
    fields = [f for f in fields if f in df.columns]
    counted = value_frequencies(df, fields)
    ranked = counted.withColumn(
        "value_rank",
        F.row_number()
        .over(W.partitionBy("column_name").orderBy(F.desc("event_count"), F.asc_nulls_first("value")))
        .cast("bigint"),
    ).where(F.col("value_rank") <= limit)
    totals = counted.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("event_count")).otherwise(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
    )
    return (
        _columns_with_types(df, fields)
        .drop("_all")
        .join(totals, "column_name")
        .join(ranked, "column_name")
        .select(
            "column_name", "data_type", "null_count", "unique_count",
            "value_rank", "value", "event_count",
        )
    )


def field_profile(df: DataFrame, fields: Sequence[str], limit: int = 20) -> DataFrame:
    """:func:`top_values` with the values of a field nested in one row."""
    entries = F.array_sort(F.collect_list(F.struct("value_rank", "value", "event_count")))
    return (
        top_values(df, fields, limit)
        .groupBy("column_name", "data_type", "null_count", "unique_count")
        .agg(
            F.transform(entries, lambda e: F.struct(e["value"].alias("value"), e["event_count"].alias("event_count"))).alias("top_values")
        )
    )


def _with_percentage(counted: DataFrame, digits: int) -> DataFrame:
    """Add ``event_percentage`` of all rows counted in ``event_count``."""
    whole = counted.agg(F.sum("event_count").alias("_all"))
    return (
        counted.crossJoin(whole)
        .withColumn("event_percentage", percentage(F.col("event_count"), F.col("_all"), digits))
        .drop("_all")
    )


def activity_frequency(log: DataFrame, activity: str = "activity") -> DataFrame:
    counted = log.groupBy(
        F.coalesce(_named(activity), F.lit(MISSING_ACTIVITY_LABEL)).alias("activity")
    ).agg(_rows().alias("event_count"))
    return _with_percentage(counted, 4).orderBy(F.desc("event_count"), "activity")


def year_distribution(log: DataFrame, event_time: str = "event_timestamp") -> DataFrame:
    counted = log.groupBy(F.year(_named(event_time)).cast("bigint").alias("event_year")).agg(
        _rows().alias("event_count")
    )
    return _with_percentage(counted, 6).orderBy(F.asc_nulls_last("event_year"))


def timestamp_quality_distribution(events: DataFrame) -> DataFrame:
    counted = events.groupBy("timestamp_quality_status").agg(_rows().alias("event_count"))
    return _with_percentage(counted, 6).orderBy(
        F.desc("event_count"), F.asc_nulls_first("timestamp_quality_status")
    )


def outlier_activities(events: DataFrame) -> DataFrame:
    """Historical outliers by year and activity."""
    return (
        events.where(F.col("timestamp_quality_status") == HISTORICAL_OUTLIER)
        .groupBy(F.col("event_year").cast("bigint").alias("event_year"), "activity")
        .agg(_rows().alias("event_count"))
        .orderBy("event_year", F.desc("event_count"), F.asc_nulls_first("activity"))
    )


def case_profile(log: DataFrame) -> DataFrame:
    """Events, span, activities and duration in hours of every case."""
    return (
        log.where(F.col("case_id").isNotNull())
        .groupBy("case_id")
        .agg(
            _rows().alias("event_count"),
            F.min("event_timestamp").alias("first_event"),
            F.max("event_timestamp").alias("last_event"),
            F.count_distinct("activity").alias("unique_activity_count"),
        )
        .withColumn(
            "case_duration_hours", elapsed_hours(F.col("last_event"), F.col("first_event"))
        )
    )


def _middle(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Interpolating median of an integer expression as one row, from counts per value."""
    counts = Q.value_counts(df.select(value.cast("bigint").alias("_value")), [], "_value")
    middle = Q.ranked_values(
        counts, [], "_value", {"_low": Q.lower_middle, "_high": Q.upper_middle}
    )
    return middle.select(((F.col("_low") + F.col("_high")) / F.lit(2)).alias(name))


def log_profile(log: DataFrame, cases: DataFrame) -> DataFrame:
    """Size, period, gaps and case statistics of a log as one row."""
    overall = log.agg(
        _rows().alias("event_count"),
        F.lit(len(log.columns)).cast("bigint").alias("column_count"),
        F.count_distinct("case_id").alias("case_count"),
        F.count_distinct("activity").alias("activity_count"),
        F.min("event_timestamp").alias("period_start"),
        F.max("event_timestamp").alias("period_end"),
        count_where(F.col("case_id").isNull()).alias("missing_case_id_count"),
        count_where(F.col("activity").isNull()).alias("missing_activity_count"),
        count_where(F.col("event_timestamp").isNull()).alias("invalid_timestamp_count"),
    )
    hours = F.col("case_duration_hours")
    spread = cases.agg(
        F.min("event_count").alias("minimum_events_per_case"),
        F.round(F.avg("event_count"), 4).alias("mean_events_per_case"),
        F.max("event_count").alias("maximum_events_per_case"),
        F.round(F.min(hours), 4).alias("minimum_case_duration_hours"),
        F.round(F.avg(hours), 4).alias("mean_case_duration_hours"),
        F.round(F.max(hours), 4).alias("maximum_case_duration_hours"),
    )
    # Hours carry two decimals, so hundredths are whole numbers.
    median_hours = _middle(cases, F.round(hours * 100), "_hundredths").select(
        F.round(F.col("_hundredths") / 100, 4).alias("median_case_duration_hours")
    )
    return (
        overall.crossJoin(spread)
        .crossJoin(_middle(cases, F.col("event_count"), "median_events_per_case"))
        .crossJoin(median_hours)
    )


def earliest_events(
    log: DataFrame,
    columns: Sequence[str],
    *,
    event_time: str,
    tie_break: Sequence[str],
    limit: int = 200,
) -> DataFrame:
    """The first events by time, with the wanted columns that exist."""
    available = [_named(c) for c in columns if c in log.columns]
    order = [F.asc_nulls_last(f"`{event_time}`"), *[F.asc_nulls_last(f"`{c}`") for c in tie_break]]
    return log.orderBy(*order).limit(limit).select(*available)


def _first_known(column: str, order: Column) -> Column:
    """First non-NULL value in ``order``."""
    return F.min_by(_named(column), F.when(_named(column).isNotNull(), order))


def largest_cases(
    log: DataFrame, attributes: Mapping[str, str], *, order: Sequence[str], limit: int = 200
) -> DataFrame:
    """The cases with most events; ``attributes`` maps an output column to a log column."""
    position = F.struct(*order)
    grouped = (
        log.where(F.col("case_id").isNotNull())
        .groupBy("case_id")
        .agg(
            _rows().alias("event_count"),
            F.count_distinct("activity").alias("unique_activity_count"),
            F.min("event_timestamp").alias("first_event"),
            F.max("event_timestamp").alias("last_event"),
            *[_first_known(src, position).alias(out) for out, src in attributes.items()],
        )
    )
    return (
        grouped.withColumn("duration_hours", elapsed_hours(F.col("last_event"), F.col("first_event")))
        .orderBy(F.desc("event_count"), "case_id")
        .limit(limit)
    )


def agreement_summary(log: DataFrame, left: str, right: str) -> DataFrame:
    """How far two columns agree after stripping, as metric/value rows."""
    a, b = _named(left), _named(right)
    stripped = [F.btrim(c.cast("string"), F.lit(" \t\n\r\x0b\x0c")) for c in (a, b)]
    counted = log.agg(
        _rows().alias("row_count"),
        count_where(a.isNull()).alias("missing_user_count"),
        count_where(b.isNull()).alias("missing_resource_count"),
        count_where(stripped[0] == stripped[1]).alias("equal_non_null_values"),
        F.count_distinct(a).alias("unique_user_values"),
        F.count_distinct(b).alias("unique_resource_values"),
    )
    names = counted.columns
    return counted.select(
        F.stack(F.lit(len(names)), *[x for n in names for x in (F.lit(n), F.col(n))]).alias(
            "metric", "value"
        )
    )


def pair_frequency(log: DataFrame, left: str, right: str, limit: int = 500) -> DataFrame:
    """The most frequent value pairs of two columns; NULL is a value."""
    return (
        log.groupBy(_named(left), _named(right))
        .agg(_rows().alias("event_count"))
        .orderBy(
            F.desc("event_count"),
            F.asc_nulls_first(f"`{left}`"),
            F.asc_nulls_first(f"`{right}`"),
        )
        .limit(limit)
    )


def case_labels(log: DataFrame, order: Sequence[str], label: str = "case_name") -> DataFrame:
    """First label, number of labels and events per case, and whether label and id are equal."""
    return (
        log.where(F.col("case_id").isNotNull())
        .groupBy("case_id")
        .agg(
            _first_known(label, F.struct(*order)).alias("case_name_first"),
            F.count_distinct(_named(label)).alias("case_name_unique_count"),
            _rows().alias("event_count"),
        )
        .withColumn("case_id_equals_case_name", F.col("case_id") == F.col("case_name_first"))
    )


def case_label_summary(labels: DataFrame) -> DataFrame:
    return labels.agg(
        _rows().alias("case_count"),
        count_where(F.col("case_name_first").isNull()).alias("case_name_missing_count"),
        count_where(F.col("case_name_unique_count") > 1).alias("cases_with_multiple_names"),
        count_where(F.col("case_id_equals_case_name")).alias("cases_where_id_equals_name"),
    )


def potential_duplicates(events: DataFrame, key: Sequence[str] = DUPLICATE_KEY) -> DataFrame:
    """Rows whose key occurs more than once; all of them count, and NULL equals NULL."""
    repeated = events.groupBy(*key).agg(_rows().alias("n")).where(F.col("n") > 1)
    return repeated.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("potential_duplicate_event_row_count")
    )


def standardization_summary(events: DataFrame) -> DataFrame:
    """Size, gaps, duplicates, period and quality classes of canonical events as one row."""
    overall = events.agg(
        _rows().alias("row_count"),
        F.count_distinct("case_id").alias("case_count"),
        F.count_distinct("activity").alias("activity_count"),
        F.lit(len(events.columns)).cast("bigint").alias("column_count"),
        count_where(F.col("resource_id").isNull()).alias(
            "resource_missing_count_after_normalization"
        ),
        count_where(F.col("case_id").isNull()).alias("case_id_missing_count"),
        count_where(F.col("activity").isNull()).alias("activity_missing_count"),
        count_where(F.col("event_timestamp").isNull()).alias("timestamp_missing_count"),
        F.min("event_timestamp").alias("period_start"),
        F.max("event_timestamp").alias("period_end"),
    )
    months = events.groupBy("event_year", "event_month").agg(_rows().alias("n"))
    statuses = events.groupBy("timestamp_quality_status").agg(_rows().alias("n"))
    # One entry per quality class.
    counts = statuses.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.coalesce("timestamp_quality_status", F.lit("<NA>")).alias("key"),
                        F.col("n").alias("value"),
                    )
                )
            )
        ).alias("timestamp_quality_counts")
    )
    return (
        overall.crossJoin(months.agg(_rows().alias("partition_count")))
        .crossJoin(potential_duplicates(events))
        .crossJoin(counts)
    )
