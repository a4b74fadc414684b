"""Source attributes -> canonical events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.fixed_values import (
    DESCRIPTIVE_COLUMNS,
    EDGE_AFTER,
    EDGE_BEFORE,
    EXPECTED_PERIOD,
    HISTORICAL_OUTLIER,
    IDENTIFIER_COLUMNS,
    INVALID_TIMESTAMP,
    MISSING_RESOURCE_TEXTS,
    SOURCE_TO_CANONICAL,
)
from tracewright.functions.text import standard_text
from tracewright.functions.time import parse_utc
from tracewright.operators.ordering import HotKeys, file_order_rank, global_rank, positions_in_group
from tracewright.schema import CANONICAL, YearBounds

ROW_NUMBER = "source_row_number"


def numbered_source(
    source: DataFrame, file_order: Sequence[Column], partitions: int | None = None
) -> DataFrame:
    """Number rows 1..n in an order given by their values, without a global window."""
    return global_rank(source, file_order, ROW_NUMBER, partitions)


def numbered_file_rows(log: DataFrame) -> DataFrame:
    """Number the rows of a settled log file in file order; no row is moved for it."""
    return file_order_rank(log, ["_file", "_block"], "_row", ROW_NUMBER)


def renamed_source(source: DataFrame) -> DataFrame:
    """Row number and the mapped attributes under their canonical names; all else is dropped."""
    return source.select(
        ROW_NUMBER,
        *[F.col(f"`{old}`").alias(new) for old, new in SOURCE_TO_CANONICAL.items()],
    )


def missing_resource_to_null(resource: Column) -> Column:
    return F.when(~resource.isin(*MISSING_RESOURCE_TEXTS), resource)


def cleaned_source(events: DataFrame) -> DataFrame:
    """Strip texts, blank -> NULL, and the "no resource" texts -> NULL."""
    types = {f.name: f.dataType for f in events.schema}
    cleaned = {
        c: standard_text(F.col(c), types[c])
        for c in (*IDENTIFIER_COLUMNS, *DESCRIPTIVE_COLUMNS)
        if c in types
    }
    if "resource_id" in cleaned:
        cleaned["resource_id"] = missing_resource_to_null(cleaned["resource_id"])
    return events.withColumns(cleaned)


def typed_source(events: DataFrame) -> DataFrame:
    """Event time in UTC and net worth as double; unreadable values become NULL."""
    types = {f.name: f.dataType for f in events.schema}
    return events.withColumns(
        {
            "event_timestamp": parse_utc(F.col("event_timestamp"), types["event_timestamp"]),
            "cumulative_net_worth_eur": F.trim(F.col("cumulative_net_worth_eur").cast("string"))
            .try_cast("double"),
        }
    )


def with_calendar(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "event_year": F.year("event_timestamp").cast("smallint"),
            "event_month": F.month("event_timestamp").cast("tinyint"),
            "event_date": F.to_date("event_timestamp"),
        }
    )


def timestamp_quality(event_time: Column, bounds: YearBounds = YearBounds()) -> Column:
    """Class of an event time by calendar year.

    Years after the edge year keep the default class, as in the source pipeline's rule.
    """
    year = F.year(event_time)
    return (
        F.when(event_time.isNull(), INVALID_TIMESTAMP)
        .when(year == bounds.edge_after, EDGE_AFTER)
        .when(year == bounds.edge_before, EDGE_BEFORE)
        .when(year < bounds.historical_before, HISTORICAL_OUTLIER)
        .otherwise(EXPECTED_PERIOD)
    )


def with_lineage(
    events: DataFrame, source_file: str, pipeline_batch_id: str, processed_at: datetime
) -> DataFrame:
    return events.withColumns(
        {
            "source_file": F.lit(source_file),
            "pipeline_batch_id": F.lit(pipeline_batch_id),
            "processing_timestamp_utc": F.lit(processed_at.isoformat()).cast("timestamp_ntz"),
        }
    )


def with_event_sequence(events: DataFrame, hot_cases: HotKeys | None = None) -> DataFrame:
    """Position in the case, unreadable times last; events without a case get none.

    Those are taken out first: they would all be one group of the window.
    """
    without = events.where(F.col("case_id").isNull()).withColumn("event_sequence", F.lit(None).cast("int"))
    placed = positions_in_group(
        events.where(F.col("case_id").isNotNull()),
        "case_id",
        [F.asc_nulls_last("event_timestamp"), F.asc_nulls_last(ROW_NUMBER)],
        position="event_sequence",
        hot=hot_cases,
    )
    return placed.withColumn("event_sequence", F.col("event_sequence").cast("int")).unionByName(without)


def canonical_projection(events: DataFrame) -> DataFrame:
    return events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANONICAL])


def canonical_events(
    numbered: DataFrame,
    *,
    source_file: str,
    pipeline_batch_id: str,
    processed_at: datetime,
    bounds: YearBounds = YearBounds(),
    hot_cases: HotKeys | None = None,
) -> DataFrame:
    """Numbered source rows -> canonical events; one shuffle, for the position in the case.

    What follows from other columns is added behind that shuffle, so that it is not carried through it.
    """
    events = typed_source(cleaned_source(renamed_source(numbered)))
    events = with_calendar(with_event_sequence(events, hot_cases))
    events = events.withColumns(
        {
            "timestamp_quality_status": timestamp_quality(F.col("event_timestamp"), bounds),
            "event_id": F.col(ROW_NUMBER).cast("bigint"),
        }
    )
    return canonical_projection(with_lineage(events, source_file, pipeline_batch_id, processed_at))
