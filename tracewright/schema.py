"""Table schemas and the settings shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "TINYINT": T.ByteType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """``name TYPE, ...`` as a schema, without the running session that ``fromDDL`` asks for."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CANONICAL = _struct(
    """
    event_id BIGINT, case_id STRING, case_name STRING, event_sequence INT, activity STRING,
    event_timestamp TIMESTAMP_NTZ, event_date DATE, event_year SMALLINT, event_month TINYINT,
    timestamp_quality_status STRING, resource_id STRING, cumulative_net_worth_eur DOUBLE,
    purchasing_document_id STRING, item_id STRING, document_type STRING,
    purchasing_document_category STRING, company_id STRING, vendor_id STRING, source_system STRING,
    spend_area STRING, sub_spend_area STRING, spend_classification STRING, item_type STRING,
    item_category STRING, gr_based_invoice_verification STRING, goods_receipt_required STRING,
    source_file STRING, source_row_number BIGINT, pipeline_batch_id STRING,
    processing_timestamp_utc TIMESTAMP_NTZ
    """
)

DELIVERY = _struct(
    """
    ingestion_batch_id STRING, ingestion_batch_sequence BIGINT,
    simulated_ingestion_timestamp_utc TIMESTAMP_NTZ, simulated_ingestion_date DATE,
    batch_row_number BIGINT
    """
)

# Partition columns come last in a table that was read back from a partitioned directory.
_PARTITION_COLUMNS = ("event_year", "event_month")
RAW = T.StructType(
    [f for f in CANONICAL if f.name not in _PARTITION_COLUMNS]
    + [f for f in CANONICAL if f.name in _PARTITION_COLUMNS]
    + list(DELIVERY)
)

MANIFEST = _struct(
    """
    batch_id STRING, batch_sequence BIGINT, simulated_ingestion_date DATE, row_count BIGINT,
    unique_case_count BIGINT, unique_activity_count BIGINT,
    minimum_event_timestamp TIMESTAMP_NTZ, maximum_event_timestamp TIMESTAMP_NTZ,
    historical_outlier_count BIGINT, file_name STRING, file_size_bytes BIGINT, sha256 STRING,
    status STRING
    """
)

LOAD_HISTORY = _struct(
    """
    run_id STRING, batch_id STRING, landing_uri STRING, expected_rows BIGINT, loaded_rows BIGINT,
    status STRING, job_id STRING, sha256 STRING, message STRING, load_timestamp_utc TIMESTAMP_NTZ
    """
)

QUALITY_RESULTS = _struct(
    """
    run_id STRING, run_timestamp_utc TIMESTAMP_NTZ, rule_id STRING, rule_name STRING,
    severity STRING, status STRING, failed_rows BIGINT, total_rows BIGINT, failure_rate DOUBLE,
    message STRING
    """
)

RUN_SUMMARY = _struct(
    """
    run_id STRING, run_timestamp_utc TIMESTAMP_NTZ, rules_executed BIGINT, passed_rules BIGINT,
    warning_rules BIGINT, failed_rules BIGINT, overall_status STRING
    """
)


@dataclass(frozen=True)
class YearBounds:
    """Calendar years that delimit the main observation window."""

    historical_before: int = 2017
    edge_before: int = 2017
    edge_after: int = 2020


@dataclass(frozen=True)
class BatchPlan:
    """How a log is cut into deliveries: size, first day and the hour of arrival."""

    size: int = 100_000
    first_day: datetime = datetime(2026, 1, 1)
    arrival_hour: int = 8


@dataclass(frozen=True)
class SkewPlan:
    """When one key counts as hot, and how much of the input is sampled to find out.

    A key that is missed or flagged in error only changes how the work is spread, never the result.
    """

    max_rows: int = 1_000_000
    sample_fraction: float = 1 / 16
    seed: int = 7
