"""Controlled failures: damaged deliveries in a landing tree per scenario, and their validation.

A scenario is one fault in every batch. Faults of rows are written as batch files, faults of bytes are
made on copies of the clean files; a manifest says which scenario a batch belongs to and which rule has
to notice it. All trees are validated together, with one scan of their bytes and one of their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.fixed_values import FAULT_RULES
from tracewright.operators import validate
from tracewright.plans import publish
from tracewright.shared_storage import settle, settled
from tracewright.sources import files, sinks, storage

#: The scenario of a file, from the directory above that of its batch.
SCENARIO_IN_PATH = r"scenario=([^/]+)/(?:batch=)?batch_\d+/[^/]*$"

# Rows of a batch that a fault touches, and what each scenario is said to hold.
FAULTY_ROWS = {"duplicate_events": 25, "missing_case_id": 10, "missing_timestamp": 5}
EXPECTED_ISSUES = {
    "duplicate_events": "Duplicate event_id values",
    "missing_case_id": "NULL values in case_id",
    "missing_timestamp": "NULL values in event_timestamp",
    "schema_drift": "Missing activity column and unexpected activity_name column",
    "duplicate_batch_delivery": "Previously processed ingestion_batch_id",
    "corrupted_parquet": "Unreadable corrupted Parquet file",
}


@dataclass(frozen=True)
class Fault:
    """A fault of rows, or one of bytes on copies; ``redelivered``: the batch was processed before."""

    rows: Callable[[DataFrame], DataFrame] | None = None
    bytes: str | None = None
    redelivered: bool = False


FAULTS = {
    "duplicate_events": Fault(rows=lambda b: validate.with_repeated_rows(b, FAULTY_ROWS["duplicate_events"])),
    "missing_case_id": Fault(
        rows=lambda b: validate.with_missing_values(b, "case_id", FAULTY_ROWS["missing_case_id"])
    ),
    "missing_timestamp": Fault(
        rows=lambda b: validate.with_missing_values(b, "event_timestamp", FAULTY_ROWS["missing_timestamp"])
    ),
    "schema_drift": Fault(rows=lambda b: validate.with_renamed_column(b, "activity", "activity_name")),
    "duplicate_batch_delivery": Fault(bytes="whole", redelivered=True),
    "corrupted_parquet": Fault(bytes="cut"),
}


def copy_tasks(spark: SparkSession, plan: DataFrame) -> int:
    """One task per file, at most one per core."""
    return min(max(plan.count(), 1), spark.sparkContext.defaultParallelism)


def deliver_scenarios(
    spark: SparkSession, clean_path: str, manifest: DataFrame, root: str, faults: dict[str, Fault] | None = None
) -> DataFrame:
    """Write a landing tree per scenario below ``root``; returns the scenario manifest.

    ``clean_path`` holds the clean batch files, which stay as they are; ``manifest`` describes them. A
    scenario manifest has scenario_name, source_batch_id, expected_issue, expected_rule, redelivered and
    expected_rows, one row per scenario and batch.
    """
    faults = FAULTS if faults is None else faults
    clean = files.read_landed(spark, clean_path).drop("landed_path")
    inventory = settle(files.listed_files(spark, clean_path).select("path", "batch_id"))
    at = publish.qualified(spark, root).rstrip("/")
    by_bytes = [(name, f.bytes) for name, f in faults.items() if f.bytes]
    with settled(spark):
        # The many small files are read once, not for every fault.
        rows = settle(clean) if any(f.rows for f in faults.values()) else clean
        for name, fault in faults.items():
            if fault.rows:
                sinks.write_batches(fault.rows(rows), f"{at}/scenario={name}")
    if by_bytes:
        named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for n, k in by_bytes]))
        plan = inventory.select("path", "batch_id", named.alias("fault")).select(
            F.col("path").alias("source"),
            F.concat(
                F.lit(f"{at}/scenario="), "fault.name", F.lit("/"), "batch_id", F.lit("/events.parquet")
            ).alias("target"),
            F.col("fault.kind").alias("kind"),
        )
        settle(storage.copied(plan, copy_tasks(spark, plan)))
    listed = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("scenario_name"),
                    F.lit(EXPECTED_ISSUES.get(name)).cast("string").alias("expected_issue"),
                    F.lit(FAULT_RULES.get(name)).cast("string").alias("expected_rule"),
                    F.lit(fault.redelivered).alias("redelivered"),
                )
                for name, fault in faults.items()
            ]
        )
    )
    return manifest.select(
        F.col("batch_id").alias("source_batch_id"), F.col("row_count").alias("expected_rows"), listed.alias("s")
    ).select("s.*", "source_batch_id", "expected_rows")


def scenario_label(scenario: str, batch: str) -> Column:
    return F.concat_ws("/", scenario, batch)


def validate_scenarios(
    spark: SparkSession, root: str, scenarios: DataFrame, baseline: list[str]
) -> DataFrame:
    """Rule results of every batch of every scenario; the data set is named ``scenario/batch``."""
    expected = scenarios.select(
        scenario_label("scenario_name", "source_batch_id").alias("label"),
        F.col("source_batch_id").alias("batch_id"),
        "expected_rows",
    )
    processed = scenarios.where("redelivered").select(
        scenario_label("scenario_name", "source_batch_id").alias("label")
    )
    path = F.col("dataset_name")
    label = F.concat_ws(
        "/", F.regexp_extract(path, SCENARIO_IN_PATH, 1), F.regexp_extract(path, files.BATCH_IN_PATH, 1)
    )
    return publish.file_results(spark, root, label, expected, baseline, processed)


def detected(results: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Was the fault of each data set noticed by the rule that its scenario names?"""
    rules = scenarios.select(
        scenario_label("scenario_name", "source_batch_id").alias("dataset_name"), "expected_rule"
    )
    return validate.scenario_results(results, rules)
