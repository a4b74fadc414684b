"""Rule suite over delivered batches, and the faults that prove that the rules notice.

A delivered data set is a group of rows with one ``dataset_name``. Rows of all data sets are measured
in one grouped aggregation; the rules are then expressions over one row of facts per data set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.fixed_values import BATCH_RULES
from tracewright.functions.numbers import count_where
from tracewright.functions.text import grouped_digits

# Rule names and the columns they check.
NOT_NULL_RULES = {
    "DQ_NOT_NULL_CASE_ID": "case_id",
    "DQ_NOT_NULL_ACTIVITY": "activity",
    "DQ_NOT_NULL_EVENT_TIMESTAMP": "event_timestamp",
}


def _rows() -> Column:
    return F.count(F.lit(1))


# -- faults --------------------------------------------------------------------------------------


def with_repeated_rows(batches: DataFrame, rows: int) -> DataFrame:
    """Deliver the first ``rows`` rows of each batch twice."""
    return batches.unionByName(batches.where(F.col("batch_row_number") <= rows))


def with_missing_values(batches: DataFrame, column: str, rows: int) -> DataFrame:
    """Blank ``column`` in the first ``rows`` rows of each batch."""
    return batches.withColumn(
        column, F.when(F.col("batch_row_number") > rows, F.col(column))
    )


def with_renamed_column(batches: DataFrame, column: str, renamed: str) -> DataFrame:
    return batches.withColumnRenamed(column, renamed)


# -- facts ---------------------------------------------------------------------------------------


def measured(landed: DataFrame, name: str = "dataset_name") -> DataFrame:
    """One row of counts per data set.

    Repeats of an id beyond its first row are rows minus distinct ids, where NULL is one id. Whether
    there is exactly one batch id needs only its least and greatest value, not a distinct count. The
    digest over all values is for files, where it proves that every column could be decoded; Spark
    leaves it out wherever it is not used.
    """
    no_id = F.max(F.col("event_id").isNull().cast("int")).cast("bigint")
    values = [c for c in landed.columns if c not in (name, "landed_path")]
    return landed.groupBy(name).agg(
        _rows().alias("row_count"),
        *[
            count_where(F.col(c).isNull()).alias(f"missing_{c}")
            for c in NOT_NULL_RULES.values()
        ],
        (_rows() - F.count_distinct("event_id") - no_id).alias("repeated_event_ids"),
        F.min("ingestion_batch_id").alias("least_batch_id"),
        F.max("ingestion_batch_id").alias("greatest_batch_id"),
        F.bit_xor(F.xxhash64(*values)).alias("row_digest"),
    )


def facts(expected: DataFrame, counts: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """Join what is expected of each data set with what was measured.

    ``expected``: dataset_name, batch_id, expected_rows, readable, read_message, columns.
    ``counts``: the result of :func:`measured`.
    ``processed``: dataset_name, batch_id of deliveries that were processed before.
    """
    joined = expected.join(counts, "dataset_name", "left")
    if processed is None:
        return joined.withColumn("already_processed", F.lit(False))
    before = processed.select("dataset_name", "batch_id", F.lit(True).alias("_before")).distinct()
    return (
        joined.join(before, ["dataset_name", "batch_id"], "left")
        .withColumn("already_processed", F.coalesce("_before", F.lit(False)))
        .drop("_before")
    )


# -- rules ---------------------------------------------------------------------------------------

# The message texts of all rules below; reports carry them verbatim.


def _outcome(status: Column | str, failed: Column | int, message: Column | str) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        lit(status).alias("status"),
        lit(failed).cast("bigint").alias("failed_rows"),
        lit(message).alias("message"),
    )


def _has(column: str) -> Column:
    return F.array_contains("columns", column)


def schema_rule(baseline: Sequence[str]) -> Column:
    """Compare the set of column names with the baseline; order and types do not matter."""
    wanted = F.array(*[F.lit(c) for c in sorted(baseline)])
    missing = F.array_sort(F.array_except(wanted, F.col("columns")))
    extra = F.array_sort(F.array_except(F.col("columns"), wanted))
    differs = F.size(missing) + F.size(extra)
    text = F.concat_ws(
        " | ",
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing columns: "), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit("Unexpected columns: "), F.array_join(extra, ", "))),
    )
    return F.when(differs > 0, _outcome("FAIL", differs, text)).otherwise(
        _outcome("PASS", 0, "Schema matches baseline.")
    )


def not_null_rule(column: str) -> Column:
    missing = F.coalesce(f"missing_{column}", F.lit(0))
    skipped = f"Column '{column}' is unavailable because schema validation failed."
    found = F.concat(grouped_digits(missing), F.lit(f" rows contain NULL in {column}."))
    return (
        F.when(~_has(column), _outcome("SKIPPED", 0, skipped))
        .when(missing > 0, _outcome("FAIL", missing, found))
        .otherwise(_outcome("PASS", 0, f"Column '{column}' contains no NULL values."))
    )


def unique_event_id_rule() -> Column:
    repeats = F.coalesce("repeated_event_ids", F.lit(0))
    found = F.concat(grouped_digits(repeats), F.lit(" duplicate event_id values detected."))
    return (
        F.when(~_has("event_id"), _outcome("SKIPPED", 0, "event_id column is unavailable."))
        .when(repeats > 0, _outcome("FAIL", repeats, found))
        .otherwise(_outcome("PASS", 0, "event_id is unique."))
    )


def row_count_rule() -> Column:
    rows, expected = F.coalesce("row_count", F.lit(0)), F.col("expected_rows")
    differs = F.concat(
        F.lit("Expected "), grouped_digits(expected),
        F.lit(" rows, received "), grouped_digits(rows), F.lit("."),
    )
    agrees = F.concat(
        F.lit("Row count matches expected value: "), grouped_digits(expected), F.lit(".")
    )
    return (
        F.when(expected.isNull(), _outcome("SKIPPED", 0, "No expected row count is available."))
        .when(rows != expected, _outcome("FAIL", F.abs(rows - expected), differs))
        .otherwise(_outcome("PASS", 0, agrees))
    )


def batch_id_rule() -> Column:
    least, rows = F.col("least_batch_id"), F.coalesce("row_count", F.lit(0))
    single = F.coalesce(least == F.col("greatest_batch_id"), F.lit(False))
    other = F.concat(F.lit("Expected "), F.col("batch_id"), F.lit(", received "), least, F.lit("."))
    return (
        F.when(
            ~_has("ingestion_batch_id"),
            _outcome("SKIPPED", 0, "ingestion_batch_id column is unavailable."),
        )
        .when(
            ~single,
            _outcome("FAIL", rows, "Batch contains multiple or zero ingestion_batch_id values."),
        )
        .when(F.col("batch_id") != least, _outcome("FAIL", rows, other))
        .otherwise(
            _outcome("PASS", 0, F.concat(F.lit("Batch identifier is "), least, F.lit(".")))
        )
    )


def idempotency_rule() -> Column:
    batch = F.col("batch_id")
    return (
        F.when(batch.isNull(), _outcome("SKIPPED", 0, "Expected batch ID is unavailable."))
        .when(
            F.col("already_processed"),
            _outcome("FAIL", 1, F.concat(batch, F.lit(" has already been processed."))),
        )
        .otherwise(
            _outcome("PASS", 0, F.concat(batch, F.lit(" has not previously been processed.")))
        )
    )


def readable_rule() -> Column:
    return F.when(
        F.col("readable"), _outcome("PASS", 0, "Parquet file opened successfully.")
    ).otherwise(_outcome("FAIL", 1, F.col("read_message")))


def rule_results(known: DataFrame, baseline: Sequence[str], name: str = "dataset_name") -> DataFrame:
    """Nine rule rows per data set, named by column ``name``; an unreadable one gets the first rule only."""
    rules: dict[str, Column] = {
        "FILE_READABLE": readable_rule(),
        "DQ_SCHEMA_COLUMNS": schema_rule(baseline),
        **{rule: not_null_rule(column) for rule, column in NOT_NULL_RULES.items()},
        "DQ_UNIQUE_EVENT_ID": unique_event_id_rule(),
        "DQ_ROW_COUNT": row_count_rule(),
        "DQ_BATCH_ID": batch_id_rule(),
        "DQ_IDEMPOTENCY": idempotency_rule(),
    }
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("rule_order"), F.lit(r).alias("rule_id"), rules[r].alias("o"))
            for i, r in enumerate(BATCH_RULES, start=1)
        ]
    )
    return (
        known.select(name, "batch_id", "readable", F.explode(listed).alias("r"))
        .where(F.col("readable") | (F.col("r.rule_order") == 1))
        .select(name, "batch_id", "r.rule_order", "r.rule_id", "r.o.*")
    )


# -- summaries -----------------------------------------------------------------------------------


def dataset_results(results: DataFrame, dataset_type: str) -> DataFrame:
    """Overall status and the failed rules, in rule order, of every data set (nine rows each)."""
    failed = F.col("status") == "FAIL"
    names = F.expr(
        "listagg(CASE WHEN status = 'FAIL' THEN rule_id END, ', ') WITHIN GROUP (ORDER BY rule_order)"
    )
    return results.groupBy("dataset_name", "batch_id").agg(
        F.lit(dataset_type).alias("dataset_type"),
        F.when(count_where(failed) > 0, "FAIL").otherwise("PASS").alias("overall_status"),
        count_where(failed).alias("failed_rule_count"),
        F.coalesce(names, F.lit("")).alias("failed_rules"),
    )


def clean_results(results: DataFrame) -> DataFrame:
    return dataset_results(results, "clean").drop("batch_id")


def scenario_results(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Was the fault of each data set noticed by the rule meant for it? Other failures may occur too.

    ``rules``: dataset_name and the ``expected_rule`` of its scenario.
    """
    per_dataset = dataset_results(results, "controlled_failure")
    failed = results.where(F.col("status") == "FAIL").select("dataset_name", F.col("rule_id").alias("failed_rule"))
    detected = (
        rules.join(failed, "dataset_name", "left")
        .groupBy("dataset_name", "expected_rule")
        .agg((count_where(F.col("failed_rule") == F.col("expected_rule")) > 0).alias("expected_failure_detected"))
    )
    return per_dataset.join(detected, "dataset_name").select(
        "dataset_name",
        "dataset_type",
        F.col("batch_id").alias("source_batch_id"),
        "overall_status",
        "expected_rule",
        "expected_failure_detected",
        "failed_rule_count",
        "failed_rules",
    )


def validation_summary(clean: DataFrame, scenarios: DataFrame, results: DataFrame) -> DataFrame:
    passed = count_where(F.col("overall_status") == "PASS")
    noticed = count_where(F.col("expected_failure_detected"))
    return (
        clean.agg(
            _rows().alias("clean_batches_tested"),
            passed.alias("clean_batches_passed"),
            (passed == _rows()).alias("clean_validation_success"),
        )
        .crossJoin(
            scenarios.agg(
                _rows().alias("controlled_scenarios_tested"),
                noticed.alias("controlled_scenarios_detected"),
                (noticed == _rows()).alias("failure_detection_success"),
            )
        )
        .crossJoin(results.agg(_rows().alias("total_validation_rule_results")))
    )
