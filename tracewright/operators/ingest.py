"""Cutting a log into deliveries, and deciding what is published and loaded.

Every decision is a DataFrame with one row per batch; nothing here brings rows to the driver except
the one-row checks that raise.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.fixed_values import HISTORICAL_OUTLIER
from tracewright.functions.numbers import count_where
from tracewright.operators.ordering import global_rank
from tracewright.schema import LOAD_HISTORY, BatchPlan


class PipelineError(RuntimeError):
    """A gate or reconciliation did not hold."""


def _rows() -> Column:
    return F.count(F.lit(1))


# -- batches -------------------------------------------------------------------------------------


def key_integrity(events: DataFrame) -> DataFrame:
    """Missing and repeated event ids as one row."""
    return events.agg(
        count_where(F.col("event_id").isNull()).alias("missing_event_ids"),
        (F.count("event_id") - F.count_distinct("event_id")).alias("repeated_event_ids"),
    )


def require_key_integrity(events: DataFrame) -> None:
    found = key_integrity(events).first()
    if found["missing_event_ids"]:
        raise PipelineError("event_id contains missing values.")
    if found["repeated_event_ids"]:
        raise PipelineError("event_id is not unique.")


def batch_name(sequence: Column) -> Column:
    """``batch_`` and at least four digits; longer numbers are kept whole."""
    return F.format_string("batch_%04d", sequence)


def delivery_columns(rank: Column, plan: BatchPlan = BatchPlan()) -> dict[str, Column]:
    """Delivery metadata of the event with the given chronological rank; event time is untouched."""
    sequence = F.floor((rank - 1) / F.lit(plan.size)) + 1
    first = plan.first_day.isoformat()
    arrival = F.timestamp_add("DAY", sequence - 1, F.lit(first).cast("timestamp_ntz"))
    arrival = F.timestamp_add("HOUR", F.lit(plan.arrival_hour), arrival)
    return {
        "ingestion_batch_id": batch_name(sequence),
        "ingestion_batch_sequence": sequence,
        "simulated_ingestion_timestamp_utc": arrival,
        "simulated_ingestion_date": F.to_date(arrival),
        "batch_row_number": (rank - 1) % F.lit(plan.size) + 1,
    }


def chronological_batches(
    events: DataFrame, plan: BatchPlan = BatchPlan(), partitions: int | None = None
) -> DataFrame:
    """Cut the events, ordered by time and source row, into batches of equal size."""
    ranked = global_rank(
        events,
        [F.asc_nulls_last("event_timestamp"), F.asc_nulls_last("source_row_number")],
        "_rank",
        partitions,
    )
    return ranked.withColumns(delivery_columns(F.col("_rank"), plan)).drop("_rank")


def batch_manifest(batches: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Size, content and (with an inventory of the written files) fingerprint of every batch."""
    manifest = batches.groupBy(
        F.col("ingestion_batch_id").alias("batch_id"),
        F.col("ingestion_batch_sequence").alias("batch_sequence"),
        "simulated_ingestion_date",
    ).agg(
        _rows().alias("row_count"),
        F.count_distinct("case_id").alias("unique_case_count"),
        F.count_distinct("activity").alias("unique_activity_count"),
        F.min("event_timestamp").alias("minimum_event_timestamp"),
        F.max("event_timestamp").alias("maximum_event_timestamp"),
        count_where(F.col("timestamp_quality_status") == HISTORICAL_OUTLIER).alias(
            "historical_outlier_count"
        ),
    )
    if files is not None:
        fingerprints = files.select("batch_id", "file_name", "file_size_bytes", "sha256")
        manifest = manifest.join(fingerprints, "batch_id", "left")
    return manifest.withColumn("status", F.lit("READY"))


def batch_set_check(manifest: DataFrame, events: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Do the batches add up, are their names unique, and is every file there? One row."""
    totals = manifest.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("batch_rows"),
        (_rows() - F.count_distinct("batch_id")).alias("repeated_batch_ids"),
    )
    check = totals.crossJoin(events.agg(_rows().alias("input_rows")))
    if files is None:
        check = check.withColumn("missing_files", F.lit(0).cast("bigint"))
    else:
        absent = manifest.join(files.select("file_name"), "file_name", "left_anti")
        check = check.crossJoin(absent.agg(_rows().alias("missing_files")))
    return check.withColumn(
        "batches_valid",
        (F.col("batch_rows") == F.col("input_rows"))
        & (F.col("repeated_batch_ids") == 0)
        & (F.col("missing_files") == 0),
    )


def require_batch_set(check: DataFrame) -> None:
    found = check.first()
    if not found["batches_valid"]:
        raise PipelineError(f"Batch validation failed: {found.asDict()}")


def batch_summary(manifest: DataFrame, events: DataFrame, plan: BatchPlan = BatchPlan()) -> DataFrame:
    return manifest.agg(
        _rows().alias("batch_count"),
        F.lit(plan.size).cast("bigint").alias("configured_batch_size"),
        F.sum("row_count").alias("total_row_count"),
        F.min("simulated_ingestion_date").alias("first_simulated_ingestion_date"),
        F.max("simulated_ingestion_date").alias("last_simulated_ingestion_date"),
        F.min("row_count").alias("smallest_batch_row_count"),
        F.max("row_count").alias("largest_batch_row_count"),
    ).crossJoin(
        events.agg(
            F.count_distinct("case_id").alias("canonical_case_count"),
            F.count_distinct("activity").alias("canonical_activity_count"),
        )
    )


# -- files and publishing ------------------------------------------------------------------------


def file_integrity(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Compare the manifest with the files found: OK, MISSING, SIZE_MISMATCH or HASH_MISMATCH."""
    found = inventory.select(
        "batch_id",
        F.col("file_size_bytes").alias("actual_size_bytes"),
        F.col("sha256").alias("actual_sha256"),
    )
    return manifest.join(found, "batch_id", "left").select(
        "batch_id",
        "file_size_bytes",
        "actual_size_bytes",
        "sha256",
        "actual_sha256",
        F.when(F.col("actual_size_bytes").isNull(), "MISSING")
        .when(F.col("actual_size_bytes") != F.col("file_size_bytes"), "SIZE_MISMATCH")
        .when(~F.col("actual_sha256").eqNullSafe(F.col("sha256")), "HASH_MISMATCH")
        .otherwise("OK")
        .alias("integrity"),
    )


def require_file_integrity(integrity: DataFrame) -> None:
    bad = integrity.where(F.col("integrity") != "OK").orderBy("batch_id").first()
    if bad:
        raise PipelineError(f"{bad['batch_id']}: {bad['integrity']}")


def landing_key(batch_id: Column) -> Column:
    """Object key of a batch in the landing zone."""
    return F.concat(F.lit("raw/events/"), batch_id, F.lit("/events.parquet"))


def publish_decisions(manifest: DataFrame, target: DataFrame) -> DataFrame:
    """What has to happen to each batch: UPLOAD when absent, SKIPPED when equal, CONFLICT otherwise."""
    present = target.select("batch_id", F.col("sha256").alias("_target_sha256"), F.lit(True).alias("_there"))
    same = F.col("_target_sha256").eqNullSafe(F.col("sha256"))
    return manifest.join(present, "batch_id", "left").select(
        "batch_id",
        "batch_sequence",
        landing_key(F.col("batch_id")).alias("landing_key"),
        "row_count",
        "file_size_bytes",
        "sha256",
        F.when(F.col("_there").isNull(), "UPLOAD")
        .when(same, "SKIPPED")
        .otherwise("CONFLICT")
        .alias("decision"),
    )


def publish_outcomes(decisions: DataFrame, target_after: DataFrame) -> DataFrame:
    """Final status of each batch after the copy; a copy of another size is FAILED."""
    landed = target_after.select("batch_id", F.col("file_size_bytes").alias("_landed_bytes"))
    copied = F.col("_landed_bytes") == F.col("file_size_bytes")
    status = F.when(F.col("decision") != "UPLOAD", F.col("decision")).otherwise(
        F.when(copied, "UPLOADED").otherwise("FAILED")
    )
    # Outcome messages.
    message = (
        F.when(status == "SKIPPED", "Identical object already exists in Cloud Storage.")
        .when(status == "CONFLICT", "Object already exists but SHA-256 metadata differs.")
        .when(status == "FAILED", "Remote object size does not match local file size.")
        .otherwise("Upload completed and remote object size verified.")
    )
    return decisions.join(landed, "batch_id", "left").select(
        "batch_id",
        "batch_sequence",
        "landing_key",
        status.alias("status"),
        "row_count",
        "file_size_bytes",
        "sha256",
        message.alias("message"),
    )


def validated_manifest(manifest: DataFrame, batch_results: DataFrame) -> DataFrame:
    """The batches that took part in the validation."""
    validated = batch_results.select(F.col("dataset_name").alias("batch_id"))
    return manifest.join(validated, "batch_id", "left_semi")


def publish_gate(validation_summary: DataFrame, batch_results: DataFrame) -> DataFrame:
    """May anything be published? Both suite verdicts hold and no batch has failed. One row."""
    failed = batch_results.agg(
        count_where(F.col("overall_status") != "PASS").alias("failed_batches")
    )
    clean = F.coalesce("clean_validation_success", F.lit(False))
    detected = F.coalesce("failure_detection_success", F.lit(False))
    return validation_summary.crossJoin(failed).select(
        clean.alias("clean_validation_success"),
        detected.alias("failure_detection_success"),
        "failed_batches",
        (clean & detected & (F.col("failed_batches") == 0)).alias("may_publish"),
    )


def require_publish_gate(gate: DataFrame) -> None:
    found = gate.first()
    if not found["may_publish"]:
        raise PipelineError(f"Publishing refused: {found.asDict()}")


def require_published(outcomes: DataFrame) -> None:
    """Every batch was uploaded, or was there with the same content."""
    bad = outcomes.where(~F.col("status").isin("UPLOADED", "SKIPPED")).orderBy("batch_id").first()
    if bad is not None:
        raise PipelineError(f"Publishing failed for {bad['batch_id']}: {bad['status']}")


def _status_counts(outcomes: DataFrame) -> DataFrame:
    """Status counts as one map; there are at most five statuses."""
    counted = outcomes.groupBy("status").agg(_rows().alias("n"))
    return counted.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_counts")
    )


def publish_summary(outcomes: DataFrame) -> DataFrame:
    done = count_where(F.col("status").isin("UPLOADED", "SKIPPED"))
    return outcomes.agg(
        _rows().alias("batch_count"),
        done.alias("successful_batches"),
        F.sum("row_count").alias("total_rows"),
        F.sum("file_size_bytes").alias("total_bytes"),
        (done == _rows()).alias("upload_success"),
    ).crossJoin(_status_counts(outcomes))


# -- loading -------------------------------------------------------------------------------------


def rows_per_batch(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("ingestion_batch_id")
        .agg(_rows().alias("row_count"))
        .orderBy(F.asc_nulls_first("ingestion_batch_id"))
    )


def existing_rows(manifest: DataFrame, raw: DataFrame | None) -> DataFrame:
    """Rows already loaded for every batch of the manifest, 0 where there are none or no table."""
    if raw is None:
        return manifest.select("batch_id", F.lit(0).cast("bigint").alias("existing_rows"))
    counted = raw.groupBy(F.col("ingestion_batch_id").alias("batch_id")).agg(_rows().alias("_n"))
    return manifest.join(counted, "batch_id", "left").select(
        "batch_id", F.coalesce("_n", F.lit(0)).alias("existing_rows")
    )


def load_decisions(manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """LOAD when nothing is there, SKIPPED when all is there, CONFLICT when something else is."""
    here, expected = F.col("existing_rows"), F.col("row_count")
    return manifest.join(existing, "batch_id").select(
        "batch_id",
        "batch_sequence",
        expected.alias("expected_rows"),
        "existing_rows",
        "sha256",
        F.when(here == expected, "SKIPPED")
        .when(here != 0, "CONFLICT")
        .otherwise("LOAD")
        .alias("decision"),
    )


def admitted_decisions(decisions: DataFrame, landed_rows: DataFrame) -> DataFrame:
    """The batches an ordered run reaches: everything up to the first one that will not succeed.

    ``landed_rows`` (batch_id, landed_rows) tells before loading which batch will miss its count.
    """
    known = decisions.join(landed_rows, "batch_id", "left").withColumn(
        "landed_rows", F.coalesce("landed_rows", F.lit(0))
    )
    fails = (F.col("decision") == "CONFLICT") | (
        (F.col("decision") == "LOAD") & (F.col("landed_rows") != F.col("expected_rows"))
    )
    stop = known.agg(F.min(F.when(fails, F.col("batch_sequence"))).alias("_stop"))
    return (
        known.crossJoin(stop)
        .where(F.col("_stop").isNull() | (F.col("batch_sequence") <= F.col("_stop")))
        .drop("_stop")
    )


def load_outcomes(
    decisions: DataFrame,
    recounted: DataFrame,
    *,
    run_id: str,
    loaded_at: datetime,
    landing_root: str,
    job_id: str | None = None,
) -> DataFrame:
    """Audit rows of a run: decisions and the rows counted after loading."""
    after = recounted.select("batch_id", F.col("existing_rows").alias("_after"))
    loads = F.col("decision") == "LOAD"
    loaded = F.when(loads, F.coalesce("_after", F.lit(0))).otherwise(F.col("existing_rows"))
    status = F.when(~loads, F.col("decision")).otherwise(
        F.when(loaded == F.col("expected_rows"), "LOADED").otherwise("FAILED")
    )
    # Audit messages.
    message = (
        F.when(status == "SKIPPED", "Expected batch row count already exists in raw.events.")
        .when(status == "CONFLICT", "Partial or unexpected batch already exists in raw.events.")
        .when(status == "LOADED", "Batch loaded successfully and row count reconciled.")
        .otherwise(
            F.format_string("Expected %d rows after load, found %d.", "expected_rows", loaded)
        )
    )
    columns = {
        "run_id": F.lit(run_id),
        "batch_id": F.col("batch_id"),
        "landing_uri": F.concat(F.lit(landing_root.rstrip("/") + "/"), landing_key(F.col("batch_id"))),
        "expected_rows": F.col("expected_rows"),
        "loaded_rows": loaded,
        "status": status,
        "job_id": F.when(loads, F.lit(job_id)),
        "sha256": F.col("sha256"),
        "message": message,
        "load_timestamp_utc": F.lit(loaded_at.isoformat()),
    }
    return decisions.join(after, "batch_id", "left").select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in LOAD_HISTORY]
    )


def require_loaded(outcomes: DataFrame) -> None:
    bad = (
        outcomes.where(~F.col("status").isin("LOADED", "SKIPPED")).orderBy("batch_id").first()
    )
    if bad:
        raise PipelineError(f"{bad['batch_id']} finished with {bad['status']}: {bad['message']}")


def raw_metrics(raw: DataFrame) -> DataFrame:
    return raw.agg(
        _rows().alias("total_rows"),
        F.count_distinct("event_id").alias("unique_event_ids"),
        F.count_distinct("case_id").alias("unique_cases"),
        F.count_distinct("activity").alias("unique_activities"),
        F.count_distinct("ingestion_batch_id").alias("ingestion_batches"),
    )


def raw_reconciliation(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """RAW metrics next to what the manifest promises, with the verdict. One row."""
    promised = manifest.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("expected_rows"),
        _rows().alias("expected_batches"),
    )
    return raw_metrics(raw).crossJoin(promised).withColumn(
        "raw_load_success",
        (F.col("total_rows") == F.col("expected_rows"))
        & (F.col("unique_event_ids") == F.col("expected_rows"))
        & (F.col("ingestion_batches") == F.col("expected_batches")),
    )


def require_raw_reconciliation(reconciliation: DataFrame) -> None:
    found = reconciliation.first()
    if not found["raw_load_success"]:
        raise PipelineError(f"Final RAW reconciliation failed: {found.asDict()}")


def load_audit(history: DataFrame) -> DataFrame:
    """The load history, newest first."""
    return history.select(
        "batch_id", "expected_rows", "loaded_rows", "status", "job_id", "load_timestamp_utc"
    ).orderBy(F.desc("load_timestamp_utc"), "batch_id")


def load_summary(outcomes: DataFrame, raw: DataFrame) -> DataFrame:
    done = count_where(F.col("status").isin("LOADED", "SKIPPED"))
    return (
        outcomes.agg(
            _rows().alias("batches_processed"),
            done.alias("successful_batches"),
            (done == _rows()).alias("raw_load_success"),
        )
        .crossJoin(_status_counts(outcomes))
        .crossJoin(raw_metrics(raw))
    )


