"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.fixed_values import BATCH_RULES
from tracewright.functions.text import standard_text
from tracewright.functions.time import parse_utc
from tracewright.operators import analytics, ingest, monitor, profile, staging, standardize, validate
from tracewright.operators.ordering import positions_in_group
from tracewright.plans import load, prepare, publish, scenarios
from tracewright.plans.build import Databases, build_analytics, build_staging, run_monitoring
from tracewright.schema import (
    LOAD_HISTORY,
    MANIFEST,
    RAW,
    BatchPlan,
    SkewPlan,
    YearBounds,
)
from tracewright.shared_storage import settle, shared_folder
from tracewright.sources import files, sinks, storage, xes
from tracewright.streaming.incremental_load import stream_landed
from verification import logs
from verification.logs import BATCH_SIZE, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

RUN_ID = "run-1"
RUN_AT = datetime(2026, 2, 1, 12, 0, 0)
PLAN = BatchPlan(size=BATCH_SIZE)
ORDER_BOUNDS = YearBounds(historical_before=1996, edge_before=1996, edge_after=2001)


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- shared inputs -------------------------------------------------------------------------------


class UserDays:
    """RAW, staged events and cases of the user-day log with redelivered events."""

    def __init__(self, spark: SparkSession, sf_dir: str, skew: SkewPlan = SkewPlan()):
        self.raw = logs.redelivered_raw(spark, sf_dir)
        self.hot = staging.hot_cases(self.raw, skew)
        self.events = staging.staged_events(self.raw, self.hot)

    def written(self, *columns: str) -> UserDays:
        """Go on from the written event table, as the analytics and monitoring layers do.

        ``columns`` names the columns that are needed, when they are few.
        """
        self.events = settle(self.events.select(*columns) if columns else self.events)
        return self

    @property
    def cases(self) -> DataFrame:
        return staging.case_table(self.events, self.hot)

    @property
    def kpis(self) -> DataFrame:
        return analytics.case_kpis(self.events, self.hot)

    @property
    def variants(self) -> DataFrame:
        return analytics.process_variants(self.events, self.kpis, exact=True)

    @property
    def variant_statistics(self) -> DataFrame:
        variants = analytics.case_variants(self.events)
        return analytics.variant_statistics(variants, self.kpis, exact=True)


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in logs.ORDER_LOG_KEY]
    numbered = standardize.numbered_source(logs.order_events(spark, sf_dir), order)
    return logs.order_source_log(numbered, "source_row_number")


def renamed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.renamed_source(numbered_orders(spark, sf_dir))


def cleaned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and typed order events without row numbers."""
    log = logs.order_source_log(
        logs.order_events(spark, sf_dir), "cast(null as bigint) as source_row_number"
    )
    renamed = standardize.renamed_source(log)
    return standardize.with_calendar(standardize.typed_source(standardize.cleaned_source(renamed)))


def canonical_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.canonical_events(
        numbered_orders(spark, sf_dir),
        source_file="orders",
        pipeline_batch_id="order_snapshot",
        processed_at=RUN_AT,
        bounds=ORDER_BOUNDS,
    )


def classified_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and classified order events as a written table."""
    classified = cleaned_orders(spark, sf_dir).withColumn(
        "timestamp_quality_status",
        standardize.timestamp_quality(F.col("event_timestamp"), ORDER_BOUNDS),
    )
    return settle(classified)


def user_day_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-day log cut into batches by the batching operator."""
    events = logs.user_day_raw(spark, sf_dir)
    delivery = [c for c in RAW.names if c.startswith(("ingestion_", "simulated_", "batch_"))]
    batches = ingest.chronological_batches(events.drop(*delivery), PLAN)
    return batches.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW])


def manifest_of(batches: DataFrame) -> DataFrame:
    return ingest.batch_manifest(batches)


# -- sources and sinks ---------------------------------------------------------------------------


#: Events of one XES file, so that the task that writes it has a bounded part of the log.
XES_FILE_EVENTS = 100_000


def write_xes(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The user-day log as an XES file set: a trace per user, day and thousand events."""
    events = table(spark, sf_dir, "events")
    count = max(4, -(-events.count() // XES_FILE_EVENTS))

    def typed(kind: str, **pairs: str) -> str:
        inner = ", ".join(
            f"named_struct('_key', '{k.replace('__', ':')}', '_value', {v})" for k, v in pairs.items()
        )
        return f"array({inner}) as {kind}"

    event = (
        "named_struct("
        "'string', array("
        "named_struct('_key', 'concept:name', '_value', event_type), "
        "named_struct('_key', 'org:resource', '_value', concat('user_', cast(user_id % 10 as string)))), "
        "'date', array(named_struct('_key', 'time:timestamp', '_value', "
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00'))), "
        "'float', array(named_struct('_key', 'Cumulative net worth (EUR)', '_value', cast(value as string))))"
    )
    traces = (
        events
        .selectExpr(
            "concat(cast(user_id as string), '_', cast(cast(ts as date) as string)) as case_id",
            "user_id", "event_id", f"event_id div {BATCH_SIZE} as piece", f"{event} as e",
        )
        .groupBy("case_id", "user_id", "piece")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "e"))), lambda x: x["e"]).alias("event"))
        # Four files or more in the order of their traces, so that the place of every event is known.
        .repartitionByRange(count, "case_id", "piece")
        .sortWithinPartitions("case_id", "piece")
        .selectExpr(
            "array(named_struct('_key', 'concept:name', '_value', case_id), "
            "named_struct('_key', 'Name', '_value', concat('user <', cast(user_id as string), '>'))) as string",
            "array(named_struct('_key', 'Goods Receipt', '_value', cast(user_id % 2 = 0 as string))) as boolean",
            "event",
        )
    )
    traces.write.format("xml").option("rootTag", "log").option("rowTag", "trace").save(path)


@query
def src_xes_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    write_xes(spark, sf_dir, path)
    log = xes.require_events(xes.read_xes(spark, path))
    return log.select(
        F.col("`case:concept:name`").alias("case_id"),
        F.col("`case:Name`").alias("case_name"),
        F.col("`concept:name`").alias("activity"),
        F.col("`org:resource`").alias("resource_id"),
        F.col("`case:Vendor`").alias("vendor_id"),
        F.col("`case:Goods Receipt`").alias("goods_receipt_required"),
        parse_utc(F.col("`time:timestamp`"), log.schema["time:timestamp"].dataType).alias("event_timestamp"),
        F.col("`Cumulative net worth (EUR)`").try_cast("double").alias("net_worth"),
    )


@query
def std_file_order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of an XES log of several files, and the event that each number belongs to."""
    path = shared_folder(spark)
    write_xes(spark, sf_dir, path)
    log = settle(xes.read_xes(spark, path))
    several = log.agg((F.count_distinct("_file") >= 3).alias("in_several_files"))
    return standardize.numbered_file_rows(log).crossJoin(F.broadcast(several)).select(
        "source_row_number",
        F.col("`case:concept:name`").alias("case_id"),
        F.col("`concept:name`").alias("activity"),
        parse_utc(F.col("`time:timestamp`"), log.schema["time:timestamp"].dataType).alias("event_timestamp"),
        "in_several_files",
    )


@query
def src_canonical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_canonical(canonical_orders(spark, sf_dir), path)
    return (
        files.read_canonical(spark, path)
        .groupBy("event_year", "event_month")
        .agg(F.count(F.lit(1)).alias("event_count"), F.count("resource_id").alias("known_resources"))
    )


@query
def snk_canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_canonical(canonical_orders(spark, sf_dir), path)
    return files.read_canonical(spark, path).select(
        "event_id", "case_id", "activity", "event_sequence", "event_timestamp", "event_year", "event_month"
    )


def landed_batches(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = shared_folder(spark)
    sinks.write_batches(user_day_batches(spark, sf_dir), path)
    return path, files.read_landed(spark, path)


@query
def snk_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and order of the batch files as read back."""
    _, landed = landed_batches(spark, sf_dir)
    return landed.groupBy("ingestion_batch_id").agg(
        F.count_distinct("landed_path").alias("file_count"),
        F.count(F.lit(1)).alias("row_count"),
        F.min("batch_row_number").alias("first_row"),
        F.max("batch_row_number").alias("last_row"),
        F.min("event_id").alias("least_event_id"),
        F.max("event_id").alias("greatest_event_id"),
    )


@query
def src_landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files of which some are cut or overwritten in storage: what can be read of them."""
    root, _ = delivered_files(spark, sf_dir, {0: "whole", 1: "cut", 2: "overwritten", 3: "whole"})
    landed = files.read_landed(spark, root)
    return files.readability(files.file_inventory(spark, root), files.decoded_files(landed)).select(
        "batch_id",
        "readable",
        "read_message",
        F.size("columns").cast("bigint").alias("column_count"),
    )


@query
def src_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    batches = user_day_batches(spark, sf_dir)
    inventory = spark.createDataFrame(
        [], "batch_id string, file_name string, file_size_bytes bigint, sha256 string"
    )
    manifest = ingest.batch_manifest(batches, inventory)
    sinks.write_csv(manifest.select(*MANIFEST.names), path)
    return files.read_manifest(spark, path)


@query
def src_given_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, size and SHA-256 of every given file."""
    return files.file_inventory(spark, sf_dir, name_root=sf_dir).select("file_name", "file_size_bytes", "sha256")


@query
def src_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files as listed, streamed and as their footers say: the digest of each equals that of a copy."""
    path, manifest = described_batches(spark, sf_dir)
    root, _ = delivered_files(spark, sf_dir, dict.fromkeys(range(4), "whole"))
    copies = files.file_inventory(spark, root).select("batch_id", F.col("sha256").alias("copied"))
    return manifest.join(copies, "batch_id").select(
        "batch_id",
        (F.col("file_size_bytes") > 0).alias("has_bytes"),
        F.length("sha256").cast("bigint").alias("digest_length"),
        (F.col("sha256") == F.col("copied")).alias("same_as_copy"),
    )


def _databases(spark: SparkSession) -> tuple[str, str]:
    folder = shared_folder(spark)
    name = "tw_" + folder.rsplit("/", 1)[1]
    sinks.create_database(spark, name, folder)
    return name, folder


@query
def snk_raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The redelivered log appended in two loads."""
    name, _ = _databases(spark)
    first = logs.user_day_raw(spark, sf_dir)
    sinks.append_raw(first, f"{name}.events")
    sinks.append_raw(first.withColumn("ingestion_batch_sequence", F.col("ingestion_batch_sequence") + 1), f"{name}.events")
    return spark.table(f"{name}.events").select(
        "event_id", "case_id", "ingestion_batch_sequence", "simulated_ingestion_date"
    )


@query
def snk_replaced_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """staging.events replaced twice in its partitioned layout and read back."""
    name, _ = _databases(spark)
    log = UserDays(spark, sf_dir)
    for _ in range(2):
        sinks.replace_table(log.events, f"{name}.events", "staging.events")
    return spark.table(f"{name}.events").select(
        "event_id", "event_date", "case_id", "activity", "process_event_sequence"
    )


@query
def snk_audit_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load history of two runs in the append-only audit table."""
    name, _ = _databases(spark)
    history = f"{name}.batch_load_history"
    sinks.ensure_audit_table(spark, history, LOAD_HISTORY, "load_timestamp_utc")
    for run in ("run-1", "run-2"):
        rows = load_history(spark, sf_dir).withColumn("run_id", F.lit(run))
        sinks.append_audit(rows, history, LOAD_HISTORY, "load_timestamp_utc")
    return spark.table(history).select(
        "run_id", "batch_id", "expected_rows", "loaded_rows", "status", "message",
        "load_timestamp_utc", "run_date",
    )


@query
def snk_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case report sample written as CSV and read back."""
    path = shared_folder(spark)
    cases = profile.case_profile(standardize_user_days(spark, sf_dir))
    sinks.write_csv(sinks.sample_rows(cases, ["case_id"], sinks.SAMPLE_ROWS["cases"]), path)
    return spark.read.option("header", True).option("timestampNTZFormat", files.REPORT_TIME).schema(
        "case_id string, event_count bigint, first_event timestamp_ntz, last_event timestamp_ntz, "
        "unique_activity_count bigint, case_duration_hours double"
    ).csv(path)


@query
def snk_event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of events (JSON) and of canonical rows (CSV), written and read back."""
    path = shared_folder(spark)
    events = standardize_user_days(spark, sf_dir).select(
        "event_id", "case_id", "activity", "event_timestamp", "resource_id"
    )
    sinks.write_json(sinks.sample_rows(events, ["event_id"], sinks.SAMPLE_ROWS["events"]), f"{path}/events")
    sinks.write_csv(sinks.sample_rows(events, ["event_id"], sinks.SAMPLE_ROWS["canonical"]), f"{path}/canonical")
    reader = lambda: spark.read.schema(events.schema).option("timestampNTZFormat", files.REPORT_TIME)
    back = {
        "events": reader().json(f"{path}/events"),
        "canonical": reader().option("header", True).csv(f"{path}/canonical"),
    }
    return back["events"].withColumn("report", F.lit("events")).unionByName(
        back["canonical"].withColumn("report", F.lit("canonical"))
    )


@query
def snk_json_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standardisation summary written as JSON and read back."""
    path = shared_folder(spark)
    summary = profile.standardization_summary(classified_orders(spark, sf_dir))
    sinks.write_json(summary, path)
    back = spark.read.schema(summary.schema).option("timestampNTZFormat", files.REPORT_TIME).json(path)
    return _flat_quality_counts(back)


@query
def snk_table_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven layouts: rows by the footers, and files whose key range crosses that of the one before."""
    name, folder = _databases(spark)
    log = UserDays(spark, sf_dir).written()
    sinks.append_raw(log.raw, f"{name}.raw_events")
    tables = {
        "staging.events": log.events,
        "staging.cases": log.cases,
        "analytics.case_kpis": log.kpis,
        "analytics.activity_performance": analytics.activity_performance(log.events),
        "analytics.transitions": analytics.transitions(log.events),
    }
    for layout, df in tables.items():
        sinks.replace_table(df, f"{name}.{layout.replace('.', '_')}", layout)
    sinks.ensure_audit_table(spark, f"{name}.history", LOAD_HISTORY, "load_timestamp_utc")
    sinks.append_audit(load_history(spark, sf_dir), f"{name}.history", LOAD_HISTORY, "load_timestamp_utc")
    keys = {"raw_events": "case_id", "history": "batch_id"}
    keys |= {layout.replace(".", "_"): sinks.LAYOUTS[layout].cluster_by[0] for layout in tables}
    parts = [
        sinks.key_range_summary(spark, f"{folder}/{table}", key).withColumn("table_name", F.lit(table))
        for table, key in keys.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("table_name", "row_count", "crossing_files")


# -- standardisation -----------------------------------------------------------------------------


@query
def std_renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed_orders(spark, sf_dir)


@query
def std_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = logs.order_events(spark, sf_dir)
    numbered = standardize.numbered_source(events, [F.col(c) for c in logs.ORDER_LOG_KEY])
    return numbered.select(
        "source_row_number",
        F.col("source_row_number").alias("event_id"),
        "order_key", "activity", "ts", "line", "part", "supplier", "price",
    )


@query
def std_text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(spark, sf_dir).select(
        *standardize.IDENTIFIER_COLUMNS, *standardize.DESCRIPTIVE_COLUMNS
    )


@query
def std_missing_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        cleaned_orders(spark, sf_dir)
        .groupBy("resource_id")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


@query
def std_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(spark, sf_dir).select("case_id", "activity", "event_timestamp")


@query
def std_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(spark, sf_dir).select("case_id", "activity", "cumulative_net_worth_eur")


@query
def std_calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(spark, sf_dir).select(
        "case_id", "event_timestamp", "event_year", "event_month", "event_date"
    )


@query
def std_timestamp_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_orders(spark, sf_dir).select(
        "case_id", "event_timestamp", "timestamp_quality_status"
    )


@query
def std_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.with_lineage(
        cleaned_orders(spark, sf_dir).select("case_id", "activity"), "orders", "order_snapshot", RUN_AT
    )


@query
def std_event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_orders(spark, sf_dir).select(
        "event_id", "case_id", "event_timestamp", "event_sequence"
    )


@query
def std_canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_orders(spark, sf_dir)


# -- profiles ------------------------------------------------------------------------------------


def standardize_user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-day log with clean activities, as a log to profile."""
    raw = logs.user_day_raw(spark, sf_dir)
    return raw.withColumn("activity", standard_text(F.col("activity")))


@query
def prf_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(table(spark, sf_dir, "customer"))


@query
def prf_canonical_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every canonical column."""
    return profile.schema_profile(settle(canonical_orders(spark, sf_dir)))


@query
def prf_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.order_events(spark, sf_dir).selectExpr(
        "nullif(activity, 'Ship OA') as activity"
    )
    return profile.activity_frequency(log)


@query
def prf_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.case_profile(standardize_user_days(spark, sf_dir))


@query
def prf_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = standardize_user_days(spark, sf_dir)
    return profile.log_profile(log, profile.case_profile(log))


@query
def prf_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.year_distribution(cleaned_orders(spark, sf_dir))


@query
def prf_earliest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = logs.order_events(spark, sf_dir)
    return profile.earliest_events(
        events,
        ["ts", "order_key", "activity", "line", "not_there", "price"],
        event_time="ts",
        tie_break=logs.ORDER_LOG_KEY[1:],
    )


@query
def prf_largest_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.order_events(spark, sf_dir).selectExpr(
        "cast(order_key as string) as case_id", "activity", "ts as event_timestamp",
        "supplier", "line", "order_key", "ts", "part", "price",
    )
    return profile.largest_cases(
        log, {"vendor": "supplier", "item": "line"}, order=logs.ORDER_LOG_KEY
    )


@query
def prf_column_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.agreement_summary(
        logs.order_source_log(logs.order_events(spark, sf_dir)), "User", "org:resource"
    )


@query
def prf_value_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = logs.order_source_log(logs.order_events(spark, sf_dir))
    pairs = profile.pair_frequency(log, "User", "org:resource")
    return pairs.toDF("user_value", "resource_value", "event_count")


@query
def prf_case_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.case_labels(labelled_orders(spark, sf_dir), logs.ORDER_LOG_KEY)


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with a label that is missing, equal to the id or differs inside a case."""
    return logs.order_events(spark, sf_dir).selectExpr(
        "*",
        "cast(order_key as string) as case_id",
        "case when order_key % 5 = 0 then null when order_key % 5 = 1 then cast(order_key as string)"
        " else activity end as case_name",
    )


@query
def prf_case_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = profile.case_labels(labelled_orders(spark, sf_dir), logs.ORDER_LOG_KEY)
    return profile.case_label_summary(labels)


@query
def prf_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["c_mktsegment", "c_nationkey", "c_name", "not_there"]
    return profile.top_values(table(spark, sf_dir, "customer"), fields)


@query
def prf_field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per field; its most frequent values as text, best first."""
    fields = ["c_mktsegment", "c_nationkey", "c_name", "not_there"]
    nested = profile.field_profile(table(spark, sf_dir, "customer"), fields)
    entry = lambda e: F.concat_ws("=", F.coalesce(e["value"], F.lit("NULL")), e["event_count"].cast("string"))
    return nested.withColumn("top_values", F.array_join(F.transform("top_values", entry), ";"))


@query
def prf_standardization_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_quality_counts(profile.standardization_summary(classified_orders(spark, sf_dir)))


def _flat_quality_counts(summary: DataFrame) -> DataFrame:
    entries = F.transform(
        F.array_sort(F.map_entries("timestamp_quality_counts")),
        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
    )
    return summary.withColumn("timestamp_quality_counts", F.array_join(entries, ","))


@query
def prf_potential_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.potential_duplicates(cleaned_orders(spark, sf_dir))


@query
def prf_timestamp_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.timestamp_quality_distribution(classified_orders(spark, sf_dir))


@query
def prf_outlier_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outlier_activities(classified_orders(spark, sf_dir))


# -- batches and loading -------------------------------------------------------------------------


@query
def ing_key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.key_integrity(logs.redelivered_raw(spark, sf_dir))


@query
def ing_chronological_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events, with many equal times and unreadable ones, cut into batches."""
    # The columns that are wanted go in: the ranking writes what it is given.
    events = canonical_orders(spark, sf_dir).select("event_id", "event_timestamp", "source_row_number")
    return ingest.chronological_batches(events, PLAN).select("event_id", "ingestion_batch_id", "batch_row_number")


@query
def ing_delivery_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_day_batches(spark, sf_dir).select(
        "event_id", "event_timestamp", "ingestion_batch_id", "ingestion_batch_sequence",
        "simulated_ingestion_timestamp_utc", "simulated_ingestion_date", "batch_row_number",
    )


@query
def ing_batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_of(user_day_batches(spark, sf_dir))


@query
def ing_batch_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = user_day_batches(spark, sf_dir)
    return ingest.batch_set_check(manifest_of(batches), logs.user_day_raw(spark, sf_dir))


@query
def ing_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = user_day_batches(spark, sf_dir)
    return ingest.batch_summary(manifest_of(batches), standardize_user_days(spark, sf_dir), PLAN)


def described_batches(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Batch files and their manifest with fingerprints."""
    path, landed = landed_batches(spark, sf_dir)
    inventory = settle(files.file_inventory(spark, path, name_root=path))
    return path, settle(ingest.batch_manifest(landed, inventory))


def delivered_files(spark: SparkSession, sf_dir: str, kinds: dict[int, str]) -> tuple[str, DataFrame]:
    """Copies of the batch files, each damaged by its batch's number modulo 4 (none: not copied)."""
    path, manifest = described_batches(spark, sf_dir)
    root = shared_folder(spark)
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[(F.col("batch_sequence") % 4).cast("int")]
    plan = (
        files.listed_files(spark, path)
        .join(manifest.select("batch_id", kind.alias("kind")), "batch_id")
        .where(F.col("kind").isNotNull())
        .select(
            F.col("path").alias("source"),
            F.concat(
                F.lit(f"{publish.qualified(spark, root)}/"), "batch_id", F.lit("/events.parquet")
            ).alias("target"),
            "kind",
        )
    )
    settle(storage.copied(plan, scenarios.copy_tasks(spark, plan)))
    return root, manifest


@query
def ing_file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest against landed files of which some were lost, cut or altered in storage."""
    root, manifest = delivered_files(spark, sf_dir, {0: "whole", 2: "cut", 3: "overwritten"})
    return ingest.file_integrity(manifest, files.file_inventory(spark, root)).select("batch_id", "integrity")


def publish_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A manifest whose digests are derived from the batch content, and a partly filled target."""
    batches = user_day_batches(spark, sf_dir)
    manifest = manifest_of(batches).withColumns(
        {
            "sha256": F.sha2(F.concat_ws("|", "batch_id", "row_count", "unique_case_count"), 256),
            "file_size_bytes": F.col("row_count") * 30,
        }
    )
    manifest = settle(manifest)
    kind = F.col("batch_sequence") % 3
    target = manifest.withColumns(
        {
            "batch_id": F.when(kind == 0, F.concat(F.lit("other_"), "batch_id")).otherwise(F.col("batch_id")),
            "sha256": F.when(kind == 1, F.lit("different")).otherwise(F.col("sha256")),
        }
    )
    return manifest, target.select("batch_id", "sha256", "file_size_bytes")


@query
def ing_publish_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.publish_decisions(*publish_inputs(spark, sf_dir))


def publish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes after a copy in which every sixth batch arrives short."""
    manifest, target = publish_inputs(spark, sf_dir)
    decisions = ingest.publish_decisions(manifest, target)
    short = F.when(F.col("batch_sequence") % 6 == 0, 1).otherwise(0)
    after = manifest.select("batch_id", (F.col("file_size_bytes") - short).alias("file_size_bytes"))
    return ingest.publish_outcomes(decisions, after)


@query
def ing_publish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_outcomes(spark, sf_dir)


@query
def ing_publish_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files copied to an empty landing zone, then published again."""
    path, manifest = described_batches(spark, sf_dir)
    root = shared_folder(spark)
    first = publish.publish(spark, manifest, path, root)
    second = publish.publish(spark, manifest, path, root)
    keep = ["batch_id", "landing_key", "row_count", "status", "message"]
    return (
        first.select(F.lit(1).cast("bigint").alias("attempt"), *keep)
        .unionByName(second.select(F.lit(2).cast("bigint").alias("attempt"), *keep))
    )


@query
def ing_publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, scenarios, results = validated(spark, sf_dir)
    return ingest.publish_gate(validate.validation_summary(clean, scenarios, results), clean)


@query
def ing_publish_gate_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third clean batch has failed."""
    clean, scenarios, results = validated(spark, sf_dir)
    third = F.substring_index("dataset_name", "_", -1).cast("int") % 3 == 0
    status = F.when(third, "FAIL").otherwise(F.col("overall_status"))
    failing = settle(clean.withColumn("overall_status", status))
    return ingest.publish_gate(validate.validation_summary(failing, scenarios, results), failing)


@query
def ing_validated_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _, _ = validated(spark, sf_dir)
    manifest = manifest_of(logs.redelivered_raw(spark, sf_dir))
    return ingest.validated_manifest(manifest, clean).select("batch_id", "row_count")


def _flat_status_counts(summary: DataFrame) -> DataFrame:
    entries = F.transform(
        F.array_sort(F.map_entries("status_counts")),
        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
    )
    return summary.withColumn("status_counts", F.array_join(entries, ","))


@query
def ing_publish_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_status_counts(ingest.publish_summary(publish_outcomes(spark, sf_dir)))


def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the user-day batches should hold; every seventh batch is announced one row too large."""
    wrong = F.when(F.col("batch_sequence") % 7 == 0, 1).otherwise(0)
    return manifest_of(logs.user_day_raw(spark, sf_dir)).withColumns(
        {"row_count": F.col("row_count") + wrong, "sha256": F.sha2("batch_id", 256)}
    )


def partly_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW after an earlier load: some batches complete, some doubled, some absent."""
    copies = "explode(array_repeat(1, cast(ingestion_batch_sequence % 3 as int))) as copy"
    return logs.user_day_raw(spark, sf_dir).selectExpr("*", copies).drop("copy")


@query
def ing_existing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.existing_rows(load_manifest(spark, sf_dir), partly_loaded(spark, sf_dir))


def load_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = load_manifest(spark, sf_dir)
    return ingest.load_decisions(
        manifest, ingest.existing_rows(manifest, partly_loaded(spark, sf_dir))
    )


@query
def ing_load_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_decisions(spark, sf_dir)


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a run over all batches, recounted as if every missing batch had been appended."""
    decisions = load_decisions(spark, sf_dir)
    after = ingest.existing_rows(decisions, logs.user_day_raw(spark, sf_dir))
    return ingest.load_outcomes(
        decisions, after, run_id=RUN_ID, loaded_at=RUN_AT, landing_root="landing", job_id="job-1"
    )


@query
def ing_load_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_history(spark, sf_dir)


@query
def ing_admitted_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered run ends at the first batch that cannot succeed."""
    landed = logs.user_day_raw(spark, sf_dir).groupBy(
        F.col("ingestion_batch_id").alias("batch_id")
    ).agg(F.count(F.lit(1)).alias("landed_rows"))
    manifest = load_manifest(spark, sf_dir)
    decisions = ingest.load_decisions(manifest, ingest.existing_rows(manifest, None))
    return ingest.admitted_decisions(decisions, landed).select(
        "batch_id", "expected_rows", "landed_rows", "decision"
    )


@query
def ing_load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches loaded, then the same run again."""
    name, folder = _databases(spark)
    landed = logs.user_day_raw(spark, sf_dir)
    manifest = settle(manifest_of(landed).withColumn("sha256", F.sha2("batch_id", 256)))
    for run in ("run-1", "run-2"):
        outcomes = load.load_batches(
            spark, landed, manifest, raw=f"{name}.events", history=f"{name}.batch_load_history",
            run_id=run, loaded_at=RUN_AT, landing_root=folder,
        )
        ingest.require_loaded(outcomes)
    ingest.require_raw_reconciliation(
        ingest.raw_reconciliation(spark.table(f"{name}.events"), manifest)
    )
    return spark.table(f"{name}.batch_load_history").select(
        "run_id", "batch_id", "expected_rows", "loaded_rows", "status", "message"
    )


@query
def ing_incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch files loaded by the file stream; a second run of the stream finds nothing new."""
    name, folder = _databases(spark)
    path, manifest = described_batches(spark, sf_dir)
    for run in ("run-1", "run-2"):
        stream_landed(
            spark, path, lambda: manifest, raw=f"{name}.events",
            history=f"{name}.batch_load_history", checkpoint=f"{folder}/checkpoint",
            run_id=run, clock=lambda: RUN_AT,
        ).awaitTermination()
    return spark.table(f"{name}.batch_load_history").select(
        "run_id", "batch_id", "expected_rows", "loaded_rows", "status"
    )


@query
def ing_stream_late_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the manifest comes a run later: the batches wait and no row is lost."""
    name, folder = _databases(spark)
    path, manifest = described_batches(spark, sf_dir)
    early = manifest.where("batch_sequence % 2 = 1")
    for run, known in (("run-1", early), ("run-2", manifest)):
        started = stream_landed(
            spark, path, lambda known=known: known, raw=f"{name}.events",
            history=f"{name}.batch_load_history", checkpoint=f"{folder}/checkpoint",
            run_id=run, clock=lambda: RUN_AT,
        )
        try:
            started.awaitTermination()
        except StreamingQueryException as error:
            if run == "run-2" or "no manifest row" not in str(error):
                raise
    ingest.require_raw_reconciliation(ingest.raw_reconciliation(spark.table(f"{name}.events"), manifest))
    return spark.table(f"{name}.batch_load_history").select("run_id", "batch_id", "loaded_rows", "status")


@query
def ing_raw_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = logs.redelivered_raw(spark, sf_dir)
    return ingest.raw_reconciliation(raw, manifest_of(raw))


@query
def ing_rows_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rows_per_batch(logs.redelivered_raw(spark, sf_dir))


@query
def ing_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.load_audit(load_history(spark, sf_dir))


@query
def ing_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = logs.redelivered_raw(spark, sf_dir)
    return _flat_status_counts(ingest.load_summary(load_history(spark, sf_dir), raw))


# -- batch validation ----------------------------------------------------------------------------


def delivered(spark: SparkSession, sf_dir: str, fault: str) -> DataFrame:
    """All batches with one fault of rows in each of them."""
    batches = logs.user_day_raw(spark, sf_dir)
    change = scenarios.FAULTS[fault].rows if fault in scenarios.FAULTS else None
    return change(batches) if change else batches


def suite_results(
    spark: SparkSession, sf_dir: str, fault: str, manifest: DataFrame | None = None
) -> DataFrame:
    """Rule results for every batch delivered with ``fault`` ("clean" for none)."""
    manifest = manifest or manifest_of(logs.user_day_raw(spark, sf_dir))
    landed = delivered(spark, sf_dir, fault)
    columns = F.array(*[F.lit(c) for c in landed.columns])
    name = F.col("ingestion_batch_id") if fault == "clean" else F.concat_ws("/", F.lit(fault), "ingestion_batch_id")
    landed = landed.withColumn("dataset_name", name)
    if fault == "schema_drift":
        landed = landed.withColumn("activity", F.lit(None).cast("string"))
    label = F.col("batch_id") if fault == "clean" else F.concat_ws("/", F.lit(fault), "batch_id")
    expected = manifest.select(
        label.alias("dataset_name"),
        "batch_id",
        F.col("row_count").alias("expected_rows"),
        F.lit(True).alias("readable"),
        F.lit(None).cast("string").alias("read_message"),
        columns.alias("columns"),
    )
    processed = None
    if fault == "duplicate_batch_delivery":
        processed = expected.select("dataset_name", "batch_id")
    return validate.rule_results(validate.facts(expected, validate.measured(landed), processed), RAW.names)


def fault_results(spark: SparkSession, path: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rule results of all scenario trees, and the scenario manifest; the baseline is the first clean batch."""
    root = shared_folder(spark)
    described = settle(scenarios.deliver_scenarios(spark, path, manifest, root))
    baseline = publish.baseline_columns(spark, path, manifest)
    return scenarios.validate_scenarios(spark, root, described, baseline), described


def validated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    path, manifest = described_batches(spark, sf_dir)
    clean = settle(publish.validate_files(spark, path, manifest))
    results, described = fault_results(spark, path, manifest)
    faulty = settle(results)
    return validate.clean_results(clean), scenarios.detected(faulty, described), clean.unionByName(faulty)


def _rules(results: DataFrame, *rules: str) -> DataFrame:
    return results.where(F.col("rule_id").isin(*rules)).select(
        "dataset_name", "batch_id", "rule_id", "status", "failed_rows", "message"
    )


@query
def val_file_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite over batch files that were cut, overwritten or emptied in storage."""
    root, manifest = delivered_files(spark, sf_dir, {0: "whole", 1: "cut", 2: "overwritten", 3: "emptied"})
    return _rules(publish.validate_files(spark, root, manifest, RAW.names), *BATCH_RULES)


@query
def val_schema_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch lacks a column, and so all others differ from it."""
    root = shared_folder(spark)
    batches = user_day_batches(spark, sf_dir)
    first = F.col("ingestion_batch_sequence") == 1
    sinks.write_batches(batches.where(first).drop("spend_area"), f"{root}/first")
    sinks.write_batches(batches.where(~first), f"{root}/others")
    results = publish.validate_files(spark, root, manifest_of(batches))
    return _rules(results, "DQ_SCHEMA_COLUMNS")


@query
def val_schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(suite_results(spark, sf_dir, "schema_drift"), "DQ_SCHEMA_COLUMNS", "DQ_NOT_NULL_ACTIVITY")


@query
def val_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = suite_results(spark, sf_dir, "missing_case_id").unionByName(
        suite_results(spark, sf_dir, "missing_timestamp")
    )
    return _rules(results, *validate.NOT_NULL_RULES)


@query
def val_unique_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(suite_results(spark, sf_dir, "duplicate_events"), "DQ_UNIQUE_EVENT_ID")


@query
def val_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(suite_results(spark, sf_dir, "duplicate_events"), "DQ_ROW_COUNT")


@query
def val_batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data sets cut by event id blocks of another size, so that most of them mix batches."""
    landed = logs.user_day_raw(spark, sf_dir).withColumn(
        "dataset_name", F.concat(F.lit("block_"), F.floor(F.col("event_id") / 750).cast("string"))
    )
    expected = landed.groupBy("dataset_name").agg(
        F.concat(F.lit("batch_"), F.lpad((F.floor(F.min("event_id") / 750) + 1).cast("string"), 4, "0")).alias("batch_id"),
        F.count(F.lit(1)).alias("expected_rows"),
        F.lit(True).alias("readable"),
        F.lit(None).cast("string").alias("read_message"),
        F.array(*[F.lit(c) for c in RAW.names]).alias("columns"),
    )
    return _rules(validate.rule_results(validate.facts(expected, validate.measured(landed)), RAW.names), "DQ_BATCH_ID")


@query
def val_idempotency(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = suite_results(spark, sf_dir, "duplicate_batch_delivery").unionByName(
        suite_results(spark, sf_dir, "clean")
    )
    return _rules(results, "DQ_IDEMPOTENCY")


@query
def val_rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(suite_results(spark, sf_dir, "clean"), *BATCH_RULES)


@query
def val_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole suite over written batch files: schema from footers, rows from one scan."""
    path, manifest = described_batches(spark, sf_dir)
    return _rules(publish.validate_files(spark, path, manifest, RAW.names), *BATCH_RULES)


@query
def val_clean_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.clean_results(suite_results(spark, sf_dir, "clean"))


@query
def val_fault_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenarios.detected(*fault_results(spark, *described_batches(spark, sf_dir)))


@query
def val_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validation_summary(*validated(spark, sf_dir))


@query
def val_fault_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(spark, sf_dir, "duplicate_events").select(
        "event_id", "ingestion_batch_id", "batch_row_number"
    )


@query
def val_fault_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty = validate.with_missing_values(
        delivered(spark, sf_dir, "missing_case_id"),
        "event_timestamp",
        scenarios.FAULTY_ROWS["missing_timestamp"],
    )
    return faulty.select("event_id", "case_id", "event_timestamp")


@query
def val_fault_renamed_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(spark, sf_dir, "schema_drift").select("event_id", "activity_name")


@query
def val_fault_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch delivered again with the ids it had; its name is found in the load history."""
    landed = delivered(spark, sf_dir, "duplicate_batch_delivery")
    known = load_history(spark, sf_dir).select(F.col("batch_id").alias("ingestion_batch_id"))
    return landed.join(known, "ingestion_batch_id", "left_semi").select("event_id", "ingestion_batch_id")


# -- staging -------------------------------------------------------------------------------------


@query
def stg_latest_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.latest_delivery(logs.redelivered_raw(spark, sf_dir)).select(
        "event_id", "ingestion_batch_id", "simulated_ingestion_timestamp_utc", "cumulative_net_worth_eur"
    )


@query
def stg_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.cleaned_events(logs.user_day_raw(spark, sf_dir)).select(
        "event_id", *staging.STAGED_TEXT_COLUMNS, "event_date", "event_year", "event_month"
    )


@query
def stg_process_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events.select("event_id", "case_id", "process_event_sequence")


@query
def stg_process_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events.select("event_id", "case_id", "process_event_count")


@query
def stg_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events.select(
        "event_id", "previous_activity", "next_activity",
        "previous_event_timestamp", "next_event_timestamp",
    )


@query
def stg_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events.select(
        "event_id", "seconds_since_previous_event", "seconds_to_next_event"
    )


@query
def stg_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events.select(
        "event_id", "is_case_start", "is_case_end", "is_timestamp_outlier", "is_resource_missing"
    )


@query
def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).events


@query
def stg_case_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).cases.select(
        "case_id", "case_start_timestamp", "case_end_timestamp",
        "case_duration_seconds", "case_duration_hours", "case_duration_days",
    )


@query
def stg_case_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).cases.select("case_id", "start_activity", "end_activity")


@query
def stg_case_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).cases.select("case_id", "case_name", "company_id", "vendor_id")


@query
def stg_case_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).cases.select(
        "case_id", "event_count", "distinct_activity_count", "maximum_cumulative_net_worth_eur",
        "timestamp_outlier_event_count", "missing_resource_event_count", "ingestion_batch_count",
        "first_ingestion_date", "last_ingestion_date",
    )


@query
def stg_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).cases


HOT = SkewPlan(max_rows=5, sample_fraction=1.0)


@query
def stg_events_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for hot cases, with every case of more than five events taken for one."""
    return UserDays(spark, sf_dir, HOT).events


@query
def stg_cases_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir, HOT).cases


@query
def ana_case_kpis_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir, HOT).kpis


@query
def stg_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.event_counts(UserDays(spark, sf_dir).events)


@query
def stg_raw_and_staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = UserDays(spark, sf_dir)
    return staging.raw_and_staged_rows(log.raw, log.events)


@query
def stg_missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.missing_mandatory_fields(cleaned_orders(spark, sf_dir))


@query
def stg_repeated_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.repeated_event_ids(logs.redelivered_raw(spark, sf_dir))


@query
def stg_case_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.case_counts(UserDays(spark, sf_dir).cases)


@query
def stg_broken_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of the log as delivered twice: positions end before the row count does."""
    log = UserDays(spark, sf_dir)
    doubled = log.events.unionByName(
        log.events.withColumn("process_event_sequence", F.lit(1).cast("bigint"))
    )
    return staging.broken_sequences(doubled)


@query
def stg_timestamp_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.timestamp_quality_counts(UserDays(spark, sf_dir).events)


@query
def stg_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = UserDays(spark, sf_dir).written()
    return staging.staging_verdict(log.raw, log.events, log.cases)


# -- monitoring ----------------------------------------------------------------------------------


def monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = UserDays(spark, sf_dir).written()
    return monitor.quality_results(
        log.raw, log.events, log.cases, load_history(spark, sf_dir), run_id=RUN_ID, run_at=RUN_AT
    )


def _rule(spark: SparkSession, sf_dir: str, rule_id: str) -> DataFrame:
    return monitored(spark, sf_dir).where(F.col("rule_id") == rule_id)


def _register_rule(name: str, rule_id: str) -> None:
    _QUERIES[name] = lambda spark, sf_dir: _rule(spark, sf_dir, rule_id)


for _name, _rule_id in (
    ("mon_event_id_unique", "DQ_RAW_EVENT_ID_UNIQUE"),
    ("mon_row_reconciliation", "DQ_RAW_STAGING_ROW_RECONCILIATION"),
    ("mon_case_reconciliation", "DQ_CASE_RECONCILIATION"),
    ("mon_mandatory_fields", "DQ_MANDATORY_EVENT_FIELDS"),
    ("mon_sequence_integrity", "DQ_PROCESS_SEQUENCE_INTEGRITY"),
    ("mon_batch_reconciliation", "DQ_BATCH_LOAD_RECONCILIATION"),
    ("mon_negative_durations", "DQ_NEGATIVE_PROCESS_DURATION"),
    ("mon_timestamp_quality", "MON_TIMESTAMP_QUALITY"),
    ("mon_missing_resources", "MON_MISSING_RESOURCE"),
):
    _register_rule(_name, _rule_id)


@query
def mon_rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitored(spark, sf_dir)


@query
def mon_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.run_summary(monitored(spark, sf_dir), run_id=RUN_ID, run_at=RUN_AT)


def _two_runs(results: DataFrame) -> DataFrame:
    return results.unionByName(results.withColumn("run_id", F.lit("run-0")))


@query
def mon_results_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.results_of_run(_two_runs(monitored(spark, sf_dir)), RUN_ID).select(
        "rule_id", "severity", "status", "failed_rows"
    )


@query
def mon_summary_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = monitor.run_summary(monitored(spark, sf_dir), run_id=RUN_ID, run_at=RUN_AT)
    return monitor.summary_of_run(_two_runs(summary), RUN_ID)


# -- analytics -----------------------------------------------------------------------------------

TRANSITION_INPUT = ("case_id", "activity", "next_activity", "seconds_to_next_event")
ACTIVITY_INPUT = (
    "case_id", "activity", "resource_id", "is_case_start", "is_case_end", "is_resource_missing",
    "is_timestamp_outlier", "seconds_since_previous_event", "seconds_to_next_event",
)


@query
def ana_case_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).kpis


@query
def ana_case_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.case_variants(UserDays(spark, sf_dir).events)


@query
def ana_conversation_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as cases and their turns as events: the variant of roles."""
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as string) as case_id", "role as activity", "turn", "conv_id"
    )
    ordered = positions_in_group(turns, "case_id", [F.col("turn")], position="process_event_sequence")
    return analytics.case_variants(ordered)


@query
def ana_variant_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).written().variant_statistics


@query
def ana_variant_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = analytics.ranked_variants(UserDays(spark, sf_dir).written().variant_statistics)
    return analytics.with_share(ranked, "case_count", "case_share").select(
        "variant_rank", "process_variant", "case_count", "case_share"
    )


@query
def ana_variant_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = analytics.case_variants(UserDays(spark, sf_dir).events)
    return variants.select("case_id", analytics.variant_id(F.col("process_variant")).alias("variant_id"))


@query
def ana_process_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserDays(spark, sf_dir).written().variants


@query
def ana_activity_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.activity_performance(UserDays(spark, sf_dir).written(*ACTIVITY_INPUT).events, exact=True)


@query
def ana_transition_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.transition_statistics(UserDays(spark, sf_dir).written(*TRANSITION_INPUT).events, exact=True)


@query
def ana_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.transitions(UserDays(spark, sf_dir).written(*TRANSITION_INPUT).events, exact=True)


@query
def ana_process_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = UserDays(spark, sf_dir).written()
    return analytics.process_overview(
        log.events, log.kpis, log.variant_statistics, calculated_at=RUN_AT, exact=True
    )


@query
def ana_sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transition quantiles by sketch, checked against the exact ranks they stand for."""
    log = UserDays(spark, sf_dir).written(*TRANSITION_INPUT)
    events = log.events
    sketched = analytics.transition_statistics(events).select(
        "from_activity", "to_activity", "transition_count", "median_transition_seconds", "p90_transition_seconds"
    )
    gaps = events.where(F.col("next_activity").isNotNull()).select(
        F.col("activity").alias("from_activity"),
        F.col("next_activity").alias("to_activity"),
        F.col("seconds_to_next_event").alias("gap"),
    )
    reached = gaps.join(sketched, ["from_activity", "to_activity"]).groupBy(
        "from_activity", "to_activity", "transition_count"
    )
    off = lambda q, share: F.abs(
        F.count_if(F.col("gap") <= F.col(q)) / F.count(F.lit(1)) - F.lit(share)
    )
    return reached.agg(
        (off("median_transition_seconds", 0.5) <= 0.02).alias("median_is_close"),
        (off("p90_transition_seconds", 0.9) <= 0.02).alias("p90_is_close"),
    )


@query
def ana_case_kpi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.case_kpi_counts(UserDays(spark, sf_dir).kpis)


@query
def ana_variant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.variant_counts(UserDays(spark, sf_dir).written().variant_statistics)


@query
def ana_activity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.activity_counts(analytics.activity_performance(UserDays(spark, sf_dir).written(*ACTIVITY_INPUT).events))


@query
def ana_transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.transition_counts(analytics.transition_statistics(UserDays(spark, sf_dir).events))


@query
def ana_top_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_variants(UserDays(spark, sf_dir).written().variants)


@query
def ana_slow_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.slow_transitions(
        analytics.transition_statistics(UserDays(spark, sf_dir).written(*TRANSITION_INPUT).events, exact=True)
    )


@query
def ana_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = UserDays(spark, sf_dir).written()
    events = log.events
    kpis = settle(analytics.case_kpis(events, log.hot))
    variants = analytics.variant_statistics(analytics.case_variants(events), kpis)
    return analytics.analytics_verdict(
        events,
        staging.case_table(events, log.hot),
        kpis,
        variants,
        analytics.activity_performance(events),
        analytics.transition_statistics(events),
    )


# -- whole run -----------------------------------------------------------------------------------


@query
def run_source_to_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From XES files to the process overview, through every layer and every gate on the way."""
    name, folder = _databases(spark)
    db = Databases(*(f"{name}_{layer}" for layer in ("raw", "staging", "analytics", "monitoring")))
    db.create(spark, folder)
    write_xes(spark, sf_dir, f"{folder}/source")
    events = prepare.standardize_log(
        xes.read_xes(spark, f"{folder}/source"), source_file="events.xes", pipeline_batch_id="run", processed_at=RUN_AT
    )
    sinks.write_canonical(events, f"{folder}/canonical")
    canonical = files.read_canonical(spark, f"{folder}/canonical")
    batches = f"{folder}/batches"
    manifest = prepare.deliver_batches(spark, canonical, batches, PLAN)
    clean = settle(publish.validate_files(spark, batches, manifest))
    damaged = settle(scenarios.deliver_scenarios(spark, batches, manifest, f"{folder}/invalid"))
    baseline = publish.baseline_columns(spark, batches, manifest)
    faulty = settle(scenarios.validate_scenarios(spark, f"{folder}/invalid", damaged, baseline))
    per_batch = validate.clean_results(clean)
    summary = validate.validation_summary(per_batch, scenarios.detected(faulty, damaged), clean.unionByName(faulty))
    gate = settle(ingest.publish_gate(summary, per_batch))
    ingest.require_published(publish.publish(spark, manifest, batches, f"{folder}/landing", gate))
    loaded = load.load_batches(
        spark, files.read_landed(spark, f"{folder}/landing").drop("landed_path"), manifest, raw=f"{db.raw}.events",
        history=f"{db.raw}.batch_load_history", run_id=RUN_ID, loaded_at=RUN_AT, landing_root=f"{folder}/landing",
        inventory=files.file_inventory(spark, f"{folder}/landing"),
    )
    ingest.require_loaded(loaded)
    build_staging(spark, db)
    build_analytics(spark, db, exact=True, calculated_at=RUN_AT)
    run_monitoring(spark, RUN_ID, RUN_AT, db)
    return spark.table(f"{db.analytics}.process_overview")
