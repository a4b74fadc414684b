"""Writers: partitioned events, batch files, RAW appends, replaced tables, audit tables, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions.numbers import count_where
from tracewright.shared_storage import freed_shuffles, settle, settled
from tracewright.sources import storage
from tracewright.sources.files import REPORT_TIME, listed_files


#: Rows that :func:`write_canonical` shuffles at a time.
ROUND_ROWS = 140_000_000


def write_canonical(events: DataFrame, path: str) -> None:
    """One directory per year and month. Rows without a readable time go to Hive's null partition.

    Ranges over month, time and row number give tasks of equal size, however the log is spread over
    time; only ranges that cross a month write more than one file.

    Whole rows take several times the room in a shuffle that they take in a file. So they are settled, and
    then moved to their month, in rounds of about ``ROUND_ROWS`` rows; only one round lies in a shuffle at a
    time. The first rounds are shares of the cases, the second ones follow each other in time. ``events``
    is read once per round, so its row numbers must be settled. ``path`` is replaced when all is written.
    """
    spark = events.sparkSession
    order = ["event_year", "event_month", "event_timestamp", "source_row_number"]
    with settled(spark), storage.replaced_folder(spark, path) as root, freed_shuffles(spark):
        for rows in _time_rounds(_settled_by_case(events, ROUND_ROWS), ROUND_ROWS):
            (
                rows.repartitionByRange(*order)
                .write.mode("append")
                .option("compression", "snappy")
                .partitionBy("event_year", "event_month")
                .parquet(root)
            )


def _settled_by_case(events: DataFrame, size: int) -> DataFrame:
    """Settle the events in shares of about ``size`` rows; the events of a case are in one share.

    The choice of a share is pushed below the window over cases, and so below its shuffle.
    """
    shares = -(-events.count() // size)
    if shares <= 1:
        return settle(events)
    share = F.pmod(F.xxhash64("case_id"), F.lit(shares))
    return reduce(DataFrame.unionByName, [settle(events.where(share == i)) for i in range(shares)])


def _time_rounds(rows: DataFrame, size: int) -> list[DataFrame]:
    """Cut settled rows into ranges of time of about ``size`` rows; a time is never cut, rows without one come last."""
    rounds = -(-rows.count() // size)
    if rounds <= 1:
        return [rows]
    found = F.percentile_approx("event_timestamp", F.lit([i / rounds for i in range(1, rounds)]))
    # As text, since Python has no years beyond 9999.
    texts = rows.agg(F.array_sort(F.array_distinct(found)).cast("array<string>").alias("cuts")).first()["cuts"]
    if not texts:
        return [rows]
    time, cuts = F.col("event_timestamp"), [F.lit(text).cast("timestamp_ntz") for text in texts]
    between = [(time >= low) & (time < high) for low, high in zip(cuts, cuts[1:])]
    return [rows.where(c) for c in (time < cuts[0], *between, (time >= cuts[-1]) | time.isNull())]


def write_batches(batches: DataFrame, path: str) -> None:
    """One directory and one file per batch, rows in delivery order. A batch has a fixed size."""
    spark = batches.sparkSession
    rows = batches.repartition("ingestion_batch_id").sortWithinPartitions("ingestion_batch_id", "batch_row_number")
    with storage.replaced_folder(spark, path) as root:
        settle(storage.written_groups(rows, "ingestion_batch_id", "batch", root))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def _laid_out(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition by the layout, so that files hold narrow key ranges and scans skip them.

    The last columns of ``order`` tell rows apart, so that a partition value or key with very many
    rows is written by many tasks.
    """
    if not order:
        return df
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def append_raw(
    batches: DataFrame,
    table: str,
    partition_by: str = "simulated_ingestion_date",
    cluster_by: Sequence[str] = ("case_id", "activity", "ingestion_batch_id"),
) -> None:
    """Append to the RAW table, creating it when needed."""
    order = [partition_by, *cluster_by, "event_id", "source_row_number"]
    writer = _laid_out(batches, order).write.mode("append").format("parquet")
    writer.partitionBy(partition_by).saveAsTable(table)


@dataclass(frozen=True)
class Layout:
    """Partition columns, clustering columns, and the columns that tell rows apart beyond them."""

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    identity: tuple[str, ...] = ()


LAYOUTS = {
    "staging.events": Layout(
        ("event_date",),
        ("case_id", "activity", "vendor_id", "company_id"),
        ("event_id", "source_row_number"),
    ),
    "staging.cases": Layout((), ("company_id", "vendor_id"), ("case_id",)),
    "analytics.case_kpis": Layout(
        (), ("company_id", "vendor_id", "start_activity", "end_activity"), ("case_id",)
    ),
    "analytics.activity_performance": Layout((), ("activity",)),
    "analytics.transitions": Layout((), ("from_activity", "to_activity")),
}


def replace_table(df: DataFrame, table: str, layout: str | None = None) -> DataFrame:
    """Create or replace ``table`` in the layout named ``layout`` (default: its own name)."""
    plan = LAYOUTS.get(layout or table, Layout())
    order = [*plan.partition_by, *plan.cluster_by, *plan.identity]
    writer = _laid_out(df, order).write.mode("overwrite").format("parquet")
    if plan.partition_by:
        writer = writer.partitionBy(*plan.partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def key_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(partition, rows, low, high) of every file of a written table, from the footers.

    ``partition`` is the file's directory; ``low`` and ``high`` are those of a text column in it.
    """
    listing = listed_files(spark, path).select("path", F.regexp_extract("path", "^(.*)/", 1).alias("partition"))
    return storage.with_key_ranges(listing, column)


def key_range_summary(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row: ``row_count``, ``file_count``, and ``crossing_files``.

    A file crosses when a file of its partition with a smaller or equal least key reaches beyond that
    key: a scan that looks for one key then has to open both.
    """
    before = W.partitionBy("partition").orderBy("low", "high").rowsBetween(W.unboundedPreceding, -1)
    ranged = key_ranges(spark, path, column).withColumn("reached", F.max("high").over(before))
    return ranged.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        count_where(F.col("reached") > F.col("low")).alias("crossing_files"),
    )


def ensure_audit_table(
    spark: SparkSession, table: str, schema: T.StructType, time_column: str
) -> None:
    """Create an append-only table with a fixed schema, partitioned by the day of ``time_column``."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run_date DATE) "
        "USING parquet PARTITIONED BY (run_date) "
        f"TBLPROPERTIES ('time_column' = '{time_column}')"
    )


def append_audit(rows: DataFrame, table: str, schema: T.StructType, time_column: str) -> None:
    """Append rows of exactly ``schema`` to an audit table."""
    dated = rows.select(*schema.names, F.to_date(time_column).alias("run_date"))
    dated.write.mode("append").format("parquet").partitionBy("run_date").saveAsTable(table)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("timestampNTZFormat", REPORT_TIME)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("encoding", "UTF-8")
        .option("timestampNTZFormat", REPORT_TIME)
        .json(path)
    )


def sample_rows(df: DataFrame, key: Sequence[str], limit: int) -> DataFrame:
    """The first rows by a key; Spark tables have no row order of their own."""
    return df.orderBy(*key).limit(limit)


# Rows kept in each sample report.
SAMPLE_ROWS = {"cases": 1_000, "events": 5_000, "canonical": 1_000, "case_labels": 5_000}
