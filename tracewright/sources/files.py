"""Canonical events, manifests, file inventories and landed batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators.ingest import PipelineError
from tracewright.schema import CANONICAL, MANIFEST, RAW
from tracewright.sources import storage

# A batch has a directory of its own, plain or as a partition value.
BATCH_IN_PATH = r"[=/](batch_\d+)/[^/]*$"

# Text form of event times in reports; microseconds are kept.
REPORT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned canonical events; a missing directory or an empty table is an error."""
    events = spark.read.schema(CANONICAL).parquet(path)
    if events.isEmpty():
        raise PipelineError("Canonical event dataset is empty.")
    return events


def read_manifest(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """A manifest with a header line, ordered by batch.

    The header is checked against ``schema``, so a file that lacks a required column fails the read.
    """
    manifest = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", REPORT_TIME)
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )
    return manifest.orderBy("batch_sequence") if "batch_sequence" in schema.names else manifest


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List folders in four tasks per core; by default each of up to 10,000 folders is a task of its own."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# -- inventory -----------------------------------------------------------------------------------


def listed_files(
    spark: SparkSession, path: str | list[str], *, pattern: str = "*.parquet", name_root: str | None = None
) -> DataFrame:
    """Path, batch and size of every file below ``path``; no file is opened."""
    relative = F.col("path")
    if name_root:
        relative = F.substring_index(relative, name_root.rstrip("/") + "/", -1)
    with few_listing_tasks(spark):
        found = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(path)
        )
    return found.select(
        "path",
        F.regexp_extract("path", BATCH_IN_PATH, 1).alias("batch_id"),
        relative.alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        "modificationTime",
    )


def file_inventory(
    spark: SparkSession, path: str | list[str], *, pattern: str = "*.parquet", name_root: str | None = None
) -> DataFrame:
    """Path, batch, size, SHA-256 and Parquet footer of every file below ``path``.

    The bytes are streamed through the digest in tasks, so that a file may have any size. A file that is no
    readable Parquet has ``footer_error``.
    """
    listing = listed_files(spark, path, pattern=pattern, name_root=name_root)
    return storage.with_footers(listing, digests=True)


# -- landed batches ------------------------------------------------------------------------------


def read_landed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW) -> DataFrame:
    """All landed rows with the path they came from; damaged parts of files yield no rows.

    Only to be used together with :func:`readability`, which reports what is missing.
    """
    with few_listing_tasks(spark):
        landed = (
            spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("ignoreCorruptFiles", True)
            .parquet(*([paths] if isinstance(paths, str) else paths))
        )
    return landed.select("*", F.col("_metadata.file_path").alias("landed_path"))


def plain_path(path: Column) -> Column:
    """Path spelling shared by the scan and the file listing."""
    return F.regexp_replace(path, r"^file:/+", "/")


def decoded_files(landed: DataFrame) -> DataFrame:
    """Rows decoded from each file, and a digest over all their values.

    The digest is what makes the scan decode every column; counting rows alone reads footers only.
    """
    values = [c for c in landed.columns if c != "landed_path"]
    return landed.groupBy(plain_path(F.col("landed_path")).alias("dataset_name")).agg(
        F.count(F.lit(1)).alias("row_count"), F.bit_xor(F.xxhash64(*values)).alias("row_digest")
    )


def readability(inventory: DataFrame, decoded: DataFrame) -> DataFrame:
    """One row per file: readable or not, never an exception.

    A file fails when its footer cannot be parsed, or when fewer rows can be decoded than the footer
    promises (damage further inside). ``decoded`` comes from :func:`decoded_files`.
    """
    rows = F.coalesce("row_count", F.lit(0))
    whole = (rows >= F.col("footer_rows")) & ((rows == 0) | F.col("row_digest").isNotNull())
    damage = F.format_string("Only %d of %d rows could be decoded.", rows, "footer_rows")
    return (
        inventory.withColumn("dataset_name", plain_path(F.col("path")))
        .join(decoded.select("dataset_name", "row_count", "row_digest"), "dataset_name", "left")
        .select(
            "dataset_name",
            "batch_id",
            "file_size_bytes",
            "sha256",
            "columns",
            (F.col("footer_error").isNull() & whole).alias("readable"),
            F.coalesce("footer_error", F.when(~whole, damage)).alias("read_message"),
        )
    )
