"""Load landed batches as they arrive, with the file source's own bookkeeping."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.operators import ingest
from tracewright.plans.load import load_batches
from tracewright.schema import RAW
from tracewright.shared_storage import settle
from tracewright.sources import files, storage


def stream_landed(
    spark: SparkSession,
    landing_path: str,
    manifest: Callable[[], DataFrame],
    *,
    raw: str,
    history: str,
    checkpoint: str,
    run_id: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
) -> StreamingQuery:
    """Start a query that loads every file that has landed since the last run, then ends.

    The checkpoint remembers which files were read; the count check of the load makes a micro-batch
    that is repeated after a failure harmless. ``manifest`` is read again for each micro-batch. A
    micro-batch takes all new files, so that a batch of several files is never torn apart. Size and
    digest of the new files are checked against the manifest first.

    A batch may land before its manifest row. Batches with a row are loaded; then the micro-batch
    fails, so that the checkpoint does not take the others for read and the next run meets them again.
    """

    def load(landed: DataFrame, _: int) -> None:
        session = landed.sparkSession
        arrived = settle(
            landed.select(F.col("ingestion_batch_id").alias("batch_id"), "landed_path").distinct()
        )
        expected = settle(manifest())
        described = expected.join(arrived, "batch_id", "left_semi")
        # All files are listed, as the file source does; only the new ones are opened.
        new = arrived.select(files.plain_path(F.col("landed_path")).alias("plain")).distinct()
        listing = files.listed_files(session, landing_path)
        listing = listing.join(new, files.plain_path(F.col("path")) == new["plain"], "left_semi")
        outcomes = load_batches(
            session,
            landed.drop("landed_path"),
            described,
            raw=raw,
            history=history,
            run_id=run_id,
            loaded_at=clock(),
            landing_root=landing_path,
            inventory=storage.with_footers(listing, digests=True),
        )
        ingest.require_loaded(outcomes)
        early = arrived.join(expected, "batch_id", "left_anti").agg(
            F.count_distinct("batch_id").alias("n"), F.min("batch_id").alias("first")
        ).first()
        if early["n"]:
            raise ingest.PipelineError(
                f"{early['n']} landed batches have no manifest row yet, the first is {early['first']}."
            )

    # The query takes over the settings that hold when it starts.
    with files.few_listing_tasks(spark):
        return (
            spark.readStream.schema(RAW)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .parquet(landing_path)
            .select("*", F.col("_metadata.file_path").alias("landed_path"))
            .writeStream.trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(load)
            .start()
        )
