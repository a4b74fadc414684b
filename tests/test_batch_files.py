"""Batch files written by tasks, and the listing of their folders."""

import os

import pytest
from pyspark.sql import functions as F

from tracewright.sources import files, sinks
from verification import queries


def _batches(spark, names):
    """Seven rows per name, in no order."""
    rows = [(n, 7 * i + r, r + 1) for i, n in enumerate(names) for r in range(7)]
    return spark.createDataFrame(rows[::-1], "ingestion_batch_id string, event_id bigint, batch_row_number bigint")


def _tree(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, found in os.walk(path) for f in found)


def test_one_file_per_batch_across_transfer_limits(spark, tmp_path):
    path = str(tmp_path / "b")
    names = [f"batch_{i:04d}" for i in range(5)] + [None, "a/b=c"]
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        sinks.write_batches(_batches(spark, names), path)
    finally:
        spark.conf.set(limit, before)
    folders = [f"batch=batch_{i:04d}" for i in range(5)] + ["batch=__HIVE_DEFAULT_PARTITION__", "batch=a%2Fb%3Dc"]
    assert _tree(path) == sorted(f"{f}/events.parquet" for f in folders)
    back = spark.read.parquet(path)
    assert {r["batch"] for r in back.select("batch").distinct().collect()} == set(names)
    assert back.where(~F.col("batch").eqNullSafe(F.col("ingestion_batch_id"))).isEmpty()
    assert back.where("batch = 'batch_0003'").orderBy("event_id").select("batch_row_number").collect() == [
        (r,) for r in range(1, 8)
    ]
    assert back.count() == 49


def test_writing_replaces_the_tree_and_may_read_it(spark, tmp_path):
    path = str(tmp_path / "b")
    sinks.write_batches(_batches(spark, ["batch_0001", "batch_0002"]), path)
    old = spark.read.option("recursiveFileLookup", True).parquet(path)
    sinks.write_batches(old.where("ingestion_batch_id = 'batch_0002'"), path)
    assert _tree(path) == ["batch=batch_0002/events.parquet"]
    assert os.listdir(tmp_path) == ["b"]


def test_a_failed_write_leaves_the_old_tree(spark, tmp_path):
    path = str(tmp_path / "b")
    sinks.write_batches(_batches(spark, ["batch_0001"]), path)
    broken = _batches(spark, ["batch_0002"]).withColumn("event_id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_batches(broken, path)
    assert _tree(path) == ["batch=batch_0001/events.parquet"]
    assert os.listdir(tmp_path) == ["b"]


def test_no_batches_give_an_empty_tree(spark, tmp_path):
    path = str(tmp_path / "b")
    sinks.write_batches(_batches(spark, ["x"]).where("false"), path)
    assert files.listed_files(spark, path).isEmpty()


def test_listing_takes_few_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"batch=batch_{i:04d}").mkdir()
        (tmp_path / f"batch=batch_{i:04d}" / "events.parquet").write_bytes(b"x")
    context = spark.sparkContext
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    context.setJobGroup("listing", "listing")
    try:
        listing = files.listed_files(spark, str(tmp_path))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and all(tracker.getStageInfo(s).numTasks <= 4 * context.defaultParallelism for s in stages)
    assert spark.conf.get(setting) == before
    assert listing.count() == 40


def test_the_batch_files_of_a_validation_are_made_once(spark, monkeypatch):
    made = []
    stub = spark.range(1).selectExpr("'d' as dataset_name")
    monkeypatch.setattr(queries, "described_batches", lambda *_: made.append(1) or ("path", stub))
    monkeypatch.setattr(queries.publish, "validate_files", lambda *_: stub)
    monkeypatch.setattr(queries.publish, "baseline_columns", lambda *_: ["c"])
    monkeypatch.setattr(queries.scenarios, "deliver_scenarios", lambda *_: stub)
    monkeypatch.setattr(queries.scenarios, "validate_scenarios", lambda *_: stub)
    monkeypatch.setattr(queries.scenarios, "detected", lambda *_: stub)
    monkeypatch.setattr(queries.validate, "clean_results", lambda *_: stub)
    queries.validated(spark, "nowhere")
    assert made == [1]
