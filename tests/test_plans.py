"""Whole runs: validate, publish, load, build, monitor; and what stops them."""

import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.test_sources import batches_on_disk
from tracewright.operators import analytics, ingest
from tracewright.plans import load, publish, scenarios
from tracewright.plans.build import Databases, build_analytics, build_staging, run_monitoring
from tracewright.schema import RAW, SkewPlan
from tracewright.shared_storage import settle, settled, shared_folder
from tracewright.sources import files, sinks, storage
from tracewright.streaming.incremental_load import stream_landed
from verification import queries
from verification.queries import all_queries

AT = datetime(2026, 2, 1)


@pytest.fixture()
def db(spark, tmp_path):
    names = Databases(*[f"t_{tmp_path.name}_{layer}".lower() for layer in ("raw", "staging", "analytics", "monitoring")])
    names.create(spark, str(tmp_path / "tables"))
    return names


def test_from_landing_zone_to_monitoring(spark, tmp_path, db):
    path, root = str(tmp_path / "b"), str(tmp_path / "landing")
    manifest = batches_on_disk(spark, path, n=200, size=25)
    assert publish.validate_files(spark, path, manifest, RAW.names).where("status <> 'PASS'").count() == 0
    publish.publish(spark, manifest, path, root)
    tables = {"raw": f"{db.raw}.events", "history": f"{db.raw}.batch_load_history"}
    for run, loaded in (("run-1", 8), ("run-2", 8)):
        stream_landed(
            spark, root, lambda: manifest, checkpoint=str(tmp_path / "checkpoint"), run_id=run, clock=lambda: AT, **tables
        ).awaitTermination()
        assert spark.table(tables["history"]).count() == loaded
    again = load.load_batches(
        spark, files.read_landed(spark, root).drop("landed_path"), manifest, run_id="run-3", loaded_at=AT,
        landing_root=root, **tables,
    )
    assert {r.status for r in again.collect()} == {"SKIPPED"}
    assert spark.table(tables["raw"]).count() == 200
    ingest.require_raw_reconciliation(ingest.raw_reconciliation(spark.table(tables["raw"]), manifest))
    audit = ingest.load_audit(spark.table(tables["history"]))
    assert audit.count() == 16 and audit.columns[0] == "batch_id"

    # Twice, since a build replaces its tables; the second time with every case taken for hot.
    seen = []
    for skew in (SkewPlan(), SkewPlan(max_rows=5, sample_fraction=1.0)):
        assert build_staging(spark, db, skew).first().staging_build_success
        verdict = build_analytics(spark, db, exact=True, calculated_at=AT, skew=skew)
        assert verdict.first().analytics_build_success
        seen.append(
            {
                name: sorted(map(str, spark.table(f"{db.analytics}.{name}").collect()))
                for name in ("case_kpis", "process_variants", "activity_performance", "transitions", "process_overview")
            }
        )
    assert seen[0] == seen[1]
    summary = run_monitoring(spark, "m-1", AT, db).first()
    assert (summary.rules_executed, summary.failed_rules, summary.overall_status) == (9, 0, "WARN")
    assert run_monitoring(spark, "m-2", AT, db).first().run_id == "m-2"
    assert spark.table(f"{db.monitoring}.data_quality_results").count() == 18
    pruned = spark.table(f"{db.monitoring}.data_quality_results").where("run_date = date'2026-02-01'")
    assert "PartitionFilters: [isnotnull(run_date" in pruned._jdf.queryExecution().toString()


def test_load_ends_at_the_first_bad_batch(spark, tmp_path, db):
    path = str(tmp_path / "b")
    manifest = batches_on_disk(spark, path, n=60, size=10)
    landed = files.read_landed(spark, path).drop("landed_path")
    args = {"raw": f"{db.raw}.events", "history": f"{db.raw}.h", "loaded_at": AT, "landing_root": "l"}
    third = F.when(F.col("batch_sequence") == 3, 1).otherwise(0)
    wrong = manifest.withColumn("row_count", F.col("row_count") + third)
    first = load.load_batches(spark, landed, wrong, run_id="a", **args)
    assert [(r.batch_id[-1], r.status, r.loaded_rows) for r in first.orderBy("batch_id").collect()] == [
        ("1", "LOADED", 10), ("2", "LOADED", 10), ("3", "FAILED", 10),
    ]
    with pytest.raises(ingest.PipelineError, match="batch_0003 finished with FAILED"):
        ingest.require_loaded(first)
    second = load.load_batches(spark, landed, wrong, run_id="b", **args)
    assert [r.status for r in second.orderBy("batch_id").collect()] == ["SKIPPED", "SKIPPED", "FAILED"]
    assert spark.table(args["raw"]).count() == 20
    third_run = load.load_batches(spark, landed, manifest, run_id="c", **args)
    assert [r.status for r in third_run.orderBy("batch_id").collect()] == ["SKIPPED"] * 2 + ["LOADED"] * 4
    assert spark.table(args["raw"]).count() == 60


def test_small_files_are_listed_in_few_tasks_and_read_once(spark, tmp_path, db, monkeypatch):
    """Loading lists in few tasks and appends settled rows; faults are made from settled rows; digests once."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    path, usual = str(tmp_path / "b"), spark.conf.get(name)
    manifest = batches_on_disk(spark, path, n=20, size=10)
    plan = lambda df: df._jdf.queryExecution().toString()
    seen = []
    append, write = sinks.append_raw, sinks.write_batches
    monkeypatch.setattr(sinks, "append_raw", lambda df, *a: (seen.append((plan(df), spark.conf.get(name))), append(df, *a)))
    landed = files.read_landed(spark, path).drop("landed_path")
    args = {"raw": f"{db.raw}.events", "history": f"{db.raw}.h", "loaded_at": AT, "landing_root": "l"}
    assert load.load_batches(spark, landed, manifest, run_id="a", **args).count() == 2
    ((appended, tasks),) = seen
    assert path not in appended and "Join" not in appended
    assert int(tasks) <= 4 * spark.sparkContext.defaultParallelism and spark.conf.get(name) == usual
    assert spark.table(args["raw"]).count() == 20

    seen.clear()
    monkeypatch.setattr(sinks, "write_batches", lambda df, at: (seen.append(plan(df)), write(df, at)))
    described = settle(scenarios.deliver_scenarios(spark, path, manifest, str(tmp_path / "invalid")))
    assert len(seen) == 4 and not any(path in p for p in seen)
    results = scenarios.validate_scenarios(spark, str(tmp_path / "invalid"), described, sorted(RAW.names))
    assert "MapInArrow" not in plan(results)
    found = scenarios.detected(results, described).collect()
    assert len(found) == 12 and all(r.expected_failure_detected for r in found)


def test_bad_staging_build_raises(spark, tmp_path, db):
    manifest = batches_on_disk(spark, str(tmp_path / "b"), n=20, size=10)
    assert manifest.count() == 2
    landed = files.read_landed(spark, str(tmp_path / "b")).drop("landed_path")
    landed.unionByName(landed).write.saveAsTable(f"{db.raw}.events")
    with pytest.raises(ingest.PipelineError, match="STAGING"):
        build_staging(spark, db)


def test_plans_of_the_sketching_tables(spark):
    """No grouping keeps sketches per case, and scans read only the columns that are needed."""
    folder = shared_folder(spark)
    from tests.test_operators import ROWS, raw
    from tracewright.operators import staging

    events = settle(staging.staged_events(raw(spark, ROWS)))
    assert folder
    plan = analytics.transition_statistics(events)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans
    for line in plan.splitlines():
        assert not ("percentile_approx" in line and "case_id" in line)
    for line in scans:
        assert "vendor_id" not in line.split("ReadSchema")[1]
    for line in scans:
        assert "IsNotNull(next_activity)" in line.split("PushedFilters")[1]


def test_deduplication_cuts_before_the_shuffle(spark):
    from tests.test_operators import ROWS, raw
    from tracewright.operators import staging

    plan = staging.staged_events(raw(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning(event_id") == 1
    assert plan.count("Exchange") == 2


def test_batches_without_a_manifest_row_wait(spark, tmp_path, db):
    path = str(tmp_path / "b")
    manifest = batches_on_disk(spark, path, n=20, size=10)
    args = {"raw": f"{db.raw}.events", "history": f"{db.raw}.h", "checkpoint": str(tmp_path / "c"), "clock": lambda: AT}
    first = stream_landed(spark, path, lambda: manifest.where("batch_sequence = 1"), run_id="a", **args)
    with pytest.raises(StreamingQueryException, match="no manifest row"):
        first.awaitTermination()
    assert spark.table(args["raw"]).count() == 10
    stream_landed(spark, path, lambda: manifest, run_id="b", **args).awaitTermination()
    assert spark.table(args["raw"]).count() == 20
    assert spark.table(args["history"]).where("status in ('LOADED', 'SKIPPED')").count() == 3


def test_copy_tasks_are_not_merged(spark, tmp_path):
    names = [f"batch_{i:04d}" for i in range(40)]
    decisions = spark.createDataFrame([(n, "UPLOAD", 10, f"raw/{n}") for n in names], "batch_id string, decision string, file_size_bytes bigint, landing_key string")
    source = spark.createDataFrame([(n, f"file:/x/{n}") for n in names], "batch_id string, path string")
    plan, tasks = publish.copy_plan(spark, decisions, source, str(tmp_path))
    assert tasks == spark.sparkContext.defaultParallelism
    assert storage.copied(plan, tasks).rdd.getNumPartitions() == tasks
    assert storage.located(plan.first().target)[1].startswith(f"{tmp_path}/raw/")


def test_publishing_is_refused_without_the_gate(spark, tmp_path):
    gate = spark.createDataFrame([(True, False, 0, False)], "clean_validation_success boolean, failure_detection_success boolean, failed_batches bigint, may_publish boolean")
    with pytest.raises(ingest.PipelineError, match="Publishing refused"):
        publish.publish(spark, gate, str(tmp_path), str(tmp_path / "l"), gate)


def test_settled_folders_go_with_their_scope(spark):
    with settled(spark):
        kept = settle(spark.range(3))
        (file,) = {f.rsplit("/", 1)[0].removeprefix("file:") for f in kept.inputFiles()}
        assert os.path.isdir(file)
    assert not os.path.exists(file)


def test_a_cluster_needs_a_shared_folder():
    class Unset:
        master = "spark://host:7077"
        get = staticmethod(lambda key, default: default)
        getCheckpointDir = staticmethod(lambda: None)

    session = type("Session", (), {"conf": Unset, "sparkContext": Unset})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_from_source_log_to_batches(spark, tmp_path):
    from tests.test_sources import LOG
    from tracewright.plans import prepare
    from tracewright.schema import BatchPlan
    from tracewright.sources import xes

    (tmp_path / "log.xes").write_text(LOG)
    made = dict(source_file="log.xes", pipeline_batch_id="b", processed_at=AT)
    log = xes.read_xes(spark, str(tmp_path / "log.xes"))
    plain, hot = (
        settle(prepare.standardize_log(log, skew=skew, **made))
        for skew in (SkewPlan(), SkewPlan(max_rows=1, sample_fraction=1.0))
    )
    assert sorted(map(str, plain.collect())) == sorted(map(str, hot.collect()))
    manifest = prepare.deliver_batches(spark, plain, str(tmp_path / "batches"), BatchPlan(size=2))
    assert [(r.batch_id, r.row_count) for r in manifest.orderBy("batch_id").collect()] == [("batch_0001", 2), ("batch_0002", 1)]
    with pytest.raises(ingest.PipelineError, match="not unique"):
        prepare.deliver_batches(spark, plain.union(plain), str(tmp_path / "twice"))


def test_missing_values_in_the_first_rows_of_every_batch(spark, tmp_path):
    events = [(i, datetime(2024, 1, 1 + i % 3), i % 5, "view", 1.0) for i in range(1_020)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r for r in all_queries()["val_fault_missing_values"](spark, str(tmp_path)).collect()}
    assert len(got) == 1_020
    assert {i for i, r in got.items() if r.case_id is None} == {*range(10), *range(1_000, 1_010)}
    assert {i for i, r in got.items() if r.event_timestamp is None} == {*range(5), *range(1_000, 1_005)}


def test_xes_files_grow_in_number_with_the_events(spark, tmp_path, monkeypatch):
    events = [(i, datetime(2024, 1, 1 + i % 9, i % 24, i % 60), i % 50, "view", 1.0) for i in range(900)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    for size, least in ((100_000, 3), (50, 12)):
        monkeypatch.setattr(queries, "XES_FILE_EVENTS", size)
        queries.write_xes(spark, str(tmp_path), f"{tmp_path}/xes{size}")
        assert len(list((tmp_path / f"xes{size}").glob("part-*"))) >= least
        numbered = all_queries()["std_file_order_numbers"](spark, str(tmp_path)).collect()
        seen.append(sorted(map(tuple, numbered)))
    assert seen[0] == seen[1] and len(seen[0]) == 900
