"""Operators on literal rows: missing cases, times and ids, ties, duplicates, empty inputs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewright.operators import analytics, ingest, monitor, profile, staging, standardize, validate
from tracewright.operators.ordering import hot_keys
from tracewright.schema import LOAD_HISTORY, MANIFEST, RAW, SkewPlan, YearBounds

T0 = datetime(2024, 1, 1)


def raw(spark, rows):
    """rows: (event_id, case_id, activity, hours or None, resource_id, status, delivery)."""
    full = []
    for i, (event_id, case, activity, hours, resource, status, delivery) in enumerate(rows):
        values = dict.fromkeys(RAW.names)
        values |= {
            "event_id": event_id, "case_id": case, "activity": activity, "source_row_number": i + 1,
            "event_timestamp": None if hours is None else T0 + timedelta(hours=hours),
            "resource_id": resource, "timestamp_quality_status": status,
            "ingestion_batch_id": f"batch_{delivery:04d}", "ingestion_batch_sequence": delivery,
            "simulated_ingestion_timestamp_utc": T0 + timedelta(days=delivery),
            "simulated_ingestion_date": (T0 + timedelta(days=delivery)).date(), "batch_row_number": i + 1,
            "case_name": "n", "company_id": None if i % 2 else "c", "cumulative_net_worth_eur": float(i),
        }
        full.append(tuple(values[n] for n in RAW.names))
    return spark.createDataFrame(full, RAW)


OK = "expected_period"
ROWS = [
    (1, "a", " start ", 0, "r1", OK, 1),
    (2, "a", "check", 5, None, OK, 1),
    (3, "a", "check", 5, "r2", OK, 1),
    (4, "a", None, 30, "r1", OK, 1),
    (2, "a", "recheck", 5, "r9", OK, 2),  # a later delivery of event 2
    (5, "b", "start", 2, " ", "historical_outlier", 1),
    (6, None, "lost", 1, "r1", OK, 1),
    (7, "  ", "lost", None, "r1", None, 1),
    (8, "d", None, 3, "r3", OK, 2),
    (None, "e", "x", 1, "r1", OK, 1),
    (None, "e", "y", 2, "r1", OK, 2),  # ids that are missing count as one id
]


def test_staged_events(spark):
    events = staging.staged_events(raw(spark, ROWS))
    got = {
        (r.event_id, r.activity): (
            r.case_id, r.process_event_sequence, r.process_event_count, r.previous_activity, r.next_activity,
            r.seconds_since_previous_event, r.seconds_to_next_event, r.is_case_start, r.is_case_end,
            r.is_timestamp_outlier, r.is_resource_missing,
        )
        for r in events.collect()
    }
    hour = 3600
    assert got == {
        (1, "start"): ("a", 1, 4, None, "check", None, 5 * hour, True, False, False, False),
        (3, "check"): ("a", 2, 4, "start", "recheck", 5 * hour, 0, False, False, False, False),
        (2, "recheck"): ("a", 3, 4, "check", None, 0, 25 * hour, False, False, False, False),
        (4, None): ("a", 4, 4, "recheck", None, 25 * hour, None, False, True, False, False),
        (5, "start"): ("b", 1, 1, None, None, None, None, True, True, True, True),
        (6, "lost"): (None, 2, 2, "lost", None, None, None, False, True, False, False),
        (7, "lost"): (None, 1, 2, None, "lost", None, None, True, False, None, False),
        (8, None): ("d", 1, 1, None, None, None, None, True, True, False, False),
        (None, "y"): ("e", 1, 1, None, None, None, None, True, True, False, False),
    }


def test_cases_and_kpis(spark):
    events = staging.staged_events(raw(spark, ROWS))
    cases = {r.case_id: r for r in staging.case_table(events).collect()}
    assert set(cases) == {"a", "b", "d", "e", None}
    a = cases["a"]
    assert (a.event_count, a.distinct_activity_count, a.start_activity, a.end_activity) == (4, 3, "start", None)
    assert (a.case_duration_seconds, a.case_duration_hours, a.case_duration_days) == (108000, 30, 1)
    assert (a.company_id, a.ingestion_batch_count) == ("c", 2)
    assert cases[None].event_count == 2 and cases[None].timestamp_outlier_event_count == 0
    kpis = {r.case_id: r for r in analytics.case_kpis(events).collect()}
    assert set(kpis) == {"a", "b", "d", "e"}
    assert (kpis["a"].repeated_activity_event_count, kpis["a"].has_rework, kpis["a"].rework_event_rate) == (1, True, 0.25)
    assert kpis["d"].repeated_activity_event_count == 1  # a missing activity counts as a repeat
    assert (kpis["a"].distinct_resource_count, kpis["b"].is_analysis_ready) == (3, False)


def test_analytics_tables(spark):
    events = staging.staged_events(raw(spark, ROWS))
    variants = {r.case_id: r.process_variant for r in analytics.case_variants(events).collect()}
    assert variants == {"a": "start -> check -> recheck", "b": "start", "d": None, "e": "y"}
    assert {
        r.case_id: r.process_variant for r in analytics.case_variants(events, piece=2).collect()
    } == variants
    moves = {(r.from_activity, r.to_activity): r for r in analytics.transitions(events, exact=True).collect()}
    assert {k: r.transition_count for k, r in moves.items()} == {
        ("start", "check"): 1, ("check", "recheck"): 1, ("lost", "lost"): 1,
    }
    assert moves["lost", "lost"].median_transition_seconds is None
    assert sum(r.transition_share for r in moves.values()) == pytest.approx(1)
    performance = {r.activity: r for r in analytics.activity_performance(events, exact=True).collect()}
    assert performance[None].event_count == 2 and performance[None].case_count == 2
    assert performance["lost"].case_count == 0
    kpis = analytics.case_kpis(events)
    statistics = analytics.variant_statistics(analytics.case_variants(events), kpis, exact=True)
    table = analytics.process_variants(events, kpis, exact=True).orderBy("variant_rank").collect()
    assert [(r.variant_rank, r.process_variant, r.case_share) for r in table] == [
        (1, None, 0.25), (2, "start", 0.25), (3, "start -> check -> recheck", 0.25), (4, "y", 0.25),
    ]
    assert table[1].average_case_duration_hours is None  # its only case is not analysis-ready
    overview = analytics.process_overview(events, kpis, statistics, exact=True).first()
    assert (overview.total_cases, overview.analysis_ready_cases, overview.total_events) == (4, 3, 9)
    verdict = analytics.analytics_verdict(
        events, staging.case_table(events), kpis, statistics,
        analytics.activity_performance(events), analytics.transition_statistics(events),
    ).first()
    assert not verdict.case_reconciliation_success  # the rows without a case
    assert not verdict.activity_reconciliation_success  # the missing activity is a group, not a value
    assert verdict.transition_reconciliation_success


def test_hot_cases_change_nothing(spark):
    rows = [
        (i, ["hot", None, f"c{i % 40}"][i % 3], f"a{i * i % 5}", (i * 37) % 400, f"r{i % 4}", OK, i % 3)
        for i in range(600)
    ]
    log = raw(spark, rows)
    hot = hot_keys(log, "case_id", SkewPlan(max_rows=50, sample_fraction=1.0))
    assert hot.keys.count() == 2
    plain, sliced = staging.staged_events(log), staging.staged_events(log, hot)
    assert plain.columns == sliced.columns
    same = lambda x, y: {tuple(r) for r in x.collect()} == {tuple(r) for r in y.collect()}
    assert same(plain, sliced)
    assert same(staging.case_table(plain), staging.case_table(sliced, hot))
    assert same(analytics.case_kpis(plain), analytics.case_kpis(sliced, hot))


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        test_analytics_tables(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_staging_verdict_sees_the_removed_duplicates(spark):
    log = raw(spark, ROWS)
    events = staging.staged_events(log)
    verdict = staging.staging_verdict(log, events, staging.case_table(events)).first()
    assert (verdict.raw_rows, verdict.staging_rows, verdict.unique_event_ids) == (11, 9, 8)
    assert not verdict.row_reconciliation_success and not verdict.case_reconciliation_success
    assert not verdict.mandatory_fields_success and not verdict.staging_build_success


def history(spark, rows):
    full = [("r", b, "u", n, n, "LOADED", None, None, None, T0 + timedelta(days=d)) for b, n, d in rows]
    return spark.createDataFrame(full, LOAD_HISTORY)


def test_monitoring(spark):
    log = raw(spark, ROWS)
    events = staging.staged_events(log)
    loads = history(spark, [("batch_0001", 1, 1), ("batch_0001", 8, 2), ("batch_0002", 3, 1), ("gone", 4, 1)])
    results = monitor.quality_results(
        log, events, staging.case_table(events), loads, run_id="x", run_at=T0
    )
    got = {r.rule_id: (r.status, r.failed_rows, r.total_rows) for r in results.collect()}
    assert got == {
        "DQ_RAW_EVENT_ID_UNIQUE": ("FAIL", 3, 11),
        "DQ_RAW_STAGING_ROW_RECONCILIATION": ("FAIL", 2, 11),
        "DQ_CASE_RECONCILIATION": ("FAIL", 1, 4),
        "DQ_MANDATORY_EVENT_FIELDS": ("FAIL", 5, 9),
        "DQ_PROCESS_SEQUENCE_INTEGRITY": ("PASS", 0, 5),
        "DQ_BATCH_LOAD_RECONCILIATION": ("FAIL", 1, 3),
        "DQ_NEGATIVE_PROCESS_DURATION": ("PASS", 0, 9),
        "MON_TIMESTAMP_QUALITY": ("WARN", 1, 9),
        "MON_MISSING_RESOURCE": ("WARN", 1, 9),
    }
    summary = monitor.run_summary(results, run_id="x", run_at=T0)
    row = summary.first()
    assert (row.rules_executed, row.passed_rules, row.warning_rules, row.failed_rules, row.overall_status) == (9, 2, 2, 5, "FAIL")
    with pytest.raises(ingest.PipelineError):
        monitor.require_no_failed_rule(summary)
    assert [r.severity for r in monitor.results_of_run(results, "x").collect()] == ["CRITICAL"] * 7 + ["WARNING"] * 2


def test_monitoring_of_nothing(spark):
    log = raw(spark, [])
    events = staging.staged_events(log)
    results = monitor.quality_results(
        log, events, staging.case_table(events), history(spark, []), run_id="x", run_at=T0
    ).collect()
    assert {(r.status, r.failed_rows, r.total_rows, r.failure_rate) for r in results} == {("PASS", 0, 0, None)}


def test_event_sequence_puts_unreadable_times_last(spark):
    rows = [(1, "a", None), (2, "a", 5), (3, "a", 1), (4, None, 0), (5, "b", None)]
    df = spark.createDataFrame(
        [(i, c, None if h is None else T0 + timedelta(hours=h)) for i, c, h in rows],
        "source_row_number bigint, case_id string, event_timestamp timestamp_ntz",
    )
    got = {r.source_row_number: r.event_sequence for r in standardize.with_event_sequence(df).collect()}
    assert got == {3: 1, 2: 2, 1: 3, 4: None, 5: 1}


def test_timestamp_quality(spark):
    df = spark.createDataFrame([(y and datetime(y, 6, 1),) for y in (1948, 2016, 2017, 2018, 2019, 2020, 2021, None)], "t timestamp_ntz").coalesce(1)
    got = [r[0] for r in df.select(standardize.timestamp_quality(F.col("t"))).collect()]
    assert got == [
        "historical_outlier", "historical_outlier", "edge_period_before_main_window", OK, OK,
        "edge_period_after_main_window", OK, "invalid_timestamp",
    ]
    moved = standardize.timestamp_quality(F.col("t"), YearBounds(2019, 2019, 2021))
    assert [r[0] for r in df.select(moved).collect()][3] == "historical_outlier"


def test_profiles_of_awkward_logs(spark):
    log = spark.createDataFrame(
        [("a", "x", T0), ("a", None, T0 + timedelta(seconds=90)), (None, "x", None)],
        "case_id string, activity string, event_timestamp timestamp_ntz",
    )
    cases = profile.case_profile(log)
    assert [tuple(r)[1:] for r in cases.collect()] == [(2, T0, T0 + timedelta(seconds=90), 1, 0.03)]
    found = profile.log_profile(log, cases).first()
    assert (found.event_count, found.case_count, found.missing_case_id_count, found.invalid_timestamp_count) == (3, 1, 1, 1)
    assert (found.median_events_per_case, found.median_case_duration_hours) == (2.0, 0.03)
    assert {tuple(r) for r in profile.activity_frequency(log).collect()} == {
        ("x", 2, 66.6667), ("<MISSING_ACTIVITY>", 1, 33.3333),
    }
    assert [r.event_year for r in profile.year_distribution(log).collect()] == [2024, None]
    empty = profile.column_profile(log.where("false")).collect()
    assert {tuple(r)[2:] for r in empty} == {(0, 0.0, 0)} and len(empty) == 3
    nested = profile.field_profile(log, ["activity", "absent"]).collect()
    assert [(r.column_name, r.null_count, [tuple(v) for v in r.top_values]) for r in nested] == [
        ("activity", 1, [("x", 2), (None, 1)])
    ]
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),)], "v double")
    assert profile.column_profile(zeros).first().unique_value_count == 2


def test_potential_duplicates_count_all_members_and_nulls(spark):
    rows = [("a", "x", T0, None, "d", "i")] * 2 + [("a", "x", T0, "r", "d", "i")]
    df = spark.createDataFrame(
        rows, "case_id string, activity string, event_timestamp timestamp_ntz, resource_id string,"
        " purchasing_document_id string, item_id string",
    )
    assert profile.potential_duplicates(df).first()[0] == 2
    assert profile.potential_duplicates(df.where("false")).first()[0] == 0


def test_batches_with_ties_and_missing_times(spark):
    rows = [(i, None if i % 4 == 0 else T0 + timedelta(hours=i % 3)) for i in range(1, 26)]
    df = spark.createDataFrame(rows, "source_row_number bigint, event_timestamp timestamp_ntz")
    got = ingest.chronological_batches(df.repartition(3), ingest.BatchPlan(size=10)).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or T0, r[0]))
    assert {(r.source_row_number, r.ingestion_batch_id, r.batch_row_number) for r in got} == {
        (row[0], f"batch_{i // 10 + 1:04d}", i % 10 + 1) for i, row in enumerate(order)
    }
    third = next(r for r in got if r.ingestion_batch_sequence == 3)
    assert third.simulated_ingestion_timestamp_utc == datetime(2026, 1, 3, 8)


def test_gates_raise(spark):
    log = raw(spark, ROWS)
    with pytest.raises(ingest.PipelineError, match="missing"):
        ingest.require_key_integrity(log)
    with pytest.raises(ingest.PipelineError, match="unique"):
        ingest.require_key_integrity(log.where("event_id is not null"))
    ingest.require_key_integrity(log.where("event_id in (1, 3)"))
    manifest = ingest.batch_manifest(log)
    check = ingest.batch_set_check(manifest, log.limit(3))
    with pytest.raises(ingest.PipelineError):
        ingest.require_batch_set(check)
    ingest.require_batch_set(ingest.batch_set_check(manifest, log))
    refused = spark.createDataFrame([(True, None)], "clean_validation_success boolean, failure_detection_success boolean")
    passed = spark.createDataFrame([("PASS",)], "overall_status string")
    with pytest.raises(ingest.PipelineError):
        ingest.require_publish_gate(ingest.publish_gate(refused, passed))


def test_rules_without_columns_and_expectations(spark):
    expected = spark.createDataFrame(
        [("d", None, None, True, None, ["x"])],
        "dataset_name string, batch_id string, expected_rows bigint, readable boolean, read_message string, columns array<string>",
    )
    counts = validate.measured(raw(spark, []).withColumn("dataset_name", F.lit("d")))
    results = validate.rule_results(validate.facts(expected, counts), ["b", "a"]).collect()
    assert {r.rule_id: r.status for r in results} == {
        "FILE_READABLE": "PASS", "DQ_SCHEMA_COLUMNS": "FAIL", "DQ_NOT_NULL_CASE_ID": "SKIPPED",
        "DQ_NOT_NULL_ACTIVITY": "SKIPPED", "DQ_NOT_NULL_EVENT_TIMESTAMP": "SKIPPED",
        "DQ_UNIQUE_EVENT_ID": "SKIPPED", "DQ_ROW_COUNT": "SKIPPED", "DQ_BATCH_ID": "SKIPPED",
        "DQ_IDEMPOTENCY": "SKIPPED",
    }
    assert results[1].message == "Missing columns: a, b | Unexpected columns: x"


def test_unique_rule_counts_missing_ids_like_values(spark):
    log = raw(spark, [(i, "a", "x", 1, "r", OK, 1) for i in (1, 1, None, None, None, 2)])
    counts = validate.measured(log.withColumn("dataset_name", F.lit("d"))).first()
    assert counts.repeated_event_ids == 3


def test_manifest_schema_is_complete(spark):
    files = spark.createDataFrame(
        [("batch_0001", "f", 1, "s")], "batch_id string, file_name string, file_size_bytes bigint, sha256 string"
    )
    manifest = ingest.batch_manifest(raw(spark, ROWS), files)
    assert set(manifest.columns) == set(MANIFEST.names)
