"""Files: XES, manifests, inventories, damaged batches, table layouts."""

import hashlib
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracewright.operators import ingest, standardize, validate
from tracewright.plans import publish
from tracewright.schema import CANONICAL, MANIFEST, RAW, BatchPlan
from tracewright.shared_storage import settle
from tracewright.sources import files, sinks, xes

LOG = """<?xml version="1.0" encoding="UTF-8"?>
<log xes.version="1.0">
  <extension name="Concept" prefix="concept" uri="http://www.xes-standard.org/concept.xesext"/>
  <global scope="event"><string key="concept:name" value="x"/></global>
  <trace>
    <string key="concept:name" value="c1"/>
    <string key="Name" value=" N &amp; 1 "/>
    <boolean key="Goods Receipt" value="true"/>
    <event>
      <string key="User" value="u1"/><string key="org:resource" value="NONE"/>
      <string key="concept:name" value="Create"/>
      <float key="Cumulative net worth (EUR)" value="298.0"/>
      <date key="time:timestamp" value="2018-01-02T14:53:00.000+01:00"/>
    </event>
    <event>
      <string key="concept:name" value="Pay"/><date key="time:timestamp" value="not a date"/>
      <float key="Cumulative net worth (EUR)" value="abc"/>
    </event>
  </trace>
  <trace>
    <string key="concept:name" value="c2"/>
    <boolean key="Goods Receipt" value="false"/>
    <event>
      <string key="concept:name" value=" Create "/><string key="org:resource" value="  "/>
      <date key="time:timestamp" value="2016-12-31T23:59:59Z"/>
    </event>
  </trace>
  <trace><string key="concept:name" value="empty"/></trace>
</log>
"""


def test_xes_to_canonical(spark, tmp_path):
    (tmp_path / "log.xes").write_text(LOG)
    log = settle(xes.read_xes(spark, str(tmp_path / "log.xes")))
    events = standardize.canonical_events(
        standardize.numbered_file_rows(log),
        source_file="log.xes",
        pipeline_batch_id="b",
        processed_at=datetime(2026, 1, 1),
    )
    assert events.schema.names == CANONICAL.names
    got = [
        (r.event_id, r.case_id, r.case_name, r.event_sequence, r.activity, r.event_timestamp,
         r.timestamp_quality_status, r.resource_id, r.cumulative_net_worth_eur, r.goods_receipt_required)
        for r in events.orderBy("event_id").collect()
    ]
    assert got == [
        (1, "c1", "N & 1", 1, "Create", datetime(2018, 1, 2, 13, 53), "expected_period", None, 298.0, "True"),
        (2, "c1", "N & 1", 2, "Pay", None, "invalid_timestamp", None, None, "True"),
        (3, "c2", None, 1, "Create", datetime(2016, 12, 31, 23, 59, 59), "historical_outlier", None, None, "False"),
    ]
    keys = {(r.scope, r.key) for r in xes.attribute_keys(spark, str(tmp_path / "log.xes")).collect()}
    assert ("event", "User") in keys and ("trace", "Goods Receipt") in keys


def test_empty_xes_is_refused(spark, tmp_path):
    (tmp_path / "log.xes").write_text("<log></log>")
    with pytest.raises(ingest.PipelineError):
        xes.require_events(xes.read_xes(spark, str(tmp_path / "log.xes")))


def raw_events(spark, n=40):
    values = {
        "event_id": "id", "source_row_number": "id", "case_id": "concat('c', id % 7)",
        "activity": "concat('a', id % 3)", "event_timestamp": "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int))",
        "timestamp_quality_status": "'expected_period'",
    }
    return spark.range(n).selectExpr(
        *[f"cast({values.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in CANONICAL]
    )


def batches_on_disk(spark, path, n=40, size=10):
    batches = ingest.chronological_batches(raw_events(spark, n), BatchPlan(size=size))
    batches = batches.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW])
    sinks.write_batches(batches, path)
    inventory = settle(files.file_inventory(spark, path))
    return settle(ingest.batch_manifest(files.read_landed(spark, path), inventory))


def test_inventory_matches_the_bytes(spark, tmp_path):
    path = str(tmp_path / "b")
    batches_on_disk(spark, path)
    got = {r.batch_id: (r.file_size_bytes, r.sha256) for r in files.file_inventory(spark, path).collect()}
    wanted = {}
    for file in Path(path).rglob("*.parquet"):
        data = file.read_bytes()
        wanted[file.parent.name.split("=")[1]] = (len(data), hashlib.sha256(data).hexdigest())
    assert got == wanted and len(got) == 4


def damage(path, batch, how):
    file = next(Path(path, f"batch={batch}").glob("*.parquet"))
    data = bytearray(file.read_bytes())
    if how == "tail":
        data = data[: len(data) - min(4096, len(data) // 10)]
    elif how == "page":
        data[4:600] = b"\xff" * 596
    elif how == "empty":
        data = b""
    file.write_bytes(bytes(data))
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()


def test_damaged_files_become_findings(spark, tmp_path):
    path = str(tmp_path / "b")
    manifest = batches_on_disk(spark, path)
    damage(path, "batch_0001", "tail")
    damage(path, "batch_0002", "page")
    damage(path, "batch_0003", "empty")
    results = publish.validate_files(spark, path, manifest, RAW.names).collect()
    by_batch = {}
    for r in results:
        by_batch.setdefault(r.batch_id, []).append(r)
    for batch in ("batch_0001", "batch_0002", "batch_0003"):
        (only,) = by_batch[batch]
        assert (only.rule_id, only.status, only.failed_rows) == ("FILE_READABLE", "FAIL", 1)
    assert "ArrowInvalid" in by_batch["batch_0001"][0].message
    assert "rows could be decoded" in by_batch["batch_0002"][0].message
    assert "FileNotFoundError" in by_batch["batch_0003"][0].message
    assert [r.status for r in by_batch["batch_0004"]] == ["PASS"] * 9


def test_schema_drift_is_seen_in_the_footer(spark, tmp_path):
    path = str(tmp_path / "b")
    manifest = batches_on_disk(spark, path)
    directory = Path(path, "batch=batch_0002")
    drifted = validate.with_renamed_column(
        spark.read.parquet(str(directory)), "activity", "activity_name"
    )
    drifted.coalesce(1).write.parquet(str(tmp_path / "d"))
    next(directory.glob("*.parquet")).write_bytes(next((tmp_path / "d").glob("*.parquet")).read_bytes())
    for crc in directory.glob(".*.crc"):
        crc.unlink()
    results = publish.validate_files(spark, path, manifest, RAW.names)
    got = {r.rule_id: (r.status, r.failed_rows, r.message) for r in results.where("batch_id = 'batch_0002'").collect()}
    assert got["DQ_SCHEMA_COLUMNS"] == ("FAIL", 2, "Missing columns: activity | Unexpected columns: activity_name")
    assert got["DQ_NOT_NULL_ACTIVITY"][0] == "SKIPPED"
    assert got["DQ_ROW_COUNT"] == ("PASS", 0, "Row count matches expected value: 10.")


def test_publish_is_idempotent_and_sees_conflicts(spark, tmp_path):
    path, root = str(tmp_path / "b"), str(tmp_path / "landing")
    manifest = batches_on_disk(spark, path)
    statuses = lambda: {
        r.batch_id: r.status for r in publish.publish(spark, manifest, path, root).collect()
    }
    assert set(statuses().values()) == {"UPLOADED"}
    landed = Path(root, "raw/events/batch_0003/events.parquet")
    landed.write_bytes(b"PAR1 something else PAR1")
    Path(root, "raw/events/batch_0002/events.parquet").unlink()
    assert statuses() == {
        "batch_0001": "SKIPPED", "batch_0002": "UPLOADED", "batch_0003": "CONFLICT", "batch_0004": "SKIPPED",
    }
    assert not list(Path(root).rglob("*.part"))
    damage(path, "batch_0001", "tail")
    with pytest.raises(ingest.PipelineError, match="batch_0001"):
        publish.publish(spark, manifest, path, root)


def test_manifest_without_a_required_column_is_refused(spark, tmp_path):
    good = "batch_id,batch_sequence\nbatch_0002,2\nbatch_0001,1\n"
    (tmp_path / "good.csv").write_text(good)
    (tmp_path / "bad.csv").write_text(good.replace("batch_id", "name"))
    schema = type(MANIFEST)(MANIFEST.fields[:2])
    rows = files.read_manifest(spark, str(tmp_path / "good.csv"), schema).collect()
    assert [r.batch_id for r in rows] == ["batch_0001", "batch_0002"]
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_manifest(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_canonical_partitions_and_unreadable_times(spark, tmp_path):
    events = raw_events(spark, 100).withColumns(
        {
            "event_timestamp": F.when(F.col("event_id") % 10 > 0, F.col("event_timestamp")),
            "event_year": F.when(F.col("event_id") % 10 > 0, F.lit(2024)).cast("smallint"),
            "event_month": F.when(F.col("event_id") % 10 > 0, (F.col("event_id") % 2 + 1)).cast("tinyint"),
        }
    )
    path = str(tmp_path / "canonical")
    sinks.write_canonical(events, path)
    assert sorted(p.name for p in Path(path).glob("event_year=*")) == [
        "event_year=2024", "event_year=__HIVE_DEFAULT_PARTITION__",
    ]
    back = files.read_canonical(spark, path)
    assert back.where("event_year is null").count() == 10
    pruned = back.where("event_year = 2024 and event_month = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_year" in pruned
    assert pruned and back.where("event_month = 1").count() == 40


def test_canonical_events_are_written_in_rounds(spark, tmp_path, monkeypatch):
    """Shares of the cases, then ranges of time: every row once, in the month of its time."""
    odd = {0: None, 1: "+12000-01-01 00:00:00", 2: "0001-02-03 04:05:06.000007"}
    time = F.coalesce(*[F.when(F.col("event_id") % 10 == k, F.lit(v)).cast("timestamp_ntz") for k, v in odd.items()],
                      F.when(F.col("event_id") % 10 > 0, F.col("event_timestamp")))
    times = raw_events(spark, 100).withColumn("event_timestamp", time)
    times = times.withColumn("case_id", F.when(F.col("event_id") % 7 > 0, F.col("case_id")))
    events = standardize.canonical_projection(standardize.with_calendar(times))
    path, count = str(tmp_path / "canonical"), events.count()
    wanted = sorted(events.selectExpr("to_json(struct(*))").collect())
    rounds = []
    of = sinks._time_rounds
    monkeypatch.setattr(sinks, "_time_rounds", lambda rows, size: rounds.append(of(rows, size)) or rounds[-1])
    for size in (count, 30):
        monkeypatch.setattr(sinks, "ROUND_ROWS", size)
        sinks.write_canonical(events, path)
        back = files.read_canonical(spark, path).select(*CANONICAL.names)
        assert sorted(back.selectExpr("to_json(struct(*))").collect()) == wanted
    assert [len(r) for r in rounds] == [1, 4]
    assert [p.name for p in tmp_path.iterdir()] == ["canonical"]
    nowhen = events.withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))
    sinks.write_canonical(nowhen, path)
    assert files.read_canonical(spark, path).count() == count


def test_a_failed_write_leaves_the_canonical_events_as_they_were(spark, tmp_path):
    path, events = str(tmp_path / "canonical"), standardize.canonical_projection(raw_events(spark, 20))
    sinks.write_canonical(events, path)
    with pytest.raises(Exception, match="no such row"):
        sinks.write_canonical(events.withColumn("activity", F.raise_error(F.lit("no such row")).cast("string")), path)
    assert files.read_canonical(spark, path).count() == 20


def test_json_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema("a bigint, b string").json(str(tmp_path / "j")).orderBy("a").collect() == df.collect()


def test_the_last_of_a_repeated_xes_key_counts(spark, tmp_path):
    event = "".join(f'<string key="concept:name" value="{v}"/>' for v in ("first", "last"))
    (tmp_path / "log.xes").write_text(f'<log><trace><string key="concept:name" value="c"/><event>{event}</event></trace></log>')
    (row,) = xes.read_xes(spark, str(tmp_path / "log.xes")).collect()
    assert (row["concept:name"], row["case:concept:name"]) == ("last", "c")
