"""Bytes in tasks: digests, damaged copies, scenario trees, baselines, key ranges, numbers in file order."""

import gzip
import hashlib
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_sources import LOG, batches_on_disk
from tracewright.fixed_values import FAULT_RULES
from tracewright.operators import ingest, standardize, validate
from tracewright.plans import publish, scenarios
from tracewright.schema import RAW
from tracewright.shared_storage import settle
from tracewright.sources import files, sinks, storage, xes


def test_a_file_larger_than_a_chunk_is_digested_in_pieces(spark, tmp_path):
    data = random.Random(1).randbytes(2 * storage.CHUNK_BYTES + 12_345)
    (tmp_path / "large file.bin").write_bytes(data)
    (tmp_path / "one.bin").write_bytes(b"x")
    found = files.file_inventory(spark, str(tmp_path), pattern="*.bin", name_root=str(tmp_path)).collect()
    wanted = {"large file.bin": data, "one.bin": b"x"}
    assert {r.file_name: (r.file_size_bytes, r.sha256) for r in found} == {
        n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in wanted.items()
    }
    assert all(r.footer_error and not r.columns for r in found)
    assert storage.digest(str(tmp_path / "large file.bin"), chunk=1000) == hashlib.sha256(data).hexdigest()


def test_listing_opens_no_file(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"no parquet")
    listing = files.listed_files(spark, str(tmp_path))
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert [r.file_size_bytes for r in listing.collect()] == [10]


def copies(spark, plan, tasks=4):
    return settle(storage.copied(spark.createDataFrame(plan, "source string, target string, kind string"), tasks))


def test_copies_are_damaged_as_said_and_sources_stay(spark, tmp_path):
    data = bytes(range(256)) * 200
    source = tmp_path / "source.parquet"
    source.write_bytes(data)
    copies(spark, [(str(source), f"file:{tmp_path}/to/{kind}.parquet", kind) for kind in storage.KINDS])
    got = {kind: (tmp_path / "to" / f"{kind}.parquet").read_bytes() for kind in storage.KINDS}
    assert got["whole"] == data and got["emptied"] == b"" and got["cut"] == data[:-4096]
    assert len(got["overwritten"]) == len(data) and got["overwritten"][:4] == data[:4]
    assert got["overwritten"][4:604] == b"\xff" * 600 and got["overwritten"][604:] == data[604:]
    assert source.read_bytes() == data and not list(tmp_path.rglob("*.part"))
    small = tmp_path / "small.parquet"
    small.write_bytes(data[:100])
    copies(spark, [(str(small), f"{tmp_path}/to/s.parquet", "cut")])
    assert len((tmp_path / "to" / "s.parquet").read_bytes()) == 90


def test_scenarios_are_found_in_files_by_one_validation(spark, tmp_path):
    path, root = str(tmp_path / "clean"), str(tmp_path / "invalid")
    manifest = batches_on_disk(spark, path)
    before = {p: p.read_bytes() for p in Path(path).rglob("*.parquet")}
    described = settle(scenarios.deliver_scenarios(spark, path, manifest, root))
    assert {p: p.read_bytes() for p in Path(path).rglob("*.parquet")} == before
    assert described.count() == 6 * 4
    baseline = publish.baseline_columns(spark, path, manifest)
    assert baseline == sorted(RAW.names)
    results = settle(scenarios.validate_scenarios(spark, root, described, baseline))
    found = scenarios.detected(results, described).collect()
    assert {(r.dataset_name.split("/")[0], r.expected_rule) for r in found} == set(FAULT_RULES.items())
    assert len(found) == 24 and all(r.expected_failure_detected for r in found)
    first = {r.rule_id: r for r in results.where("dataset_name = 'corrupted_parquet/batch_0001'").collect()}
    assert set(first) == {"FILE_READABLE"} and first["FILE_READABLE"].message.startswith("ArrowInvalid")
    assert results.where("dataset_name like 'missing_case_id/%' and rule_id = 'DQ_NOT_NULL_CASE_ID'").agg(
        F.min("failed_rows"), F.max("failed_rows")
    ).first() == (10, 10)


def test_a_fault_that_no_rule_notices_and_a_lost_tree(spark, tmp_path):
    path, root = str(tmp_path / "clean"), str(tmp_path / "invalid")
    manifest = batches_on_disk(spark, path)
    harmless = {"missing_case_id": scenarios.Fault(rows=lambda b: b), "schema_drift": scenarios.FAULTS["schema_drift"]}
    described = settle(scenarios.deliver_scenarios(spark, path, manifest, root, harmless))
    next(Path(root).glob("scenario=schema_drift/*batch_0002/*.parquet")).unlink()
    results = scenarios.validate_scenarios(spark, root, described, RAW.names)
    found = {r.dataset_name: r for r in scenarios.detected(results, described).collect()}
    assert not any(r.expected_failure_detected for n, r in found.items() if n.startswith("missing"))
    assert found["missing_case_id/batch_0001"].overall_status == "PASS"
    lost = found["schema_drift/batch_0002"]
    assert (lost.failed_rules, lost.expected_failure_detected) == ("FILE_READABLE", False)
    assert found["schema_drift/batch_0001"].expected_failure_detected


def test_the_first_batch_is_the_baseline(spark, tmp_path):
    path = str(tmp_path / "b")
    manifest = batches_on_disk(spark, path)
    rows = files.read_landed(spark, path).drop("landed_path")
    sinks.write_batches(rows.where("ingestion_batch_sequence = 1").drop("spend_area", "item_id"), str(tmp_path / "m" / "1"))
    sinks.write_batches(rows.where("ingestion_batch_sequence > 1"), str(tmp_path / "m" / "2"))
    results = publish.validate_files(spark, str(tmp_path / "m"), manifest).where("rule_id = 'DQ_SCHEMA_COLUMNS'")
    got = {r.batch_id: (r.status, r.failed_rows, r.message) for r in results.collect()}
    assert got.pop("batch_0001") == ("PASS", 0, "Schema matches baseline.")
    assert set(got.values()) == {("FAIL", 2, "Unexpected columns: item_id, spend_area")} and len(got) == 3
    with pytest.raises(ingest.PipelineError, match="Baseline"):
        publish.baseline_columns(spark, path, manifest.limit(0))
    file = next(Path(path, "batch=batch_0001").glob("*.parquet"))
    file.write_bytes(file.read_bytes()[:-100])
    with pytest.raises(ingest.PipelineError, match="Baseline"):
        publish.validate_files(spark, path, manifest)


def test_lost_cut_and_altered_files_fail_the_integrity_check(spark, tmp_path):
    path, root = str(tmp_path / "b"), str(tmp_path / "landing")
    manifest = batches_on_disk(spark, path)
    kinds = {"batch_0002": "cut", "batch_0003": "overwritten", "batch_0004": "whole"}
    listing = {r.batch_id: r.path for r in files.listed_files(spark, path).collect()}
    copies(spark, [(listing[b], f"{root}/{b}/events.parquet", kind) for b, kind in kinds.items()])
    found = ingest.file_integrity(manifest, files.file_inventory(spark, root)).collect()
    assert {r.batch_id: r.integrity for r in found} == {
        "batch_0001": "MISSING", "batch_0002": "SIZE_MISMATCH", "batch_0003": "HASH_MISMATCH", "batch_0004": "OK",
    }


def test_a_conflict_stops_the_run(spark):
    outcomes = spark.createDataFrame([("batch_0001", "SKIPPED"), ("batch_0002", "CONFLICT")], "batch_id string, status string")
    with pytest.raises(ingest.PipelineError, match="batch_0002: CONFLICT"):
        ingest.require_published(outcomes)
    ingest.require_published(outcomes.limit(1))


def test_a_clustered_table_is_opened_in_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), "id")
    rows.repartition(8).write.parquet(str(tmp_path / "random"))
    rows.repartitionByRange(8, "key").sortWithinPartitions("key").write.parquet(str(tmp_path / "ranged"))
    holding = lambda name: sinks.key_ranges(spark, str(tmp_path / name), "key").where(
        "low <= '7' and high >= '7'"
    ).count()
    assert holding("random") == 8 and holding("ranged") == 1
    crossing = {n: sinks.key_range_summary(spark, str(tmp_path / n), "key").first() for n in ("random", "ranged")}
    assert tuple(crossing["ranged"]) == (20_000, 8, 0) and tuple(crossing["random"]) == (20_000, 8, 7)


def test_rows_are_numbered_in_file_order_over_several_files(spark, tmp_path):
    def log(name, traces):
        body = "".join(
            f'<trace><string key="concept:name" value="{c}"/>'
            + "".join(f'<event><string key="concept:name" value="{c}.{k}"/></event>\n' for k in range(n))
            + "</trace>\n"
            for c, n in traces
        )
        (tmp_path / name).write_text(f"<log>\n{body}</log>")
        return [f"{c}.{k}" for c, n in traces for k in range(n)]

    rng = random.Random(3)
    wanted = []
    for name in ("part-0.xes", "part-1.xes", "part-2.xes"):
        wanted += log(name, [(f"{name}-{rng.random()}", rng.randrange(1, 30)) for _ in range(60)])
    events = settle(xes.read_xes(spark, str(tmp_path)))
    assert events.select("_file").distinct().count() == 3
    numbered = standardize.numbered_file_rows(events).orderBy("source_row_number").collect()
    assert [r["concept:name"] for r in numbered] == wanted
    assert [r["source_row_number"] for r in numbered] == list(range(1, len(wanted) + 1))


def test_a_compressed_log_is_read_like_a_plain_one(spark, tmp_path):
    (tmp_path / "plain.xes").write_text(LOG)
    (tmp_path / "packed.xes.gz").write_bytes(gzip.compress(LOG.encode()))
    read = lambda name: xes.read_xes(spark, str(tmp_path / name)).drop("_file", "_row", "_block").collect()
    assert read("packed.xes.gz") == read("plain.xes") and len(read("plain.xes")) == 3


def test_the_fault_of_a_scenario_is_matched_by_its_own_rule(spark):
    results = spark.createDataFrame(
        [("a/b1", "b1", 1, "X", "FAIL"), ("a/b1", "b1", 2, "Y", "PASS"), ("c/b1", "b1", 1, "X", "FAIL")],
        "dataset_name string, batch_id string, rule_order int, rule_id string, status string",
    )
    rules = spark.createDataFrame([("a/b1", "Y"), ("c/b1", "X")], "dataset_name string, expected_rule string")
    found = {r.dataset_name: r.expected_failure_detected for r in validate.scenario_results(results, rules).collect()}
    assert found == {"a/b1": False, "c/b1": True}


def test_shuffle_files_of_a_settled_table_go_when_it_is_written(spark):
    store = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    before = store.getAllFiles().size()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    settled_rows = settle(spark.range(1000).repartition(7, "id"))
    for _ in range(50):
        if store.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert store.getAllFiles().size() <= before
    assert settled_rows.count() == 1000 and spark.conf.get(name) == setting
