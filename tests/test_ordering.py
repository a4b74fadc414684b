"""Distributed ranks and positions against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tracewright.operators.ordering import global_rank, hot_keys, positions_in_group
from tracewright.schema import SkewPlan

ROWS = "id bigint, key string, t bigint, activity string"


def rows(n, seed=1):
    """A third of all rows share one key, another large part has none; times have ties and gaps."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        draw = rng.random()
        key = "hot" if draw < 0.35 else None if draw < 0.6 else f"k{rng.randrange(n // 10)}"
        t = None if rng.random() < 0.1 else rng.randrange(n // 4)
        out.append((i, key, t, f"a{rng.randrange(5)}"))
    return out


def expected(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[1]].append(row)
    result = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        for i, row in enumerate(members):
            before = members[i - 1] if i else None
            after = members[i + 1] if i + 1 < len(members) else None
            result[row[0]] = (
                i + 1,
                len(members),
                before and before[3],
                after and after[3],
                before and before[2],
                after and after[2],
            )
    return result


def placed(df, hot):
    out = positions_in_group(
        df,
        "key",
        [F.asc_nulls_first("t"), F.asc("id")],
        position="p",
        total="n",
        previous={"prev_a": "activity", "prev_t": "t"},
        following={"next_a": "activity", "next_t": "t"},
        hot=hot,
    )
    return {
        r["id"]: (r["p"], r["n"], r["prev_a"], r["next_a"], r["prev_t"], r["next_t"])
        for r in out.collect()
    }


@pytest.mark.parametrize("n", [30, 2000])
def test_positions_with_and_without_hot_keys(spark, n):
    data = rows(n)
    df = spark.createDataFrame(data, ROWS).repartition(5)
    wanted = expected(data)
    assert placed(df, None) == wanted
    hot = hot_keys(df, "key", SkewPlan(max_rows=n // 10, sample_fraction=1.0))
    assert hot.keys.count() >= 2 and hot.slices >= 6
    assert placed(df, hot) == wanted


def test_cold_keys_flagged_as_hot_change_nothing(spark):
    data = rows(300, seed=3)
    df = spark.createDataFrame(data, ROWS)
    hot = hot_keys(df, "key", SkewPlan(max_rows=4, sample_fraction=1.0))
    assert placed(df, hot) == expected(data)


@pytest.mark.parametrize("buckets", [16, 1 << 20])
def test_very_many_hot_keys_need_few_slices_and_hashes(spark, buckets):
    data = [(i, f"k{i % 300}" if i % 4 else "hot", i % 17, f"a{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(data, ROWS).repartition(3)
    hot = hot_keys(df, "key", SkewPlan(max_rows=5, sample_fraction=1.0), buckets)
    assert hot.slices <= 2 * spark.sparkContext.defaultParallelism
    assert hot.keys.count() <= buckets
    assert placed(df, hot) == expected(data)


def test_no_hot_keys(spark):
    df = spark.createDataFrame(rows(50), ROWS)
    assert hot_keys(df, "key", SkewPlan()) is None


def test_hot_key_is_found_in_a_sample(spark):
    df = spark.range(40_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key")
    hot = hot_keys(df, "key", SkewPlan(max_rows=5_000, sample_fraction=0.1))
    assert hot.keys.count() == 1


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_global_rank(spark, partitions):
    rng = random.Random(5)
    data = [(i, None if i % 11 == 0 else rng.randrange(40)) for i in range(1000)]
    df = spark.createDataFrame(data, "id bigint, t bigint").repartition(9)
    order = [F.asc_nulls_last("t"), F.desc("id")]
    got = {r["id"]: r["n"] for r in global_rank(df, order, "n", partitions).collect()}
    data.sort(key=lambda r: (r[1] is None, r[1] or 0, -r[0]))
    assert got == {row[0]: i for i, row in enumerate(data, start=1)}


def test_global_rank_has_no_single_task_over_rows(spark):
    df = spark.range(1000)
    plan = global_rank(df, [F.col("id")], "n")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange is the one over partition sizes, below a broadcast.
    assert plan.count("SinglePartition") == 1
    assert "BroadcastHashJoin" in plan
