"""Centroid clustering against plain Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import centroid_clusters as cc

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, hash string, vector string"


def brute(rows, clusters=16, rounds=3):
    kept = [
        (i, [math.floor(x * 64) if abs(x) < 2**53 else int(x) * 64 for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:clusters]]

    def assigned():
        for i, v in kept:
            yield i, v, *min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        of = [[] for _ in centroids]
        for _, v, _, k in assigned():
            of[k].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(of, centroids)]
    last = list(assigned())
    inertia = [sum(d for _, _, d, c in last if c == k) for k in range(len(centroids))]
    fits = lambda x: x if x < 2**63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, k, fits(d), fits(inertia[k]), fits(sum(inertia)), digest[k]) for i, _, d, k in last), key=repr
    )


def table(spark, rows):
    return spark.createDataFrame([(i, v, "mine", "mine", "mine") for i, v in rows], SCHEMA)


def result(spark, rows):
    found = cc.clustered(table(spark, rows))
    return sorted(map(tuple, found.select("vec_id", *cc.NEW_COLUMNS).collect()), key=repr)


def odd_rows(rng):
    plain = [(k, [rng.gauss(k % 5, 1) for _ in range(64)]) for k in range(200)]
    copies = [(1000 + k, plain[7][1]) for k in range(150)] + [(7, plain[8][1]), (7, plain[8][1]), (7, plain[9][1])]
    cut = [(2000, plain[0][1][:63]), (2001, plain[0][1] + [0.0]), (2002, []), (2003, None), (None, plain[3][1])]
    bad = [(2010, [None] + plain[1][1][1:]), (2011, [math.nan] + plain[1][1][1:]), (2012, [math.inf] + [0.0] * 63)]
    return plain + copies + cut + bad + [(None, None)]


def test_against_brute_force_with_odd_rows(spark):
    rows = odd_rows(random.Random(4))
    assert result(spark, rows) == brute(rows)
    found = cc.clustered(table(spark, rows))
    assert set(found.select("hash", "vector").distinct().collect()) == {("mine", "mine")}


@pytest.mark.parametrize("scale", [1e5, 1e17, 1e300])
def test_very_large_components(spark, scale):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 1) * (scale if k % 3 == 0 else 1) for _ in range(64)]) for k in range(60)]
    assert result(spark, rows) == brute(rows)


def test_few_equal_or_no_vectors(spark):
    few = [(k, [float(k)] * 64) for k in range(5)]
    assert result(spark, few) == brute(few)
    same = [(k, [0.25] * 64) for k in range(40)]
    assert result(spark, same) == brute(same)
    assert {r[1] for r in result(spark, same)} == {0}
    empty = cc.clustered(table(spark, few).limit(0))
    assert empty.count() == 0 and empty.columns[-5:] == list(cc.NEW_COLUMNS)
    assert result(spark, [(1, None), (2, [])]) == []


def test_floats_and_partitions_do_not_matter(spark):
    rng = random.Random(6)
    rows = [(k, [float(np.float32(rng.uniform(-1, 1))) for _ in range(64)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(13)
    found = cc.clustered(df).select("vec_id", *cc.NEW_COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_the_transform_is_orthogonal_and_coarse_first():
    matrix = cc.transform(np.eye(64, dtype=np.int64)).T
    assert (matrix @ matrix.T == 64 * np.eye(64, dtype=np.int64)).all()
    for k in range(7):
        blocks = matrix[: 1 << k].reshape(1 << k, 1 << k, -1)
        assert (blocks == blocks[:, :, :1]).all()


def test_ties_go_to_the_smaller_number_and_worse_centroids_leave():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-3, 3, (500, 64))
    centroids = np.concatenate((rng.integers(-3, 3, (6, 64)), vectors[:3], vectors[:3]))
    number, distance = cc.nearest(cc.transform(vectors), cc.transform(centroids))
    full = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (distance == full.min(axis=1)).all() and (number == full.argmin(axis=1)).all()
    assert cc.nearest(cc.transform(vectors), cc.transform(centroids))[0][:3].tolist() == [6, 7, 8]


def test_the_query_reads_a_written_folder(spark, tmp_path):
    from tracewright.llm.queries import llm_queries

    rows = odd_rows(random.Random(9))
    table(spark, rows).withColumn("label", F.lit(1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = llm_queries()["op11_centroid_clusters"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)
