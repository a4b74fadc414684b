"""Positions in a total order, without ever putting a whole group or table into one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.schema import SkewPlan
from tracewright.shared_storage import settle

# monotonically_increasing_id() keeps the partition number above and the row position below this bit.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1

# Most keys that are broadcast one by one; more are told by a bucket of their hash.
HOT_BUCKETS = 1 << 20

# A slice of fewer rows costs more to start than to sort.
SLICE_ROWS = 100_000


def _sorted_slices(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Range-partition and sort by ``order``; ``_slice`` and ``_place`` number the result.

    Settled on shared storage, because range bounds come from a sample and may differ when the plan
    is evaluated again.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    numbered = ranged.sortWithinPartitions(*order).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    return (
        settle(numbered)
        .withColumn("_slice", F.shiftright("_row", _POSITION_BITS))
        .withColumn("_place", F.col("_row").bitwiseAND(F.lit(_POSITION_MASK)))
        .drop("_row")
    )


def global_rank(
    df: DataFrame, order: Sequence[Column], column: str, partitions: int | None = None
) -> DataFrame:
    """Add ``column`` = 1..n in ``order``, which must be a total order.

    Range partitions are sorted in parallel; each partition only needs the number of rows before it.
    The table of partition sizes has one row per partition, which is what bounds the broadcast.
    """
    slices = _sorted_slices(df, order, partitions)
    sizes = slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        "_slice",
        (F.sum("_rows").over(W.orderBy("_slice")) - F.col("_rows")).alias("_before"),
    )
    return (
        slices.join(F.broadcast(before), "_slice")
        .withColumn(column, F.col("_before") + F.col("_place") + F.lit(1))
        .drop("_slice", "_place", "_before")
    )


def file_order_rank(df: DataFrame, split: Sequence[str], row: str, column: str) -> DataFrame:
    """Number rows 1..n in file order without moving them.

    ``split`` names the file and block a row was read from, ``row`` grows by one from row to row of a
    split. Both must come from a settled table. Only the sizes of the splits are ordered and joined.
    """
    sizes = df.groupBy(*split).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        *split,
        "_first",
        (F.sum("_rows").over(W.orderBy(*split)) - F.col("_rows")).alias("_before"),
    )
    return (
        df.join(before, list(split))
        .withColumn(column, F.col("_before") + F.col(row) - F.col("_first") + F.lit(1))
        .drop("_first", "_before", row, *split)
    )


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the keys with very many rows (column ``_hot``) and how many slices they need.

    With ``buckets`` a hash stands for all keys of its bucket.
    """

    keys: DataFrame
    slices: int
    buckets: int | None = None

    def mark(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """Split ``df`` into its calm and its hot rows.

        At most :data:`HOT_BUCKETS` hashes are broadcast, eight bytes each.
        """
        marked = df.join(
            F.broadcast(self.keys), _hashed(key, self.buckets) == F.col("_hot"), "left"
        )
        calm = marked.where(F.col("_hot").isNull()).drop("_hot")
        return calm, marked.where(F.col("_hot").isNotNull()).drop("_hot")


def _hashed(key: str, buckets: int | None) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)) if buckets else F.xxhash64(key)


def hot_keys(
    df: DataFrame, key: str, plan: SkewPlan = SkewPlan(), buckets: int = HOT_BUCKETS
) -> HotKeys | None:
    """Keys that hold more than ``plan.max_rows`` rows, or None when there is none.

    Counts a row sample of the key column alone, partly before the shuffle. A key that is missed or
    flagged in error only changes how the work is spread. So with more than ``buckets`` hot keys their
    hashes are put into so many buckets, and slices hold ``SLICE_ROWS`` rows as soon as every core has one.
    """
    sampled = df.select(F.xxhash64(key).alias("_hot"))
    if plan.sample_fraction < 1:
        sampled = sampled.sample(fraction=plan.sample_fraction, seed=plan.seed)
    found = (
        sampled.groupBy("_hot")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > plan.max_rows * plan.sample_fraction)
    )
    found = settle(found)
    sampled_rows, keys = found.agg(F.sum("_rows"), F.count(F.lit(1))).first()
    if not keys:
        return None
    rows = sampled_rows / plan.sample_fraction
    cores = df.sparkSession.sparkContext.defaultParallelism
    most = max(2 * cores, math.ceil(rows / SLICE_ROWS))
    slices = max(2, min(2 * math.ceil(rows / plan.max_rows), most))
    if keys <= buckets:
        return HotKeys(found.select("_hot"), slices)
    coarse = found.select(F.pmod("_hot", F.lit(buckets)).alias("_hot")).distinct()
    return HotKeys(settle(coarse), slices, buckets)


def positions_in_group(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    *,
    position: str,
    total: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add position and size within ``key``, and values of the neighbouring rows.

    ``previous`` and ``following`` map a new column to the column it takes from the row before or
    after. NULL keys form one group. Without hot keys this is one window over one shuffle. Groups
    listed in ``hot`` are cut into sorted slices; windows then run per slice, and a small table of
    slice edges supplies the rows before each slice and the neighbours across its ends.
    """
    previous, following = dict(previous or {}), dict(following or {})
    if hot is None:
        return _windowed(df, [key], order, position, total, previous, following)

    df = settle(df)
    calm, busy = hot.mark(df, key)
    calm = calm.withColumn("_slice", F.lit(-1).cast("bigint"))
    busy = _sorted_slices(busy, [F.col(key), *order], hot.slices)

    lasts = [F.max_by(src, "_place").alias(f"_last_{new}") for new, src in previous.items()]
    firsts = [F.min_by(src, "_place").alias(f"_first_{new}") for new, src in following.items()]
    chain = W.partitionBy(key).orderBy("_slice")
    edges = busy.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_rows"), *lasts, *firsts)
    edges = edges.select(
        F.col(key).alias("_edge_key"),
        F.col("_slice").alias("_edge_slice"),
        (F.sum("_rows").over(chain) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(W.partitionBy(key)).alias("_all"),
        F.count(F.lit(1)).over(W.partitionBy(key)).alias("_slices"),
        *[F.lag(f"_last_{new}").over(chain).alias(f"_edge_{new}") for new in previous],
        *[F.lead(f"_first_{new}").over(chain).alias(f"_edge_{new}") for new in following],
    )
    # A key inside one slice has nothing before it and no neighbours beyond.
    edges = edges.where(F.col("_slices") > 1).drop("_slices")

    sliced = _windowed(
        calm.unionByName(busy.drop("_place")),
        [key, "_slice"],
        order,
        position,
        "_slice_rows",
        previous,
        following,
    )
    # Of two slices that follow each other only one key can lie in both: at most 2 * slices rows.
    joined = sliced.join(
        F.broadcast(edges),
        F.col(key).eqNullSafe(F.col("_edge_key")) & (F.col("_slice") == F.col("_edge_slice")),
        "left",
    )
    is_first = F.col(position) == 1
    is_last = F.col(position) == F.col("_slice_rows")
    added = {position: F.col(position) + F.coalesce("_before", F.lit(0))}
    if total:
        added[total] = F.coalesce("_all", "_slice_rows")
    for new in previous:
        added[new] = F.when(is_first, F.col(f"_edge_{new}")).otherwise(F.col(new))
    for new in following:
        added[new] = F.when(is_last, F.col(f"_edge_{new}")).otherwise(F.col(new))
    return joined.select(*df.columns, *[column.alias(name) for name, column in added.items()])


def _windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    position: str,
    total: str | None,
    previous: Mapping[str, str],
    following: Mapping[str, str],
) -> DataFrame:
    ordered = W.partitionBy(*keys).orderBy(*order)
    added = {position: F.row_number().over(ordered).cast("bigint")}
    if total:
        added[total] = F.count(F.lit(1)).over(W.partitionBy(*keys))
    for new, source in previous.items():
        added[new] = F.lag(source).over(ordered)
    for new, source in following.items():
        added[new] = F.lead(source).over(ordered)
    return df.select("*", *[column.alias(name) for name, column in added.items()])
