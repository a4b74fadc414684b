"""Grouped quantiles whose value is an element of the data.

Three ways, all ignoring NULL:

* ``sketch``: ``percentile_approx``, bounded memory per group; the choice for dashboards.
* ``exact_small_domain``: ``percentile_disc``; its buffer holds one entry per distinct value, so it is
  used only for values of a small domain such as whole hours.
* ``value_counts`` + ``ranked_values``: exact for any number of rows and distinct values. Rows are
  counted per value before the shuffle, and a running count is taken inside value ranges of fixed
  width, so that no window ever holds more than ``RANGE_WIDTH`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000
RANGE_WIDTH = 65_536


def sketch(column: Column, percent: int, accuracy: int = DEFAULT_ACCURACY) -> Column:
    return F.percentile_approx(column, percent / 100, accuracy)


def exact_small_domain(column_sql: str, percent: int) -> Column:
    return F.expr(
        f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY {column_sql})"
    ).cast("bigint")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value): ``keys + [value, n]``; NULL keys and values are groups."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def at_percent(percent: int) -> Callable[[Column], Column]:
    """Rank of a percent among ``n`` rows."""
    return lambda n: F.ceil(n * F.lit(percent) / F.lit(100))


def lower_middle(n: Column) -> Column:
    return F.floor((n + 1) / F.lit(2))


def upper_middle(n: Column) -> Column:
    return F.floor(n / F.lit(2)) + 1


def ranked_values(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
) -> DataFrame:
    """For each group the smallest value whose running count reaches each wanted rank.

    ``counts`` comes from :func:`value_counts` over an integer value. Groups without any value are
    absent from the result.
    """
    # Both filters are spelled out, so that the counts below and above the join are one exchange.
    known = counts.withColumn("_range", F.floor(F.col(value) / F.lit(RANGE_WIDTH))).where(
        F.col(value).isNotNull() & F.col("_range").isNotNull()
    )
    by_range = W.partitionBy(*keys).orderBy("_range")
    ranges = (
        known.groupBy(*keys, "_range")
        .agg(F.sum("n").alias("_in_range"))
        .withColumn("_group_rows", F.sum("_in_range").over(W.partitionBy(*keys)))
        .withColumn("_before", F.sum("_in_range").over(by_range) - F.col("_in_range"))
    )
    # Only ranges that hold a wanted rank take part in the second step.
    wanted = [rank(F.col("_group_rows")) for rank in ranks.values()]
    holds_rank = [
        (rank > F.col("_before")) & (rank <= F.col("_before") + F.col("_in_range"))
        for rank in wanted
    ]
    ranges = ranges.where(F.greatest(*holds_rank) if len(holds_rank) > 1 else holds_rank[0])
    pick = [F.col(f"r.{k}").alias(f"_r_{k}") for k in keys]
    right = ranges.alias("r").select(*pick, F.col("r._range").alias("_r_range"), "_before", "_group_rows")
    same = F.col("_range") == F.col("_r_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    inside = W.partitionBy(*keys, "_range").orderBy(value)
    located = known.join(right, same, "inner").withColumn(
        "_reached", F.col("_before") + F.sum("n").over(inside)
    )
    return located.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("_reached") >= rank, F.col(value))).alias(name)
            for name, rank in zip(ranks, wanted)
        ]
    )
