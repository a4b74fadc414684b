"""Process analytics tables built from staged events and cases."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.fixed_values import VARIANT_SEPARATOR
from tracewright.functions import quantiles as Q
from tracewright.functions.numbers import count_where, ratio
from tracewright.functions.time import utc_clock
from tracewright.operators.ordering import HotKeys, global_rank
from tracewright.operators.staging import case_aggregates, grouped_by_case
from tracewright.shared_storage import settle

# Events whose texts are joined in one step; longer cases are joined from such pieces.
VARIANT_PIECE = 4_096

# Column names and order of the result tables.
KPI_COLUMNS = (
    "case_id", "case_name", "case_start_timestamp", "case_end_timestamp",
    "case_duration_seconds", "case_duration_hours", "case_duration_days",
    "event_count", "distinct_activity_count", "repeated_activity_event_count",
    "has_rework", "rework_event_rate", "distinct_resource_count",
    "missing_resource_event_count", "missing_resource_rate",
    "timestamp_outlier_event_count", "is_analysis_ready", "ingestion_batch_count",
    "start_activity", "end_activity", "company_id", "vendor_id",
    "purchasing_document_id", "document_type", "purchasing_document_category",
    "item_type", "item_category", "spend_area", "sub_spend_area", "spend_classification",
    "maximum_cumulative_net_worth_eur", "first_ingestion_date", "last_ingestion_date",
)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys where NULL meets NULL; the keys are kept once."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, "left").drop(*[f"_right_{k}" for k in keys])


# -- case KPIs -----------------------------------------------------------------------------------


def _kpi_aggregates(distinct: Callable[[str], Column]) -> dict[str, Column]:
    return case_aggregates(distinct) | {"distinct_resource_count": distinct("resource_id")}


def case_kpis(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Case attributes and case measures in one row per case; events without a case are left out.

    The case table and the event statistics share their grouping key and their input, so one grouping
    of the events gives both and no join is needed.
    """
    grouped = grouped_by_case(events.where(F.col("case_id").isNotNull()), _kpi_aggregates, hot)
    repeats = F.col("event_count") - F.col("distinct_activity_count")
    return grouped.select(
        "*",
        repeats.alias("repeated_activity_event_count"),
        (repeats > 0).alias("has_rework"),
        ratio(repeats, F.col("event_count")).alias("rework_event_rate"),
        ratio(F.col("missing_resource_event_count"), F.col("event_count")).alias(
            "missing_resource_rate"
        ),
        (F.col("timestamp_outlier_event_count") == 0).alias("is_analysis_ready"),
    ).select(*KPI_COLUMNS)


# -- variants ------------------------------------------------------------------------------------


def case_variants(events: DataFrame, piece: int = VARIANT_PIECE) -> DataFrame:
    """The activities of each case in order, as one text; NULL when a case has no activity.

    Pieces of consecutive events are joined first, so that no aggregation buffer holds the rows of
    a whole long case.
    """
    ordered = events.where(F.col("case_id").isNotNull()).select(
        "case_id",
        "activity",
        "process_event_sequence",
        F.floor((F.col("process_event_sequence") - 1) / F.lit(piece)).alias("_piece"),
    )
    separator = VARIANT_SEPARATOR
    pieces = ordered.groupBy("case_id", "_piece").agg(
        F.expr(
            f"listagg(activity, '{separator}') WITHIN GROUP (ORDER BY process_event_sequence)"
        ).alias("_text")
    )
    return pieces.groupBy("case_id").agg(
        F.expr(f"listagg(_text, '{separator}') WITHIN GROUP (ORDER BY _piece)").alias(
            "process_variant"
        )
    )


def _ready_hours() -> Column:
    return F.when(F.col("is_analysis_ready"), F.col("case_duration_hours"))


def _hours_summary(exact: bool) -> list[Column]:
    """Average, median and P90 of the hours of analysis-ready cases (column ``ready_hours``)."""
    if exact:
        median, p90 = (Q.exact_small_domain("ready_hours", p) for p in (50, 90))
    else:
        median, p90 = (Q.sketch(F.col("ready_hours"), p) for p in (50, 90))
    return [
        F.avg("ready_hours").alias("average_case_duration_hours"),
        median.alias("median_case_duration_hours"),
        p90.alias("p90_case_duration_hours"),
    ]


def variant_statistics(variants: DataFrame, kpis: DataFrame, exact: bool = False) -> DataFrame:
    """Cases, durations and rework per variant."""
    cases = variants.join(
        kpis.select(
            "case_id",
            "is_analysis_ready",
            "has_rework",
            "event_count",
            _ready_hours().alias("ready_hours"),
        ),
        "case_id",
    )
    # The digest is the key: texts can be long, and only one per variant has to travel on.
    keyed = cases.withColumn("_id", variant_id(F.col("process_variant")))
    return keyed.groupBy("_id").agg(
        F.min("process_variant").alias("process_variant"),
        F.count(F.lit(1)).alias("case_count"),
        count_where(F.col("is_analysis_ready")).alias("analysis_ready_case_count"),
        *_hours_summary(exact),
        F.avg("event_count").alias("average_event_count"),
        count_where(F.col("has_rework")).alias("rework_case_count"),
        ratio(count_where(F.col("has_rework")), F.count(F.lit(1))).alias("rework_case_rate"),
    ).drop("_id")


def with_share(
    df: DataFrame, count: str, share: str, whole: DataFrame | None = None
) -> DataFrame:
    """Add the share of each row in the column total (a one-row cross join, not a global window).

    ``whole`` is the total as a one-row, one-column frame where there is a cheaper way to it.
    """
    if whole is None:
        whole = df.agg(F.sum(count))
    return (
        df.crossJoin(whole.toDF("_whole"))
        .withColumn(share, ratio(F.col(count), F.col("_whole")))
        .drop("_whole")
    )


def ranked_variants(statistics: DataFrame) -> DataFrame:
    """Rank by size, then text. There can be as many variants as cases, hence the parallel rank."""
    return global_rank(
        statistics,
        [F.desc("case_count"), F.asc_nulls_first("process_variant")],
        "variant_rank",
    )


def variant_id(variant: Column) -> Column:
    return F.sha2(variant, 256)


def process_variants(events: DataFrame, kpis: DataFrame, exact: bool = False) -> DataFrame:
    """The variant table, most frequent first by rank."""
    ranked = ranked_variants(variant_statistics(case_variants(events), kpis, exact))
    return with_share(ranked, "case_count", "case_share").select(
        "variant_rank",
        variant_id(F.col("process_variant")).alias("variant_id"),
        "process_variant",
        "case_count",
        "case_share",
        "analysis_ready_case_count",
        "average_case_duration_hours",
        "median_case_duration_hours",
        "p90_case_duration_hours",
        "average_event_count",
        "rework_case_count",
        "rework_case_rate",
    )


# -- activities ----------------------------------------------------------------------------------

# Column names and order.
ACTIVITY_COLUMNS = (
    "activity", "event_count", "case_count", "distinct_resource_count",
    "case_start_count", "case_end_count", "missing_resource_event_count",
    "missing_resource_rate", "timestamp_outlier_event_count",
    "average_seconds_since_previous_event", "median_seconds_since_previous_event",
    "p90_seconds_since_previous_event", "average_seconds_to_next_event",
    "median_seconds_to_next_event", "p90_seconds_to_next_event",
)


def _with_distinct_counts(
    result: DataFrame, df: DataFrame, keys: Sequence[str], distinct: dict[str, str]
) -> DataFrame:
    """Add a distinct count per entry of ``distinct`` (new column -> counted column).

    Each count is a grouping of its own over (keys, value) pairs, spread over all tasks. In one
    grouping with other measures, Spark would first keep those measures per pair: a whole quantile
    sketch for every activity of every case.
    """
    for new, column in distinct.items():
        counted = df.groupBy(*keys).agg(F.count_distinct(column).alias(new))
        result = _join_null_safe(result, counted, keys)
    return result


def _sketches(gap: str, names: tuple[str, str]) -> list[Column]:
    return [Q.sketch(F.col(gap), p).alias(name) for name, p in zip(names, (50, 90))]


def _value_counts(
    df: DataFrame, keys: Sequence[str], texts: Sequence[str], numbers: Sequence[str], flags: Sequence[str]
) -> DataFrame:
    """Rows per key, measure and value, in one scan and one exchange; settled, as all statistics use it.

    Text and number columns are the measures. The counts of true ``flags`` stand with the first one.
    """
    measures = [
        F.struct(
            F.lit(c).alias("measure"),
            (F.col(c) if c in texts else F.lit(None)).cast("string").alias("text"),
            (F.col(c) if c in numbers else F.lit(None)).cast("bigint").alias("number"),
        )
        for c in (*texts, *numbers)
    ]
    rows = df.select(*keys, *flags, F.inline(F.array(*measures)))
    first = F.col("measure") == texts[0]
    return settle(
        rows.groupBy(*keys, "measure", "text", "number").agg(
            F.count(F.lit(1)).alias("n"), *[count_where(first & F.col(f)).alias(f) for f in flags]
        )
    )


def _rows_of(counts_of: str) -> Column:
    return F.sum(F.when(F.col("measure") == counts_of, F.col("n")))


def _distinct_of(text: str) -> Column:
    return count_where((F.col("measure") == text) & F.col("text").isNotNull())


def _average_of(number: str) -> Column:
    known = (F.col("measure") == number) & F.col("number").isNotNull()
    total = F.sum(F.when(known, F.col("number") * F.col("n")))
    return total / F.sum(F.when(known, F.col("n")))


def _with_exact_quantiles(
    result: DataFrame, counts: DataFrame, keys: Sequence[str], names: dict[str, tuple[str, str]]
) -> DataFrame:
    """Median and P90 of every number column in ``names``, from the settled counts."""
    numbers = counts.where(F.col("measure").isin(*names)).select(*keys, "measure", "number", "n")
    ranks = {"_median": Q.at_percent(50), "_p90": Q.at_percent(90)}
    ranked = Q.ranked_values(numbers, [*keys, "measure"], "number", ranks)
    picked = ranked.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("measure") == measure, F.col(rank))).alias(name)
            for measure, both in names.items()
            for rank, name in zip(ranks, both)
        ]
    )
    return _join_null_safe(result, picked, keys)


def _exact_activity_performance(events: DataFrame, gaps: dict[str, tuple[str, str]]) -> DataFrame:
    flags = ("is_case_start", "is_case_end", "is_resource_missing", "is_timestamp_outlier")
    counts = _value_counts(events, ["activity"], ("case_id", "resource_id"), tuple(gaps), flags)
    summed = lambda flag: F.sum(flag)
    result = counts.groupBy("activity").agg(
        _rows_of("case_id").alias("event_count"),
        _distinct_of("case_id").alias("case_count"),
        _distinct_of("resource_id").alias("distinct_resource_count"),
        summed("is_case_start").alias("case_start_count"),
        summed("is_case_end").alias("case_end_count"),
        summed("is_resource_missing").alias("missing_resource_event_count"),
        ratio(summed("is_resource_missing"), _rows_of("case_id")).alias("missing_resource_rate"),
        summed("is_timestamp_outlier").alias("timestamp_outlier_event_count"),
        *[_average_of(gap).alias(f"average_{gap}") for gap in gaps],
    )
    return _with_exact_quantiles(result, counts, ["activity"], gaps).select(*ACTIVITY_COLUMNS)


def activity_performance(events: DataFrame, exact: bool = False) -> DataFrame:
    """Counts, completeness and gaps per activity; NULL is an activity of its own."""
    gaps = {
        gap: (f"median_{gap}", f"p90_{gap}")
        for gap in ("seconds_since_previous_event", "seconds_to_next_event")
    }
    if exact:
        return _exact_activity_performance(events, gaps)
    missing = count_where(F.col("is_resource_missing"))
    sketches = [s for gap, names in gaps.items() for s in _sketches(gap, names)]
    result = events.groupBy("activity").agg(
        F.count(F.lit(1)).alias("event_count"),
        count_where(F.col("is_case_start")).alias("case_start_count"),
        count_where(F.col("is_case_end")).alias("case_end_count"),
        missing.alias("missing_resource_event_count"),
        ratio(missing, F.count(F.lit(1))).alias("missing_resource_rate"),
        count_where(F.col("is_timestamp_outlier")).alias("timestamp_outlier_event_count"),
        *[F.avg(gap).alias(f"average_{gap}") for gap in gaps],
        *sketches,
    )
    result = _with_distinct_counts(
        result,
        events,
        ["activity"],
        {"case_count": "case_id", "distinct_resource_count": "resource_id"},
    )
    return result.select(*ACTIVITY_COLUMNS)


# -- transitions ---------------------------------------------------------------------------------


def transition_statistics(events: DataFrame, exact: bool = False) -> DataFrame:
    """Directly-follows pairs with their frequency and gap statistics."""
    keys = ["from_activity", "to_activity"]
    pairs = events.where(F.col("next_activity").isNotNull()).select(
        F.col("activity").alias("from_activity"),
        F.col("next_activity").alias("to_activity"),
        "case_id",
        F.col("seconds_to_next_event").alias("gap"),
    )
    names = ("median_transition_seconds", "p90_transition_seconds")
    if exact:
        counts = _value_counts(pairs, keys, ("case_id",), ("gap",), ())
        number = F.when(F.col("measure") == "gap", F.col("number"))
        result = counts.groupBy(*keys).agg(
            _rows_of("case_id").alias("transition_count"),
            _distinct_of("case_id").alias("case_count"),
            _average_of("gap").alias("average_transition_seconds"),
            F.min(number).alias("minimum_transition_seconds"),
            F.max(number).alias("maximum_transition_seconds"),
        )
        result = _with_exact_quantiles(result, counts, keys, {"gap": names})
    else:
        result = pairs.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("transition_count"),
            F.avg("gap").alias("average_transition_seconds"),
            F.min("gap").alias("minimum_transition_seconds"),
            F.max("gap").alias("maximum_transition_seconds"),
            *_sketches("gap", names),
        )
        result = _with_distinct_counts(result, pairs, keys, {"case_count": "case_id"})
    return result.select(
        *keys,
        "transition_count",
        "case_count",
        "average_transition_seconds",
        *names,
        "minimum_transition_seconds",
        "maximum_transition_seconds",
    )


def transitions(events: DataFrame, exact: bool = False) -> DataFrame:
    """The transition table: statistics and the share in all transitions."""
    statistics = settle(transition_statistics(events, exact))
    return with_share(statistics, "transition_count", "transition_share")


# -- overview ------------------------------------------------------------------------------------


def process_overview(
    events: DataFrame,
    kpis: DataFrame,
    variants: DataFrame,
    calculated_at: datetime | None = None,
    exact: bool = False,
) -> DataFrame:
    """One row over cases, events and variants (any frame with process_variant and case_count).

    ``calculated_at`` None stamps the row with the time of the query.
    """
    per_case = kpis.select("*", _ready_hours().alias("ready_hours")).agg(
        F.count(F.lit(1)).alias("total_cases"),
        count_where(F.col("is_analysis_ready")).alias("analysis_ready_cases"),
        *_hours_summary(exact),
        F.avg("event_count").alias("average_events_per_case"),
        count_where(F.col("has_rework")).alias("rework_cases"),
        ratio(count_where(F.col("has_rework")), F.count(F.lit(1))).alias("rework_case_rate"),
    )
    rows = F.count(F.lit(1))
    per_event = events.agg(
        rows.alias("total_events"),
        F.count_distinct("activity").alias("total_activities"),
        ratio(count_where(F.col("is_resource_missing")), rows).alias("missing_resource_rate"),
        ratio(count_where(F.col("is_timestamp_outlier")), rows).alias("timestamp_outlier_rate"),
    )
    per_variant = variants.agg(
        F.count(F.lit(1)).alias("total_variants"),
        ratio(F.max("case_count"), F.sum("case_count")).alias("top_variant_case_share"),
    )
    if calculated_at is None:
        now = utc_clock(F.current_timestamp())
    else:
        now = F.lit(calculated_at.isoformat()).cast("timestamp_ntz")
    return (
        per_case.crossJoin(per_event)
        .crossJoin(per_variant)
        .select(now.alias("calculation_timestamp_utc"), "*")
    )


# -- reports and checks --------------------------------------------------------------------------


def case_kpi_counts(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.count(F.lit(1)).alias("case_kpi_rows"), F.count_distinct("case_id").alias("unique_cases")
    )


def variant_counts(variants: DataFrame) -> DataFrame:
    return variants.agg(
        F.count(F.lit(1)).alias("process_variant_count"),
        F.sum("case_count").alias("cases_represented_by_variants"),
    )


def activity_counts(performance: DataFrame) -> DataFrame:
    return performance.agg(F.count(F.lit(1)).alias("activity_count"))


def transition_counts(moves: DataFrame) -> DataFrame:
    return moves.agg(
        F.count(F.lit(1)).alias("transition_types"),
        F.sum("transition_count").alias("total_transitions"),
    )


def top_variants(variants: DataFrame, limit: int = 20) -> DataFrame:
    return (
        variants.orderBy("variant_rank")
        .limit(limit)
        .select(
            "variant_rank",
            "case_count",
            F.round(F.col("case_share") * 100, 2).alias("case_share_percent"),
            F.round(F.col("median_case_duration_hours").cast("double"), 2).alias(
                "median_duration_hours"
            ),
            F.round(F.col("rework_case_rate") * 100, 2).alias("rework_rate_percent"),
            "process_variant",
        )
    )


def slow_transitions(moves: DataFrame, minimum_count: int = 100, limit: int = 20) -> DataFrame:
    """The frequent transitions with the longest P90; the activity names break ties."""
    return (
        moves.where(F.col("transition_count") >= minimum_count)
        .orderBy(
            F.desc("p90_transition_seconds"),
            F.asc_nulls_first("from_activity"),
            F.asc_nulls_first("to_activity"),
        )
        .limit(limit)
        .select(
            "from_activity",
            "to_activity",
            "transition_count",
            "case_count",
            F.round(F.col("median_transition_seconds") / 3600, 2).alias("median_transition_hours"),
            F.round(F.col("p90_transition_seconds") / 3600, 2).alias("p90_transition_hours"),
        )
    )


def analytics_verdict(
    events: DataFrame,
    cases: DataFrame,
    kpis: DataFrame,
    variants: DataFrame,
    performance: DataFrame,
    moves: DataFrame,
) -> DataFrame:
    """Ten metrics, three reconciliation flags and their conjunction, as one row."""
    rows = F.count(F.lit(1))
    metrics = (
        cases.agg(rows.alias("staging_case_count"))
        .crossJoin(
            kpis.agg(
                rows.alias("case_kpi_rows"), F.count_distinct("case_id").alias("unique_cases")
            )
        )
        .crossJoin(
            variants.agg(
                rows.alias("variant_count"), F.sum("case_count").alias("variant_case_count")
            )
        )
        .crossJoin(performance.agg(rows.alias("activity_count")))
        .crossJoin(
            moves.agg(
                rows.alias("transition_type_count"),
                F.sum("transition_count").alias("transition_count"),
            )
        )
        .crossJoin(
            events.agg(
                F.count_distinct("activity").alias("expected_activity_count"),
                count_where(F.col("next_activity").isNotNull()).alias("expected_transition_count"),
            )
        )
    )
    cases_agree = (
        (F.col("staging_case_count") == F.col("case_kpi_rows"))
        & (F.col("case_kpi_rows") == F.col("unique_cases"))
        & (F.col("unique_cases") == F.col("variant_case_count"))
    )
    activities_agree = F.col("activity_count") == F.col("expected_activity_count")
    transitions_agree = F.col("transition_count") == F.col("expected_transition_count")
    return metrics.select(
        "staging_case_count", "case_kpi_rows", "unique_cases", "variant_count",
        "variant_case_count", "activity_count", "expected_activity_count",
        "transition_type_count", "transition_count", "expected_transition_count",
        cases_agree.alias("case_reconciliation_success"),
        activities_agree.alias("activity_reconciliation_success"),
        transitions_agree.alias("transition_reconciliation_success"),
        (cases_agree & activities_agree & transitions_agree).alias("analytics_build_success"),
    )
