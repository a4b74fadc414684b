"""Event logs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.schema import RAW

BATCH_SIZE = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_USER_DAY = {
    "event_id": "event_id",
    "case_id": "concat(cast(user_id as string), '_', cast(cast(ts as date) as string))",
    "case_name": "cast(user_id as string)",
    "event_sequence": "cast(null as int)",
    "activity": "case when event_id % 2 = 0 then concat('  ', event_type, ' ') else event_type end",
    "event_timestamp": "ts",
    "event_date": "cast(ts as date)",
    "event_year": "cast(year(ts) as smallint)",
    "event_month": "cast(month(ts) as tinyint)",
    "timestamp_quality_status": """case day(ts) when 1 then 'edge_period_before_main_window'
        when 30 then 'edge_period_after_main_window' else 'expected_period' end""",
    "resource_id": "case when event_id % 4 <> 0 then concat('user_', cast(user_id % 10 as string)) end",
    "cumulative_net_worth_eur": "value",
    "company_id": "concat('c', cast(user_id % 4 as string))",
    "vendor_id": "concat(' v', cast(user_id % 20 as string))",
    "source_system": "'events'",
    "source_row_number": "event_id",
    "ingestion_batch_sequence": f"event_id div {BATCH_SIZE} + 1",
    "ingestion_batch_id": f"format_string('batch_%04d', event_id div {BATCH_SIZE} + 1)",
    "simulated_ingestion_timestamp_utc": "timestamp_ntz'2026-01-01 08:00:00' + "
    f"make_dt_interval(cast(event_id div {BATCH_SIZE} as int))",
    "simulated_ingestion_date": f"date_add(date'2026-01-01', cast(event_id div {BATCH_SIZE} as int))",
    "batch_row_number": f"event_id % {BATCH_SIZE} + 1",
}


def _raw_columns(expressions: dict[str, str]) -> list[str]:
    return [
        f"cast({expressions.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
        for f in RAW
    ]


def user_day_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw.events: one case per user and day, delivered in batches by event id."""
    return table(spark, sf_dir, "events").selectExpr(*_raw_columns(_USER_DAY))


def redelivered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-day log with every fiftieth event delivered twice, later and with another net worth."""
    events = table(spark, sf_dir, "events")
    # Second deliveries get the batch numbers that follow the real ones.
    batches = (events.agg({"event_id": "max"}).first()[0] or 0) // BATCH_SIZE + 1
    again = f"(delivery - 1) * {batches}"
    batch = f"event_id div {BATCH_SIZE} + 1 + {again}"
    delivered = {
        **_USER_DAY,
        "cumulative_net_worth_eur": "value + delivery - 1",
        "ingestion_batch_sequence": batch,
        "ingestion_batch_id": f"format_string('batch_%04d', {batch})",
        "simulated_ingestion_timestamp_utc": "timestamp_ntz'2026-01-01 08:00:00' + "
        f"make_dt_interval(cast({batch} - 1 as int))",
        "simulated_ingestion_date": f"date_add(date'2026-01-01', cast({batch} - 1 as int))",
    }
    deliveries = "explode(sequence(1, case when event_id % 50 = 0 then 2 else 1 end)) as delivery"
    return events.selectExpr("*", deliveries).selectExpr(
        *_raw_columns(delivered)
    )


# The order log: one creation event per order and one shipping event per line.
_ORDER_EVENTS = [
    "o_orderkey as order_key", "'Create Order' as activity", "o_orderdate as ts",
    "cast(null as int) as line", "cast(null as bigint) as part", "cast(null as bigint) as supplier",
    "o_totalprice as price",
]
_SHIP_EVENTS = [
    "l_orderkey as order_key", "concat('Ship ', l_linestatus, l_returnflag) as activity",
    "l_shipdate as ts", "l_linenumber as line", "l_partkey as part", "l_suppkey as supplier",
    "l_extendedprice as price",
]
ORDER_LOG_KEY = ("ts", "order_key", "activity", "line", "part", "supplier", "price")

# Source attributes with blanks, missing markers, offsets and unreadable values mixed in.
_SOURCE_ATTRIBUTES = {
    "User": "case when order_key % 5 = 0 then 'NONE' when order_key % 11 = 3 then null"
    " else concat(' clerk_', cast(order_key % 9 as string)) end",
    "org:resource": "case when order_key % 5 = 0 then 'NONE' when order_key % 5 = 1 then ' none '"
    " else concat('clerk_', cast(order_key % 9 as string)) end",
    "concept:name": "concat('  ', activity, '\t')",
    "Cumulative net worth (EUR)": "case when order_key % 13 = 2 then 'n/a' else cast(price as string) end",
    "time:timestamp": "case when order_key % 17 = 4 then 'unknown'"
    " when order_key % 3 = 0 then concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00')"
    " when order_key % 3 = 1 then date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
    " else concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), 'Z') end",
    "case:Spend area text": "case when order_key % 7 = 0 then ' ' else concat('area ', cast(order_key % 21 as string)) end",
    "case:Company": "concat('company ', cast(order_key % 4 as string))",
    "case:Document Type": "concat('type ', cast(order_key % 3 as string))",
    "case:Sub spend area text": "case when order_key % 7 = 0 then '' else concat('sub ', cast(order_key % 136 as string)) end",
    "case:Purchasing Document": "order_key div 4",
    "case:Purch. Doc. Category name": "'Purchase order'",
    "case:Vendor": "concat('vendor ', cast(order_key % 1975 as string))",
    "case:Item Type": "concat('item type ', cast(order_key % 6 as string))",
    "case:Item Category": "concat('item category ', cast(order_key % 4 as string))",
    "case:Spend classification text": "case when order_key % 7 = 0 then null else 'NPR' end",
    "case:Source": "'orders'",
    "case:Name": "concat('name ', cast(order_key % 1899 as string))",
    "case:GR-Based Inv. Verif.": "order_key % 2 = 0",
    "case:Item": "concat('0000', cast(order_key % 49 as string))",
    "case:concept:name": "concat(' ', cast(order_key as string))",
    "case:Goods Receipt": "order_key % 3 <> 0",
}


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` and ``lineitem`` as one list of happenings."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(*_ORDER_EVENTS)
        .unionByName(table(spark, sf_dir, "lineitem").selectExpr(*_SHIP_EVENTS))
    )


def order_source_log(happenings: DataFrame, *kept: str) -> DataFrame:
    """Happenings of the order log under the attribute names of an event-log file."""
    return happenings.selectExpr(
        *[f"{sql} as `{name}`" for name, sql in _SOURCE_ATTRIBUTES.items()], *kept
    )
