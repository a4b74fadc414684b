"""Time arithmetic that does not depend on the session time zone.

Event times are TIMESTAMP_NTZ values holding UTC. Differences of such values are true elapsed time;
differences of zoned timestamps follow the wall clock of the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# A sign or letter behind the time of day: the text names its own zone.
_ZONED = r"\d:\d[\d:.]*\s*[A-Za-z+-]"


def utc_clock(instant: Column) -> Column:
    """Zoned timestamp -> TIMESTAMP_NTZ in UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def parse_utc(column: Column, data_type: T.DataType) -> Column:
    """Event time in UTC from text, date or timestamp; NULL where it cannot be read.

    Text without a zone is taken as UTC. Text without a full date is NULL: the reading as a plain
    timestamp asks for one, where the zoned reading would add the current date.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return column
    if isinstance(data_type, T.TimestampType):
        return utc_clock(column)
    if isinstance(data_type, T.DateType):
        return column.cast("timestamp_ntz")
    plain = column.try_cast("timestamp_ntz")
    zoned = column.rlike(_ZONED) & plain.isNotNull()
    return F.when(zoned, utc_clock(column.try_cast("timestamp"))).otherwise(plain)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Whole elapsed seconds, truncated toward zero."""
    return (later - earlier).cast("interval second").cast("bigint")


def whole_units(seconds: Column, seconds_per_unit: int) -> Column:
    """Whole units in a second count, truncated toward zero."""
    return (seconds / F.lit(seconds_per_unit)).cast("bigint")


def elapsed_hours(later: Column, earlier: Column) -> Column:
    """Elapsed hours as a fraction, with two decimals."""
    seconds = (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")
    return F.round(seconds / F.lit(3600), 2)
