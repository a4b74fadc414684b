"""Ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """Rounded share in percent, 0.0 when ``whole`` is zero."""
    share = F.round(ratio(part, whole) * F.lit(100.0), digits)
    return F.when(whole == 0, F.lit(0.0)).otherwise(share)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true (NULL counts as not true)."""
    return F.count_if(condition)
