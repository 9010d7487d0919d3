from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_up(value: Column) -> Column:
    """Round a double to the nearest bigint, halves upwards."""
    return F.floor(value + F.lit(0.5)).cast("bigint")


def percent(part: Column, total: Column) -> Column:
    """Share in percent with one decimal; NULL when there is nothing to share."""
    return half_up(F.try_divide(F.lit(1000.0) * part, total.cast("double"))) / F.lit(10.0)


def proportional_quota(group_size: Column, total: Column, sample_size: int) -> Column:
    """A group's share of the sample, rounded, never above the group itself."""
    share = group_size.cast("double") / total.cast("double") * F.lit(float(sample_size))
    return F.least(half_up(share), group_size)
