"""Column expressions shared by the operators; all native, none is a UDF."""

from footfall.functions.hashing import below_ceiling, hash_bits, hash_ceiling, sample_hash
from footfall.functions.kinds import (
    category_ids,
    category_kind,
    is_click,
    is_order,
    is_pay,
    product_kind,
    product_value,
)
from footfall.functions.numbers import half_up, percent, proportional_quota
from footfall.functions.text import split_ids
from footfall.functions.times import (
    action_moment,
    day_hour,
    epoch_seconds,
    is_unreadable,
    moment_text,
    readable_moment,
    seconds_between,
    unreadable_error,
)

__all__ = [
    "action_moment",
    "below_ceiling",
    "category_ids",
    "category_kind",
    "day_hour",
    "epoch_seconds",
    "half_up",
    "hash_bits",
    "hash_ceiling",
    "is_click",
    "is_order",
    "is_pay",
    "is_unreadable",
    "moment_text",
    "percent",
    "product_kind",
    "product_value",
    "proportional_quota",
    "readable_moment",
    "sample_hash",
    "seconds_between",
    "split_ids",
    "unreadable_error",
]
