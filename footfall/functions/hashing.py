"""The seeded order samples are drawn in.

A key's md5 is uniform, the same on any cluster layout, and known wherever the
key is: "the n smallest hashes" is a uniform sample without replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The leading 15 hex digits are 60 bits, which fit a bigint.
_PREFIX_DIGITS = 15


def sample_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key, F.lit("")), F.lit(f":{seed}")))


def hash_bits(hashed: Column) -> Column:
    """Number of significant bits (1 to 60) of the hash's prefix.

    It grows with the hash and each value covers twice the range of the one
    before, so about log2(n) of its values occur among n keys.
    """
    prefix = F.conv(F.substring(hashed, 1, _PREFIX_DIGITS), 16, 10).cast("bigint")
    return F.length(F.bin(prefix))


def hash_ceiling(bits: Column) -> Column:
    """Prefix text of the largest hash with that many significant bits."""
    largest = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - F.lit(1)
    return F.lpad(F.lower(F.hex(largest)), _PREFIX_DIGITS, "0")


def below_ceiling(hashed: Column, ceiling: Column) -> Column:
    return F.substring(hashed, 1, _PREFIX_DIGITS) <= ceiling
