"""Filters for "is this one of the wanted ids?" that can be asked of every scanned row.

Ids set bits in an array of 64-bit words. If the ids lie close enough together, each has
a bit of its own and the filter is exact. Otherwise the array's length follows their
number: each id picks one word by its hash and four bits in it, so a row whose word lacks
one of its bits belongs to no wanted id, and of the others about one in a hundred passes;
an exact join has to follow. Either way no wanted row is ever lost. The array is built by
Spark aggregates and read as a scalar subquery, which leaves rows in generated code:
no shuffle, no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_ID = 16
#: Beyond this size a filter travels to every task at too high a price, so none is built.
MOST_BYTES = 64 << 20
_PAGE = 1 << 10  # words that are put in order together
# Which bits of the hash choose the four bits; the lower ones choose the word.
_BIT_CHOICES = (40, 46, 52, 58)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _words(own: DataFrame, length: int) -> DataFrame:
    """One row ``words, bits_set`` from rows ``word, bits``.

    Equal words combine in the map tasks, words are put in order page by page, and only
    the finished pages meet in one task.
    """
    empty = own.sparkSession.range(length).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    words = own.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    pages = words.groupBy(F.floor(F.col("word") / _PAGE).alias("page")).agg(
        F.transform(in_order, lambda w: w["bits"]).alias("bits"),
        F.sum(F.bit_count("bits")).alias("bits_set"),
    )
    all_pages = F.sort_array(F.collect_list(F.struct("page", "bits")))
    return pages.agg(
        F.flatten(F.transform(all_pages, lambda p: p["bits"])).alias("words"),
        F.sum("bits_set").alias("bits_set"),
    )


# A bit for each id


def exact_length(least: int, most: int, most_bytes: int = MOST_BYTES) -> int | None:
    """Words for all numbers between the two; None if that would take over ``most_bytes``."""
    words = (most - least) // 64 + 1
    return words if words * 8 <= most_bytes else None


def exact_filter(ids: DataFrame, column: str, least: int, length: int) -> DataFrame:
    """One row ``words, bits_set``: the ids in ``column``, and how many different ones there are."""
    place = F.col(column) - F.lit(least)
    own = ids.where(F.col(column).isNotNull()).select(
        F.shiftright(place, 6).alias("word"), _bit(place.bitwiseAND(F.lit(63))).alias("bits")
    )
    return _words(own, length)


def is_in(words: Column, value: Column, least: int, most: int) -> Column:
    """Whether ``value`` is one of the ids of an exact filter; false for null."""
    place = value - F.lit(least)
    word = F.get(words, F.shiftright(place, 6).cast("int"))
    hit = word.bitwiseAND(_bit(place.bitwiseAND(F.lit(63)))) != 0
    # What is out of range is never subtracted from or cast.
    return F.when(value.between(F.lit(least), F.lit(most)), hit).otherwise(F.lit(False))


# Four bits for each id's hash


def filter_length(ids: int, bits_per_id: int = BITS_PER_ID, most_bytes: int = MOST_BYTES) -> int | None:
    """Words for so many ids, a power of two; None if that would take over ``most_bytes``."""
    words = 1 << max(0, -(-ids * bits_per_id // 64) - 1).bit_length()
    return words if words * 8 <= most_bytes else None


def _hash_bits(hashed: Column) -> Column:
    bits = F.lit(0).cast("bigint")
    for shift in _BIT_CHOICES:
        place = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63))
        bits = bits.bitwiseOR(_bit(place))
    return bits


def _hash_word(hashed: Column, length: Column) -> Column:
    return hashed.bitwiseAND(length.cast("bigint") - 1)


def id_filter(ids: DataFrame, column: str, length: int) -> DataFrame:
    """One row ``words, bits_set`` over the ids in ``column``; nulls take no part."""
    hashed = F.xxhash64(column)
    own = ids.where(F.col(column).isNotNull()).select(
        _hash_word(hashed, F.lit(length)).alias("word"), _hash_bits(hashed).alias("bits")
    )
    return _words(own, length)


def may_be_in(words: Column, value: Column) -> Column:
    """True for every value that ``id_filter`` was built over, false for nearly all others."""
    hashed = F.xxhash64(value)
    bits = _hash_bits(hashed)
    own = F.get(words, _hash_word(hashed, F.size(words)).cast("int"))
    return own.bitwiseAND(bits) == bits
