"""Reproducible random samples of sessions, overall and by start hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions import (
    below_ceiling,
    hash_bits,
    hash_ceiling,
    proportional_quota,
    sample_hash,
)
from footfall.operators.sessions import session_info, session_rollup

SAMPLE_SIZE = 1000
SEED = 42
ROUNDED, EXACT = "rounded", "exact"


def uniform_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly n rows (or all there are), without replacement."""
    return df.orderBy(sample_hash(F.col(key), seed), key).limit(n)


def hour_hash_histogram(sessions: DataFrame, seed: int = SEED) -> DataFrame:
    """Sessions by start hour and hash magnitude: ``day_hour, bits, sessions``.

    At most 60 rows per hour, and it combines map-side.
    """
    bits = hash_bits(sample_hash(F.col("session_id"), seed))
    return (
        sessions.select("day_hour", bits.alias("bits"))
        .groupBy("day_hour", "bits")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


def hour_quota(
    histogram: DataFrame, sample_size: int = SAMPLE_SIZE, allocation: str = ROUNDED
) -> DataFrame:
    """``day_hour, session_count, quota, cutoff_bits``, one row per hour.

    By default the quota is the hour's proportional share, rounded by itself, so
    the quotas need not add up to the sample size: an hour below one
    ``2 * sample_size``-th of all sessions gets none, and with enough such hours
    the sample is empty. ``allocation="exact"`` rounds down and gives what is left
    to the hours with the largest remainders (ties to the earlier hour), so that
    quotas add up to the sample size, or to all sessions if those are fewer.
    ``cutoff_bits`` is the smallest hash magnitude that holds the hour's first
    ``quota`` sessions.
    """
    if allocation not in (ROUNDED, EXACT):
        raise ValueError(f"allocation is {ROUNDED} or {EXACT}, not {allocation}")
    total = histogram.agg(F.sum("sessions")).scalar()
    hour = Window.partitionBy("day_hour")
    so_far = hour.orderBy("bits").rowsBetween(Window.unboundedPreceding, 0)
    steps = histogram.select(
        "day_hour",
        "bits",
        F.sum("sessions").over(so_far).alias("so_far"),
        F.sum("sessions").over(hour).alias("session_count"),
    )
    if allocation == ROUNDED:
        quota = proportional_quota(F.col("session_count"), total, sample_size)
        steps = steps.withColumn("quota", quota)
    else:
        steps = steps.join(_exact_quotas(histogram, total, sample_size), "day_hour")
    reached = (F.col("quota") > 0) & (F.col("so_far") >= F.col("quota"))
    return steps.groupBy("day_hour", "session_count", "quota").agg(
        F.min(F.when(reached, F.col("bits"))).alias("cutoff_bits")
    )


def _exact_quotas(histogram: DataFrame, total: Column, sample_size: int) -> DataFrame:
    """``day_hour, quota`` by largest remainder, in whole numbers only."""
    hours = histogram.groupBy("day_hour").agg(F.sum("sessions").alias("n"))
    size = F.least(F.lit(sample_size).cast("bigint"), total)
    share = F.col("n").cast("decimal(38,0)") * size
    floors = hours.select(
        "day_hour",
        F.expr("1").alias("one"),
        F.floor(share / total).cast("bigint").alias("low"),
        (share % total).alias("remainder"),
    )
    # One row an hour, so one task can order them.
    order = Window.partitionBy("one").orderBy(F.desc("remainder"), "day_hour")
    left = size - F.sum("low").over(Window.partitionBy("one"))
    extra = (F.row_number().over(order) <= left).cast("bigint")
    return floors.select("day_hour", (F.col("low") + extra).alias("quota"))


def stratified_sessions(
    actions: DataFrame,
    sessions: DataFrame | None = None,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
    allocation: str = ROUNDED,
) -> DataFrame:
    """``session_info`` rows of a sample stratified by start hour.

    First the histogram of all sessions fixes how far up the hash order any
    hour has to go; that bound then filters the actions themselves, before the
    lists are built. What passes is a superset of the sample, whole sessions
    only, of a size set by the sample and not by the data, and each hour's
    smallest hashes are ranked within it. No hour is ever sorted in full
    unless all of it is wanted.

    ``sessions`` may pass in a roll-up of the same actions that already exists.
    """
    if sessions is None:
        sessions = session_rollup(actions)
    quotas = hour_quota(hour_hash_histogram(sessions, seed), sample_size, allocation)
    ceiling = quotas.agg(hash_ceiling(F.max("cutoff_bits"))).scalar()
    hashed = sample_hash(F.col("session_id"), seed)
    candidates = session_info(actions.where(below_ceiling(hashed, ceiling)))
    in_hash_order = Window.partitionBy("day_hour").orderBy(hashed, "session_id")
    return (
        candidates.join(quotas.select("day_hour", "quota"), "day_hour")
        .withColumn("rank", F.row_number().over(in_hash_order))
        .where(F.col("rank") <= F.col("quota"))
        .drop("rank", "quota")
    )
