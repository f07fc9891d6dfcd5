"""Unique counts and skew-safe counts per window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.operators.history import running_count, running_sum, scan
from streamlab.operators.windows import window_of


def _windowed(df: DataFrame, ts: str, size: timedelta) -> DataFrame:
    return df.select("*", window_of(ts, size)).select("*", F.col("window.end").alias("window_end")).drop("window")


def unique_exact(df: DataFrame, user: str, ts: str, size: timedelta) -> DataFrame:
    """Exact unique users per window. Planned as group by (window, user) and then by window, both with partial sums."""
    return _windowed(df, ts, size).groupBy("window_end").agg(F.count_distinct(user).alias("uv"))


def unique_two_phase(df: DataFrame, user: str, ts: str, size: timedelta) -> DataFrame:
    """The same in two explicit steps, each usable on its own as a streaming aggregate."""
    per_user = _windowed(df, ts, size).groupBy(user, "window_end").agg(F.count("*").alias("_n"))
    return per_user.groupBy("window_end").agg(F.count("*").alias("uv"))


def unique_bitmap(df: DataFrame, user: str, ts: str, size: timedelta) -> DataFrame:
    """Exact unique count of integer ids with bitmaps: one bit per id, kept in buckets of fixed width."""
    bits = (
        _windowed(df, ts, size)
        .groupBy("window_end", F.bitmap_bucket_number(user).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("_bits"))
    )
    return bits.groupBy("window_end").agg(F.sum(F.bitmap_count("_bits")).alias("uv"))


def unique_approx(df: DataFrame, user: str, ts: str, size: timedelta, rsd: float = 0.02) -> DataFrame:
    """HyperLogLog estimate with relative standard deviation ``rsd``; the state does not grow with the users."""
    return _windowed(df, ts, size).groupBy("window_end").agg(F.approx_count_distinct(user, rsd).alias("uv"))


def unique_running(
    df: DataFrame, user: str, order: Sequence[str], size: timedelta, hot_rows: int | None = None
) -> DataFrame:
    """After every row, the number of users seen so far in its window."""
    windowed = _windowed(df, order[0], size)
    seen = scan(windowed, ["window_end", user], order, {"_seen": running_count()}, hot_rows)
    first = F.when(F.col("_seen") == 1, 1).otherwise(0).cast("long")
    return scan(seen, ["window_end"], order, {"uv": running_sum(first)}, hot_rows).drop("_seen")


def salted_count(df: DataFrame, ts: str, size: timedelta, spread_by: str, salts: int = 8, name: str = "pv") -> DataFrame:
    """Count per window in two steps over a salt. The salt is a hash, so a retried task gives the same rows.

    Batch aggregation already combines before the shuffle; the explicit form is for streaming state, where all rows of
    one window would otherwise update one state row in one task.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).alias("_salt")
    partial = _windowed(df, ts, size).groupBy(salt, "window_end").agg(F.count("*").alias("_n"))
    return partial.groupBy("window_end").agg(F.sum("_n").alias(name))
