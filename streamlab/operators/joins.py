"""Interval join, two-sided reconciliation and lateral join."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.operators import durations as d

_BUCKET = "_bucket"


def _bucket_of(ts: Column, width: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(width))


def _bucketed(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: timedelta, upper: timedelta,
) -> tuple[DataFrame, DataFrame, Column]:
    """Left rows with their time bucket, right rows in every bucket they may meet (two or three), and the condition.

    The range condition becomes an equi-join on (key, bucket): a busy key is spread over its time range instead of
    meeting itself in one task.
    """
    width = max(d.micros(upper) - d.micros(lower), 1)
    a = left.withColumn(_BUCKET, _bucket_of(F.col(left_ts), width)).alias("l")
    first = _bucket_of(F.col(right_ts) - F.lit(upper), width)
    last = _bucket_of(F.col(right_ts) - F.lit(lower), width)
    b = right.withColumn(_BUCKET, F.explode(F.sequence(first, last))).alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, _BUCKET]]
    lt, rt = F.col(f"l.{left_ts}"), F.col(f"r.{right_ts}")
    inside = rt.between(lt + F.lit(lower), lt + F.lit(upper))
    return a, b, reduce(lambda x, y: x & y, same) & inside


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys])


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: timedelta, upper: timedelta, how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and ``right_ts`` in [left_ts + lower, left_ts + upper], both ends included.

    ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti``; non-key columns are prefixed ``l_`` / ``r_``.
    """
    left, right = _renamed(left, keys, "l_"), _renamed(right, keys, "r_")
    a, b, on = _bucketed(left, right, keys, f"l_{left_ts}", f"r_{right_ts}", lower, upper)
    joined = a.join(b, on, how)
    columns = [F.col(f"l.{c}") for c in left.columns]
    if how in ("inner", "left"):
        columns += [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return joined.select(*columns)


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: timedelta, upper: timedelta, names: tuple[str, str, str] = ("matched", "left_only", "right_only"),
) -> DataFrame:
    """Matched pairs and the rows of either side without a partner in the interval, with a ``status`` column."""
    both = interval_join(left, right, keys, left_ts, right_ts, lower, upper, "left")
    both = both.withColumn("status", F.when(F.col(f"r_{right_ts}").isNull(), names[1]).otherwise(names[0]))
    lonely = interval_join(right, left, keys, right_ts, left_ts, -upper, -lower, "left_anti")
    lonely = lonely.select(
        *keys, *[F.col(f"l_{c}").alias(f"r_{c}") for c in right.columns if c not in keys],
        F.lit(names[2]).alias("status"),
    )
    return both.unionByName(lonely, allowMissingColumns=True)


def lateral_words(df: DataFrame, column: str, separator: str, keep: Sequence[str]) -> DataFrame:
    """Each row with every (word, length) of one of its columns, as a lateral join of a table function."""
    pairs = F.transform(
        F.split(column, separator), lambda w: F.struct(w.alias("word"), F.length(w).alias("word_length"))
    )
    return df.select(*keep, F.inline(pairs))
