"""Late rows by the replay rule: the watermark a row meets is the largest time of earlier arrivals minus a bound."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.operators import durations as d
from streamlab.operators.history import Scan, running_count, running_max, scan
from streamlab.operators.windows import count_levels, window_of

_ALL = "_all"
_TICK = timedelta(milliseconds=1)


def with_watermark_column(
    df: DataFrame, arrival: Sequence[str], ts: str, bound: timedelta, hot_rows: int | None = None
) -> DataFrame:
    """Add ``watermark`` as each row met it (NULL on the first row). Arrival order is sliced, so this stays parallel."""
    one = df.withColumn(_ALL, F.lit(0))
    ahead = scan(one, [_ALL], arrival, {"_top": Scan("max", F.col(ts), inclusive=False)}, hot_rows)
    return ahead.withColumn("watermark", F.col("_top") - F.lit(bound)).drop("_top", _ALL)


def clamped_time(df: DataFrame, arrival: Sequence[str], ts: str, hot_rows: int | None = None) -> DataFrame:
    """Add ``clamped_ts``: late times are raised to the largest time seen so far."""
    one = df.withColumn(_ALL, F.lit(0))
    return scan(one, [_ALL], arrival, {"clamped_ts": running_max(F.col(ts))}, hot_rows).drop(_ALL)


def _last_window_end(ts: str, size: timedelta, slide: timedelta | None) -> Column:
    """End of the last of the windows that hold the row."""
    step = slide or size
    return window_of(ts, step)["start"] + F.lit(size)


def late_split(
    df: DataFrame,
    arrival: Sequence[str],
    ts: str,
    size: timedelta,
    bound: timedelta,
    slide: timedelta | None = None,
    lateness: timedelta = timedelta(0),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``is_late``: all windows of the row were closed for good when it arrived."""
    seen = with_watermark_column(df, arrival, ts, bound, hot_rows)
    closed_at = _last_window_end(ts, size, slide) - F.lit(_TICK) + F.lit(lateness)
    return seen.withColumn("is_late", F.coalesce(closed_at <= F.col("watermark"), F.lit(False)))


def window_firings(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    ts: str,
    size: timedelta,
    bound: timedelta,
    lateness: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Counts a tumbling window emits: once when the watermark passes it, then again for each row within lateness.

    Columns: keys, ``window_end``, ``firing`` (0 = on time) and ``cnt`` as known at that firing.
    """
    kept = late_split(df, arrival, ts, size, bound, lateness=lateness, hot_rows=hot_rows).where(~F.col("is_late"))
    kept = kept.withColumn("window_end", _last_window_end(ts, size, None))
    refires = F.coalesce(F.col("window_end") - F.lit(_TICK) <= F.col("watermark"), F.lit(False))
    per_window = [*keys, "window_end"]
    counted = scan(
        kept.withColumn("_re", refires), per_window, arrival,
        {"_n": running_count(), "_fires": Scan("sum", F.col("_re").cast("long"))}, hot_rows,
    )
    return (
        counted.groupBy(*per_window, F.col("_fires").alias("firing"))
        .agg(F.max("_n").alias("cnt"))
    )


def hop_kept(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    ts: str,
    size: timedelta,
    slide: timedelta,
    bound: timedelta,
    lateness: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Final sliding counts when each window takes rows until the watermark passes it by ``lateness``.

    A late row still counts in those of its windows that are open, which are the last ones: it enters the count at the
    first open window end instead of the first end (see ``windows.hop_count``; ``slide`` must divide ``size``).
    """
    if d.micros(size) % d.micros(slide):
        raise ValueError("slide must divide size")
    seen = with_watermark_column(df, arrival, ts, bound, hot_rows)
    closed_until = F.col("watermark") - F.lit(lateness) + F.lit(_TICK)
    spans = (
        seen.select(*keys, ts, F.greatest(F.col(ts), closed_until).alias("_open"))
        .withColumn("_fall", window_of(ts, slide)["end"] + F.lit(size))
        .withColumn("_rise", window_of("_open", slide)["end"])
        .where(F.col("_rise") < F.col("_fall"))
    )
    return count_levels(spans, keys, slide, "cnt")
