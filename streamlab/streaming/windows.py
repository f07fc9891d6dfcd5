"""Windows, distinct and joins on streams, all on built-in stateful operators.

The input needs a watermark on the time column. Append mode gives each window once it is closed; update mode gives the
current result at every change, for a keyed sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.operators import durations as d
from streamlab.operators.topn import top_n
from streamlab.operators.windows import Agg, _bounds, window_of


def tumble(stream: DataFrame, keys: Sequence[str], ts: str, size: timedelta, aggs: dict[str, Agg],
           offset: timedelta | None = None) -> DataFrame:
    grouped = stream.groupBy(*keys, window_of(ts, size, offset=offset))
    return _bounds(grouped.agg(*[a.over().alias(n) for n, a in aggs.items()]))


def hop(stream: DataFrame, keys: Sequence[str], ts: str, size: timedelta, slide: timedelta, aggs: dict[str, Agg]
        ) -> DataFrame:
    """Sliding windows in two chained aggregations: panes first, then the windows of each closed pane (append mode)."""
    if d.micros(size) % d.micros(slide):
        return hop_rows(stream, keys, ts, size, slide, aggs)
    partials = [column for n, a in aggs.items() for column in a.partial(n)]
    panes = stream.groupBy(*keys, window_of(ts, slide)).agg(*partials)
    merged = panes.groupBy(*keys, F.window("window", d.text(size), d.text(slide)).alias("window"))
    return _bounds(merged.agg(*[a.merge(n) for n, a in aggs.items()]))


def hop_rows(stream: DataFrame, keys: Sequence[str], ts: str, size: timedelta, slide: timedelta, aggs: dict[str, Agg]
             ) -> DataFrame:
    """Sliding windows in one aggregation over row copies; needed for update mode, which allows no second aggregation."""
    grouped = stream.groupBy(*keys, window_of(ts, size, slide))
    return _bounds(grouped.agg(*[a.over().alias(n) for n, a in aggs.items()]))


def session(stream: DataFrame, keys: Sequence[str], ts: str, gap: timedelta, aggs: dict[str, Agg]) -> DataFrame:
    grouped = stream.groupBy(*keys, F.session_window(ts, d.text(gap)).alias("window"))
    return _bounds(grouped.agg(*[a.over().alias(n) for n, a in aggs.items()]))


def salted_count(stream: DataFrame, ts: str, size: timedelta, spread_by: str, salts: int = 8) -> DataFrame:
    """Count per window over a salt, then the sum of the salts: no state row takes all updates of a window."""
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).alias("_salt")
    partial = stream.groupBy(salt, window_of(ts, size)).agg(F.count("*").alias("_n"))
    return _bounds(partial.groupBy(F.window("window", d.text(size)).alias("window")).agg(F.sum("_n").alias("pv")))


def unique_users(stream: DataFrame, user: str, ts: str, size: timedelta) -> DataFrame:
    """Exact unique users per window: one state row per (user, window), then a count per window."""
    per_user = stream.groupBy(user, window_of(ts, size)).agg(F.count("*").alias("_n"))
    return _bounds(per_user.groupBy(F.window("window", d.text(size)).alias("window")).agg(F.count("*").alias("uv")))


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: timedelta, upper: timedelta, how: str = "inner",
) -> DataFrame:
    """Stream-stream join on keys and ``right_ts`` in [left_ts + lower, left_ts + upper].

    Both sides need a watermark, by which Spark drops state that can no longer match. ``full_outer`` gives the rows
    without a partner once that is certain.
    """
    a, b = left.alias("l"), right.alias("r")
    on = F.col(f"r.{right_ts}").between(
        F.col(f"l.{left_ts}") + F.lit(lower), F.col(f"l.{left_ts}") + F.lit(upper)
    )
    for k in keys:
        on = (F.col(f"l.{k}") == F.col(f"r.{k}")) & on
    columns = [F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys]
    columns += [F.col(f"l.{c}").alias(f"l_{c}") for c in left.columns if c not in keys]
    columns += [F.col(f"r.{c}").alias(f"r_{c}") for c in right.columns if c not in keys]
    return a.join(b, on, how).select(*columns)


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
    lower: timedelta, upper: timedelta, names: tuple[str, str, str] = ("matched", "left_only", "right_only"),
) -> DataFrame:
    """Pairs and timed-out rows of either side with a ``status``."""
    joined = interval_join(left, right, keys, left_ts, right_ts, lower, upper, "full_outer")
    status = F.when(F.col(f"r_{right_ts}").isNull(), names[1]).when(F.col(f"l_{left_ts}").isNull(), names[2])
    return joined.withColumn("status", status.otherwise(names[0]))


def top_n_per_batch(
    group: Sequence[str], best_first: Sequence[Column], n: int, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that ranks closed windows. In append mode all rows of a window come in one batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(top_n(batch, group, best_first, n), batch_id)

    return run
