"""End-to-end jobs over a DataFrame of events (user_id, event_id, ts, event_type, value), for batch and for streams.

Batch jobs return the result. Streaming jobs take a stream with a watermark, write closed windows to parquet files at
``path`` and run until the input available now is used up; a scheduled or continuous trigger works the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.operators import alerts, distinct, durations, late, rolling, windows
from streamlab.operators.topn import top_n
from streamlab.operators.windows import Agg
from streamlab.sinks.files import Write, fan_out
from streamlab.sinks.keyed import KeyedTable
from streamlab.streaming import alerts as stream_alerts
from streamlab.streaming import windows as streaming
from streamlab.streaming.run import run_to_end

HOUR, FIVE_MINUTES = timedelta(hours=1), timedelta(minutes=5)
TOP = 5


def _views(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'view'")


def _best_first() -> list:
    return [F.desc("cnt"), F.asc("item_id")]


def hot_items(events: DataFrame) -> DataFrame:
    items = _views(events).select(F.col("user_id").alias("item_id"), "ts")
    counts = windows.hop_count(items, ["item_id"], "ts", HOUR, FIVE_MINUTES)
    return top_n(counts, ["window_end"], _best_first(), TOP).select("window_end", "rank", "item_id", "cnt")


def hot_items_stream(events: DataFrame, path: str, checkpoint: str) -> None:
    """All windows that end together close in one micro-batch, so ranking each batch is exact."""
    # naming the time column keeps this filter above the watermark, which all rows should move
    items = events.where(F.when(F.col("ts").isNotNull(), F.col("event_type") == "view"))
    items = items.select(F.col("user_id").alias("item_id"), "ts")
    counts = streaming.hop(items, ["item_id"], "ts", HOUR, FIVE_MINUTES, {"cnt": Agg("count")})

    def write(ranked: DataFrame, batch_id: int) -> None:
        ranked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run_to_end(counts, checkpoint, each_batch=streaming.top_n_per_batch(["window_end"], _best_first(), TOP, write))


def page_views(events: DataFrame) -> DataFrame:
    return windows.tumble(events, [], "ts", HOUR, {"pv": Agg("count")}).select("window_end", "pv")


def page_views_stream(events: DataFrame, path: str, checkpoint: str) -> None:
    run_to_end(streaming.salted_count(events, "ts", HOUR, "event_id"), checkpoint, path)


def unique_visitors(events: DataFrame) -> DataFrame:
    return distinct.unique_exact(events, "user_id", "ts", HOUR)


def unique_visitors_stream(events: DataFrame, path: str, checkpoint: str) -> None:
    run_to_end(streaming.unique_users(events, "user_id", "ts", HOUR), checkpoint, path)


def channel_report(events: DataFrame) -> DataFrame:
    keys = ["event_type", "user_id"]
    return windows.hop_count(events, keys, "ts", HOUR, FIVE_MINUTES).select(*keys, "window_end", "cnt")


def channel_report_stream(events: DataFrame, path: str, checkpoint: str) -> None:
    counted = streaming.hop(events, ["event_type", "user_id"], "ts", HOUR, FIVE_MINUTES, {"cnt": Agg("count")})
    run_to_end(counted, checkpoint, path)


def hot_urls(hits: DataFrame, bound: timedelta, lateness: timedelta, n: int = TOP) -> DataFrame:
    """Most requested URLs per window from hits (url, ts, seq, event_id) in order of arrival, late hits included."""
    counts = late.hop_kept(hits, ["url"], ["seq", "event_id"], "ts", HOUR, FIVE_MINUTES, bound, lateness)
    return top_n(counts, ["window_end"], [F.desc("cnt"), F.asc("url")], n)


def hot_urls_stream(hits: DataFrame, bound: timedelta, lateness: timedelta, table: KeyedTable, checkpoint: str) -> None:
    """Keep the latest count of each (window, URL); a late hit replaces it. Rank with ``hot_urls_now``."""
    waiting = hits.withWatermark("ts", durations.text(bound + lateness))
    counts = streaming.hop_rows(waiting, ["url"], "ts", HOUR, FIVE_MINUTES, {"cnt": Agg("count")})
    run_to_end(counts, checkpoint, mode="update", each_batch=table.upsert)


def hot_urls_now(spark: SparkSession, table: KeyedTable, n: int = TOP) -> DataFrame:
    return top_n(table.latest(spark), ["window_end"], [F.desc("cnt"), F.asc("url")], n)


def count_and_alarm(readings: DataFrame, keys: list[str], order: list[str], value: str, length: timedelta
                    ) -> dict[str, DataFrame]:
    """Running count of every reading (main output) and the no-decrease alarm (side output)."""
    return {
        "count": rolling.rolling_count(readings, keys, order, "cnt"),
        "alarm": alerts.no_decrease_alarm(readings, keys, order, value, length),
    }


def count_and_alarm_stream(readings: DataFrame, keys: list[str], order: list[str], value: str, length: timedelta,
                           writes: dict[str, Write], checkpoint: str) -> None:
    """Both outputs from one pass over the stream, each to its own sink."""
    machine = stream_alerts.CountAndNoDecrease(value, length)
    both = stream_alerts.run_machine(readings, keys, order[0], machine, [value], order[1:])
    run_to_end(stream_alerts.with_times(both), checkpoint, each_batch=fan_out(writes))


BATCH: dict[str, Callable[[DataFrame], DataFrame]] = {
    "hot_items": hot_items,
    "page_views": page_views,
    "unique_visitors": unique_visitors,
    "channel_report": channel_report,
}
STREAM: dict[str, Callable[[DataFrame, str, str], None]] = {
    "hot_items": hot_items_stream,
    "page_views": page_views_stream,
    "unique_visitors": unique_visitors_stream,
    "channel_report": channel_report_stream,
}
