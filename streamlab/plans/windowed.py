"""Windows, unique counts, late rows and top-N."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from streamlab.operators import distinct, late, windows
from streamlab.operators.topn import top_n
from streamlab.operators.windows import Agg
from streamlab.plans.registry import events, query, table
from streamlab.sources import parse

HOUR, MINUTE, DAY = timedelta(hours=1), timedelta(minutes=1), timedelta(days=1)
CNT = {"cnt": Agg("count")}


def _hops(keys: str, size_min: int, slide_min: int, source: str = "events") -> str:
    """Rows copied into their sliding windows, by plain arithmetic."""
    n = -(-size_min // slide_min)
    return f"""SELECT {keys}, time_bucket(INTERVAL '{slide_min} minutes', ts, TIMESTAMP '1970-01-01')
        - (k * INTERVAL '{slide_min} minutes') AS window_start,
        time_bucket(INTERVAL '{slide_min} minutes', ts, TIMESTAMP '1970-01-01')
        - (k * INTERVAL '{slide_min} minutes') + INTERVAL '{size_min} minutes' AS window_end, ts, value, event_id
        FROM {source}, generate_series(0, {n - 1}) s(k)
        WHERE time_bucket(INTERVAL '{slide_min} minutes', ts, TIMESTAMP '1970-01-01')
        - (k * INTERVAL '{slide_min} minutes') + INTERVAL '{size_min} minutes' > ts"""


@query("tumble_count", """
    SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           count(*) AS cnt
    FROM events GROUP BY ALL""")
def tumble_count(spark, d):
    return windows.tumble(events(spark, d), ["event_type"], "ts", HOUR, CNT)


@query("hop_count", f"""
    SELECT user_id, window_start, window_end, count(*) AS cnt, min(value) AS low, max(value) AS high
    FROM ({_hops('user_id', 60, 5)}) GROUP BY ALL""")
def hop_count(spark, d):
    aggs = {**CNT, "low": Agg("min", F.col("value")), "high": Agg("max", F.col("value"))}
    return windows.hop(events(spark, d), ["user_id"], "ts", HOUR, 5 * MINUTE, aggs)


@query("hop_uneven", f"""
    SELECT event_type, window_start, window_end, count(*) AS cnt
    FROM ({_hops('event_type', 100, 30)}) GROUP BY ALL""")
def hop_uneven(spark, d):
    return windows.hop(events(spark, d), ["event_type"], "ts", 100 * MINUTE, 30 * MINUTE, CNT)


@query("hop_all", f"SELECT window_start, window_end, count(*) AS cnt FROM ({_hops('1 AS one', 60, 10)}) GROUP BY ALL")
def hop_all(spark, d):
    return windows.hop(events(spark, d), [], "ts", HOUR, 10 * MINUTE, CNT)


@query("session_count", """
    WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM f)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOURS AS window_end, count(*) AS cnt,
           max(value) AS high
    FROM s GROUP BY user_id, n""")
def session_count(spark, d):
    e = events(spark, d).select("user_id", "ts", "event_id", "value")
    return windows.session(e, ["user_id"], ["ts", "event_id"], 6 * HOUR, {**CNT, "high": Agg("max", F.col("value"))})


@query("day_offset_count", """
    SELECT event_type, date_trunc('day', ts + INTERVAL 8 HOURS) - INTERVAL 8 HOURS AS window_start,
           date_trunc('day', ts + INTERVAL 8 HOURS) + INTERVAL 16 HOURS AS window_end, count(*) AS cnt
    FROM events GROUP BY ALL""")
def day_offset_count(spark, d):
    return windows.tumble(events(spark, d), ["event_type"], "ts", DAY, CNT, offset=16 * HOUR)


@query("count_window_tumbling", """
    SELECT user_id, (n - 1) // 10 AS window_no, min(value) AS low, max(ts) AS last_ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    GROUP BY 1, 2 HAVING count(*) = 10""")
def count_window_tumbling(spark, d):
    e = events(spark, d).select("user_id", "ts", "event_id", "value")
    aggs = {"low": Agg("min", F.col("value")), "last_ts": Agg("max", F.col("ts"))}
    return windows.count_tumble(e, ["user_id"], ["ts", "event_id"], 10, aggs)


@query("count_window_sliding", """
    SELECT user_id, n AS window_no, low, cnt FROM (
      SELECT user_id, row_number() OVER o AS n,
             min(value) OVER w AS low, count(*) OVER w AS cnt
      FROM events
      WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id),
             w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 9 PRECEDING))
    WHERE n % 3 = 0""")
def count_window_sliding(spark, d):
    e = events(spark, d).select("user_id", "ts", "event_id", "value")
    return windows.count_hop(e, ["user_id"], ["ts", "event_id"], 10, 3, {"low": Agg("min", F.col("value")), **CNT})


@query("window_min_bean", """
    SELECT user_id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           min(value) AS value, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id
    FROM events GROUP BY ALL""")
def window_min_bean(spark, d):
    order = F.struct("ts", "event_id")
    return windows.tumble(events(spark, d), ["user_id"], "ts", DAY, {
        "value": Agg("min", F.col("value")), "event_type": Agg("first", F.col("event_type"), order),
        "event_id": Agg("first", F.col("event_id"), order)})


@query("window_max_by", """
    SELECT user_id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           arg_max(event_id, (value, -event_id)) AS event_id, max(value) AS value
    FROM events GROUP BY ALL""")
def window_max_by(spark, d):
    best = F.struct(F.col("value"), -F.col("event_id"))
    return windows.tumble(events(spark, d), ["user_id"], "ts", DAY, {
        "event_id": Agg("last", F.col("event_id"), best), "value": Agg("max", F.col("value"))})


@query("window_full_fn", """
    SELECT user_id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           user_id || ':' || count(*) AS message, min(ts) AS first_ts, max(ts) AS last_ts,
           count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY user_id, 2, 3""")
def window_full_fn(spark, d):
    rows = windows.tumble(events(spark, d), ["user_id"], "ts", DAY, {
        **CNT, "first_ts": Agg("min", F.col("ts")), "last_ts": Agg("max", F.col("ts")),
        "errors": Agg("count", F.when(F.col("event_type") == "error", 1))})
    message = F.concat_ws(":", F.col("user_id").cast("string"), F.col("cnt").cast("string"))
    return rows.withColumn("message", message).drop("cnt")


@query("window_fold", """
    WITH n AS (SELECT event_type, user_id, date_trunc('day', ts) AS window_start,
                 row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS n FROM events)
    SELECT event_type, window_start, window_start + INTERVAL 1 DAY AS window_end, piece,
           CASE WHEN piece = 0 THEN 'Start:' ELSE '' END || text AS folded
    FROM (SELECT event_type, window_start, (n - 1) // 1000 AS piece, string_agg(' - ' || user_id, '' ORDER BY n) AS text
          FROM n GROUP BY 1, 2, 3)""")
def window_fold(spark, d):
    e = events(spark, d).select("event_type", "user_id", "ts", "event_id")
    return windows.fold_text(e, ["event_type"], ["ts", "event_id"], DAY, "user_id")


_HOUR_END = "date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end"


@query("pv_hourly", f"SELECT {_HOUR_END}, count(*) AS pv FROM events WHERE event_type = 'view' GROUP BY ALL")
def pv_hourly(spark, d):
    views = events(spark, d).where("event_type = 'view'")
    return windows.tumble(views, [], "ts", HOUR, {"pv": Agg("count")}).select("window_end", "pv")


@query("pv_salted", f"SELECT {_HOUR_END}, count(*) AS pv FROM events WHERE event_type = 'view' GROUP BY ALL")
def pv_salted(spark, d):
    return distinct.salted_count(events(spark, d).where("event_type = 'view'"), "ts", HOUR, "event_id")


_UV = f"SELECT {_HOUR_END}, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL"


@query("uv_exact", _UV)
def uv_exact(spark, d):
    return distinct.unique_exact(events(spark, d), "user_id", "ts", HOUR)


@query("uv_two_phase", _UV)
def uv_two_phase(spark, d):
    return distinct.unique_two_phase(events(spark, d), "user_id", "ts", HOUR)


@query("uv_bitmap", _UV)
def uv_bitmap(spark, d):
    return distinct.unique_bitmap(events(spark, d), "user_id", "ts", HOUR)


@query("uv_approx", """
    SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(DISTINCT user_id) AS uv, true AS within_error
    FROM events GROUP BY ALL""")
def uv_approx(spark, d):
    e = events(spark, d)
    exact = distinct.unique_exact(e, "user_id", "ts", DAY)
    approx = distinct.unique_approx(e, "user_id", "ts", DAY, 0.01).withColumnRenamed("uv", "estimate")
    close = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * 0.05)
    return exact.join(approx, "window_end").select("window_end", "uv", close.alias("within_error"))


@query("uv_running", """
    WITH s AS (SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM events),
    f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) = 1
                    THEN 1 ELSE 0 END AS first FROM s)
    SELECT event_id, window_end,
           sum(first) OVER (PARTITION BY window_end ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS uv
    FROM f""")
def uv_running(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts")
    return distinct.unique_running(e, "user_id", ["ts", "event_id"], HOUR).select("event_id", "window_end", "uv")


def hot_items(spark, d, n: int = 5):
    """Most viewed items of each 1 h window sliding by 5 min."""
    views = events(spark, d).where("event_type = 'view'").select(F.col("user_id").alias("item_id"), "ts")
    counts = windows.hop_count(views, ["item_id"], "ts", HOUR, 5 * MINUTE)
    return top_n(counts, ["window_end"], [F.desc("cnt"), F.asc("item_id")], n)


@query("hot_items_topn", f"""
    WITH c AS (SELECT user_id AS item_id, window_start, window_end, count(*) AS cnt FROM (
                 {_hops('user_id', 60, 5, "(SELECT * FROM events WHERE event_type = 'view')")}) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id)::INTEGER AS rank FROM c)
    SELECT * FROM r WHERE rank <= 5""")
def hot_items_topn(spark, d):
    return hot_items(spark, d)


@query("top2_per_key", """
    SELECT user_id, event_id, value, rank FROM (SELECT *, row_number() OVER (
      PARTITION BY user_id ORDER BY value DESC, event_id)::INTEGER AS rank FROM events) WHERE rank <= 2""")
def top2_per_key(spark, d):
    e = events(spark, d).select("user_id", "event_id", "value")
    return top_n(e, ["user_id"], [F.desc("value"), F.asc("event_id")], 2)


# Arrival order for late-row queries: event seconds plus a shift fixed by the event id, so that rows overtake others.
_SEQ = "CAST(epoch(date_trunc('second', ts)) AS BIGINT) + (event_id * 37) % 7200"
_ARRIVED = f"(SELECT *, {_SEQ} AS seq FROM events)"
_MET = f"""(SELECT *, max(ts) OVER (ORDER BY seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL 10 MINUTES AS watermark FROM {_ARRIVED})"""


def arrived(spark, d):
    e = events(spark, d)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.withColumn("seq", seconds + (F.col("event_id") * 37) % 7200)


@query("late_split_rows", f"""
    SELECT event_id, watermark, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND
           + INTERVAL 5 MINUTES <= watermark, false) AS is_late FROM {_MET}""")
def late_split_rows(spark, d):
    rows = arrived(spark, d).select("event_id", "ts", "seq")
    split = late.late_split(rows, ["seq", "event_id"], "ts", HOUR, 10 * MINUTE, lateness=5 * MINUTE)
    return split.select("event_id", "watermark", "is_late")


@query("clamped_time", f"""
    SELECT event_id, max(ts) OVER (ORDER BY seq, event_id ROWS UNBOUNDED PRECEDING) AS clamped_ts FROM {_ARRIVED}""")
def clamped_time(spark, d):
    rows = arrived(spark, d).select("event_id", "ts", "seq")
    return late.clamped_time(rows, ["seq", "event_id"], "ts").select("event_id", "clamped_ts")


@query("window_firings", f"""
    WITH k AS (SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM {_MET}),
    j AS (SELECT *, coalesce(window_end - INTERVAL 1 MILLISECOND <= watermark, false) AS re FROM k
          WHERE NOT coalesce(window_end - INTERVAL 1 MILLISECOND + INTERVAL 30 MINUTES <= watermark, false)),
    n AS (SELECT event_type, window_end, sum(re::INTEGER) OVER w AS firing, count(*) OVER w AS n FROM j
          WINDOW w AS (PARTITION BY event_type, window_end ORDER BY seq, event_id ROWS UNBOUNDED PRECEDING))
    SELECT event_type, window_end, firing::BIGINT AS firing, max(n) AS cnt FROM n GROUP BY ALL""")
def window_firings(spark, d):
    rows = arrived(spark, d).select("event_id", "event_type", "ts", "seq")
    return late.window_firings(rows, ["event_type"], ["seq", "event_id"], "ts", HOUR, 10 * MINUTE, 30 * MINUTE)


@query("lateness_final", f"""
    SELECT event_type, window_end, count(*) AS cnt
    FROM (SELECT *, watermark, seq FROM {_MET} m JOIN (
            SELECT event_id AS eid, window_end FROM ({_hops('event_type', 60, 20)})) h ON m.event_id = h.eid)
    WHERE NOT coalesce(window_end - INTERVAL 1 MILLISECOND + INTERVAL 30 MINUTES <= watermark, false)
    GROUP BY ALL""")
def lateness_final(spark, d):
    rows = arrived(spark, d).select("event_id", "event_type", "ts", "seq")
    return late.hop_kept(rows, ["event_type"], ["seq", "event_id"], "ts", HOUR, 20 * MINUTE, 10 * MINUTE, 30 * MINUTE)


@query("hot_urls_topn_late", f"""
    WITH m AS (SELECT *, max(ts) OVER (ORDER BY seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL 60 SECONDS AS watermark
               FROM (SELECT event_id, url, ts, epoch(ts)::BIGINT + (event_id * 37) % 7200 AS seq
                     FROM (SELECT event_id, url, date_trunc('second', ts) AS ts
                           FROM events JOIN pages ON page_id = user_id))),
    c AS (SELECT url, window_end, count(*) AS cnt FROM (
            SELECT url, watermark, time_bucket(INTERVAL 5 MINUTES, ts, TIMESTAMP '1970-01-01') + k * INTERVAL 5 MINUTES
                   AS window_end FROM m, generate_series(1, 12) s(k))
          WHERE NOT coalesce(window_end - INTERVAL 1 MILLISECOND + INTERVAL 60 SECONDS <= watermark, false)
          GROUP BY ALL)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url)::INTEGER AS rank FROM c)
    WHERE rank <= 5""")
def hot_urls_topn_late(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    hits = events(spark, d).join(pages, F.col("user_id") == F.col("page_id")).select(
        "event_id", "url", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    hits = hits.withColumn("seq", F.unix_seconds(F.col("ts").cast("timestamp")) + (F.col("event_id") * 37) % 7200)
    counts = late.hop_kept(hits, ["url"], ["seq", "event_id"], "ts", HOUR, 5 * MINUTE, MINUTE, MINUTE)
    return top_n(counts, ["window_end"], [F.desc("cnt"), F.asc("url")], 5)
