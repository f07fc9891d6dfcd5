"""Queries that run as streams over the event table, and the same operators on a heavily skewed key."""

from __future__ import annotations

import uuid
from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.operators import alerts, patterns, rolling, windows
from streamlab.operators.history import previous, running_count, running_sum, scan
from streamlab.operators.windows import Agg
from streamlab.plans import jobs, keyed
from streamlab.plans.registry import events, query
from streamlab.session import DEFAULTS
from streamlab.sinks.documents import upsert_documents
from streamlab.sinks.files import append_files
from streamlab.sinks.keyed import KeyedTable
from streamlab.streaming import alerts as machines
from streamlab.streaming import late as stream_late
from streamlab.streaming import process as processing
from streamlab.streaming import running, topn
from streamlab.streaming import windows as streaming
from streamlab.streaming.event_time import run_machine
from streamlab.streaming.patterns import match_stream
from streamlab.streaming.run import run_to_end, work_folder

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark, d):
    schema = events(spark, d).schema
    # a pattern that fits one name: Spark takes a plain path for a folder, but the table may be a single file
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")


def _folder(spark, name):
    return work_folder(spark, f"{name}-{uuid.uuid4().hex}")


@query("stream_tumble_count", """
    SELECT event_type, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt FROM events GROUP BY ALL""")
def stream_tumble_count(spark, d):
    """Update mode into a keyed table: windows still open at the end are included."""
    folder = _folder(spark, "stream_tumble_count")
    table = KeyedTable(f"{folder}/table", ("event_type", "window_end"))
    counted = streaming.tumble(event_stream(spark, d), ["event_type"], "ts", HOUR, {"cnt": Agg("count")})
    run_to_end(counted, f"{folder}/checkpoint", mode="update", each_batch=table.upsert)
    return table.latest(spark).select("event_type", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")


@query("stream_interval_join", """
    SELECT l.user_id, l.event_id AS l_event_id, r.event_id AS r_event_id FROM events l JOIN events r
    ON l.user_id = r.user_id AND l.event_type = 'click' AND r.event_type = 'purchase'
       AND r.ts BETWEEN l.ts - INTERVAL 6 HOURS AND l.ts + INTERVAL 12 HOURS""")
def stream_interval_join(spark, d):
    folder = _folder(spark, "stream_interval_join")

    def side(kind):
        return event_stream(spark, d).where(F.col("event_type") == kind).select("user_id", "event_id", "ts")

    joined = streaming.interval_join(side("click"), side("purchase"), ["user_id"], "ts", "ts", -6 * HOUR, 12 * HOUR)
    run_to_end(joined, f"{folder}/checkpoint", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").select("user_id", "l_event_id", "r_event_id")


@query("stream_rolling_sum", """
    SELECT user_id, event_id, sum(event_id) OVER w ::BIGINT AS total, count(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def stream_rolling_sum(spark, d):
    spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    folder = _folder(spark, "stream_rolling_sum")
    state = T.StructType([T.StructField("total", T.LongType()), T.StructField("n", T.LongType())])
    folded = running.running_fold(
        event_stream(spark, d).select("user_id", "event_id"), ["user_id"], ["event_id"], ["event_id"], state,
        lambda s, row: (s[0] + row["event_id"], s[1] + 1) if s else (row["event_id"], 1))
    run_to_end(folded, f"{folder}/checkpoint", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


# What a stream has given when its input ends: all that depends on rows up to its last watermark.
_SEEN = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)"


def _written(spark, name, result):
    """Run a stream to its current end and read what it wrote."""
    spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    folder = _folder(spark, name)
    run_to_end(result, f"{folder}/checkpoint", f"{folder}/out")
    return spark.read.parquet(f"{folder}/out")


def _plain_times(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@query("stream_jump_alarm", f"""
    SELECT * FROM (SELECT user_id, ts AS at_ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                          AS previous_value FROM events)
    WHERE abs(value - previous_value) > 100 AND at_ts <= {_SEEN}""")
def stream_jump_alarm(spark, d):
    rows = event_stream(spark, d).select("user_id", "event_id", "ts", "value")
    jumps = run_machine(rows, ["user_id"], "ts", machines.Jump("value", 100.0), ["value"], ["event_id"])
    return _plain_times(_written(spark, "stream_jump_alarm", machines.with_times(jumps)))


@query("stream_fail_window", f"""
    WITH RECURSIVE e AS (SELECT user_id, ts, event_id, event_type IN ('error', 'click', 'view') AS fail FROM events),
    g AS (SELECT *, sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM e),
    stops AS (SELECT user_id, run, min(ts) AS stop FROM g WHERE NOT fail GROUP BY 1, 2),
    f AS (SELECT g.user_id, g.run, g.ts, s.stop FROM g
          LEFT JOIN stops s ON s.user_id = g.user_id AND s.run = g.run + 1 WHERE g.fail),
    a AS (SELECT user_id, run, min(ts) AS first_ts, any_value(stop) AS stop FROM f GROUP BY 1, 2
          UNION ALL
          SELECT a.user_id, a.run, min(f.ts), any_value(a.stop)
          FROM a JOIN f ON f.user_id = a.user_id AND f.run = a.run AND f.ts > a.first_ts + INTERVAL 24 HOURS
          GROUP BY a.user_id, a.run)
    SELECT a.user_id, a.first_ts, max(f.ts) AS last_ts, count(*) AS cnt
    FROM a JOIN f ON f.user_id = a.user_id AND f.run = a.run
         AND f.ts BETWEEN a.first_ts AND a.first_ts + INTERVAL 24 HOURS
    WHERE (a.stop IS NULL OR a.stop > a.first_ts + INTERVAL 24 HOURS) AND a.first_ts + INTERVAL 24 HOURS <= {_SEEN}
    GROUP BY 1, 2 HAVING count(*) >= 2""")
def stream_fail_window(spark, d):
    rows = event_stream(spark, d).withColumn("fail", F.col("event_type").isin("error", "click", "view"))
    windows_ = run_machine(rows.select("user_id", "event_id", "ts", "fail"), ["user_id"], "ts", machines.FailWindow("fail", DAY), ["fail"], ["event_id"])
    return _plain_times(_written(spark, "stream_fail_window", machines.with_times(windows_)))


@query("stream_order_timeout", f"""
    WITH c AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'signup'),
    p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase'),
    s AS (
        SELECT c.user_id, CASE WHEN min(p.ts) IS NULL THEN 'no_pay' ELSE 'paid' END AS status, c.ts AS create_ts, min(p.ts) AS pay_ts
        FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 2 DAYS
        GROUP BY c.user_id, c.event_id, c.ts
        UNION ALL
        SELECT p.user_id, 'pay_without_create', NULL, p.ts FROM p
        WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 2 DAYS))
    SELECT user_id, status, coalesce(create_ts, TIMESTAMP '1970-01-01') AS create_ts, coalesce(pay_ts, TIMESTAMP '1970-01-01') AS pay_ts
    FROM s WHERE coalesce(pay_ts, create_ts + INTERVAL 2 DAYS) <= {_SEEN}""")
def stream_order_timeout(spark, d):
    rows = event_stream(spark, d).select(
        "user_id", "event_id", "ts", (F.col("event_type") == "signup").alias("created"), (F.col("event_type") == "purchase").alias("paid"),
        F.when(F.col("event_type") == "signup", 0).otherwise(1).alias("kind"))
    machine = machines.OrderTimeout("created", "paid", 2 * DAY)
    orders = run_machine(rows, ["user_id"], "ts", machine, ["created", "paid"], ["kind", "event_id"])
    found = _plain_times(_written(spark, "stream_order_timeout", machines.with_times(orders)))
    none = F.lit("1970-01-01").cast("timestamp_ntz")
    return found.withColumns({c: F.coalesce(c, none) for c in ("create_ts", "pay_ts")})


_FIRST = """(SELECT s.user_id, s.event_id AS a_id, s.ts AS a_ts, arg_min(n.event_id, n.ts) AS b_id, min(n.ts) AS b_ts
             FROM events s LEFT JOIN events n ON n.user_id = s.user_id AND n.ts > s.ts AND n.event_type = '{b}'
             WHERE s.event_type = '{a}' GROUP BY ALL)"""


@query("stream_pattern_timeout", f"""
    WITH m AS (
        SELECT x.user_id, x.a_id, x.a_ts, CASE WHEN x.b_ts - x.a_ts < INTERVAL 3 DAYS THEN x.b_id ELSE -1 END AS b_id,
               CASE WHEN y.b_ts - x.a_ts < INTERVAL 3 DAYS THEN y.b_id ELSE -1 END AS c_id,
               CASE WHEN y.b_ts - x.a_ts < INTERVAL 3 DAYS THEN y.b_ts END AS c_ts
        FROM {_FIRST.format(a='view', b='click')} x LEFT JOIN {_FIRST.format(a='click', b='purchase')} y ON y.a_id = x.b_id)
    SELECT user_id, a_id, b_id, c_id, CASE WHEN c_ts IS NULL THEN 'timeout' ELSE 'matched' END AS status
    FROM m WHERE coalesce(c_ts, a_ts + INTERVAL 3 DAYS - INTERVAL 1 MICROSECOND) <= {_SEEN}""")
def stream_pattern_timeout(spark, d):
    pattern = (
        patterns.Pattern.begin("a", "event_type = 'view'").followed_by("b", "event_type = 'click'")
        .followed_by("c", "event_type = 'purchase'").within(3 * DAY)
    )
    found = _written(spark, "stream_pattern_timeout", match_stream(event_stream(spark, d), ["user_id"], "ts", pattern, "event_id"))
    return found.fillna(-1, ["a_id", "b_id", "c_id"])


@query("stream_pattern_times", f"""
    SELECT user_id, event_id AS a_1_id, e2 AS a_2_id, e3 AS a_3_id FROM (
      SELECT *, lead(event_id) OVER w AS e2, lead(event_id, 2) OVER w AS e3, lead(ts, 2) OVER w AS ts3
      FROM events WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE ts3 - ts < INTERVAL 3 DAYS AND ts3 <= {_SEEN}""")
def stream_pattern_times(spark, d):
    pattern = patterns.Pattern.begin("a", "event_type = 'error'").times(3).within(3 * DAY)
    found = _written(spark, "stream_pattern_times", match_stream(event_stream(spark, d), ["user_id"], "ts", pattern, "event_id"))
    return found.where("status = 'matched'").drop("status")


class _PartsAndDays(processing.ProcessFunction):
    """Purchases as 0 to 2 rows each, and a key's number of rows a day once the day is over."""

    outputs = {"part": "event_id long, n int", "day": "day_end_ms long, n int"}
    maps = {"days": ("day_end_ms long", "n int")}

    def on_row(self, ctx, row):
        if row["event_type"] == "purchase":
            for n in range(row["event_id"] % 3):
                ctx.emit("part", row["event_id"], n)
        day_end = (row["ms"] // 86_400_000 + 1) * 86_400_000
        held = ctx.maps["days"].get((day_end,))
        if held is None:
            ctx.set_timer(day_end)
        ctx.maps["days"].put((day_end,), ((held[0] if held else 0) + 1,))

    def on_timer(self, ctx, at_ms):
        ctx.emit("day", at_ms, ctx.maps["days"].get((at_ms,))[0])
        ctx.maps["days"].remove((at_ms,))


@query("process_function", f"""
    SELECT user_id, 'part' AS tag, event_id AS id, n::INTEGER AS n
    FROM (SELECT user_id, event_id, unnest(generate_series(0, event_id % 3 - 1)) AS n FROM events WHERE event_type = 'purchase')
    UNION ALL
    SELECT user_id, 'day', epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY), count(*)::INTEGER FROM events
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {_SEEN} GROUP BY ALL""")
def process_function(spark, d):
    rows = event_stream(spark, d).select("user_id", "event_id", "event_type", "ts", F.unix_millis("ts").alias("ms"))
    both = _written(spark, "process_function", processing.process(rows, ["user_id"], _PartsAndDays()))
    parts = processing.output_of(both, ["user_id"], "part").select("user_id", F.lit("part").alias("tag"), F.col("event_id").alias("id"), "n")
    days = processing.output_of(both, ["user_id"], "day").select("user_id", F.lit("day").alias("tag"), F.col("day_end_ms").alias("id"), "n")
    return parts.unionByName(days)


# Arrival order mixes neighbours; each of 8 shards of the users has a largest time of its own.
_ARRIVED = """(SELECT *, max(ts) OVER (PARTITION BY user_id % 8 ORDER BY seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 1 HOUR AS mark FROM (SELECT *, event_id + event_id * 37 % 200 AS seq FROM events))"""


def _arriving(spark, d):
    schema = events(spark, d).schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    return stream.withColumn("seq", F.col("event_id") + F.col("event_id") * 37 % 200)


def _split(spark, name, rows, closes, keep):
    """Tables of the kept and of the late rows of a stream."""
    folder = _folder(spark, name)
    split = stream_late.split_batches(F.col("user_id") % 8, ["seq", "event_id"], "ts", closes, HOUR, keep, folder)
    run_to_end(rows, f"{folder}/checkpoint", each_batch=split)
    return [spark.read.parquet(f"{folder}/{side}").drop("batch") for side in ("kept", "late")]


@query("stream_late_split", f"""
    SELECT user_id, event_id, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND <= mark, false) AS is_late
    FROM {_ARRIVED}""")
def stream_late_split(spark, d):
    kept, late = _split(spark, "stream_late_split", _arriving(spark, d), stream_late.window_closes("ts", HOUR), ["user_id", "event_id"])
    return kept.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))


@query("pattern_late_split", f"""
    WITH e AS (SELECT *, coalesce(ts <= mark, false) AS is_late FROM {_ARRIVED})
    SELECT 'late' AS kind, user_id, event_id AS a_id, -1 AS b_id FROM e WHERE is_late
    UNION ALL
    SELECT 'match', a.user_id, a.event_id, arg_min(b.event_id, b.ts)
    FROM e a JOIN e b ON b.user_id = a.user_id AND b.ts > a.ts AND NOT b.is_late AND b.event_type = 'purchase'
    WHERE a.event_type = 'signup' AND NOT a.is_late GROUP BY a.user_id, a.event_id, a.ts HAVING min(b.ts) - a.ts < INTERVAL 2 DAYS""")
def pattern_late_split(spark, d):
    """Rows behind the stream's largest time go to an output of their own; the pattern sees the others."""
    kept, late = _split(spark, "pattern_late_split", _arriving(spark, d), F.col("ts"), ["user_id", "event_id", "ts", "event_type"])
    pattern = patterns.Pattern.begin("a", "event_type = 'signup'").followed_by("b", "event_type = 'purchase'").within(2 * DAY)
    found = patterns.match_pattern(kept, ["user_id"], ["ts", "event_id"], pattern, ["event_id"]).where("status = 'matched'")
    matches = found.select(F.lit("match").alias("kind"), "user_id", F.col("a.event_id").alias("a_id"), F.col("b.event_id").alias("b_id"))
    return matches.unionByName(late.select(F.lit("late").alias("kind"), "user_id", F.col("event_id").alias("a_id"), F.lit(-1).cast("bigint").alias("b_id")))


@query("stream_hot_urls", """
    WITH c AS (
        SELECT user_id::VARCHAR AS url, date_trunc('hour', ts) + k * INTERVAL 1 HOUR AS window_end, count(*) AS cnt
        FROM events, generate_series(1, 2) s(k) WHERE event_type = 'view' GROUP BY ALL)
    SELECT window_end, rank, url, cnt
    FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url)::INTEGER AS rank FROM c) WHERE rank <= 5""")
def stream_hot_urls(spark, d):
    spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    rows = event_stream(spark, d).where(F.when(F.col("ts").isNotNull(), F.col("event_type") == "view"))
    rows = rows.select(F.col("user_id").cast("string").alias("url"), "ts")
    changes = topn.top_n_changes(rows, "url", "ts", 2 * HOUR, HOUR, 5)
    return _plain_times(topn.current(_written(spark, "stream_hot_urls", changes))).withColumnRenamed("item", "url")


@query("stream_documents", """
    SELECT event_type || '|' || user_id AS doc_key,
           '{"event_type":"' || event_type || '","user_id":' || user_id || ',"cnt":' || count(*) || '}' AS body
    FROM events GROUP BY event_type, user_id""")
def stream_documents(spark, d):
    """Running counts as documents; the latest one of a key stays."""
    folder = _folder(spark, "stream_documents")
    table, write = upsert_documents(f"{folder}/table", ["event_type", "user_id"])
    counts = event_stream(spark, d).groupBy("event_type", "user_id").agg(F.count("*").alias("cnt"))
    run_to_end(counts, f"{folder}/checkpoint", mode="update", each_batch=write)
    return table.latest(spark)


@query("stream_csv_files", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def stream_csv_files(spark, d):
    folder = _folder(spark, "stream_csv_files")
    rows = event_stream(spark, d).where("event_type = 'purchase'").select("event_id", "user_id", "value")
    append_files(rows, f"{folder}/out", f"{folder}/checkpoint", header="true").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint, value double").option("header", "true").csv(f"{folder}/out")


@query("stream_count_and_alarm", f"""{keyed._FALLS}
    a AS (SELECT user_id, island, min(ts) AS rise_ts, any_value(stop) AS stop FROM rises GROUP BY 1, 2
          UNION ALL
          SELECT a.user_id, a.island, min(r.ts), any_value(a.stop)
          FROM a JOIN rises r ON r.user_id = a.user_id AND r.island = a.island AND r.ts > a.rise_ts + INTERVAL 8 HOURS
          GROUP BY a.user_id, a.island)
    SELECT user_id, 'alarm' AS output, rise_ts + INTERVAL 8 HOURS AS at_ts FROM a
    WHERE (stop IS NULL OR stop > rise_ts + INTERVAL 8 HOURS) AND rise_ts + INTERVAL 8 HOURS <= {_SEEN}
    UNION ALL SELECT user_id, 'count', ts FROM events WHERE ts <= {_SEEN}""")
def stream_count_and_alarm(spark, d):
    """One pass over the stream, two sinks."""
    spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    folder = _folder(spark, "stream_count_and_alarm")
    tables = {tag: KeyedTable(f"{folder}/{tag}", ("user_id", "at_ts")) for tag in ("count", "alarm")}
    rows = event_stream(spark, d).select("user_id", "event_id", "ts", "value")
    writes = {tag: table.upsert for tag, table in tables.items()}
    jobs.count_and_alarm_stream(rows, ["user_id"], ["ts", "event_id"], "value", 8 * HOUR, writes, f"{folder}/checkpoint")
    found = [t.changes(spark).select("user_id", F.lit(tag).alias("output"), "at_ts") for tag, t in tables.items()]
    return _plain_times(found[0].unionByName(found[1]))


# A third of the rows on one key, and a threshold that splits it (and every other busy key) into slices.
_SKEWED = "(SELECT *, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS k FROM events)"
_SPLIT_ABOVE = 50


def _skewed(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "event_type", "value")
    return e.select(F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")).alias("k"), "*")


@query("skewed_rolling", f"""
    SELECT event_id, k, sum(event_id) OVER w ::BIGINT AS total, row_number() OVER w AS n,
           coalesce(lag(event_id) OVER w, -1) AS before
    FROM {_SKEWED} WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)""")
def skewed_rolling(spark, d):
    columns = {"total": running_sum(F.col("event_id")), "n": running_count(), "p": previous("event_id")}
    rolled = scan(_skewed(spark, d), ["k"], ["ts", "event_id"], columns, _SPLIT_ABOVE)
    return rolled.select("event_id", "k", "total", "n", F.coalesce("p.event_id", F.lit(-1)).alias("before"))


@query("skewed_session", f"""
    WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 20 MINUTES THEN 0 ELSE 1 END AS opens
               FROM {_SKEWED} WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM f)
    SELECT k, min(ts) AS window_start, max(ts) + INTERVAL 20 MINUTES AS window_end, count(*) AS cnt FROM s GROUP BY k, n""")
def skewed_session(spark, d):
    return windows.session(_skewed(spark, d), ["k"], ["ts", "event_id"], timedelta(minutes=20), {"cnt": Agg("count")},
                           _SPLIT_ABOVE)


@query("skewed_pattern", f"""
    SELECT s.k, s.event_id AS a_id, arg_min(n.event_id, n.ts) AS b_id
    FROM {_SKEWED} s JOIN {_SKEWED} n ON n.k = s.k AND n.ts > s.ts AND n.event_type = 'purchase'
    WHERE s.event_type = 'signup' GROUP BY s.k, s.event_id, s.ts HAVING min(n.ts) - s.ts < INTERVAL 12 HOURS""")
def skewed_pattern(spark, d):
    pattern = patterns.Pattern.begin("a", "event_type = 'signup'").followed_by("b", "event_type = 'purchase'")
    found = patterns.match_pattern(_skewed(spark, d), ["k"], ["ts", "event_id"], pattern.within(12 * HOUR), ["event_id"],
                                   _SPLIT_ABOVE)
    return found.where("status = 'matched'").select("k", F.col("a.event_id").alias("a_id"), F.col("b.event_id").alias("b_id"))


@query("skewed_jump_alarm", f"""
    SELECT * FROM (SELECT k, event_id, value, lag(value) OVER (PARTITION BY k ORDER BY ts, event_id) AS previous_value
                   FROM {_SKEWED})
    WHERE abs(value - previous_value) > 100""")
def skewed_jump_alarm(spark, d):
    rows = _skewed(spark, d).select("k", "event_id", "ts", "value")
    return alerts.jump_alarm(rows, ["k"], ["ts", "event_id"], "value", 100.0, hot_rows=_SPLIT_ABOVE).drop("ts")


def _first_and_sum(state, row):
    event, = row
    return (event, event, 1) if state is None else (state[0], state[1] + event, state[2] + 1)


@query("skewed_reduce", f"""
    SELECT event_id, k, first_value(event_id) OVER w AS first_event, sum(event_id) OVER w ::BIGINT AS total,
           row_number() OVER w AS n
    FROM {_SKEWED} WINDOW w AS (PARTITION BY k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def skewed_reduce(spark, d):
    """A user's fold over a key with a third of the rows, which is cut into slices."""
    reducer = rolling.Reducer(
        ("event_id",), "first_event bigint, total bigint, n bigint", _first_and_sum, lambda a, b: (a[0], a[1] + b[1], a[2] + b[2]))
    rows = _skewed(spark, d).select("event_id", "k", "ts")
    return rolling.rolling_reduce(rows, ["k"], ["ts", "event_id"], reducer, _SPLIT_ABOVE).drop("ts")


@query("skewed_hop_count", f"""
    SELECT k, e AS window_end, e - INTERVAL 6 HOURS AS window_start, count(*) AS cnt FROM (
      SELECT k, time_bucket(INTERVAL 10 SECONDS, ts) + i * INTERVAL 10 SECONDS AS e
      FROM (SELECT event_id % 7 % 2 AS k, ts FROM events WHERE event_id % 20 = 0), generate_series(1, 2160) s(i))
    GROUP BY k, e""")
def skewed_hop_count(spark, d):
    """Two busy keys and many short slides: each stretch of time is counted by itself."""
    rows = events(spark, d).where("event_id % 20 = 0").select((F.col("event_id") % 7 % 2).alias("k"), "ts")
    return windows.hop_count(rows, ["k"], "ts", 6 * HOUR, timedelta(seconds=10))


@query("skewed_fail_window", f"""
    WITH RECURSIVE e AS (SELECT k, ts, event_id, event_type <> 'purchase' AS fail FROM {_SKEWED}),
    g AS (SELECT *, sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY ts, event_id) AS run FROM e),
    stops AS (SELECT k, run, min(ts) AS stop FROM g WHERE NOT fail GROUP BY 1, 2),
    f AS (SELECT g.k, g.run, g.ts, s.stop FROM g LEFT JOIN stops s ON s.k = g.k AND s.run = g.run + 1 WHERE g.fail),
    a AS (SELECT k, run, min(ts) AS first_ts, any_value(stop) AS stop FROM f GROUP BY 1, 2
          UNION ALL
          SELECT a.k, a.run, min(f.ts), any_value(a.stop)
          FROM a JOIN f ON f.k = a.k AND f.run = a.run AND f.ts > a.first_ts + INTERVAL 2 HOURS GROUP BY a.k, a.run)
    SELECT a.k, a.first_ts, max(f.ts) AS last_ts, count(*) AS cnt
    FROM a JOIN f ON f.k = a.k AND f.run = a.run AND f.ts BETWEEN a.first_ts AND a.first_ts + INTERVAL 2 HOURS
    WHERE a.stop IS NULL OR a.stop > a.first_ts + INTERVAL 2 HOURS
    GROUP BY 1, 2 HAVING count(*) >= 2""")
def skewed_fail_window(spark, d):
    rows = _skewed(spark, d).select("k", "event_id", "ts", "event_type")
    return alerts.fail_windows(rows, ["k"], ["ts", "event_id"], F.col("event_type") != "purchase", 2 * HOUR, hot_rows=_SPLIT_ABOVE)


@query("window_user_fn", f"""
    SELECT k, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
           quantile_disc(value, 0.5) AS middle, count(*) AS cnt
    FROM {_SKEWED} GROUP BY ALL""")
def window_user_fn(spark, d):
    """A user's function over all rows of a window, sorted: the lower median. One key has a third of the rows."""
    rows = _skewed(spark, d).select("k", "ts", "event_id", "value")
    return windows.apply_rows(rows, ["k"], "ts", DAY, ["value", "event_id"], _middle, "middle double, cnt bigint")


def _middle(window, batches):
    values = np.concatenate([b["value"].to_numpy() for b in batches])
    yield values[(len(values) - 1) // 2], len(values)
