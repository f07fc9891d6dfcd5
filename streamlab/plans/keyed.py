"""Joins, keyed alerts and sequence patterns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from streamlab.operators import alerts, joins, patterns, windows
from streamlab.plans.registry import events, query

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
ORDER = ["ts", "event_id"]


def _of_type(spark, d, kind: str):
    return events(spark, d).where(F.col("event_type") == kind).select("user_id", "event_id", "ts")


_PAIR = """l.user_id = r.user_id AND r.ts >= l.ts - INTERVAL 6 HOURS AND r.ts <= l.ts + INTERVAL 12 HOURS"""
_L = "(SELECT * FROM events WHERE event_type = 'click') l"
_R = "(SELECT * FROM events WHERE event_type = 'purchase') r"


@query("interval_join", f"""
    SELECT l.user_id, l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id, r.ts AS r_ts
    FROM {_L} JOIN {_R} ON {_PAIR}""")
def interval_join(spark, d):
    return joins.interval_join(_of_type(spark, d, "click"), _of_type(spark, d, "purchase"), ["user_id"], "ts", "ts",
                               -6 * HOUR, 12 * HOUR)


@query("interval_anti_join", f"""
    SELECT l.user_id, l.event_id AS l_event_id, l.ts AS l_ts
    FROM {_L} WHERE NOT EXISTS (SELECT 1 FROM {_R} WHERE {_PAIR})""")
def interval_anti_join(spark, d):
    return joins.interval_join(_of_type(spark, d, "click"), _of_type(spark, d, "purchase"), ["user_id"], "ts", "ts",
                               -6 * HOUR, 12 * HOUR, "left_anti")


@query("reconcile_pay_receipt", f"""
    SELECT coalesce(l.user_id, r.user_id) AS user_id, l.ts AS l_ts, r.ts AS r_ts,
           coalesce(l.event_id, -1) AS l_event_id, coalesce(r.event_id, -1) AS r_event_id,
           CASE WHEN r.ts IS NULL THEN 'pay_only' WHEN l.ts IS NULL THEN 'receipt_only' ELSE 'matched' END AS status
    FROM {_L} FULL JOIN {_R} ON {_PAIR}""")
def reconcile_pay_receipt(spark, d):
    both = joins.reconcile(_of_type(spark, d, "click"), _of_type(spark, d, "purchase"), ["user_id"], "ts", "ts",
                           -6 * HOUR, 12 * HOUR, ("matched", "pay_only", "receipt_only"))
    return both.fillna({"l_event_id": -1, "r_event_id": -1})


@query("jump_alarm", """
    SELECT * FROM (SELECT user_id, event_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                          AS previous_value FROM events)
    WHERE abs(value - previous_value) > 100""")
def jump_alarm(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "value")
    return alerts.jump_alarm(e, ["user_id"], ORDER, "value", 100.0)


_FALLS = """
    WITH RECURSIVE p AS (SELECT user_id, ts, value, lag(value) OVER w AS before FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    f AS (SELECT *, sum(CASE WHEN value < before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS island
          FROM p),
    stops AS (SELECT user_id, island, min(ts) AS stop FROM f WHERE value < before GROUP BY 1, 2),
    rises AS (SELECT f.user_id, f.ts, f.island, s.stop FROM f
              LEFT JOIN stops s ON s.user_id = f.user_id AND s.island = f.island + 1
              WHERE f.before IS NULL OR f.value > f.before),"""


@query("no_decrease_alarm", _FALLS + """
    a AS (SELECT user_id, island, min(ts) AS rise_ts, any_value(stop) AS stop FROM rises GROUP BY 1, 2
          UNION ALL
          SELECT a.user_id, a.island, min(r.ts), any_value(a.stop)
          FROM a JOIN rises r ON r.user_id = a.user_id AND r.island = a.island AND r.ts > a.rise_ts + INTERVAL 8 HOURS
          GROUP BY a.user_id, a.island)
    SELECT user_id, rise_ts, rise_ts + INTERVAL 8 HOURS AS alarm_ts FROM a
    WHERE stop IS NULL OR stop > rise_ts + INTERVAL 8 HOURS""")
def no_decrease_alarm(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "value")
    return alerts.no_decrease_alarm(e, ["user_id"], ORDER, "value", 8 * HOUR)


@query("login_fail_adjacent", """
    SELECT user_id, first_ts, second_ts FROM (
      SELECT user_id, ts AS second_ts, event_type, lag(ts) OVER w AS first_ts, lag(event_type) OVER w AS before
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND before = 'error' AND abs(epoch(second_ts) - epoch(first_ts)) <= 12 * 3600""")
def login_fail_adjacent(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    return alerts.adjacent_fails(e, ["user_id"], ORDER, "ts", F.col("event_type") == "error", 12 * HOUR)


@query("login_fail_window", """
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
    WHERE a.stop IS NULL OR a.stop > a.first_ts + INTERVAL 24 HOURS
    GROUP BY 1, 2 HAVING count(*) >= 2""")
def login_fail_window(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    return alerts.fail_windows(e, ["user_id"], ORDER, F.col("event_type").isin("error", "click", "view"), DAY)


@query("order_timeout", """
    WITH c AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'signup'),
    p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')
    SELECT c.user_id, CASE WHEN min(p.ts) IS NULL THEN 'no_pay' ELSE 'paid' END AS status, c.ts AS create_ts,
           min(p.ts) AS pay_ts
    FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 2 DAYS
    GROUP BY c.user_id, c.event_id, c.ts
    UNION ALL
    SELECT p.user_id, 'pay_without_create', NULL, p.ts FROM p
    WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 2 DAYS)""")
def order_timeout(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    return alerts.order_timeout(e, ["user_id"], ORDER, F.col("event_type") == "signup",
                                F.col("event_type") == "purchase", 2 * DAY)


_RANKED = """(SELECT *, CAST(ts + INTERVAL 8 HOURS AS DATE)::TIMESTAMP AS local_day, row_number() OVER (
              PARTITION BY user_id, CAST(ts + INTERVAL 8 HOURS AS DATE) ORDER BY ts, event_id) AS n FROM events)"""


def _clicks(spark, d):
    return events(spark, d).select("user_id", "event_id", "ts", "event_type")


@query("blacklist_warn", f"SELECT user_id, event_id, ts, event_type, local_day FROM {_RANKED} WHERE n = 3")
def blacklist_warn(spark, d):
    warned = alerts.blacklist_warnings(_clicks(spark, d), ["user_id"], ORDER, "ts", 3)
    return warned.withColumn("local_day", F.col("local_day").cast("timestamp_ntz"))


@query("blacklist_pass", f"SELECT user_id, event_id, ts, event_type, local_day FROM {_RANKED} WHERE n < 3")
def blacklist_pass(spark, d):
    passed = alerts.blacklist_pass(_clicks(spark, d), ["user_id"], ORDER, "ts", 3)
    return passed.withColumn("local_day", F.col("local_day").cast("timestamp_ntz"))


@query("province_count", f"""
    SELECT event_type, e AS window_end, e - INTERVAL 1 HOUR AS window_start, count(*) AS cnt FROM (
      SELECT event_type, date_trunc('minute', ts) + k * INTERVAL 1 MINUTE AS e
      FROM {_RANKED}, generate_series(1, 60) s(k) WHERE n < 3)
    GROUP BY event_type, e""")
def province_count(spark, d):
    passed = alerts.blacklist_pass(_clicks(spark, d), ["user_id"], ORDER, "ts", 3)
    return windows.hop_count(passed, ["event_type"], "ts", HOUR, timedelta(minutes=1))


@query("channel_count", """
    SELECT event_type, user_id, e AS window_end, e - INTERVAL 1 HOUR AS window_start, count(*) AS cnt FROM (
      SELECT event_type, user_id, time_bucket(INTERVAL 5 MINUTES, ts) + k * INTERVAL 5 MINUTES AS e
      FROM events, generate_series(1, 12) s(k))
    GROUP BY event_type, user_id, e""")
def channel_count(spark, d):
    return windows.hop_count(events(spark, d), ["event_type", "user_id"], "ts", HOUR, timedelta(minutes=5))


_NEXT = """(SELECT *, lead(event_id) OVER w AS e2, lead(event_type) OVER w AS t2, lead(ts) OVER w AS ts2,
              lead(event_id, 2) OVER w AS e3, lead(event_type, 2) OVER w AS t3, lead(ts, 2) OVER w AS ts3
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def _matches(spark, d, pattern, *stages: str, status: bool = False):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    found = patterns.match_pattern(e, ["user_id"], ORDER, pattern, ["event_id"])
    ids = [F.coalesce(f"{s}.event_id", F.lit(-1)).alias(f"{s}_id") for s in stages]
    if status:
        return found.select("user_id", *ids, "status")
    return found.where("status = 'matched'").select("user_id", *ids)


@query("pattern_next", f"""
    SELECT user_id, event_id AS a_id, e2 AS b_id FROM {_NEXT}
    WHERE event_type = 'error' AND t2 = 'error' AND ts2 - ts < INTERVAL 12 HOURS""")
def pattern_next(spark, d):
    fail = "event_type = 'error'"
    return _matches(spark, d, patterns.Pattern.begin("a", fail).next("b", fail).within(12 * HOUR), "a", "b")


_FIRST = """(SELECT s.user_id, s.event_id AS a_id, s.ts AS a_ts, arg_min(n.event_id, n.ts) AS b_id, min(n.ts) AS b_ts
             FROM events s LEFT JOIN events n ON n.user_id = s.user_id AND n.ts > s.ts AND n.event_type = '{b}'
             WHERE s.event_type = '{a}' GROUP BY ALL)"""


@query("pattern_followed_by", f"""
    SELECT user_id, a_id, b_id FROM {_FIRST.format(a='signup', b='purchase')} WHERE b_ts - a_ts < INTERVAL 2 DAYS""")
def pattern_followed_by(spark, d):
    pattern = patterns.Pattern.begin("a", "event_type = 'signup'").followed_by("b", "event_type = 'purchase'")
    return _matches(spark, d, pattern.within(2 * DAY), "a", "b")


@query("pattern_three_stage", f"""
    SELECT x.user_id, x.a_id, x.b_id, y.b_id AS c_id
    FROM {_FIRST.format(a='view', b='click')} x JOIN {_FIRST.format(a='click', b='purchase')} y ON y.a_id = x.b_id
    WHERE y.b_ts - x.a_ts < INTERVAL 3 DAYS""")
def pattern_three_stage(spark, d):
    return _matches(spark, d, _funnel(), "a", "b", "c")


def _funnel():
    return (
        patterns.Pattern.begin("a", "event_type = 'view'")
        .followed_by("b", "event_type = 'click'")
        .followed_by("c", "event_type = 'purchase'")
        .within(3 * DAY)
    )


@query("pattern_timeout", f"""
    SELECT x.user_id, x.a_id, CASE WHEN x.b_ts - x.a_ts < INTERVAL 3 DAYS THEN x.b_id ELSE -1 END AS b_id,
           CASE WHEN y.b_ts - x.a_ts < INTERVAL 3 DAYS THEN y.b_id ELSE -1 END AS c_id,
           CASE WHEN y.b_ts - x.a_ts < INTERVAL 3 DAYS THEN 'matched' ELSE 'timeout' END AS status
    FROM {_FIRST.format(a='view', b='click')} x LEFT JOIN {_FIRST.format(a='click', b='purchase')} y ON y.a_id = x.b_id
    """)
def pattern_timeout(spark, d):
    return _matches(spark, d, _funnel(), "a", "b", "c", status=True)


@query("pattern_times", """
    SELECT user_id, event_id AS a_1_id, e2 AS a_2_id, e3 AS a_3_id FROM (
      SELECT *, lead(event_id) OVER w AS e2, lead(event_id, 2) OVER w AS e3, lead(ts, 2) OVER w AS ts3
      FROM events WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE ts3 - ts < INTERVAL 3 DAYS""")
def pattern_times(spark, d):
    pattern = patterns.Pattern.begin("a", "event_type = 'error'").times(3).within(3 * DAY)
    return _matches(spark, d, pattern, "a_1", "a_2", "a_3")


@query("pattern_times_consecutive", f"""
    SELECT user_id, event_id AS a_1_id, e2 AS a_2_id, e3 AS a_3_id FROM {_NEXT}
    WHERE event_type = 'error' AND t2 = 'error' AND t3 = 'error' AND ts3 - ts < INTERVAL 3 DAYS""")
def pattern_times_consecutive(spark, d):
    pattern = patterns.Pattern.begin("a", "event_type = 'error'").times(3, consecutive=True).within(3 * DAY)
    return _matches(spark, d, pattern, "a_1", "a_2", "a_3")


@query("pattern_not_followed", f"""
    SELECT x.user_id, x.a_id, x.b_id
    FROM {_FIRST.format(a='view', b='click')} x JOIN {_FIRST.format(a='click', b='purchase')} y ON y.a_id = x.b_id
    WHERE x.b_ts - x.a_ts < INTERVAL 2 DAYS AND (y.b_ts IS NULL OR y.b_ts - x.a_ts >= INTERVAL 2 DAYS)""")
def pattern_not_followed(spark, d):
    pattern = (
        patterns.Pattern.begin("a", "event_type = 'view'")
        .followed_by("b", "event_type = 'click'")
        .not_followed_by("c", "event_type = 'purchase'")
        .within(2 * DAY)
    )
    return _matches(spark, d, pattern, "a", "b")


@query("pattern_path_text", f"""
    SELECT x.user_id, x.a_id,
           'view' || CASE WHEN x.b_ts - x.a_ts < INTERVAL 3 DAYS THEN '->click' ELSE '' END
                  || CASE WHEN y.b_ts - x.a_ts < INTERVAL 3 DAYS THEN '->purchase' ELSE '' END AS path
    FROM {_FIRST.format(a='view', b='click')} x LEFT JOIN {_FIRST.format(a='click', b='purchase')} y ON y.a_id = x.b_id
    """)
def pattern_path_text(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    found = patterns.match_pattern(e, ["user_id"], ORDER, _funnel(), ["event_id", "event_type"])
    return found.select("user_id", F.col("a.event_id").alias("a_id"),
                        F.expr(patterns.joined_events(_funnel(), "event_type")).alias("path"))
