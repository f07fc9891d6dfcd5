import random
from datetime import datetime, timedelta

from conftest import rows_of
from pyspark.sql import functions as F

from streamlab.operators import alerts, distinct, windows
from streamlab.operators.topn import top_n
from streamlab.operators.windows import Agg

HOUR, MINUTE = timedelta(hours=1), timedelta(minutes=1)
CNT = {"cnt": Agg("count")}


def test_sliding_forms_agree(events):
    args = (["event_type"], "ts", HOUR, 5 * MINUTE)
    plain = rows_of(windows.hop_plain(events, *args, CNT))
    assert rows_of(windows.hop(events, *args, CNT)) == plain
    assert rows_of(windows.hop_count(events, *args)) == plain


def test_sliding_pane_merge_of_every_aggregate(events):
    order = F.struct("ts", "event_id")
    aggs = {**CNT, "total": Agg("sum", F.col("event_id")), "low": Agg("min", F.col("value")),
            "high": Agg("max", F.col("value")), "first": Agg("first", F.col("event_id"), order),
            "last": Agg("last", F.col("event_id"), order)}
    for size, slide in ((60, 20), (50, 20), (7, 3)):
        args = (["event_type"], "ts", size * MINUTE, slide * MINUTE, aggs)
        assert rows_of(windows.hop(events, *args)) == rows_of(windows.hop_plain(events, *args))


def test_wide_fan_out_sums_to_rows_times_windows(events):
    counted = windows.hop_count(events, ["event_type"], "ts", HOUR, timedelta(seconds=5))
    assert counted.agg(F.sum("cnt")).first()[0] == events.count() * 720


def test_session_equals_built_in_and_gap_is_inclusive(spark, events):
    ours = windows.session(events, ["user_id"], ["ts", "event_id"], HOUR, CNT)
    w = F.session_window("ts", "1 hour")
    built_in = events.groupBy("user_id", w.alias("w")).count().select("user_id", "w.start", "w.end", "count")
    assert rows_of(ours) == rows_of(built_in)
    rows = [("a", 0), ("a", 5), ("a", 11)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = windows.session(df, ["k"], ["ts"], timedelta(seconds=5), CNT)
    assert [r["cnt"] for r in got.orderBy("window_start").collect()] == [2, 1]


def test_day_windows_start_at_local_midnight(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 15:59:59' ts union all select timestamp_ntz'2024-01-01 16:00:00'")
    got = windows.tumble(df, [], "ts", timedelta(days=1), CNT, offset=timedelta(hours=16)).orderBy("window_start")
    assert [str(r["window_start"]) for r in got.collect()] == ["2023-12-31 16:00:00", "2024-01-01 16:00:00"]


def test_count_windows(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 8)], "k string, t long")
    value = {"total": Agg("sum", F.col("t")), "cnt": Agg("count")}
    tumbling = windows.count_tumble(df, ["k"], ["t"], 3, value)
    assert rows_of(tumbling.select("total")) == [(15,), (6,)]
    sliding = windows.count_hop(df, ["k"], ["t"], 5, 2, value).orderBy("window_no")
    assert [tuple(r) for r in sliding.select("window_no", "total", "cnt").collect()] == [(2, 3, 2), (4, 10, 4), (6, 20, 5)]


def test_unique_counts_agree(events):
    exact = rows_of(distinct.unique_exact(events, "user_id", "ts", HOUR))
    assert rows_of(distinct.unique_two_phase(events, "user_id", "ts", HOUR)) == exact
    assert rows_of(distinct.unique_bitmap(events, "user_id", "ts", HOUR)) == exact
    last = distinct.unique_running(events, "user_id", ["ts", "event_id"], HOUR).groupBy("window_end").agg(F.max("uv"))
    assert rows_of(last) == exact
    day = timedelta(days=1)
    near = distinct.unique_exact(events, "user_id", "ts", day).join(
        distinct.unique_approx(events, "user_id", "ts", day, 0.01).withColumnRenamed("uv", "a"), "window_end")
    assert near.where("abs(uv - a) > greatest(1, uv * 0.05)").count() == 0


def test_salted_equals_plain(events):
    plain = windows.tumble(events, [], "ts", HOUR, {"pv": Agg("count")}).select("window_end", "pv")
    assert rows_of(distinct.salted_count(events, "ts", HOUR, "event_id")) == rows_of(plain)


def test_top_n_limits_groups_before_the_shuffle(events):
    ranked = top_n(events.select("event_type", "event_id", "value"), ["event_type"], [F.desc("value"), F.asc("event_id")], 3)
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.count() == 15


def test_long_chains_of_anchored_windows(spark):
    """Chains of many windows, with equal times, NULL keys and a hot key, against a walk from row to row."""
    rng = random.Random(3)
    rows = []
    for k in ("a", "b", None):
        at = 0
        for i in range(400 if k == "a" else 60):
            at += rng.choice([0, 1, 2, 5])
            rows.append((k, i, datetime(2024, 1, 1) + timedelta(seconds=at), rng.random() < 0.97))
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz, fail boolean")
    want, length = [], timedelta(seconds=7)
    for k in ("a", "b", None):
        window = None
        for _, _, ts, fail in [r for r in rows if r[0] == k] + [(k, 0, datetime(2025, 1, 1), True)]:
            if window and ts - window[0] > length:
                want += [(k, *window)] if window[2] >= 2 else []
                window = None
            if not fail:
                window = None
            else:
                window = (ts, ts, 1) if window is None else (window[0], ts, window[2] + 1)
    for hot in (None, 20):
        got = alerts.fail_windows(df, ["k"], ["ts", "id"], F.col("fail"), length, hot_rows=hot)
        assert rows_of(got.select("k", "first_ts", "last_ts", "cnt")) == sorted(want, key=repr)


def test_window_function_reads_as_much_as_it_wants(spark):
    """A window of a third of the rows comes in batches; unread rows are skipped; results may be many or none."""
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, null, cast(id % 50 as string)) AS k", "timestamp_seconds(id % 7) AS ts", "id")

    def first_two(window, batches):
        for batch in batches:
            if window["k"] == "1":
                return
            for v in batch["id"].to_pylist()[:2]:
                yield v, None if window["k"] else "none"
            return

    got = windows.apply_rows(df, ["k"], "ts", timedelta(seconds=10), ["id"], first_two, "id bigint, mark string").collect()
    best = {}
    for i in range(30_000):
        best.setdefault(None if i % 3 == 0 else str(i % 50), []).append(i)
    assert sorted((str(r.k), r.id, r.mark) for r in got) == sorted(
        (str(k), i, None if k else "none") for k, v in best.items() if k != "1" for i in v[:2])

    def count(window, batches):
        yield sum(b.num_rows for b in batches), 0

    sizes = windows.apply_rows(df, ["k"], "ts", timedelta(seconds=10), ["id"], count, "n bigint, zero int")
    assert {r.k: r.n for r in sizes.collect()} == {k: len(v) for k, v in best.items()}


def test_sliding_counts_are_cut_at_stretches(spark, events, monkeypatch):
    old = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 54 YEARS"))
    for rows in (events, old):
        args = (rows, ["event_type"], "ts", HOUR, 5 * MINUTE)
        plain = rows_of(windows.hop_plain(*args, CNT))
        for stretch in (1, 3, 12, 100):
            monkeypatch.setattr(windows, "STRETCH", stretch)
            assert rows_of(windows.hop_count(*args)) == plain


def test_hop_deals_panes_to_tasks_by_their_copies(spark, monkeypatch):
    """More copies are merged in more tasks, not in larger ones, and copies are not shuffled."""
    monkeypatch.setattr(windows, "COPIES", 1000)
    monkeypatch.setattr(windows, "STRETCH", 5)
    rng, start = random.Random(8), datetime(2024, 1, 1)
    rows = [(rng.choice([1, 2, 3, None]), start + timedelta(seconds=rng.randrange(40_000)), rng.randrange(9)) for _ in range(700)] + [(1, None, 4)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, value int")
    aggs = {"cnt": Agg("count"), "low": Agg("min", F.col("value")), "at": Agg("last", F.col("value"), F.struct("ts", "value"))}
    for size, slide in ((60, 5), (100, 30)):
        args = (df, ["k"], "ts", timedelta(minutes=size), timedelta(minutes=slide), aggs)
        got = windows.hop(*args)
        assert got.rdd.getNumPartitions() == -(-len(rows) * -(-size // slide) // 1000)
        assert rows_of(got) == rows_of(windows.hop_plain(*args)) and got.schema["window_start"].dataType == df.schema["ts"].dataType


def test_sliding_counts_are_shuffled_twice(events):
    counted = windows.hop_count(events, ["user_id"], "ts", timedelta(hours=1), timedelta(minutes=5))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # by span, where equal ones meet, and by stretch of time; sums of changes and levels took one each before
    assert plan.count("Exchange hashpartitioning") == 2
