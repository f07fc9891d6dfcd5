"""Splitting hot keys must not change any result, and row order must not matter."""

from datetime import timedelta

import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamlab.operators import alerts, distinct, history, late, patterns, rolling, windows
from streamlab.operators.history import (
    History,
    first_so_far,
    following,
    last_so_far,
    next_match,
    previous,
    running_count,
    running_max,
    running_min,
    running_sum,
    scan,
)
from streamlab.operators.windows import Agg
from streamlab.session import checkpointed

ORDER, HOUR, DAY = ["ts", "event_id"], timedelta(hours=1), timedelta(days=1)
NEVER = 1_000_000

def columns():
    return {
        "total": running_sum(F.col("event_id")),
        "n": running_count(),
        "before_low": running_min(F.col("value"), inclusive=False),
        "top": running_max(F.struct("value", "event_id")),
        "p": previous("event_id", "value"),
        "f": following("event_id"),
        "m": next_match(F.col("event_type") == "purchase", "event_id"),
        "first": first_so_far(F.col("value")),
        "last_click": last_so_far(F.when(F.col("event_type") == "click", F.col("ts"))),
    }


FUNNEL = (
    patterns.Pattern.begin("a", "event_type = 'view'").followed_by("b", "event_type = 'click'")
    .followed_by("c", "event_type = 'purchase'").within(3 * DAY)
)
REDUCER = rolling.Reducer(
    ("event_type", "event_id"), "path string, top bigint", lambda s, r: (r[0][:1], r[1]) if s is None else ((s[0] + r[0][:1])[-9:], max(s[1], r[1])),
    lambda a, b: ((a[0] + b[0])[-9:], max(a[1], b[1])))
CASES = {
    "scan": lambda e, hot: scan(e, ["user_id"], ORDER, columns(), hot),
    "over": lambda e, hot: rolling.over_range(e.withColumn("day", F.to_date("ts")), ["user_id"], ["day"], "value", hot),
    "session": lambda e, hot: windows.session(e, ["user_id"], ORDER, 6 * HOUR, {"cnt": Agg("count")}, hot),
    "count_tumble": lambda e, hot: windows.count_tumble(e, ["user_id"], ORDER, 5, {"low": Agg("min", F.col("value"))},
                                                        hot),
    "count_hop": lambda e, hot: windows.count_hop(e, ["user_id"], ORDER, 5, 2, {"low": Agg("min", F.col("value"))}, hot),
    "fold": lambda e, hot: windows.fold_text(e, ["event_type"], ORDER, DAY, "user_id", chunk=3, hot_rows=hot),
    "uv": lambda e, hot: distinct.unique_running(e, "user_id", ORDER, DAY, hot),
    "late": lambda e, hot: late.late_split(e.withColumn("seq", (F.col("event_id") * 37) % 1000), ["seq", "event_id"],
                                           "ts", HOUR, HOUR, hot_rows=hot),
    "no_decrease": lambda e, hot: alerts.no_decrease_alarm(e, ["user_id"], ORDER, "value", 8 * HOUR, hot),
    "fail_windows": lambda e, hot: alerts.fail_windows(e, ["user_id"], ORDER, F.col("event_type") != "view", DAY,
                                                       hot_rows=hot),
    "order_timeout": lambda e, hot: alerts.order_timeout(e, ["user_id"], ORDER, F.col("event_type") == "signup",
                                                         F.col("event_type") == "purchase", 2 * DAY, hot),
    "reduce": lambda e, hot: rolling.rolling_reduce(e, ["user_id"], ORDER, REDUCER, hot),
    "blacklist": lambda e, hot: alerts.blacklist_pass(e, ["user_id"], ORDER, "ts", 3, hot_rows=hot),
    "pattern": lambda e, hot: patterns.match_pattern(e, ["user_id"], ORDER, FUNNEL, ["event_id"], hot),
}


@pytest.mark.parametrize("name", CASES)
def test_sliced_equals_plain(events, name):
    plain = rows_of(CASES[name](events, NEVER))
    assert plain
    skewed = events.orderBy(F.rand(7))
    assert rows_of(CASES[name](skewed, 5)) == plain


def test_one_key_with_a_third_of_the_rows(events):
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    sliced = History.of(skewed, ["user_id"], ORDER, 50).sliced
    largest = sliced.groupBy("user_id", "_slice").count().agg(F.max("count")).first()[0]
    assert largest <= 120
    assert rows_of(scan(skewed, ["user_id"], ORDER, columns(), 50)) == rows_of(scan(skewed, ["user_id"], ORDER, columns()))


def test_a_null_key_with_a_third_of_the_rows(events):
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.col("user_id")))
    sizes = History.of(skewed, ["user_id"], ORDER, 50).sliced.where("user_id is null").groupBy("_slice").count()
    assert sizes.count() > 3
    assert rows_of(scan(skewed, ["user_id"], ORDER, columns(), 50)) == rows_of(scan(skewed, ["user_id"], ORDER, columns()))
    for name in ("session", "pattern"):
        assert rows_of(CASES[name](skewed, 50)) == rows_of(CASES[name](skewed, NEVER))


def test_a_burst_inside_a_hot_key_is_split_too(spark):
    # nine tenths of the rows within a second, the rest spread over ten days
    at = "if(id % 10 = 0, cast(id * 86 as double), 400000 + id / 10000.0)"
    df = spark.range(10_000).select(F.lit("a").alias("k"), F.expr(at).alias("at"), "id")
    sliced = History.of(df, ["k"], ["at", "id"], 100).sliced
    sizes = sliced.groupBy("_slice").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] > 64 and sizes[1] < 500
    columns = {"n": running_count(), "p": previous("id")}
    assert rows_of(scan(df, ["k"], ["at", "id"], columns, 100)) == rows_of(scan(df, ["k"], ["at", "id"], columns))


def test_only_keys_over_the_threshold_are_split(events):
    assert not History.of(events, ["user_id"], ORDER).split
    assert History.of(events, ["event_type"], ORDER, 50).split


def test_many_hot_keys_are_joined_by_key(events, monkeypatch):
    plain = rows_of(scan(events, ["user_id"], ORDER, columns()))
    monkeypatch.setattr(history, "MOST_SENT", 0)
    assert rows_of(scan(events, ["user_id"], ORDER, columns(), 5)) == plain


def test_a_busy_key_beside_many_hot_keys_is_dealt_out(spark, events, monkeypatch):
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    plain = rows_of(scan(skewed, ["user_id"], ORDER, columns()))
    stored = []
    monkeypatch.setattr(history, "checkpointed", lambda df: stored.append(checkpointed(df)) or stored[-1])
    monkeypatch.setattr(history, "MOST_SENT", 70)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        sliced = scan(skewed, ["user_id"], ORDER, columns(), 20)
        assert rows_of(sliced) == plain
        in_slice = Window.partitionBy("user_id", "_parts", "_slice").orderBy(*ORDER)
        dealt = History.of(skewed, ["user_id"], ORDER, 20).sliced.withColumn("n", F.row_number().over(in_slice))
        found = dealt.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # one task had all rows of the busiest key, and every key as many cuts as the busiest
    assert len({r["task"] for r in found if r["user_id"] == -1}) > 1
    keys, cuts, parts = stored[0].agg(F.count("*"), F.sum(F.size("_cuts")), F.sum("_parts")).first()
    assert keys > 1 and cuts <= 4 * parts


def test_a_null_order_value_in_a_hot_key(events):
    holed = events.withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    plain = rows_of(scan(holed, ["user_id"], ORDER, columns()))
    assert rows_of(scan(holed, ["user_id"], ORDER, columns(), 5)) == plain
    for key in ("user_id", "event_type"):
        one = {"f": following("event_id"), "p": previous("event_id"), "m": next_match(F.col("event_id") % 5 == 0, "event_id")}
        assert rows_of(scan(holed, [key], ORDER, one, 2)) == rows_of(scan(holed, [key], ORDER, one))


def test_null_keys_and_equal_times(spark):
    rows = [(None, 1, 10), (None, 1, 11), ("a", 1, 12), ("a", 1, 13), ("a", 2, 14)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    for hot in (1, NEVER):
        got = scan(df, ["k"], ["t", "id"], {"n": running_count(), "p": previous("id")}, hot).collect()
        assert {r["id"]: (r["n"], r["p"] and r["p"]["id"]) for r in got} == {
            10: (1, None), 11: (2, 10), 12: (1, None), 13: (2, 12), 14: (3, 13)}


def test_chained_scans_shuffle_whole_rows_once(events):
    chained = History.of(events, ["user_id"], ORDER, 1000).scan(p=previous("value"))
    plan = chained.scan(n=running_sum(F.col("p.value"))).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") and "Python" not in plan
    wide = [line for line in plan.split("\n") if "FileScan" in line and "props" in line]
    assert len(wide) == 1


def test_reduce_of_small_slices_in_whole_batches():
    """A batch with many small slices goes out as one batch, and a slice over two batches has one state."""
    kinds = pa.schema([("n", pa.int64())])
    count = rolling.Reducer(("v",), "n bigint", lambda s, row: ((s[0] if s else 0) + row[0],), lambda a, b: (a[0] + b[0],))
    batches = [pa.record_batch({"k": [i // 4 if i < 12 else None for i in part], "v": [1] * len(part)}) for part in (range(6), range(6, 15))]
    sums = list(rolling._sum_slices(count, ["k"], kinds)(iter(batches)))
    assert [(r["k"], r["_state"]["n"]) for b in sums for r in b.to_pylist()] == [(0, 4), (1, 4), (2, 4), (None, 3)]
    carried = pa.record_batch({
        "k": [1, 1, 2, 2], "v": [None, 5, None, 6], "_carries": [True, False, True, False],
        "_state": pa.array([{"n": 10}, None, {"n": 20}, None], pa.struct([("n", pa.int64())]))})
    out = list(rolling._fold(count, ["k"], ["k", "v"], kinds, True)(iter([carried])))
    assert [b.to_pylist() for b in out] == [[{"k": 1, "v": 5, "n": 15}, {"k": 2, "v": 6, "n": 26}]]
    sums = pa.record_batch({"g": [1, 1, 1, 2], "p": [0, 1, 2, 0], "_state": [{"n": 1}, {"n": 2}, {"n": 3}, {"n": 4}]})
    carries = list(rolling._carry(count, ["g"], ["g", "p"], kinds)(iter([sums])))
    assert [b.to_pylist() for b in carries] == [[{"g": 1, "p": 1, "_state": {"n": 1}}, {"g": 1, "p": 2, "_state": {"n": 3}}]]
