"""Streaming forms give what the batch forms give, for several slicings and disordered arrival."""

from datetime import timedelta

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from streams import Replay, replay

from streamlab.operators import alerts as batch_alerts
from streamlab.operators import distinct, joins, patterns, route, windows
from streamlab.operators.windows import Agg
from streamlab.streaming import alerts, running
from streamlab.streaming import windows as sw
from streamlab.streaming.event_time import run_machine
from streamlab.streaming.late import split_late, window_closes
from streamlab.streaming.patterns import match_stream
from streamlab.streaming.running import running_fold

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
CNT = {"cnt": Agg("count")}
FAR = pd.Timestamp("2024-03-01")


@pytest.fixture(scope="module")
def rows(spark, events):
    """A part of the users with a UTC timestamp and an arrival number that mixes neighbours."""
    df = events.where("user_id < 6").withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withColumn("seq", F.col("event_id") + (F.col("event_id") * 37) % 50).drop("props").cache()


def sentinels(n=2):
    return [{"ts": FAR + pd.Timedelta(days=i), "user_id": -1, "event_type": "none", "event_id": -1 - i} for i in range(n)]


@pytest.fixture(scope="module", params=[(1, "event_id"), (4, "event_id"), (5, "seq")], ids=str)
def source(spark, rows, request):
    slices, order = request.param
    return replay(spark, rows, slices, [order], sentinels())


def marked(stream):
    return stream.withWatermark("ts", "5 days")


def real(df):
    return df.where("user_id >= 0")


def test_windows(rows, source):
    def compare(name, stream_form, batch_form):
        got = source.run(lambda s: stream_form(marked(s)), name=name)
        assert rows_of(real(got)) == rows_of(batch_form(rows))

    aggs = {**CNT, "high": Agg("max", F.col("value"))}
    compare("tumble", lambda s: sw.tumble(s, ["user_id"], "ts", DAY, aggs), lambda b: windows.tumble(b, ["user_id"], "ts", DAY, aggs))
    compare("hop", lambda s: sw.hop(s, ["user_id"], "ts", DAY, 6 * HOUR, aggs), lambda b: windows.hop(b, ["user_id"], "ts", DAY, 6 * HOUR, aggs))
    compare("session", lambda s: sw.session(s, ["user_id"], "ts", 6 * HOUR, CNT), lambda b: windows.session(b, ["user_id"], ["ts", "event_id"], 6 * HOUR, CNT))


def test_counts_and_uniques(rows, source):
    pv = source.run(lambda s: sw.salted_count(marked(s), "ts", DAY, "event_id"), name="pv")
    expected = windows.tumble(rows, [], "ts", DAY, {"pv": Agg("count")})
    assert rows_of(pv.where("window_end < '2024-02-15'")) == rows_of(expected)
    uv = source.run(lambda s: sw.unique_users(marked(s), "user_id", "ts", DAY), name="uv").drop("window_start")
    assert rows_of(uv.where("window_end < '2024-02-15'")) == rows_of(distinct.unique_exact(rows, "user_id", "ts", DAY))


def test_distinct(rows, source):
    got = source.run(lambda s: route.distinct_first(marked(s).select("user_id", "event_type"), ["user_id", "event_type"]), name="d")
    assert rows_of(real(got)) == rows_of(rows.select("user_id", "event_type").distinct())


MACHINES = {
    "jump": (
        lambda s: run_machine(s, ["user_id"], "ts", alerts.Jump("value", 50.0), ["value"], ["event_id"]),
        lambda b: batch_alerts.jump_alarm(b, ["user_id"], ["ts", "event_id"], "value", 50.0).select(
            "user_id", "ts", "value", "previous_value"),
    ),
    "no_decrease": (
        lambda s: run_machine(s, ["user_id"], "ts", alerts.NoDecrease("value", 8 * HOUR), ["value"], ["event_id"]),
        lambda b: batch_alerts.no_decrease_alarm(b, ["user_id"], ["ts", "event_id"], "value", 8 * HOUR),
    ),
    "adjacent": (
        lambda s: run_machine(s.withColumn("f", F.expr("event_type in ('error', 'click')")), ["user_id"], "ts",
                              alerts.AdjacentFails("f", 12 * HOUR), ["f"], ["event_id"]),
        lambda b: batch_alerts.adjacent_fails(b, ["user_id"], ["ts", "event_id"], "ts",
                                              F.col("event_type").isin("error", "click"), 12 * HOUR),
    ),
    "fail_window": (
        lambda s: run_machine(s.withColumn("f", F.expr("event_type <> 'view'")), ["user_id"], "ts",
                              alerts.FailWindow("f", DAY), ["f"], ["event_id"]),
        lambda b: batch_alerts.fail_windows(b, ["user_id"], ["ts", "event_id"], F.col("event_type") != "view", DAY),
    ),
}


@pytest.mark.parametrize("name", MACHINES)
def test_alerts(rows, source, name):
    stream_form, batch_form = MACHINES[name]
    got = source.run(lambda s: alerts.with_times(stream_form(marked(s))), name=name)
    expected = rows_of(batch_form(rows))
    assert expected and rows_of(real(got)) == expected


def test_blacklist(rows, source):
    got = real(source.run(lambda s: run_machine(marked(s), ["user_id"], "ts", alerts.Blacklist("event_id", 3), ["event_id"]), name="bl"))
    args = (rows, ["user_id"], ["ts", "event_id"], "ts", 3)
    assert rows_of(got.where("kind = 'pass'").select("id")) == rows_of(batch_alerts.blacklist_pass(*args).select("event_id"))
    assert rows_of(got.where("kind = 'warn'").select("id")) == rows_of(batch_alerts.blacklist_warnings(*args).select("event_id"))


def test_patterns(rows, source):
    begin = patterns.Pattern.begin("a", "event_type = 'view'").followed_by("b", "event_type = 'click'")
    specs = {
        "funnel": begin.followed_by("c", "event_type = 'purchase'").within(3 * DAY),
        "absent": begin.not_followed_by("c", "event_type = 'purchase'").within(3 * DAY),
        "strict": patterns.Pattern.begin("a", "event_type <> 'view'").times(3, consecutive=True).within(2 * DAY),
    }
    for name, spec in specs.items():
        got = source.run(lambda s, p=spec: match_stream(marked(s), ["user_id"], "ts", p, "event_id"), name=name)
        found = patterns.match_pattern(rows, ["user_id"], ["ts", "event_id"], spec, ["event_id"])
        expected = found.select("user_id", *[F.col(f"{s.name}.event_id") for s in spec.stages], "status")
        assert rows_of(real(got)) == rows_of(expected), name


def test_reconcile(spark, rows):
    def side(kind):
        return rows.where(F.col("event_type") == kind).select("user_id", "event_id", "ts")

    def source_of(kind):
        return replay(spark, side(kind), 3, ["event_id"], [
            {"ts": FAR + pd.Timedelta(days=40 * i), "user_id": -1, "event_id": -1 - i} for i in range(3)])

    left, right = source_of("click"), source_of("purchase")
    args = (["user_id"], "ts", "ts", -6 * HOUR, 12 * HOUR)
    both = sw.reconcile(marked(left.stream()), marked(right.stream()), *args)
    got = left.run(lambda _: both, name="join")
    assert rows_of(real(got)) == rows_of(joins.reconcile(side("click"), side("purchase"), *args))


def test_order_timeout(spark):
    rows = [(1, 0, "create", 0), (1, 1, "pay", 900), (2, 2, "create", 10), (2, 3, "pay", 911), (3, 4, "pay", 20),
            (4, 5, "create", 30), (-1, 6, "x", 10_000), (-1, 7, "x", 20_000)]
    df = spark.createDataFrame(rows, "order long, seq long, kind string, at long").withColumn("ts", F.timestamp_seconds(F.col("at") + 1_000_000))
    machine = alerts.OrderTimeout("created", "paid", timedelta(minutes=15))

    def build(s):
        flagged = s.withWatermark("ts", "1 hour").withColumn("created", F.expr("kind = 'create'")).withColumn("paid", F.expr("kind = 'pay'"))
        return alerts.with_times(run_machine(flagged.where("kind <> 'x' or order < 0"), ["order"], "ts", machine, ["created", "paid"], ["seq"]))

    got = replay(spark, df, 4, ["seq"]).run(build).where("order > 0 and status is not null")
    expected = batch_alerts.order_timeout(df, ["order"], ["ts", "seq"], F.expr("kind = 'create'"), F.expr("kind = 'pay'"), timedelta(minutes=15))
    assert rows_of(got) == rows_of(expected)


def test_running_results(spark, rows):
    source = replay(spark, rows, 4, ["event_id"])
    schema = T.StructType([T.StructField("top", T.DoubleType()), T.StructField("n", T.LongType())])
    got = source.run(lambda s: running_fold(s, ["user_id"], ["event_id"], ["event_id"], schema,
                                            lambda st, r: (max(st[0], r["value"]), st[1] + 1) if st else (r["value"], 1)))
    expected = spark.sql("""select user_id, event_id, max(value) over w, count(*) over w from {r}
        window w as (partition by user_id order by event_id rows unbounded preceding)""", r=rows)
    assert rows_of(got) == rows_of(expected)


def test_count_windows(spark, rows):
    source = replay(spark, rows, 3, ["event_id"])
    full = source.run(lambda s: running.count_window(s, ["user_id"], ["event_id"], "event_id", 5), name="full")
    expected = windows.count_tumble(rows, ["user_id"], ["event_id"], 5, {"last": Agg("max", F.col("event_id"))})
    assert rows_of(full.select("user_id", F.element_at("items", -1))) == rows_of(expected.select("user_id", "last"))
    sliding = source.run(lambda s: running.count_window(s, ["user_id"], ["event_id"], "event_id", 5, 2), name="slide")
    expected = windows.count_hop(rows, ["user_id"], ["event_id"], 5, 2, {**CNT, "first": Agg("min", F.col("event_id"))})
    assert rows_of(sliding.select("user_id", "row_no", F.col("cnt").cast("long"), F.element_at("items", 1))) == rows_of(
        expected.select("user_id", "window_no", "cnt", "first"))


def test_changelog_adds_up(spark, rows):
    got = replay(spark, rows, 4, ["event_id"]).run(lambda s: running.changelog_count(s, ["event_type"]))
    net = got.groupBy("event_type").agg(F.sum(F.expr("if(is_add, cnt, -cnt)")))
    assert rows_of(net) == rows_of(rows.groupBy("event_type").count())


START = 1_000_000


def known_case(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    source = Replay(spark, schema)
    n = 0
    for batch in ([1, 2], [20], [3, 40], [4]):
        pdf = pd.DataFrame({"k": "a", "id": range(n, n + len(batch)), "ts": [pd.Timestamp(START + t, unit="s") for t in batch]})
        n += len(batch)
        source.add(pdf)
    return source


def test_late_rows_are_dropped_by_windows_and_kept_by_late_split(spark):
    source = known_case(spark)
    five = timedelta(seconds=5)
    counted = source.run(lambda s: sw.tumble(s.withWatermark("ts", "2 seconds"), ["k"], "ts", five, CNT), name="w")
    assert sorted(rows_of(counted.select(F.unix_seconds("window_end") - START, "cnt"))) == [(5, 3), (25, 1)]
    split = source.run(lambda s: split_late(
        s, F.lit(0), ["id"], "ts", window_closes("ts", five), timedelta(seconds=2), ["id"]), name="l")
    assert rows_of(split) == [(0, False), (1, False), (2, False), (3, True), (4, False), (5, True)]


def test_restart_continues_from_the_checkpoint(spark, rows):
    pdf = rows.toPandas().sort_values("event_id", ignore_index=True)
    whole, broken = Replay(spark, rows.schema), Replay(spark, rows.schema)
    parts = [pdf.iloc[i::1][: len(pdf) // 2] if i == 0 else pdf.iloc[len(pdf) // 2:] for i in (0, 1)]

    def build(s):
        return running.running_count(s, ["user_id"], ["event_id"], ["event_id"])

    whole.add(parts[0]).add(parts[1])
    expected = rows_of(whole.run(build))
    broken.add(parts[0]).run(build)
    assert rows_of(broken.add(parts[1]).run(build)) == expected


def test_processing_time_reminder(spark, rows):
    source = replay(spark, rows, 1, ["event_id"])
    out = f"{source.folder}/out"
    query = (
        running.reminder(source.stream(), ["user_id"], timedelta(seconds=1)).writeStream.outputMode("append")
        .option("checkpointLocation", f"{source.folder}/check").trigger(processingTime="1 second")
        .format("parquet").option("path", out).start()
    )
    try:
        for _ in range(30):
            query.awaitTermination(1)
            progress = query.lastProgress
            if progress and query.recentProgress[-1].sink.numOutputRows not in (None, -1, 0):
                break
            try:
                if spark.read.parquet(out).count():
                    break
            except Exception:  # nothing written yet
                continue
    finally:
        query.stop()
    assert rows_of(spark.read.parquet(out).select("user_id", "cnt")) == rows_of(rows.groupBy("user_id").count())
