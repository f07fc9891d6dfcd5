"""Golden facts on the sample rows (counts worked out by hand from the rules)."""

from datetime import timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from sample_rows import CART, LOGINS, ORDERS, RECEIPTS

from streamlab.operators import alerts, joins, patterns, windows
from streamlab.operators.history import scan, running_count
from streamlab.sources import parse

SECOND = timedelta(seconds=1)
BASE = 1558430000


def parsed(spark, lines, fields):
    numbered = spark.createDataFrame(list(enumerate(lines)), "seq long, line string")
    rows = parse.records(parse.delimited(numbered, "line", fields))
    # lines are unique enough to carry their arrival number back by position
    order = {line: i for i, line in enumerate(lines)}
    assert len(order) == len(lines)
    text = F.concat_ws(",", *[F.col(n).cast("string") for n, _ in fields])
    joined = rows.withColumn("line", text).join(numbered, "line").drop("line")
    return joined.withColumn("ts", F.timestamp_seconds("at"))


@pytest.fixture(scope="module")
def logins(spark):
    return parsed(spark, LOGINS, [("user", "bigint"), ("ip", "string"), ("kind", "string"), ("at", "bigint")]).cache()


@pytest.fixture(scope="module")
def orders(spark):
    return parsed(spark, ORDERS, [("order", "bigint"), ("kind", "string"), ("tx", "string"), ("at", "bigint")]).cache()


@pytest.fixture(scope="module")
def receipts(spark):
    return parsed(spark, RECEIPTS, [("tx", "string"), ("channel", "string"), ("at", "bigint")]).cache()


@pytest.fixture(scope="module")
def cart(spark):
    return parsed(spark, CART, [("user", "string"), ("at", "bigint"), ("kind", "string")]).cache()


def failed():
    return F.col("kind") == "fail"


def test_login_counts(logins):
    assert logins.count() == 48 and logins.select("user").distinct().count() == 25
    assert dict(rows_of(logins.groupBy("kind").count())) == {"success": 37, "fail": 11}


def test_adjacent_fails_in_arrival_order(logins):
    got = alerts.adjacent_fails(logins, ["user"], ["seq"], "ts", failed(), 2 * SECOND)
    found = got.select("user", F.unix_seconds("first_ts") - BASE, F.unix_seconds("second_ts") - BASE)
    assert rows_of(found) == rows_of(found.sparkSession.createDataFrame(
        [(1035, 842, 843), (1035, 843, 844), (83419, 882, 881), (83419, 881, 883)], "a long, b long, c long"))


def test_adjacent_fail_pattern(logins):
    pattern = patterns.Pattern.begin("a", "kind = 'fail'").next("b", "kind = 'fail'").within(3 * SECOND)
    got = patterns.match_pattern(logins, ["user"], ["ts", "seq"], pattern, ["at"])
    assert got.where("status = 'matched'").count() == 4


def test_repeated_fail_patterns(logins):
    def count(pattern):
        found = patterns.match_pattern(logins, ["user"], ["ts", "seq"], pattern, ["at"])
        return found.where("status = 'matched'").count()

    start = patterns.Pattern.begin("f", "kind = 'fail'")
    assert count(start.times(2).within(2000 * SECOND)) == 5
    assert count(start.times(3, consecutive=True).within(5 * SECOND)) == 2


def test_order_timeout(orders):
    got = alerts.order_timeout(orders, ["order"], ["ts", "seq"], F.col("kind") == "create", F.col("kind") == "pay",
                               900 * SECOND)
    assert dict(rows_of(got.groupBy("status").count())) == {"paid": 37, "no_pay": 2, "pay_without_create": 3}
    assert [r[0] for r in rows_of(got.where("status = 'no_pay'").select("order"))] == [34756, 34767]
    assert [r[0] for r in rows_of(got.where("status = 'pay_without_create'").select("order"))] == [34756, 34767, 34768]


def test_order_pattern_with_timeout(orders):
    pattern = patterns.Pattern.begin("c", "kind = 'create'").followed_by("p", "kind = 'pay'").within(900 * SECOND)
    got = patterns.match_pattern(orders, ["order"], ["ts", "seq"], pattern, ["at"])
    assert dict(rows_of(got.groupBy("status").count())) == {"matched": 37, "timeout": 2}


def test_receipts_interval_join_and_reconcile(orders, receipts):
    pays = orders.where("kind = 'pay'").select("tx", "order", "ts")
    got = receipts.select("tx", "channel", "ts")
    args = (pays, got, ["tx"], "ts", "ts", -3 * SECOND, 5 * SECOND)
    assert joins.interval_join(*args).count() == 4
    status = joins.reconcile(*args, ("matched", "pay_only", "receipt_only")).groupBy("status").count()
    assert dict(rows_of(status)) == {"matched": 4, "pay_only": 36, "receipt_only": 36}


def test_cart_patterns(cart):
    def statuses(seconds):
        pattern = (
            patterns.Pattern.begin("add", "kind = 'add'").followed_by("order", "kind = 'order'")
            .followed_by("pay", "kind = 'pay'").within(seconds * SECOND)
        )
        got = patterns.match_pattern(cart, ["user"], ["ts", "seq"], pattern, ["kind"])
        texts = got.selectExpr(patterns.joined_events(pattern, "kind"), "status")
        return rows_of(texts)

    assert statuses(10) == [("add->order", "timeout")] * 4
    assert statuses(11) == [("add->order", "timeout")] * 2 + [("add->order->pay", "matched")] * 2
    absent = (
        patterns.Pattern.begin("add", "kind = 'add'").followed_by("order", "kind = 'order'")
        .not_followed_by("pay", "kind = 'pay'").within(11 * SECOND)
    )
    assert patterns.match_pattern(cart, ["user"], ["ts", "seq"], absent, ["at"]).count() == 2


@pytest.fixture(scope="module")
def clicks(spark):
    """Ad clicks as in the sample: one pair with 121 clicks in two minutes, 22 other clicks, all on one local day."""
    busy = [(937166, 1715, "beijing", 1511661601 + i) for i in range(119)]
    busy += [(937166, 1715, "beijing", 1511661710), (937166, 1715, "beijing", 1511661711)]
    other = [(i, i % 7, ["guangdong", "zhejiang", "henan"][i % 3], 1511658000 + 60 * i) for i in range(22)]
    rows = [(i, *r) for i, r in enumerate(other + busy)]
    df = spark.createDataFrame(rows, "seq long, user long, ad long, province string, at long")
    return df.withColumn("ts", F.timestamp_seconds("at"))


def test_blacklist(clicks):
    args = (clicks, ["user", "ad"], ["seq"], "ts", 100)
    warned = alerts.blacklist_warnings(*args).collect()
    assert [(r["user"], r["ad"], r["at"]) for r in warned] == [(937166, 1715, 1511661700)]
    passed = alerts.blacklist_pass(*args)
    assert passed.count() == 22 + 99
    counts = windows.hop_count(passed, ["province"], "ts", timedelta(hours=1), 5 * SECOND)
    total, top = counts.agg(F.sum("cnt"), F.max(F.struct("cnt", "province"))).first()
    assert total == 121 * 720 and (top["cnt"], top["province"]) == (99, "beijing")


def test_blacklist_starts_again_at_local_midnight(spark):
    midnight = 1511712000  # 2017-11-27 00:00 at UTC+8
    df = spark.createDataFrame([(i, 1, midnight - 2 + i) for i in range(4)], "seq long, user long, at long")
    passed = alerts.blacklist_pass(df.withColumn("ts", F.timestamp_seconds("at")), ["user"], ["seq"], "ts", 2)
    assert rows_of(passed.select("seq")) == [(0,), (2,)]


def test_no_decrease_rules(spark):
    def alarms(temps):
        df = spark.createDataFrame([(i, "s", t, v) for i, (t, v) in enumerate(temps)], "seq long, id string, at long, v double")
        got = alerts.no_decrease_alarm(df.withColumn("ts", F.timestamp_seconds("at")), ["id"], ["ts", "seq"], "v", 10 * SECOND)
        return [r[0] for r in rows_of(got.select(F.unix_seconds("alarm_ts")))]

    assert alarms([(0, -5.0), (4, -5.0), (9, -4.0)]) == [10]
    assert alarms([(0, 1.0), (10, 0.5), (11, 2.0)]) == [21]
    assert alarms([(0, 1.0), (11, 2.0), (12, 3.0), (30, 4.0), (35, 1.0)]) == [10, 21]
    assert alarms([(0, 1.0), (5, 0.5), (6, 0.6), (7, 0.4)]) == []


def test_fail_window_rules(spark):
    def found(events):
        rows = [(i, "u", t, k) for i, (t, k) in enumerate(events)]
        df = spark.createDataFrame(rows, "seq long, user string, at long, kind string")
        got = alerts.fail_windows(df.withColumn("ts", F.timestamp_seconds("at")), ["user"], ["ts", "seq"], failed(), 2 * SECOND)
        return rows_of(got.select(F.unix_seconds("first_ts"), F.unix_seconds("last_ts"), "cnt"))

    assert found([(0, "fail"), (1, "fail"), (2, "fail"), (3, "fail"), (4, "fail")]) == [(0, 2, 3), (3, 4, 2)]
    assert found([(0, "fail"), (1, "fail"), (2, "success")]) == []
    assert found([(0, "fail"), (1, "fail"), (3, "success")]) == [(0, 1, 2)]


def test_stage_names_are_checked():
    pattern = patterns.Pattern.begin("a", "x")
    with pytest.raises(ValueError):
        pattern.next("a", "y")
    with pytest.raises(KeyError):
        pattern.stage("b")


def test_running_count_depth(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, t long")
    got = rows_of(scan(df, ["k"], ["t"], {"n": running_count()}))
    assert got == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]
