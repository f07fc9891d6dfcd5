"""NULL keys, NULL readings, large ids and folder tables."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows_of
from streamlab.functions import user_functions
from streamlab.operators import alerts
from streamlab.plans.streams import event_stream

START = datetime(2024, 1, 1)


def readings(spark, values, key="a"):
    rows = [(key, START + timedelta(seconds=i), i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp, id bigint, v double")


def test_null_readings_are_no_rise(spark):
    def alarms(values):
        return alerts.no_decrease_alarm(readings(spark, values), ["k"], ["ts", "id"], "v", timedelta(seconds=2)).collect()
    assert [r.rise_ts for r in alarms([5.0, 4.0, None, 3.0])] == []
    assert [r.rise_ts for r in alarms([5.0, 4.0, None, 6.0])] == [START + timedelta(seconds=3)]


def test_null_and_large_keys_of_failure_windows(spark):
    rows = [(None, START, 0), (None, START + timedelta(seconds=1), 1), (None, START + timedelta(seconds=2), 2),
            (2**53, START, 3), (2**53 + 1, START + timedelta(seconds=1), 4)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp, id bigint").withColumn("_chain", F.lit(0)).withColumn("_stop", F.lit(None).cast("timestamp"))
    got = alerts._anchor_windows(df, ["k"], "ts", timedelta(seconds=5)).select("k", "cnt")
    assert rows_of(got) == rows_of(spark.createDataFrame([(None, 3), (2**53, 1), (2**53 + 1, 1)], "k bigint, cnt bigint"))


def test_large_keys_of_user_aggregates(spark):
    df = spark.createDataFrame([(2**53, 2.0), (2**53 + 1, 4.0), (None, 1.0), (None, 3.0)], "k bigint, v double")
    average = user_functions.average_with_state(df, ["k"], "v", "m")
    assert {r.k: r.m for r in average.collect()} == {2**53: 2.0, 2**53 + 1: 4.0, None: 2.0}
    top = user_functions.top_with_state(df, ["k"], "v", 1)
    assert {r.k: r.v for r in top.collect()} == {2**53: 2.0, 2**53 + 1: 4.0, None: 3.0}


def test_stream_of_a_folder_table(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/events.parquet").repartition(3).write.parquet(f"file://{tmp_path}/events.parquet")
    for folder, name in ((f"file://{tmp_path}", "parts"), (source, "one")):
        query = event_stream(spark, folder).writeStream.format("memory").queryName(f"rows_{name}").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(f"rows_{name}").count() == spark.read.parquet(f"{source}/events.parquet").count()
