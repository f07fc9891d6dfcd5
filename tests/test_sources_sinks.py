import os
import subprocess
import sys
import time
from collections import Counter
from datetime import timedelta
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from streams import replay

from streamlab.functions import user_functions as uf
from streamlab.operators import late, rolling, route
from streamlab.operators.windows import Agg
from streamlab.plans import jobs
from streamlab.sinks import documents, files, jdbc, keyed
from streamlab.sources import messages, parse, tables
from streamlab.sources.replay import TableReplay
from streamlab.streaming import windows as sw
from streamlab.streaming.run import run_to_end, work_folder

HOUR = timedelta(hours=1)


def test_delimited_lines_and_rejects(spark):
    df = spark.createDataFrame([("1,a,2.5",), ("x,a,1",), ("2,b",), ("3,,4",)], "line string")
    parsed = parse.delimited(df, "line", [("id", "bigint"), ("name", "string"), ("value", "double")])
    assert rows_of(parse.records(parsed)) == [(1, "a", 2.5), (3, "", 4.0)]
    assert rows_of(parse.rejects(parsed)) == [("2,b",), ("x,a,1",)]


def test_access_log(spark):
    df = spark.createDataFrame(
        [("83.1.2.3 7 - 17/05/2015:10:05:03 +0000 GET /index.html",), ("broken line",)], "line string")
    parsed = parse.access_log(df, "line")
    row = parse.records(parsed).first()
    assert (row["ip"], row["user_id"], row["method"], row["url"]) == ("83.1.2.3", "7", "GET", "/index.html")
    assert str(row["event_time"]) == "2015-05-17 10:05:03"
    assert rows_of(parse.rejects(parsed)) == [("broken line",)]


def test_payload_round_trips(spark, events):
    e = events.select("event_id", "user_id", "event_type")
    schema = "event_id bigint, user_id bigint, event_type string"
    as_json = e.select(parse.to_json_message(*e.columns))
    as_csv = e.select(parse.to_csv_message(*e.columns))
    assert rows_of(parse.json_payload(as_json, "value", schema)) == rows_of(e)
    assert rows_of(parse.csv_payload(as_csv, "value", schema)) == rows_of(e)


def test_message_options():
    assert messages.read_options("h:9", "t")["startingOffsets"] == "latest"
    assert messages.read_options("h:9", "t", "earliest", 5)["maxOffsetsPerTrigger"] == "5"
    assert messages.write_options("h:9", "t") == {"kafka.bootstrap.servers": "h:9", "topic": "t", "kafka.acks": "all"}


def test_table_spec(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("s1,1611200070822,76.3\ns2,1611200071697,73.9\n")
    spec = tables.TableSpec(
        str(tmp_path / "in"), "id string, ts bigint, temp double",
        computed={"rt": "to_timestamp(from_unixtime(ts div 1000))"}, watermark=("rt", "1 second"))
    spec.register(spark, "sensor")
    got = spark.sql("select id, temp from sensor where id = 's1' and year(rt) = 2021")
    assert rows_of(got) == [("s1", 76.3)]
    assert spec.read_stream(spark).isStreaming
    assert tables.text_lines(spark, str(tmp_path / "in")).count() == 2
    timed = tables.from_rows(spark, [(5, 5000)], "s long, ms long").select(
        tables.event_time(seconds="s").alias("a"), tables.event_time(millis="ms").alias("b"), tables.arrival_time())
    assert timed.first()["a"] == timed.first()["b"]


def test_csv_file_sink(spark, events, tmp_path):
    rows = events.where("user_id < 5").select("event_id", "user_id", "event_type")
    source = replay(spark, rows, 3, ["event_id"])
    query = files.append_files(source.stream(), str(tmp_path / "out"), str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    back = spark.read.schema(rows.schema).csv(str(tmp_path / "out"))
    assert rows_of(back) == rows_of(rows)


def test_keyed_table_replay_and_compaction(spark, tmp_path):
    table = keyed.KeyedTable(str(tmp_path / "t"), ("k",))
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 5), ("b", 3, 7)], "k string, seq long, v long")
    second = spark.createDataFrame([("a", 4, 9)], "k string, seq long, v long")
    table.upsert(first, 0, ["seq"])
    table.upsert(second, 1, ["seq"])
    expected = [("a", 4, 9), ("b", 3, 7)]
    assert rows_of(table.latest(spark)) == expected
    table.upsert(second, 1, ["seq"])
    assert rows_of(table.latest(spark)) == expected
    assert rows_of(table.compact_into(spark, str(tmp_path / "c"), 1).latest(spark)) == expected


def test_update_mode_counts_into_a_keyed_table(spark, events, tmp_path):
    rows = events.where("user_id < 20").withColumn("ts", F.col("ts").cast("timestamp"))
    source = replay(spark, rows, 4, ["event_id"])
    table = keyed.KeyedTable(str(tmp_path / "t"), ("event_type", "window_end"))
    counted = sw.tumble(source.stream().withWatermark("ts", "1 hour"), ["event_type"], "ts", timedelta(days=1), {"cnt": Agg("count")})
    run_to_end(counted, str(tmp_path / "check"), mode="update", each_batch=table.upsert)
    expected = rows.groupBy("event_type", F.window("ts", "1 day").alias("w")).count().select("event_type", "w.end", "count")
    assert rows_of(table.latest(spark).select("event_type", "window_end", "cnt")) == rows_of(expected)


def test_fan_out_to_two_sinks(spark, events, tmp_path):
    source = replay(spark, events.select("event_id", "event_type", "value"), 2, ["event_id"])
    tagged = route.tagged(source.stream(), {"side": F.col("event_type") == "error"}, "main")

    def to(name):
        return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/b={batch_id}")

    run_to_end(tagged, str(tmp_path / "check"), each_batch=files.fan_out({"main": to("main"), "side": to("side")}))
    assert spark.read.parquet(f"{tmp_path}/side").count() == events.where("event_type = 'error'").count()
    assert spark.read.parquet(f"{tmp_path}/main").count() == events.where("event_type <> 'error'").count()


def test_jdbc_statement():
    assert jdbc.merge_statement("t", "s", ["k"], ["k", "v"]) == (
        "MERGE INTO t t USING s s ON t.k = s.k WHEN MATCHED THEN UPDATE SET t.v = s.v"
        " WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)")


def test_documents(spark):
    df = spark.createDataFrame([("a", 1)], "word string, cnt long")
    assert rows_of(documents.as_documents(df, ["word"])) == [("a", '{"word":"a","cnt":1}')]


def test_table_replay_source(spark, events, tmp_path):
    spark.dataSource.register(TableReplay)
    stream = spark.readStream.format("table_replay").schema("event_id bigint, ts timestamp").load(
        path="/root/testdata/sf0.001/events.parquet", time="ts", slice_seconds=str(5 * 86400))
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
    )
    try:
        for _ in range(60):
            time.sleep(1)
            if query.exception():
                raise query.exception()
            if len(query.recentProgress) > 7:
                break
    finally:
        query.stop()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back) == rows_of(events.select("event_id", F.col("ts").cast("timestamp")))


def test_user_functions(spark, events):
    uf.register(spark)
    assert spark.sql("select text_length('abc') a").first()["a"] == 3
    assert rows_of(spark.sql("select * from split_words('ab_c', '_')")) == [("ab", 2), ("c", 1)]
    e = events.withColumn("k", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    ints = e.select("k", "event_id")
    assert rows_of(uf.average_with_state(ints, ["k"], "event_id", "m")) == rows_of(ints.groupBy("k").agg(F.avg("event_id")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        top = uf.top_with_state(ints.repartition(3), ["k"], "event_id", 2).orderBy("k", "rank")
        expected = ints.selectExpr("k", "event_id", "row_number() over (partition by k order by event_id desc) r").where("r <= 2")
        assert rows_of(top) == rows_of(expected)
        assert rows_of(uf.average_with_state(ints.repartition(3), ["k"], "event_id", "m")) == rows_of(
            ints.groupBy("k").agg(F.avg("event_id")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    negative = spark.createDataFrame([("a", -2.0), ("a", -1.0), ("a", -3.0)], "k string, v double")
    assert [r["v"] for r in uf.top_with_state(negative, ["k"], "v", 2).orderBy("rank").collect()] == [-1.0, -2.0]


def test_routing(spark, events):
    tagged = route.tagged(events, {"high": F.col("value") > 30}, "low")
    assert route.select_tags(tagged, "high", "low").count() == events.count()
    opened = route.map_with_setup(events.select("event_id"), "event_id long", lambda: {"n": 1}, lambda r, b: b + r["n"])
    assert opened.agg(F.sum("event_id")).first()[0] == events.selectExpr("sum(event_id + 1)").first()[0]


def test_changelog_is_a_running_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, t long")
    assert rows_of(rolling.changelog(df, ["k"], ["t"])) == [("a", 1, True, 1), ("a", 2, False, 1), ("a", 2, True, 2)]


def test_history_text(spark):
    row = spark.createDataFrame([("x", 3)], "k string, depth long").select(rolling.history_text("k", "depth")).first()
    assert row[0] == "x_x_x"


def test_kept_and_late_rows_are_all_rows(events):
    split = late.late_split(events.withColumn("seq", (F.col("event_id") * 37) % 1000), ["seq", "event_id"], "ts", HOUR, HOUR)
    counts = dict(rows_of(split.groupBy("is_late").count()))
    assert counts[True] > 0 and counts[True] + counts[False] == events.count()


def test_work_folder_uses_the_shared_folder():
    def session(folder, master):
        settings = {} if folder is None else {"spark.checkpoint.dir": folder}
        conf = SimpleNamespace(get=settings.get, set=settings.__setitem__)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert work_folder(session("/shared/folder/", "spark://host:7077"), "x") == "/shared/folder/x"
    alone = session(None, "local[2]")
    assert work_folder(alone, "x").endswith("/x") and work_folder(alone, "y") == work_folder(alone, "x")[:-1] + "y"
    with pytest.raises(ValueError):
        work_folder(session(None, "spark://host:7077"), "x")


@pytest.mark.parametrize("name", ["hot_items", "page_views", "unique_visitors", "channel_report"])
def test_streaming_jobs_equal_batch_jobs(spark, events, name, tmp_path):
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).drop("props")
    far = [{"ts": pd.Timestamp("2024-04-01") + pd.Timedelta(days=i), "user_id": -1} for i in range(2)]
    source = replay(spark, rows, 3, ["event_id"], far)
    folder = str(tmp_path)
    jobs.STREAM[name](source.stream().withWatermark("ts", "1 hour"), f"{folder}/out", f"{folder}/check")
    got = spark.read.parquet(f"{folder}/out").where("window_end < '2024-03-01'")
    expected = jobs.BATCH[name](rows)
    assert rows_of(got.select(*expected.columns)) == rows_of(expected)


def test_hot_urls_with_late_hits(spark, events, tmp_path):
    """The stream's watermark moves per micro-batch, so with a wide lateness it keeps all rows and equals the batch job."""
    hits = events.where("user_id < 8").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("/p"), F.col("user_id")).alias("url"))
    hits = hits.withColumn("seq", F.col("event_id") + (F.col("event_id") * 37) % 50)
    day = timedelta(days=5)
    source = replay(spark, hits, 3, ["seq"])
    table = keyed.KeyedTable(str(tmp_path / "t"), ("url", "window_end"))
    jobs.hot_urls_stream(source.stream(), HOUR, day, table, str(tmp_path / "check"))
    columns = ["window_end", "rank", "url", "cnt"]
    expected = jobs.hot_urls(hits, HOUR, day).select(*columns)
    assert rows_of(jobs.hot_urls_now(spark, table).select(*columns)) == rows_of(expected)


def test_count_and_alarm_to_two_sinks(spark, events, tmp_path):
    rows = events.where("user_id < 6").select("user_id", "event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    far = [{"ts": pd.Timestamp("2024-04-01") + pd.Timedelta(days=i), "user_id": -1} for i in range(2)]
    source = replay(spark, rows, 3, ["event_id"], far)

    def to(name):
        return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/b={batch_id}")

    args = (["user_id"], ["ts", "event_id"], "value", timedelta(hours=8))
    jobs.count_and_alarm_stream(source.stream().withWatermark("ts", "5 days"), *args,
                                {"count": to("count"), "alarm": to("alarm")}, str(tmp_path / "check"))
    expected = jobs.count_and_alarm(rows, *args)
    for name, columns, ours in (("count", ["user_id", "at_ts", "cnt"], ["user_id", "ts", "cnt"]),
                                ("alarm", ["user_id", "at_ts"], ["user_id", "alarm_ts"])):
        got = spark.read.parquet(f"{tmp_path}/{name}").where("user_id >= 0").select(*columns)
        assert rows_of(got) == rows_of(expected[name].select(*ours))


def test_processing_time_windows(spark, events, tmp_path):
    rows = events.select("event_id", "event_type")
    source = replay(spark, rows, 2, ["event_id"])
    arrived = source.stream().withColumn("pt", tables.arrival_time()).withWatermark("pt", "0 seconds")
    table = keyed.KeyedTable(str(tmp_path / "t"), ("event_type", "window_end"))
    counted = sw.tumble(arrived, ["event_type"], "pt", timedelta(seconds=10), {"cnt": Agg("count")})
    run_to_end(counted, str(tmp_path / "check"), mode="update", each_batch=table.upsert)
    totals = table.latest(spark).groupBy("event_type").agg(F.sum("cnt"))
    assert rows_of(totals) == rows_of(rows.groupBy("event_type").count())


def test_entry_and_queries_have_matching_names():
    root = Path(__file__).resolve().parents[1]
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True,
                          env={**os.environ}, check=True)
    assert int(done.stdout.strip().split()[-1]) > 60


def test_bad_messages_are_rejects(spark):
    lines = ['{"id": 1, "v": 2.5}', '{"id": 1, "v": "x"}', "{", "", None, '{"v": 1}', '{"id": 2}', "[]"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = parse.checked_payload(df, "value", "id bigint, v double", required=["id"])
    assert rows_of(parse.records(parsed)) == [(1, 2.5), (2, None)]
    assert rows_of(parse.rejects(parsed)) == sorted([(x,) for x in lines if x not in (lines[0], lines[6])], key=repr)
    table = spark.createDataFrame([("1,a",), ("x,a",), ("1",), ("1,a,b",), (None,)], "value string")
    parsed = parse.checked_payload(table, "value", "id bigint, name string", "csv")
    assert rows_of(parse.records(parsed)) == [(1, "a")] and parse.rejects(parsed).count() == 4


def test_word_counts(spark):
    """Keys that come once are counted within their row; repeated and NULL keys over all their rows."""
    rows = [(1, "b a b"), (2, ""), (3, None), (4, "  "), (5, "x  y"), (5, "y z"), (None, "n n"), (None, "m"), (6, "é e É  e é"), (7, "one"), (8, None), (8, "p"),
            (9, " ".join(str(i % 700) for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    want = {}
    for key, text in rows:
        words = [w for w in (text or "").split(" ") if w]
        if words:
            want.setdefault(key, Counter()).update(words)
    got = route.word_counts(docs, "doc_id", "text", "dictionary")
    assert {r.doc_id: r.dictionary for r in got.collect()} == {
        k: ";".join(f"{w}={n}" for w, n in sorted(c.items(), key=lambda x: x[0].encode())) for k, c in want.items()}
    assert got.count() == len(want)
