"""Projection, routing, plain aggregates, functions and payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from streamlab.functions import user_functions as uf
from streamlab.operators import joins, rolling, route
from streamlab.plans.registry import events, query, table
from streamlab.sources import parse


@query("filter_map", "SELECT event_id, user_id + 1 AS next_user, upper(event_type) AS kind FROM events WHERE value > 100")
def filter_map(spark, d):
    return events(spark, d).where("value > 100").select(
        "event_id", (F.col("user_id") + 1).alias("next_user"), F.upper("event_type").alias("kind"))


@query("sql_select_where", "SELECT user_id, ts, value FROM events WHERE event_type = 'click'")
def sql_select_where(spark, d):
    return spark.sql("SELECT user_id, ts, value FROM {t} WHERE event_type = 'click'", t=events(spark, d))


@query("word_count", """
    SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def word_count(spark, d):
    return route.words(table(spark, d, "documents"), "text").groupBy("word").agg(F.count("*").alias("cnt"))


@query("distinct_words", """
    SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''""")
def distinct_words(spark, d):
    return route.distinct_first(route.words(table(spark, d, "documents"), "text"), ["word"])


@query("word_dictionary", """
    SELECT doc_id, string_agg(word || '=' || cnt, ';' ORDER BY word) AS dictionary FROM (
      SELECT doc_id, word, count(*) AS cnt
      FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''
      GROUP BY doc_id, word)
    GROUP BY doc_id""")
def word_dictionary(spark, d):
    return route.word_counts(table(spark, d, "documents"), "doc_id", "text", "dictionary")


@query("split_high_low", """
    SELECT event_id, value, CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS tag FROM events""")
def split_high_low(spark, d):
    tagged = route.tagged(events(spark, d).select("event_id", "value"), {"high": F.col("value") > 30}, "low")
    return route.select_tags(tagged, "high", "low")


@query("side_output_typed", """
    SELECT 'main' AS output, event_id, value, '' AS message FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT 'side', -1, 0.0, 'user ' || user_id || ' failed' FROM events WHERE event_type = 'error'""")
def side_output_typed(spark, d):
    tagged = route.tagged(events(spark, d), {"side": F.col("event_type") == "error"}, "main")
    outputs = route.side_outputs(tagged, {
        "main": lambda x: x.select(F.lit("main").alias("output"), "event_id", "value"),
        "side": lambda x: x.select(
            F.lit("side").alias("output"),
            F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" failed")).alias("message")),
    })
    both = outputs["main"].unionByName(outputs["side"], allowMissingColumns=True)
    return both.fillna({"event_id": -1, "value": 0.0, "message": ""})


@query("connect_co_map", """
    SELECT 'left' AS origin, user_id AS id, value AS amount, event_type AS note, NULL::VARCHAR AS priority FROM events
    UNION ALL
    SELECT 'right', o_custkey, o_totalprice, NULL, o_orderpriority FROM orders""")
def connect_co_map(spark, d):
    return route.connect(
        events(spark, d), table(spark, d, "orders"),
        {"id": F.col("user_id"), "amount": F.col("value"), "note": F.col("event_type")},
        {"id": F.col("o_custkey"), "amount": F.col("o_totalprice"), "priority": F.col("o_orderpriority")})


@query("union_all", """
    SELECT event_id, user_id FROM events WHERE event_type = 'click' UNION ALL
    SELECT event_id, user_id FROM events WHERE value > 50 UNION ALL
    SELECT event_id, user_id FROM events WHERE event_type = 'view'""")
def union_all(spark, d):
    e = events(spark, d)
    return route.union_all(*[e.where(c).select("event_id", "user_id")
                             for c in ("event_type = 'click'", "value > 50", "event_type = 'view'")])


@query("rich_map", "SELECT event_id, length(event_type)::INTEGER AS type_length FROM events")
def rich_map(spark, d):
    def transform(cache: dict, batch: pd.DataFrame) -> pd.DataFrame:
        for kind in batch["event_type"].unique():
            cache.setdefault(kind, len(kind))
        return pd.DataFrame({"event_id": batch["event_id"], "type_length": batch["event_type"].map(cache)})

    return route.map_with_setup(events(spark, d).select("event_id", "event_type"),
                                "event_id bigint, type_length int", dict, transform)


@query("group_count_min_max", """
    SELECT user_id, event_type, count(*) AS cnt, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2""")
def group_count_min_max(spark, d):
    return events(spark, d).groupBy("user_id", "event_type").agg(
        F.count("*").alias("cnt"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("group_sum", """
    SELECT o_orderpriority, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents FROM orders GROUP BY 1""")
def group_sum(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


_CENTS = "CAST(round(value * 100) AS BIGINT)"


def cents():
    return F.round(F.col("value") * 100).cast("long")


@query("rolling_sum", f"""
    SELECT event_id, user_id, sum({_CENTS}) OVER w ::BIGINT AS total FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_sum(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "value")
    return rolling.rolling_sum(e, ["user_id"], ["ts", "event_id"], cents(), "total").select(
        "event_id", "user_id", "total")


@query("rolling_max", """
    SELECT event_id, user_id, max(value) OVER w AS value, first_value(event_type) OVER w AS event_type,
           first_value(ts) OVER w AS first_ts
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_max(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "value", "event_type", F.col("ts").alias("first_ts"))
    return rolling.rolling_extreme(e, ["user_id"], ["ts", "event_id"], "value", ["event_type", "first_ts"]).select(
        "event_id", "user_id", "value", "event_type", "first_ts")


@query("rolling_max_by", """
    SELECT event_id, user_id, arg_max(event_id, (value, -event_id)) OVER w AS best_event,
           max(value) OVER w AS best_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_max_by(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "value")
    best = rolling.rolling_max_by(e, ["user_id"], ["ts", "event_id"], "value", ["event_id", "value"])
    return best.select("event_id", "user_id", F.col("best.event_id").alias("best_event"),
                       F.col("best.value").alias("best_value"))


def _seen(state, row):
    value, ts = row
    return (value, ts, 1) if state is None else (max(state[0], value), ts, state[2] + 1)


@query("rolling_reduce", """
    SELECT event_id, user_id, max(value) OVER w AS top, ts AS latest,
           count(*) OVER w AS seen
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_reduce(spark, d):
    """A user's fold: the largest value so far, the time of the latest row and the number of rows."""
    reducer = rolling.Reducer(
        ("value", "ts"), "top double, latest timestamp_ntz, seen bigint", _seen,
        lambda a, b: (max(a[0], b[0]), b[1], a[2] + b[2]))
    e = events(spark, d).select("event_id", "user_id", "ts", "value")
    return rolling.rolling_reduce(e, ["user_id"], ["ts", "event_id"], reducer).select("event_id", "user_id", "top", "latest", "seen")


@query("first_per_key", """
    SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def first_per_key(spark, d):
    """Rows at which a key appears for the first time (running count of one)."""
    e = events(spark, d).select("event_id", "user_id", "event_type", "ts")
    counted = rolling.rolling_count(e, ["user_id", "event_type"], ["ts", "event_id"], "n")
    return counted.where("n = 1").select("event_id", "user_id", "event_type")


@query("key_history", """
    SELECT event_id, user_id, row_number() OVER w AS depth, coalesce(lag(event_id) OVER w, -1) AS continues_event,
           lag(event_type) OVER w AS continues_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def key_history(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "event_type")
    linked = rolling.history_links(e, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])
    return linked.select("event_id", "user_id", "depth", F.coalesce("continues.event_id", F.lit(-1)).alias("continues_event"),
                         F.col("continues.event_type").alias("continues_type"))


@query("changelog_count", """
    WITH n AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS cnt
               FROM events)
    SELECT event_id, event_type, true AS is_add, cnt FROM n
    UNION ALL SELECT event_id, event_type, false, cnt - 1 FROM n WHERE cnt > 1""")
def changelog_count(spark, d):
    e = events(spark, d).select("event_id", "event_type", "ts")
    return rolling.changelog(e, ["event_type"], ["ts", "event_id"]).drop("ts")


@query("over_count_range", """
    SELECT event_id, user_id, count(*) OVER w AS over_count FROM (SELECT *, date_trunc('day', ts) AS day FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def over_count_range(spark, d):
    return _over(spark, d).select("event_id", "user_id", "over_count")


@query("over_max_range", """
    SELECT event_id, user_id, max(value) OVER w AS over_max FROM (SELECT *, date_trunc('day', ts) AS day FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def over_max_range(spark, d):
    return _over(spark, d).select("event_id", "user_id", "over_max")


def _over(spark, d):
    e = events(spark, d).select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    return rolling.over_range(e, ["user_id"], ["day"], "value")


@query("lateral_split", """
    SELECT p_partkey, word, length(word)::INTEGER AS word_length
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""")
def lateral_split(spark, d):
    return joins.lateral_words(table(spark, d, "part"), "p_name", " ", ["p_partkey"])


@query("udf_length", "SELECT event_id, length(event_type)::INTEGER AS type_length FROM events")
def udf_length(spark, d):
    return events(spark, d).select("event_id", uf.text_length_udf("event_type").alias("type_length"))


@query("udtf_split", """
    SELECT p_partkey, word, length(word)::INTEGER AS word_length
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""")
def udtf_split(spark, d):
    uf.register(spark)
    return spark.sql("SELECT p_partkey, w.word, w.word_length FROM {t}, LATERAL split_words(p_name, ' ') w",
                     t=table(spark, d, "part"))


@query("udaf_avg", f"SELECT user_id, avg({_CENTS}) AS mean_cents FROM events GROUP BY user_id")
def udaf_avg(spark, d):
    e = events(spark, d).select("user_id", cents().alias("cents"))
    return uf.average_with_state(e, ["user_id"], "cents", "mean_cents")


@query("top2_table_aggregate", """
    SELECT user_id, value, rank FROM (
      SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC)::INTEGER AS rank FROM events)
    WHERE rank <= 2""")
def top2_table_aggregate(spark, d):
    return uf.top_with_state(events(spark, d), ["user_id"], "value", 2)


@query("delimited_parse", """
    SELECT event_id, user_id, event_type, value FROM events""")
def delimited_parse(spark, d):
    lines = events(spark, d).select(F.concat_ws(",", "event_id", "user_id", "event_type", "value").alias("line"))
    fields = [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double")]
    return parse.records(parse.delimited(lines, "line", fields))


@query("delimited_rejects", """
    SELECT event_id || ',' || event_type || ',' || user_id AS line FROM events WHERE event_type = 'error'""")
def delimited_rejects(spark, d):
    swapped = F.col("event_type") == "error"
    lines = events(spark, d).select(F.concat_ws(
        ",", "event_id", F.when(swapped, F.col("event_type")).otherwise(F.col("user_id").cast("string")),
        F.when(swapped, F.col("user_id").cast("string")).otherwise(F.col("event_type"))).alias("line"))
    return parse.rejects(parse.delimited(
        lines, "line", [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string")]))


@query("csv_payload", "SELECT event_id, user_id, value FROM events")
def csv_payload(spark, d):
    messages = events(spark, d).select(parse.to_csv_message("event_id", "user_id", "value"))
    return parse.csv_payload(messages, "value", "event_id bigint, user_id bigint, value double")


@query("json_payload", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_payload(spark, d):
    e = events(spark, d)
    message = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "), F.expr("substring(props, 2)"))
    return parse.json_payload(e.select(message.alias("value")), "value", "event_id bigint, k bigint")


_MESSAGE = """'{"event_id": ' || event_id || ', "value": ' || CASE WHEN event_type = 'error' THEN 'oops' ELSE '1' END ||
    CASE WHEN event_type = 'click' THEN '' ELSE '}' END"""


def _messages(spark, d):
    kind = F.col("event_type")
    message = F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "value": '), F.when(kind == "error", "oops").otherwise("1"),
        F.when(kind == "click", "").otherwise("}"))
    return events(spark, d).select(message.alias("value"))


@query("payload_rejects", f"SELECT {_MESSAGE} AS line FROM events WHERE event_type IN ('error', 'click')")
def payload_rejects(spark, d):
    """Messages that are no JSON, or no JSON of the schema."""
    return parse.rejects(parse.checked_payload(_messages(spark, d), "value", "event_id bigint, value double", required=["event_id"]))


@query("payload_records", "SELECT event_id, 1.0::DOUBLE AS value FROM events WHERE event_type NOT IN ('error', 'click')")
def payload_records(spark, d):
    return parse.records(parse.checked_payload(_messages(spark, d), "value", "event_id bigint, value double", required=["event_id"]))


@query("csv_payload_rejects", "SELECT event_id || ',' || event_type AS line FROM events WHERE event_id % 3 = 0")
def csv_payload_rejects(spark, d):
    short = F.col("event_id") % 3 == 0
    lines = events(spark, d).select(F.concat_ws(
        ",", "event_id", "event_type", F.when(~short, F.col("user_id").cast("string"))).alias("value"))
    return parse.rejects(parse.checked_payload(lines, "value", "event_id bigint, event_type string, user_id bigint", "csv"))


@query("json_documents", """
    SELECT event_type || '|' || user_id AS doc_key,
           '{"event_type":"' || event_type || '","user_id":' || user_id || ',"cnt":' || count(*) || '}' AS body
    FROM events GROUP BY event_type, user_id""")
def json_documents(spark, d):
    from streamlab.sinks.documents import as_documents

    counts = events(spark, d).groupBy("event_type", "user_id").agg(F.count("*").alias("cnt"))
    return as_documents(counts, ["event_type", "user_id"])


@query("ddl_computed_ts", """
    SELECT event_id, date_trunc('second', ts) AS rt FROM events""")
def ddl_computed_ts(spark, d):
    millis = events(spark, d).select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))
    with_time = millis.withColumn("rt", F.expr("to_timestamp(from_unixtime(millis div 1000, 'yyyy-MM-dd HH:mm:ss'))"))
    return with_time.select("event_id", F.col("rt").cast("timestamp_ntz").alias("rt"))


def log_lines(spark, d):
    """Access-log lines: each event is a hit of its user on the page of the same number."""
    pages = table(spark, d, "pages").select("page_id", "url")
    hits = events(spark, d).join(pages, F.col("user_id") == F.col("page_id"))
    time = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    return hits.select(F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(250)).cast("string")), F.col("user_id").cast("string"),
        F.lit("-"), time, F.lit("+0000"), F.lit("GET"), "url").alias("line"))


@query("log_parse", """
    SELECT '10.0.0.' || (user_id % 250) AS ip, user_id::VARCHAR AS user_id, date_trunc('second', ts) AS event_time,
           'GET' AS method, url
    FROM events JOIN pages ON page_id = user_id""")
def log_parse(spark, d):
    parsed = parse.records(parse.access_log(log_lines(spark, d), "line"))
    return parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
