"""Benchmark decontamination by winnowing: words of documents that lie inside a passage of a benchmark item.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. A text's windows
are named by their print: the least hash of the ``GRAM``-word grams inside. Neighbouring windows mostly have the same
print, so a document gives one row for each run of equal prints, about one for three or four words. Equal windows have equal
prints, so every shared span of ``WINDOW`` words or more meets its item in the join on prints, which keeps few documents. Only
for these the words at the runs found are spelled out, joined with the items' windows as text, and so confirmed exactly.
An item shorter than a window is looked for as one gram of its own length (the window of the winnowing is then one gram).

All is DataFrame operations. The prints join takes documents' rows of a few numbers; whole texts are read a second time, and
moved only if the documents found are too many to broadcast (``SENT_ROWS``, ``SENT_RUNS``, both counted). A document's runs and
windows are grouped under its id and a hash of its text, with partial sets before the shuffle, so rows repeated whole
cost one group each.

Defined cases: a null or blank text has no words; A-Z are lower-cased, no other letter; repeated rows give repeated results. Rows
of the items with the same id are one item; a null item id counts as the empty name; an item without words has no window. Other
columns are ignored, whatever their names. Empty tables give empty results, an empty item table finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, fresh_folder

#: Whatever lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, and of the grams whose least hash names it.
WINDOW, GRAM = 10, 5
#: Documents found, and their runs, that are broadcast; beyond either the join shuffles.
SENT_ROWS, SENT_RUNS = 50_000, 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str | Column) -> Column:
    text = as_text(text)
    # lower() also changes letters beyond A-Z, so it serves texts without such letters alone
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, words); the key tells apart texts under one id."""
    return df.select(
        F.col(id_col).alias("id"), F.xxhash64(as_text(text_col)).alias("key"), words(text_col).alias("words"))


def _shifted(left: str, right: str, by: int, join) -> Column:
    """``join`` of each element of ``left`` with the element of ``right`` that lies ``by`` places further on."""
    n = F.greatest(F.size(right) - by, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, by + 1, n), join)


def _spread(df: DataFrame, column: str, width: int, join) -> DataFrame:
    """``column`` with each element joined with its next ``width - 1``, by doubling. Each step is a projection of its own,
    so that no step is computed again for every element of the next."""
    whole, done = df, 1
    parts = {1: column}
    while done * 2 <= width:
        name = f"_{column}{done * 2}"
        whole = whole.withColumn(name, _shifted(parts[done], parts[done], done, join))
        done *= 2
        parts[done] = name
    got, size = parts[done], done
    for step in sorted(parts, reverse=True):
        while size + step <= width:
            name = f"_{column}_{size + step}"
            whole = whole.withColumn(name, _shifted(got, parts[step], size, join))
            got, size = name, size + step
    return whole.withColumn(f"{column}_joined", F.col(got)).drop(*[c for c in whole.columns if c.startswith(f"_{column}")])


def _prints(rows: DataFrame) -> DataFrame:
    """``rows`` with ``prints``: the print of the window at each place."""
    hashed = rows.withColumn("w", F.transform("words", lambda word: F.xxhash64(word)))
    grams = _spread(hashed, "w", GRAM, lambda a, b: F.xxhash64(a, b)).withColumnRenamed("w_joined", "g")
    least = _spread(grams, "g", WINDOW - GRAM + 1, lambda a, b: F.least(a, b))
    return least.withColumnRenamed("g_joined", "prints").drop("g")


def _short_grams(length: int) -> Column:
    """Runs for items of ``length`` words: every gram of so many words, by itself."""
    places = F.slice("w", 1, F.greatest(F.size("w") - (length - 1), F.lit(0)))
    return F.transform(places, lambda word, i: F.struct(
        F.lit(length).alias("length"), i.alias("first"), i.alias("last"),
        F.xxhash64(F.lit(length), word, *[F.get("w", i + k) for k in range(1, length)]).alias("print")))


def _runs(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, key, length, first, last, print): windows ``first`` to ``last`` of the text have the print."""
    printed = _prints(rows)
    starts = printed.withColumn("starts", F.filter(
        F.transform("prints", lambda p, i: F.when((i == 0) | (p != F.get("prints", i - 1)), F.struct(i.alias("at"), p.alias("print")))),
        lambda s: s.isNotNull()))
    runs = F.transform("starts", lambda s, i: F.struct(
        F.lit(WINDOW).alias("length"), s["at"].alias("first"),
        (F.coalesce(F.get("starts", i + 1)["at"], F.size("prints")) - 1).alias("last"), s["print"].alias("print")))
    listed = starts.select("id", "key", F.concat(runs, *[_short_grams(n) for n in lengths]).alias("runs"))
    # outer, as Spark would else put a filter on the list in front and compute it twice
    return listed.select("id", "key", F.explode_outer("runs").alias("run")).select("id", "key", "run.*").where("print is not null")


def _windows(items: DataFrame) -> DataFrame:
    """(id, gram): the distinct windows of each item, as text."""
    n = F.greatest(F.size("words") - (WINDOW - 1), F.lit(1))
    grams = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat_ws(" ", F.slice("words", i, F.lit(WINDOW))))
    return items.where(F.size("words") > 0).select("id", F.explode(F.array_distinct(grams)).alias("gram")).distinct()


def _covered(spans: str) -> Column:
    """Places inside any of the sorted ``spans`` (first, end)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["first"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end")),
        lambda a: a["n"])


def _sent(df: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` for a join with ``df``: broadcast if it is small by count."""
    size = found.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("runs")), F.lit(0)).alias("runs")).first()
    return F.broadcast(found) if size["rows"] <= SENT_ROWS and size["runs"] <= SENT_RUNS else found


def mark(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_words, n_hit (words inside a window of an item), item_ids (sorted texts), contaminated."""
    spark = df.sparkSession
    item_rows = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.lit(0).alias("key"), words(item_text).alias("words"))
    lengths = item_rows.select(F.size("words").alias("n")).where(F.col("n").between(1, WINDOW - 1)).distinct()
    lengths = sorted(r["n"] for r in lengths.collect())  # at most nine
    folder = fresh_folder(spark, "decontamination")

    item_runs = _runs(item_rows, lengths)
    short = item_rows.where(F.size("words") < WINDOW).select("id", "key", F.size("words").alias("length"))
    short = item_runs.where(F.col("length") < WINDOW).join(short.distinct(), ["id", "key", "length"], "left_semi")
    keys = item_runs.where(F.col("length") == WINDOW).unionByName(short).select("print").distinct()
    keys.write.parquet(f"{folder}/prints")
    keys = spark.read.parquet(f"{folder}/prints")
    if keys.count() <= SENT_RUNS:
        keys = F.broadcast(keys)

    rows = _rows(df, id_col, text_col)
    runs = _runs(rows, lengths).join(keys, "print", "left_semi")
    found = runs.groupBy("id", "key").agg(F.collect_set(F.struct("length", "first", "last")).alias("runs"))
    found.write.parquet(f"{folder}/runs")
    found = spark.read.parquet(f"{folder}/runs")
    found = _sent(df, found).select(F.col("id").alias("f_id"), F.col("key").alias("f_key"), "runs")

    # second reading: number of words of every row, and the words of the runs found
    same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("key") == F.col("f_key"))
    places = F.flatten(F.transform("runs", lambda r: F.transform(
        F.sequence(r["first"], r["last"]), lambda i: F.struct(i.alias("first"), r["length"].alias("length")))))
    joined = rows.join(found, same, "left").select("id", "key", "words", places.alias("places"))
    spelled = F.transform("places", lambda p: F.struct(
        p["first"].alias("first"), (p["first"] + p["length"]).alias("end"),
        F.concat_ws(" ", F.slice("words", p["first"] + 1, p["length"])).alias("gram")))
    joined.select("id", "key", F.size("words").cast("bigint").alias("n_words"), spelled.alias("spelled")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    windows = _windows(item_rows)
    windows.write.parquet(f"{folder}/windows")
    windows = spark.read.parquet(f"{folder}/windows")
    spans = rows.where("spelled is not null").select("id", "key", F.explode("spelled").alias("s")).select("id", "key", "s.*")
    spans = spans.join(windows.select("gram").distinct(), "gram", "left_semi")
    hit = spans.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))
    hit = hit.select("id", "key", _covered("spans").alias("n_hit"))
    names = spans.select("id", "key", "gram").distinct().join(windows.withColumnRenamed("id", "item"), "gram")
    names = names.groupBy("id", "key").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    result = rows.select("id", "key", "n_words")
    for more in (hit, names):
        more = more.withColumnsRenamed({"id": "m_id", "key": "m_key"})
        on = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("key") == F.col("m_key"))
        result = result.join(more, on, "left").drop("m_id", "m_key")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return result.select(
        "id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (n_hit > 0).alias("contaminated"))
