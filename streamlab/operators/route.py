"""Routing of rows: flat map, tags, side outputs, connected and united streams, distinct.

Everything here but ``word_counts`` works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = "tag"


def words(df: DataFrame, text: str, pattern: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """Flat map of a text column to one row per word (empty words dropped)."""
    return df.select(*keep, F.explode(F.split(text, pattern)).alias("word")).where("word <> ''")


def word_counts(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """``word=count;…`` in the order of the words for each key that has any, counted over all its texts.

    A key's only text is counted within its row, so words are neither copied to rows of their own nor shuffled; the
    texts of keys that come more than once are.
    """
    rows = df.select(key, text)
    repeated = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1")
    marked = rows.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
    single = marked.where(F.col("_n").isNull() & (F.trim(text) != "")).select(key, _counted_within(F.col(text)).alias(name))
    counts = words(marked.where("_n is not null"), text, keep=[key]).groupBy(key, "word").agg(F.count("*").alias("cnt"))
    entry = F.array_sort(F.collect_list(F.struct("word", "cnt")))
    joined = F.array_join(F.transform(entry, lambda e: F.concat(e["word"], F.lit("="), e["cnt"].cast("string"))), ";")
    return single.unionByName(counts.groupBy(key).agg(joined.alias(name)))


def _counted_within(text: Column) -> Column:
    """The same within one text: its sorted words, cut where they change."""
    def entries(w: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.get(w, i).eqNullSafe(F.get(w, i + 1)))
        return _with(ends, lambda at: F.transform(at, lambda e, j: F.concat(
            F.get(w, e), F.lit("="), (e - F.coalesce(F.get(at, j - 1), F.lit(-1))).cast("string"))))

    return F.array_join(_with(F.sort_array(F.filter(F.split(text, " "), lambda w: w != "")), entries), ";")


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tagged(df: DataFrame, rules: dict[str, Column], default: str) -> DataFrame:
    """Add ``tag``: the first rule that holds, else ``default``."""
    column: Column | None = None
    for name, condition in rules.items():
        column = F.when(condition, name) if column is None else column.when(condition, name)
    return df.withColumn(TAG, F.lit(default) if column is None else column.otherwise(default))


def select_tags(df: DataFrame, *names: str) -> DataFrame:
    """Rows of one or several outputs of ``tagged``."""
    return df.where(F.col(TAG).isin(*names))


def side_outputs(df: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, DataFrame]:
    """Split a tagged DataFrame; each output gets its own projection and so its own schema."""
    return {name: project(select_tags(df, name).drop(TAG)) for name, project in outputs.items()}


def connect(left: DataFrame, right: DataFrame, left_map: dict[str, Column], right_map: dict[str, Column]) -> DataFrame:
    """Two schemas in one DataFrame, each side mapped on its own; ``origin`` tells them apart."""
    a = left.select(F.lit("left").alias("origin"), *[c.alias(n) for n, c in left_map.items()])
    b = right.select(F.lit("right").alias("origin"), *[c.alias(n) for n, c in right_map.items()])
    return a.unionByName(b, allowMissingColumns=True)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_first(df: DataFrame, keys: Sequence[str], within_watermark: bool = False) -> DataFrame:
    """Each key once. On a stream ``within_watermark`` bounds the state by the watermark delay."""
    if within_watermark:
        return df.dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def map_with_setup(
    df: DataFrame,
    schema: str,
    setup: Callable[[], object],
    transform: Callable[[object, pd.DataFrame], pd.DataFrame],
    teardown: Callable[[object], None] | None = None,
) -> DataFrame:
    """Map whole Arrow batches with a resource opened once per task and closed at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield transform(resource, batch)
        finally:
            if teardown is not None:
                teardown(resource)

    return df.mapInPandas(run, schema)
