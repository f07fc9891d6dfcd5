"""User-defined functions: scalar, table, aggregate and table aggregate.

The built-in spelling is given first where Spark has one; the user-defined forms exist so that own logic can take the
same place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLUSH_ROWS = 200_000


def text_length(column: str) -> Column:
    return F.length(column)


@F.pandas_udf(T.IntegerType())
def text_length_udf(values: pd.Series) -> pd.Series:
    return values.str.len().astype("Int32")


@F.udtf(returnType=T.StructType([T.StructField("word", T.StringType()), T.StructField("word_length", T.IntegerType())]))
class SplitWords:
    """``split_words(text, separator)``: one row per word."""

    def eval(self, text: str | None, separator: str) -> Iterator[tuple[str, int]]:
        for word in (text or "").split(separator):
            yield word, len(word)


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udf.register("text_length", text_length_udf)
    spark.udtf.register("split_words", SplitWords)


def reduce_by_key(
    df: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    add: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """Group and reduce with vectorized Python steps.

    ``add`` turns a batch of input rows into state rows (``schema``, with the key columns) and ``merge`` reduces state
    rows of many keys at once. Each task first reduces its own input to few state rows, as Spark's partial aggregation
    does, so a key that fills a third of the table reaches the shuffle as a handful of rows per task. The final step
    reads rows sorted by key and holds back only the last key of a batch.
    """
    names, keys = schema.names, list(keys)

    def combine(frames: list[pd.DataFrame]) -> pd.DataFrame:
        return merge(pd.concat(frames, ignore_index=True))[names]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(add(batch)[names])
            rows += len(held[-1])
            if rows > FLUSH_ROWS:
                held = [combine(held)]
                rows = len(held[0])
                if rows > FLUSH_ROWS // 2:
                    yield held[0]
                    held, rows = [], 0
        if held:
            yield combine(held)

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_rows: pd.DataFrame | None = None
        for batch in batches:
            merged = combine([batch] if open_rows is None else [open_rows, batch])
            last = batch[keys].tail(1).merge(merged[keys].reset_index(), on=keys)["index"]
            yield merged.drop(index=last)
            open_rows = merged.loc[last]
        if open_rows is not None:
            yield open_rows

    reduced = df.mapInPandas(partial, schema)
    return reduced.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(final, schema)


def _keys_as_text(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-number keys as text, NULL as the empty text: a pandas column of numbers with a NULL would be floating point."""
    whole = [k for k in keys if isinstance(df.schema[k].dataType, T.IntegralType)]
    return df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in whole})


def average_with_state(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Average from a (sum, count) accumulator."""
    restored = [F.col(k).try_cast(df.schema[k].dataType).alias(k) for k in keys]
    df = _keys_as_text(df, keys)
    key_fields = [df.schema[k] for k in keys]
    state = T.StructType([*key_fields, T.StructField("total", T.DoubleType()), T.StructField("n", T.LongType())])

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        grouped = batch.groupby(list(keys), dropna=False, sort=False)[value]
        return grouped.agg(total="sum", n="count").reset_index()

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return states.groupby(list(keys), dropna=False, sort=False)[["total", "n"]].sum().reset_index()

    sums = reduce_by_key(df.select(*keys, value), keys, state, add, merge)
    return sums.select(*restored, F.try_divide("total", "n").alias(name))


def top_with_state(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The ``n`` largest values of each key with their rank, as a table aggregate: ``n`` state rows per key."""
    restored = [F.col(k).try_cast(df.schema[k].dataType).alias(k) for k in keys]
    df = _keys_as_text(df, keys)
    state = T.StructType([*[df.schema[k] for k in keys], df.schema[value]])

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(value, ascending=False, kind="stable")
        return ordered.groupby(list(keys), dropna=False, sort=False).head(n)

    rows = df.select(*keys, value).where(F.col(value).isNotNull())
    top = reduce_by_key(rows, keys, state, best, best)
    # at most n rows per key are left
    place = Window.partitionBy(*keys).orderBy(F.desc(value))
    return top.withColumn("rank", F.row_number().over(place)).select(*restored, value, "rank")
