"""Late rows on a stream without loss.

Spark drops rows behind a stream's watermark before an operator sees them, and its watermark moves once a micro-batch. Here each
shard of the stream keeps the largest time it has seen in a state of its own, without any watermark, and a row is late if it
is behind that time by the row's own order of arrival. Kept and late rows together are all rows, however late.

``split_late`` sorts a shard's rows of a micro-batch in one Python worker; ``split_batches`` does the same split for micro-batches of any
size with a sliced scan of the batch, its shards' largest times in files from batch to batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlab.operators import durations as d
from streamlab.operators.history import Scan, scan
from streamlab.operators.windows import window_of

_US, _CLOSES = "_us", "_closes_us"


class _LargestTime(StatefulProcessor):
    def __init__(self, arrival: Sequence[str], keep: Sequence[str], bound: int, output_names: Sequence[str]) -> None:
        self.arrival, self.keep, self.bound, self.result = list(arrival), list(keep), bound, Row(*output_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "top_us long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.top.get()
        top = None if stored is None else stored[0]
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.arrival)):
            yield self.result(*[row[c] for c in self.keep], top is not None and row[_CLOSES] <= top - self.bound)
            top = row[_US] if top is None else max(top, row[_US])
        self.top.update((top,))

    def close(self) -> None:
        pass


def split_late(
    stream: DataFrame, shard: Column, arrival: Sequence[str], ts: str, closes: Column, bound: timedelta, keep: Sequence[str]
) -> DataFrame:
    """``keep`` columns and ``is_late`` for every row: the time ``closes`` was ``bound`` or more behind the shard's largest time.

    ``shard`` (a hash of the key) spreads the state; rows of a shard in one micro-batch are put in order of ``arrival``, so use
    as many shards as leave few of them. The stream may but need not have a watermark; none is used.
    """
    rows = stream.select(
        *keep, *[c for c in arrival if c not in keep], shard.alias("_shard"), F.unix_micros(F.col(ts)).alias(_US),
        F.unix_micros(closes).alias(_CLOSES))
    output = T.StructType([*[stream.schema[c] for c in keep], T.StructField("is_late", T.BooleanType())])
    processor = _LargestTime(arrival, keep, d.micros(bound), output.names)
    return rows.groupBy("_shard").transformWithState(processor, output, "append", "none")


def window_closes(ts: str, size: timedelta, slide: timedelta | None = None, lateness: timedelta = timedelta(0)) -> Column:
    """When the last window of a row takes no more rows."""
    return window_of(ts, slide or size)["start"] + F.lit(size) - F.lit(timedelta(milliseconds=1)) + F.lit(lateness)


def split_to_tables(kept: str, late: str):
    """``foreachBatch`` function: kept rows and late rows to a table each, a folder a batch, so that a replay writes the same."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for path, side in ((kept, ~F.col("is_late")), (late, F.col("is_late"))):
            batch.where(side).drop("is_late").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.unpersist()

    return write


def split_batches(
    shard: Column, arrival: Sequence[str], ts: str, closes: Column, bound: timedelta, keep: Sequence[str], folder: str,
    hot_rows: int | None = None,
):
    """``foreachBatch`` function for a stream of rows: tables ``kept`` and ``late`` below ``folder``, a folder a batch, as by ``split_late``.

    ``tops`` there holds each shard's largest time after each batch; a replayed batch starts from the one before it and writes the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(
            *keep, *[c for c in arrival if c not in keep], shard.alias("_shard"), F.unix_micros(F.col(ts)).alias(_US),
            F.unix_micros(closes).alias(_CLOSES))
        tops = rows.groupBy("_shard").agg(F.max(_US).alias("_top_us"))
        seen = scan(rows, ["_shard"], arrival, {"_before": Scan("max", F.col(_US), inclusive=False)}, hot_rows)
        top = F.col("_before")
        if batch_id > 0:
            # a shard a row
            earlier = spark.read.parquet(f"{folder}/tops/batch={batch_id - 1}").withColumnsRenamed({"_shard": "_of", "_top_us": "_earlier"})
            seen = seen.join(F.broadcast(earlier), F.col("_shard").eqNullSafe(F.col("_of")), "left")
            top = F.greatest("_before", "_earlier")
            tops = tops.unionByName(earlier.withColumnsRenamed({"_of": "_shard", "_earlier": "_top_us"}))
            tops = tops.groupBy("_shard").agg(F.max("_top_us").alias("_top_us"))
        split = seen.select(*keep, F.coalesce(F.col(_CLOSES) <= top - d.micros(bound), F.lit(False)).alias("is_late"))
        split_to_tables(f"{folder}/kept", f"{folder}/late")(split, batch_id)
        tops.write.mode("overwrite").parquet(f"{folder}/tops/batch={batch_id}")

    return write
