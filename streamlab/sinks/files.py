"""File sinks for streams, and one batch written to several sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from streamlab.operators.route import TAG

Write = Callable[[DataFrame, int], None]


def append_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "csv", **options: str) -> DataStreamWriter:
    """Append-only file sink; the checkpoint makes each row appear exactly once."""
    writer = stream.writeStream.format(fmt).outputMode("append").options(**options)
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def print_rows(stream: DataFrame, label: str) -> StreamingQuery:
    """Rows on the console under a label, for trying things out."""
    return stream.writeStream.format("console").queryName(label).option("truncate", "false").start()


def fan_out(writes: dict[str, Write], tag: str = TAG) -> Write:
    """``foreachBatch`` function that sends the rows of each tag to its own sink, computing the batch once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, write in writes.items():
                write(batch.where(F.col(tag) == name).drop(tag), batch_id)
        finally:
            batch.unpersist()

    return run
