"""Running a stream to its current end, and where its checkpoints go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamlab.session import shared_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """Folder below the shared folder."""
    return f"{shared_folder(spark)}/{name}"


def run_to_end(
    stream: DataFrame, checkpoint: str, path: str | None = None, mode: str = "append",
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process all available input and stop. Results go to parquet files at ``path`` or to ``each_batch``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
