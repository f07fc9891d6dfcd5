"""Keyed upsert on plain files: one folder per micro-batch, the latest row of each key wins on reading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key with the greatest ``order``; combined before the shuffle, so a busy key stays cheap."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


@dataclass(frozen=True)
class KeyedTable:
    """Rows by key in folder ``path`` (shared storage).

    A batch writes its own folder and replaces it when replayed, so retries leave the table as it was.
    """

    path: str
    keys: tuple[str, ...]

    def upsert(self, batch: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Write the last row per key of the batch (``order`` decides; not needed if keys are unique in it)."""
        rows = last_per_key(batch, self.keys, order) if order else batch
        rows.write.mode("overwrite").parquet(f"{self.path}/{VERSION}={batch_id}")

    def changes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def latest(self, spark: SparkSession) -> DataFrame:
        return last_per_key(self.changes(spark), self.keys, [VERSION]).drop(VERSION)

    def compact_into(self, spark: SparkSession, path: str, upto: int) -> KeyedTable:
        """A new table with one folder for all batches up to ``upto``; point readers and the sink to it afterwards."""
        rows = self.changes(spark).where(F.col(VERSION) <= upto)
        target = KeyedTable(path, self.keys)
        target.upsert(last_per_key(rows, self.keys, [VERSION]).drop(VERSION), upto)
        return target
