"""Declared tables: path, format, schema, computed columns and watermark in one place, for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """A table as a DDL statement would declare it.

    ``computed`` maps new column names to SQL expressions; ``watermark`` is (event-time column, delay).
    """

    path: str
    schema: str
    format: str = "csv"
    options: dict[str, str] = field(default_factory=dict)
    computed: dict[str, str] = field(default_factory=dict)
    watermark: tuple[str, str] | None = None

    def _finish(self, df: DataFrame) -> DataFrame:
        for name, expression in self.computed.items():
            df = df.withColumn(name, F.expr(expression))
        return df.withWatermark(*self.watermark) if self.watermark and df.isStreaming else df

    def read(self, spark: SparkSession) -> DataFrame:
        return self._finish(spark.read.schema(self.schema).format(self.format).options(**self.options).load(self.path))

    def read_stream(self, spark: SparkSession, **options: str) -> DataFrame:
        reader = spark.readStream.schema(self.schema).format(self.format).options(**{**self.options, **options})
        return self._finish(reader.load(self.path))

    def register(self, spark: SparkSession, name: str, stream: bool = False) -> DataFrame:
        df = self.read_stream(spark) if stream else self.read(spark)
        df.createOrReplaceTempView(name)
        return df


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal collection as a table."""
    return spark.createDataFrame(rows, schema)


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Lines of a file or folder in column ``value``."""
    return (spark.readStream if stream else spark.read).text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket; for trying things out, as the source cannot replay after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def event_time(seconds: str | None = None, millis: str | None = None) -> Column:
    """Event-time column from an epoch column in seconds or milliseconds."""
    if seconds is not None:
        return F.timestamp_seconds(seconds)
    return F.timestamp_millis(millis)


def arrival_time() -> Column:
    """Processing time: one value per query or micro-batch."""
    return F.current_timestamp()
