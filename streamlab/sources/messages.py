"""Message-broker topics. The connector package must be on the class path; only the options are built here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

START_EARLIEST, START_LATEST = "earliest", "latest"


def read_options(servers: str, topic: str, start: str = START_LATEST, max_per_trigger: int | None = None
                 ) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def write_options(servers: str, topic: str, acks: str = "all") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": acks}


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = START_LATEST) -> DataFrame:
    """Message values as strings; decode with ``parse.csv_payload`` or ``parse.json_payload``."""
    raw = spark.readStream.format("kafka").options(**read_options(servers, topic, start)).load()
    return raw.selectExpr("cast(value as string) as value", "timestamp")


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer for a DataFrame with a ``value`` column (see ``parse.to_csv_message`` / ``to_json_message``)."""
    return (
        df.writeStream.format("kafka").options(**write_options(servers, topic)).option("checkpointLocation", checkpoint)
    )
