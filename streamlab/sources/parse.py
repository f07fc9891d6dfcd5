"""Typed records from delimited lines, access-log lines and CSV/JSON payloads.

Parsers never fail on a bad line: the record columns are NULL and ``rejects`` gives the line back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OK = "parsed_ok"


def delimited(df: DataFrame, line: str, fields: Sequence[tuple[str, str]], separator: str = ",") -> DataFrame:
    """Split ``line`` and cast by position. ``fields`` are (name, type); an empty string is a NULL for any non-string."""
    parts = F.split(F.col(line), rf"\Q{separator}\E")
    values = [
        F.get(parts, F.lit(i)).alias(name) if kind == "string" else F.get(parts, F.lit(i)).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields)
    ]
    ok = F.size(parts) == len(fields)
    for (name, kind), i in zip(fields, range(len(fields)), strict=True):
        if kind != "string":
            ok = ok & F.get(parts, F.lit(i)).try_cast(kind).isNotNull()
    return df.select(F.col(line).alias("line"), *values, F.coalesce(ok, F.lit(False)).alias(OK))


def records(parsed: DataFrame) -> DataFrame:
    return parsed.where(OK).drop(OK, "line")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col(OK)).select("line")


# The layout of an access-log line (field positions after splitting on a space, and its time format).
LOG_IP, LOG_USER, LOG_TIME, LOG_METHOD, LOG_URL = 0, 1, 3, 5, 6
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def access_log(df: DataFrame, line: str) -> DataFrame:
    parts = F.split(F.col(line), " ")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    time = F.try_to_timestamp(part(LOG_TIME), F.lit(LOG_TIME_FORMAT))
    return df.select(
        F.col(line).alias("line"),
        part(LOG_IP).alias("ip"),
        part(LOG_USER).alias("user_id"),
        time.alias("event_time"),
        part(LOG_METHOD).alias("method"),
        part(LOG_URL).alias("url"),
        F.coalesce(time.isNotNull() & part(LOG_URL).isNotNull(), F.lit(False)).alias(OK),
    )


def csv_payload(df: DataFrame, value: str, schema: str) -> DataFrame:
    """Decode a CSV message column."""
    return df.select(F.from_csv(F.col(value), schema).alias("_r")).select("_r.*")


def json_payload(df: DataFrame, value: str, schema: str | T.StructType) -> DataFrame:
    """Decode a JSON message column."""
    return df.select(F.from_json(F.col(value), schema).alias("_r")).select("_r.*")


_BAD = "_bad_message"


def checked_payload(df: DataFrame, value: str, schema: str, fmt: str = "json", required: Sequence[str] = ()) -> DataFrame:
    """Decode CSV or JSON messages for ``records`` and ``rejects``: a message that does not parse to the schema is a reject.

    So is one that is NULL, or has no value for a ``required`` field.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    decode = F.from_json if fmt == "json" else F.from_csv
    decoded = df.select(F.col(value).alias("line"), decode(F.col(value), f"{schema}, {_BAD} string", options).alias("_r"))
    ok = F.col("_r").isNotNull() & F.col(f"_r.{_BAD}").isNull()
    for field in required:
        ok = ok & F.col(f"_r.{field}").isNotNull()
    return decoded.select("line", "_r.*", F.coalesce(ok, F.lit(False)).alias(OK)).drop(_BAD)


def to_csv_message(*columns: str) -> Column:
    return F.to_csv(F.struct(*columns)).alias("value")


def to_json_message(*columns: str) -> Column:
    return F.to_json(F.struct(*columns)).alias("value")
