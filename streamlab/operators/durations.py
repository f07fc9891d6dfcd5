"""Durations as ``timedelta``: the spelling for ``F.window`` and the literal for timestamp arithmetic."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(d: timedelta) -> int:
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def text(d: timedelta) -> str:
    return f"{micros(d)} microseconds"


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Signed distance of two timestamps in seconds (double)."""
    def as_micros(c: str | Column) -> Column:
        return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))

    return (as_micros(later) - as_micros(earlier)) / F.lit(1e6)
