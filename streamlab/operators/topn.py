"""Top-N per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], best_first: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group.

    The rank filter lets Spark keep only ``n`` candidates per group and map task before the shuffle (group limit), so
    a large group costs ``n`` rows per task, not all of its rows.
    """
    w = Window.partitionBy(*group).orderBy(*best_first)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
