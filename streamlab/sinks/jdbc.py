"""JDBC sinks for ``foreachBatch``: plain insert, and upsert through a staging table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from streamlab.sinks.keyed import last_per_key


def insert(url: str, table: str, properties: dict[str, str], batch_size: int = 5000) -> Callable[[DataFrame, int], None]:
    """Append each batch. A replayed batch inserts again, so give the table a key or use ``upsert``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)

    return write


def merge_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard MERGE that replaces the row of each staged key."""
    rest = [c for c in columns if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in rest)}" if rest else ""
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def upsert(
    url: str, table: str, keys: Sequence[str], order: Sequence[str], properties: dict[str, str],
    execute: Callable[[str], None],
) -> Callable[[DataFrame, int], None]:
    """Stage the last row per key of each batch, then MERGE it with ``execute`` (a statement runner of the caller).

    Executors write the staging table in parallel; replaying a batch merges the same rows again.
    """
    staging = f"{table}_staging"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = last_per_key(batch, keys, order)
        rows.write.jdbc(url, staging, mode="overwrite", properties=properties)
        execute(merge_statement(table, staging, keys, rows.columns))

    return write
