"""Rows as JSON documents, keyed for upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.sinks.keyed import KeyedTable


def as_documents(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``body`` holds the row as JSON; with ``keys``, ``doc_key`` is the key columns joined by ``|``."""
    body = F.to_json(F.struct(*df.columns)).alias("body")
    if not keys:
        return df.select(body)
    return df.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("doc_key"), body)


def upsert_documents(path: str, keys: Sequence[str]) -> tuple[KeyedTable, Callable[[DataFrame, int], None]]:
    """A table of documents by key and the ``foreachBatch`` function that writes to it; a later document of a key replaces it."""
    table = KeyedTable(path, ("doc_key",))
    return table, lambda batch, batch_id: table.upsert(as_documents(batch, keys), batch_id)
