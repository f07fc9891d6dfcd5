"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.session import checkpointed, shared_folder

__all__ = ["WORD", "as_text", "checkpointed", "crc_of_id", "fresh_folder", "read_table", "run_starts", "shingle_hashes", "slices", "sorted_runs", "task_count", "unused_name"]

#: A word, wherever documents are measured in words.
WORD = r"[^\x20\x09-\x0D]+"

#: Of the hashes of shingles.
SEED = 42


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_text(column: Column | str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def crc_of_id(column: Column | str) -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(as_text(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")).cast("binary"))


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores put in front until no column of ``df`` has the name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def shingle_hashes(text: str, k: int) -> list[int]:
    words = text.encode().lower().split()
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:len(words) - k])]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:], strict=True)]


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys, and the length at the end."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), n)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for work that holds every word of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs from batches sorted by the integer columns ``keys``; the last, perhaps open, run waits for the next batch."""
    rest: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        starts = run_starts(*[table[k].to_numpy() for k in keys])
        cut = int(starts[-2])
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None:
        yield rest.combine_chunks()
