"""Sorted Arrow batches taken apart at their keys, for user code that runs over the rows of a key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]


def starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Rows whose key differs from the row before, and the end; NULL equals NULL."""
    if batch.num_rows == 0:
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        now, before = batch[k][1:], batch[k][:-1]
        differs = pc.fill_null(pc.not_equal(now, before), False)
        differs = pc.or_(differs, pc.xor(pc.is_null(now), pc.is_null(before)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), batch.num_rows)


def key_of(batch: pa.RecordBatch, row: int, keys: Sequence[str]) -> tuple:
    return tuple(batch[k][row].as_py() for k in keys)


def pieces(batches: Batches, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) in order; a key's rows may come in several pieces, one after the other."""
    for batch in batches:
        at = starts(batch, keys)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield key_of(batch, a, keys), batch.slice(a, b - a)


def by_key(batches: Batches, keys: Sequence[str], run: Callable[[tuple, Batches], Batches]) -> Batches:
    """Call ``run`` once a key with an iterator over its pieces; rows that it leaves unread are skipped.

    At most one batch is held, however many rows a key has.
    """
    stream = pieces(batches, keys)
    ahead = next(stream, None)

    def own(key: tuple) -> Batches:
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            yield ahead[1]
            ahead = next(stream, None)

    while ahead is not None:
        key = ahead[0]
        rows = own(key)
        yield from run(key, rows)
        for _ in rows:
            pass
