"""Running aggregates per key: one output row per input row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streamlab.operators.arrow_runs import Batches, key_of, starts
from streamlab.operators.history import (
    KEY,
    PARTS,
    SLICE,
    History,
    first_so_far,
    previous,
    running_count,
    running_max,
    running_min,
    running_sum,
    scan,
)


def rolling_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str,
                hot_rows: int | None = None) -> DataFrame:
    return scan(df, keys, order, {name: running_sum(value)}, hot_rows)


def rolling_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                  hot_rows: int | None = None) -> DataFrame:
    return scan(df, keys, order, {name: running_count()}, hot_rows)


def rolling_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, others: Sequence[str],
                    largest: bool = True, hot_rows: int | None = None) -> DataFrame:
    """Running max or min of ``value``; the ``others`` stay as they were on the first row of the key."""
    extreme = (running_max if largest else running_min)(F.col(value))
    first = scan(df, keys, order, {value: extreme, "_first": first_so_far(F.struct(*others))}, hot_rows)
    return first.withColumns({c: F.col(f"_first.{c}") for c in others}).drop("_first")


def _descending(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(F.col(column).cast("timestamp"))
    return -F.col(column)


def rolling_max_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, columns: Sequence[str],
                   hot_rows: int | None = None) -> DataFrame:
    """Whole row that holds the running maximum, as struct ``best``; the earliest row stays on a tie."""
    earliest = [_descending(df, o).alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.struct(F.col(value).alias("_top"), *earliest, *columns)
    marked = scan(df, keys, order, {"_best": running_max(best)}, hot_rows)
    return marked.withColumn("best", F.struct(*[F.col(f"_best.{c}").alias(c) for c in columns])).drop("_best")


def history_links(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                  hot_rows: int | None = None) -> DataFrame:
    """Depth of a key's history at each row and the entry it continues.

    Writing the concatenated history into every row would grow with the square of the key's rows; depth and link say
    the same, and ``history_text`` spells it out where the depth is small.
    """
    return scan(df, keys, order, {"depth": running_count(), "continues": previous(*columns)}, hot_rows)


def history_text(key: str, depth: str) -> Column:
    """``key_key_…`` as often as the key has been seen."""
    return F.array_join(F.array_repeat(F.col(key).cast("string"), F.col(depth).cast("int")), "_")


def over_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot_rows: int | None = None
               ) -> DataFrame:
    """OVER window with the default RANGE frame: rows tied in the order column share the result."""
    columns = {"over_count": running_count(peers=True), "over_max": running_max(F.col(value), peers=True)}
    return scan(df, keys, order, columns, hot_rows)


def changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "cnt", hot_rows: int | None = None
              ) -> DataFrame:
    """Changelog of a running count: each row withdraws the old count (if any) and adds the new one."""
    counted = rolling_count(df, keys, order, "_n", hot_rows)
    entries = F.filter(
        F.array(
            F.struct(F.lit(False).alias("is_add"), (F.col("_n") - 1).alias(name)),
            F.struct(F.lit(True).alias("is_add"), F.col("_n").alias(name)),
        ),
        lambda e: e[name] > 0,
    )
    return counted.select(*df.columns, F.inline(entries))


@dataclass(frozen=True)
class Reducer:
    """A user's reduction: ``add`` takes a state (None at a key's first row) and the row's ``columns`` and gives the new state.

    States are tuples with the fields of ``schema`` (``"top double, n bigint"``). ``merge`` joins the states of two neighbouring
    stretches of rows, the earlier first, and must agree with ``add``: folding a whole stretch is merging the folds of its parts.
    """

    columns: tuple[str, ...]
    schema: str
    add: Callable[[tuple | None, tuple], tuple]
    merge: Callable[[tuple, tuple], tuple]


_CARRIES, _STATE = "_carries", "_state"


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], reducer: Reducer, hot_rows: int | None = None
                   ) -> DataFrame:
    """After every row, the user's reduction of its key's rows so far: ``df`` with the fields of ``reducer.schema``.

    Keys that are not hot are folded in one pass over rows sorted by key. Each slice of a hot key (see ``history``) is first
    reduced to one state; these few states are merged in order, and what came before a slice enters the final pass as
    one row at the slice's start. So a key with a third of the rows is folded in as many tasks as it has slices.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], reducer.schema).schema
    output = T.StructType([*df.schema.fields, *fields.fields])
    history = History.of(df, keys, order, hot_rows)
    if not history.split:
        sliced = df.repartition(*keys).sortWithinPartitions(*keys, *order)
        return sliced.mapInArrow(_fold(reducer, list(keys), df.columns, to_arrow_schema(fields), False), output)
    keys = list(history.keys)
    parts = [*keys, PARTS, SLICE]
    hot = history.sliced.where(F.col(PARTS).isNotNull()).select(*parts, *[c for c in _unique([*order, *reducer.columns]) if c not in keys])
    state = T.StructField(_STATE, fields)
    slot = T.StructType([*[history.sliced.schema[k] for k in parts], state])
    sums = hot.repartition(*parts).sortWithinPartitions(*parts, *order).mapInArrow(_sum_slices(reducer, parts, to_arrow_schema(fields)), slot)
    carries = sums.repartition(*keys).sortWithinPartitions(*keys, SLICE).mapInArrow(_carry(reducer, keys, parts, to_arrow_schema(fields)), slot)
    # the carry of a slice comes as its first row, so rows are moved once and no join can split a slice
    rows = history.sliced.withColumns({_STATE: F.lit(None).cast(fields), _CARRIES: F.lit(False)})
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in history.sliced.schema.fields if f.name not in parts]
    first = carries.select(*parts, *blank, _STATE, F.lit(True).alias(_CARRIES))
    both = rows.select(*first.columns).unionByName(first).repartition(*parts).sortWithinPartitions(*parts, F.desc(_CARRIES), *order)
    return both.mapInArrow(_fold(reducer, parts, df.columns, to_arrow_schema(fields), True), output)


def _unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def _with_states(rows: pa.RecordBatch, parts: Sequence[str], places: list[int], states: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    """The slices of the rows at ``places``, each with a state."""
    values = pa.array([dict(zip(kinds.names, state, strict=True)) for state in states], pa.struct(list(kinds)))
    found = rows.take(pa.array(places, pa.int64()))
    return pa.RecordBatch.from_arrays([*[found[p] for p in parts], values], [*parts, _STATE])


def _state(rows: pa.RecordBatch, row: int, kinds: pa.Schema) -> tuple:
    value = rows[_STATE][row].as_py()
    return tuple(value[n] for n in kinds.names)


def _rows(batch: pa.RecordBatch, columns: Sequence[str]):
    return zip(*[batch[c].to_pylist() for c in columns], strict=True)


def _fold(reducer: Reducer, keys: Sequence[str], columns: Sequence[str], kinds: pa.Schema, carried: bool):
    """Rows sorted by key with the running state behind them; a row that carries a state gives none."""
    def run(batches: Batches) -> Batches:
        current, state = None, None
        for batch in batches:  # slices may be small, so a batch goes out as one
            at, values, found = starts(batch, keys).tolist(), list(_rows(batch, reducer.columns)), []
            carries = batch[_CARRIES].to_pylist() if carried else []
            for a, b in zip(at[:-1], at[1:], strict=True):
                key = key_of(batch, a, keys)
                if key != current:
                    current, state = key, None
                if carried and carries[a]:
                    state = _state(batch, a, kinds)
                    a += 1
                for row in values[a:b]:
                    state = reducer.add(state, row)
                    found.append(state)
            if found:
                rows = batch.filter(pc.invert(batch[_CARRIES])) if carried else batch
                added = [pa.array(list(v), f.type) for v, f in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*[rows[c] for c in columns], *added], [*columns, *kinds.names])
    return run


def _sum_slices(reducer: Reducer, parts: Sequence[str], kinds: pa.Schema):
    def run(batches: Batches) -> Batches:
        current, state, head = None, None, None  # the slice that may go on in the next batch
        for batch in batches:
            at, values, places, states = starts(batch, parts).tolist(), list(_rows(batch, reducer.columns)), [], []
            place = None
            for a, b in zip(at[:-1], at[1:], strict=True):
                key = key_of(batch, a, parts)
                if key != current:
                    if place is not None:
                        places.append(place)
                        states.append(state)
                    elif head is not None:
                        yield _with_states(head, parts, [0], [state], kinds)
                    current, state, place, head = key, None, a, None
                for row in values[a:b]:
                    state = reducer.add(state, row)
            if places:
                yield _with_states(batch, parts, places, states, kinds)
            if place is not None:
                head = batch.slice(place, 1)
        if head is not None:
            yield _with_states(head, parts, [0], [state], kinds)
    return run


def _carry(reducer: Reducer, keys: Sequence[str], parts: Sequence[str], kinds: pa.Schema):
    """Per slice, what all earlier slices of the key come to; the first has none."""
    def run(batches: Batches) -> Batches:
        current, before = None, None
        for batch in batches:
            at, places, states = starts(batch, keys).tolist(), [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                key = key_of(batch, a, keys)
                if key != current:
                    current, before = key, None
                for i in range(a, b):
                    own = _state(batch, i, kinds)
                    if before is not None:
                        places.append(i)
                        states.append(before)
                    before = own if before is None else reducer.merge(before, own)
            if places:
                yield _with_states(batch, parts, places, states, kinds)
    return run
