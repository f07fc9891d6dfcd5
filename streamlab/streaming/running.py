"""Per-record running results on a stream, in arrival order: fold, count windows, changelog, reminders.

The rows of a key within one micro-batch are put in ``order`` first, as a shuffle does not keep their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlab.operators import durations as d

Fold = Callable[[tuple | None, Row], tuple]


class _RunningFold(StatefulProcessor):
    def __init__(self, fold: Fold, state_schema: T.StructType, order: Sequence[str], keep: Sequence[str],
                 output_names: Sequence[str]) -> None:
        self.result = Row(*output_names)
        self.fold, self.state_schema, self.order, self.keep = fold, state_schema, list(order), list(keep)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.state.get()
        state = None if state is None else tuple(state)
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            state = self.fold(state, row)
            yield self.result(*key, *[row[c] for c in self.keep], *state)
        self.state.update(state)

    def close(self) -> None:
        pass


def running_fold(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], state_schema: T.StructType,
    fold: Fold,
) -> DataFrame:
    """After each row: its ``keep`` columns and the folded state of its key (sum, max, reduce, count, ...)."""
    output = T.StructType([*[stream.schema[c] for c in [*keys, *keep]], *state_schema.fields])
    processor = _RunningFold(fold, state_schema, order, keep, output.names)
    return stream.groupBy(*keys).transformWithState(processor, output, "append", "none")


def running_count(stream: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField("cnt", T.LongType())])
    return running_fold(stream, keys, order, keep, schema, lambda s, _: ((s[0] if s else 0) + 1,))


class _CountWindow(StatefulProcessor):
    """Keeps the last ``size`` values; fires every ``slide`` rows, or only on full windows if ``full``."""

    def __init__(
        self, value: str, kind: T.DataType, order: Sequence[str], size: int, slide: int, full: bool,
        output_names: Sequence[str],
    ) -> None:
        self.result = Row(*output_names)
        self.value, self.kind, self.order = value, kind, list(order)
        self.size, self.slide, self.full = size, slide, full

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("last", T.ArrayType(self.kind))])
        self.state = handle.getValueState("state", schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.state.get()
        n, last = (0, []) if stored is None else (stored[0], list(stored[1]))
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            n, last = n + 1, [*last, row[self.value]][-self.size:]
            if n % self.slide == 0 and (len(last) == self.size or not self.full):
                yield self.result(*key, n, len(last), list(last))
        self.state.update((n, last))

    def close(self) -> None:
        pass


def count_window(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int, slide: int | None = None
) -> DataFrame:
    """Count windows: keys, ``row_no``, ``cnt`` and the ``items`` of the window (at most ``size``).

    Without ``slide`` windows do not overlap and fire when full; with it they fire every ``slide`` rows.
    """
    kind = stream.schema[value].dataType
    output = T.StructType([
        *[stream.schema[k] for k in keys], T.StructField("row_no", T.LongType()), T.StructField("cnt", T.IntegerType()),
        T.StructField("items", T.ArrayType(kind)),
    ])
    processor = _CountWindow(value, kind, order, size, slide or size, slide is None, output.names)
    return stream.groupBy(*keys).transformWithState(processor, output, "append", "none")


class _Changelog(StatefulProcessor):
    def __init__(self, output_names: Sequence[str]) -> None:
        self.result = Row(*output_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "cnt long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.count.get()
        old = 0 if stored is None else stored[0]
        new = old + sum(1 for _ in rows)
        if old:
            yield self.result(*key, False, old)
        yield self.result(*key, True, new)
        self.count.update((new,))

    def close(self) -> None:
        pass


def changelog_count(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changelog of a count per key, one change per micro-batch: the old row withdrawn, the new one added."""
    fields = [T.StructField("is_add", T.BooleanType()), T.StructField("cnt", T.LongType())]
    output = T.StructType([*[stream.schema[k] for k in keys], *fields])
    return stream.select(*keys).groupBy(*keys).transformWithState(_Changelog(output.names), output, "append", "none")


class _Reminder(StatefulProcessor):
    def __init__(self, delay_ms: int, output_names: Sequence[str]) -> None:
        self.delay, self.result = delay_ms, Row(*output_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "cnt long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.count.get()
        self.count.update(((0 if stored is None else stored[0]) + sum(1 for _ in rows),))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self.result(*key, expiredTimerInfo.getExpiryTimeInMs(), self.count.get()[0])

    def close(self) -> None:
        pass


def reminder(stream: DataFrame, keys: Sequence[str], delay: timedelta) -> DataFrame:
    """Processing-time timer: ``delay`` after rows of a key arrive, its count so far."""
    fields = [T.StructField("fired_ms", T.LongType()), T.StructField("cnt", T.LongType())]
    output = T.StructType([*[stream.schema[k] for k in keys], *fields])
    processor = _Reminder(d.micros(delay) // 1000, output.names)
    return stream.select(*keys).groupBy(*keys).transformWithState(processor, output, "append", "processingTime")
