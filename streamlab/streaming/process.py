"""A user's process function: rows, watermark and timers go in, any number of rows to several tagged outputs come out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlab.streaming.map_state import MapView

TAG = "tag"


class Context:
    """What a function may ask for and do while it handles a row or timer of ``key``."""

    def __init__(self, handle: StatefulProcessorHandle, state, maps: dict[str, MapView]) -> None:
        self._handle, self._state, self.maps = handle, state, maps
        self.key: tuple = ()
        self.watermark_ms: int | None = None
        self._out: list[tuple[str, tuple]] = []

    def begin(self, key: tuple, watermark_ms: int | None) -> None:
        self.key, self.watermark_ms, self._out = key, watermark_ms, []
        for view in self.maps.values():
            view.begin()

    def get(self) -> tuple | None:
        """The key's state."""
        stored = self._state.get()
        return None if stored is None else tuple(stored)

    def put(self, *values) -> None:
        self._state.update(values)

    def clear(self) -> None:
        self._state.clear()

    def set_timer(self, at_ms: int) -> None:
        """Call ``on_timer`` once the watermark (or the clock) has reached ``at_ms``; the same time twice is one timer."""
        self._handle.registerTimer(at_ms)

    def drop_timer(self, at_ms: int) -> None:
        self._handle.deleteTimer(at_ms)

    def emit(self, tag: str, *values) -> None:
        """A row for the output ``tag``."""
        self._out.append((tag, values))

    def take(self) -> list[tuple[str, tuple]]:
        out, self._out = self._out, []
        return out

    def end(self) -> None:
        for view in self.maps.values():
            view.write()


class ProcessFunction:
    """Subclass and give ``outputs`` (fields by tag), ``state`` (fields of the key's state) and ``maps`` (key and value fields by name)."""

    outputs: dict[str, str]
    state = "rows long"
    maps: dict[str, tuple[str, str]] = {}

    def on_row(self, ctx: Context, row: Row) -> None:
        """Called for each row as it arrives; rows of a key within a micro-batch come in no given order."""

    def on_timer(self, ctx: Context, at_ms: int) -> None:
        """Called when a timer is due."""


class _Processor(StatefulProcessor):
    def __init__(self, function: ProcessFunction, names: Sequence[str], timed: bool) -> None:
        self.function, self.result, self.timed = function, Row(*names), timed
        self.tags = list(function.outputs)

    def init(self, handle: StatefulProcessorHandle) -> None:
        maps = {n: MapView(handle.getMapState(n, k, v)) for n, (k, v) in self.function.maps.items()}
        self.context = Context(handle, handle.getValueState("state", self.function.state), maps)

    def _rows(self, key: tuple) -> Iterator[Row]:
        for tag, values in self.context.take():
            yield self.result(*key, tag, *[tuple(values) if t == tag else None for t in self.tags])

    def _watermark(self, timer_values) -> int | None:
        return timer_values.getCurrentWatermarkInMs() if self.timed else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self.context.begin(key, self._watermark(timerValues))
        for row in rows:
            self.function.on_row(self.context, row)
            yield from self._rows(key)
        self.context.end()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.context.begin(key, self._watermark(timerValues))
        self.function.on_timer(self.context, expiredTimerInfo.getExpiryTimeInMs())
        yield from self._rows(key)
        self.context.end()

    def close(self) -> None:
        pass


def process(stream: DataFrame, keys: Sequence[str], function: ProcessFunction, time_mode: str = "eventTime") -> DataFrame:
    """Apply ``function`` per key: keys, ``tag`` and a struct column for each output, NULL but for the row's own.

    ``time_mode`` is ``eventTime`` (the stream needs a watermark), ``processingTime`` or ``none`` (no timers).
    """
    spark = stream.sparkSession
    fields = [T.StructField(t, spark.createDataFrame([], s).schema) for t, s in function.outputs.items()]
    output = T.StructType([*[stream.schema[k] for k in keys], T.StructField(TAG, T.StringType()), *fields])
    processor = _Processor(function, output.names, time_mode == "eventTime")
    return stream.groupBy(*keys).transformWithState(processor, output, "append", time_mode)


def output_of(processed: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """The rows of one output: keys and its fields."""
    return processed.where(F.col(TAG) == tag).select(*keys, f"{tag}.*")
