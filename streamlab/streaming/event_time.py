"""Keyed state machines in event time.

A ``Machine`` sees the rows of one key in order and may ask to be called at a deadline. The processor around it keeps
rows in state until the watermark has passed them, so the result does not depend on the order of arrival within the
watermark delay and equals the batch form in ``streamlab.operators``.

Waiting rows lie in a map by time slot; neighbouring slots with few rows share an entry, as each entry costs calls to the state
store. A timer reads the entries that the watermark has passed, each once, and drops them; only those in which the watermark stands
are written back. So the work of a key grows with its rows, not with rows times timers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlab.operators.durations import micros
from streamlab.streaming.map_state import MapView

_US = "_us"
SLOT = timedelta(hours=1)
#: Rows up to which neighbouring slots share an entry.
SHARED_ROWS = 256


class Machine:
    """State of one key. ``state`` is a tuple with the fields of ``state_schema``; times are epoch microseconds.

    ``map_schemas`` names further map states by key and value fields; a machine finds them in ``self.maps``.
    """

    state_schema: T.StructType
    output_schema: T.StructType
    map_schemas: dict[str, tuple[str, str]] = {}
    maps: dict[str, MapView]

    def start(self) -> tuple:
        return tuple(None for _ in self.state_schema.fields)

    def begin(self) -> None:
        """Called before the rows of a key, once its map states can be read."""

    def on_row(self, state: tuple, at: int, row: Row) -> tuple[tuple, list[tuple], int | None]:
        """New state, output rows (without the key) and the deadline to wait for, if any."""
        raise NotImplementedError

    def on_deadline(self, state: tuple, at: int) -> tuple[tuple, list[tuple], int | None]:
        raise NotImplementedError


class _InOrder(StatefulProcessor):
    def __init__(
        self, machine: Machine, order: Sequence[str], row_schema: T.StructType, output_names: Sequence[str], slot: timedelta
    ) -> None:
        self.machine, self.order, self.row_schema, self.slot = machine, list(order), row_schema, micros(slot)
        self.result, self.row = Row(*output_names), Row(*row_schema.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.row_schema))])
        self.waiting = handle.getMapState("waiting", "slot long", rows)
        fields = [*self.machine.state_schema.fields, T.StructField("deadline_us", T.LongType())]
        self.state = handle.getValueState("state", T.StructType(fields))
        self.timer = handle.getValueState("timer", "at_ms long")
        self.machine.maps = {n: MapView(handle.getMapState(n, k, v)) for n, (k, v) in self.machine.map_schemas.items()}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        us = self.row_schema.names.index(_US)
        new = [tuple(row[c] for c in self.row_schema.names) for row in rows]
        self._put(new, us)
        self._wake_at(min(r[us] for r in new))
        return iter(())

    def _put(self, rows: list[tuple], us: int) -> None:
        """Into the map, by the first slot of each entry."""
        slots: dict[int, list[tuple]] = {}
        for r in rows:
            slots.setdefault(r[us] // self.slot, []).append(r)
        entries: dict[int, list[tuple]] = {}
        first = None
        for slot in sorted(slots):
            if first is None or len(entries[first]) + len(slots[slot]) > SHARED_ROWS:
                first, entries[slot] = slot, []
            entries[first] += slots[slot]
        for slot, own in entries.items():
            self.waiting.updateValue((slot,), ([*self._in(slot), *own],))

    def _in(self, slot: int) -> list[tuple]:
        stored = self.waiting.getValue((slot,))
        return [] if stored is None else [tuple(r) for r in stored[0]]

    def _due(self, until: int) -> tuple[list[Row], int | None]:
        """Rows up to ``until`` in order, taken out of state, and the time of the first that stays, or of its slot."""
        us = self.row_schema.names.index(_US)
        rows: list[tuple] = []
        beyond = None
        for slot in sorted(k[0] for k in list(self.waiting.keys())):
            if slot * self.slot > until:
                beyond = slot * self.slot
                break
            rows += self._in(slot)
            self.waiting.removeKey((slot,))
        due = [self.row(*r) for r in rows if r[us] <= until]
        later = [r for r in rows if r[us] > until]
        if later:
            self._put(later, us)
            first = min(r[us] for r in later)
            beyond = first if beyond is None else min(first, beyond)
        return sorted(due, key=lambda r: tuple(r[c] for c in [_US, *self.order])), beyond

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.timer.clear()
        until = timerValues.getCurrentWatermarkInMs() * 1000
        due, later = self._due(until)
        stored = self.state.get()
        state, deadline = (self.machine.start(), None) if stored is None else (tuple(stored[:-1]), stored[-1])
        for view in self.machine.maps.values():
            view.begin()
        self.machine.begin()
        out: list[tuple] = []
        for row in due:
            while deadline is not None and deadline < row[_US]:
                state, rows_out, deadline = self.machine.on_deadline(state, deadline)
                out += rows_out
            state, rows_out, deadline = self.machine.on_row(state, row[_US], row)
            out += rows_out
        while deadline is not None and deadline <= until:
            state, rows_out, deadline = self.machine.on_deadline(state, deadline)
            out += rows_out
        self.state.update((*state, deadline))
        for view in self.machine.maps.values():
            view.write()
        pending = [t for t in (later, deadline) if t is not None]
        if pending:
            self._wake_at(min(pending))
        for values in out:
            yield self.result(*key, *values)

    def _wake_at(self, us: int) -> None:
        at = -(-us // 1000)
        current = self.timer.get()
        if current is not None:
            if current[0] <= at:
                return
            self.handle.deleteTimer(current[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


def run_machine(
    stream: DataFrame, keys: Sequence[str], ts: str, machine: Machine, columns: Sequence[str], order: Sequence[str] = (),
    slot: timedelta = SLOT,
) -> DataFrame:
    """Apply ``machine`` per key to a stream with a watermark on ``ts``. Output: keys and ``machine.output_schema``.

    ``order`` breaks ties in time. Only ``columns`` (and what order and time need) are kept in state, by ``slot``.
    """
    needed = [c for c in dict.fromkeys([*columns, *order]) if c != ts]
    with_us = stream.select(*keys, ts, *[c for c in needed if c not in keys], F.unix_micros(ts).alias(_US))
    kept = T.StructType([with_us.schema[c] for c in [*needed, _US]])
    output = T.StructType([*[stream.schema[k] for k in keys], *machine.output_schema.fields])
    processor = _InOrder(machine, order, kept, output.names, slot)
    return with_us.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="append", timeMode="eventTime"
    )
