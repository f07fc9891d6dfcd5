"""Streaming forms of the keyed alerts, as machines for ``run_machine``."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.operators.durations import micros
from streamlab.streaming.event_time import Machine, run_machine


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


LONG, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()


class Jump(Machine):
    state_schema = _schema(previous=DOUBLE)
    output_schema = _schema(at_us=LONG, value=DOUBLE, previous_value=DOUBLE)

    def __init__(self, value: str, threshold: float, upward_only: bool = False) -> None:
        self.value, self.threshold, self.upward_only = value, threshold, upward_only

    def on_row(self, state: tuple, at: int, row: Row):
        (before,), now = state, row[self.value]
        # NULL readings make no change, as in the batch form
        change = 0.0 if before is None or now is None else now - before
        hit = (change if self.upward_only else abs(change)) > self.threshold
        return (now,), [(at, now, before)] if hit else [], None


class NoDecrease(Machine):
    state_schema = _schema(previous=DOUBLE, rise_us=LONG)
    output_schema = _schema(rise_us=LONG, alarm_us=LONG)

    def __init__(self, value: str, length: timedelta) -> None:
        self.value, self.length = value, micros(length)

    def on_row(self, state: tuple, at: int, row: Row):
        (before, rise), now = state, row[self.value]
        if now is None:
            return state, [], None if rise is None else rise + self.length
        if rise is None and (before is None or now > before):
            rise = at
        elif rise is not None and now < before:
            rise = None
        return (now, rise), [], None if rise is None else rise + self.length

    def on_deadline(self, state: tuple, at: int):
        before, rise = state
        return (before, None), [(rise, at)], None


class CountAndNoDecrease(NoDecrease):
    """Running count of a key and the no-decrease alarm in one pass, told apart by ``tag`` for a fan-out sink."""

    state_schema = _schema(previous=DOUBLE, rise_us=LONG, cnt=LONG)
    output_schema = _schema(tag=STRING, at_us=LONG, cnt=LONG)

    def on_row(self, state: tuple, at: int, row: Row):
        alarm, _, deadline = super().on_row(state[:2], at, row)
        count = (state[2] or 0) + 1
        return (*alarm, count), [("count", at, count)], deadline

    def on_deadline(self, state: tuple, at: int):
        return (state[0], None, state[2]), [("alarm", at, state[2])], None


class AdjacentFails(Machine):
    state_schema = _schema(fail_us=LONG)
    output_schema = _schema(first_us=LONG, second_us=LONG)

    def __init__(self, failed: str, within: timedelta) -> None:
        self.failed, self.within = failed, micros(within)

    def on_row(self, state: tuple, at: int, row: Row):
        if not row[self.failed]:
            return (None,), [], None
        (before,) = state
        hit = before is not None and at - before <= self.within
        return (at,), [(before, at)] if hit else [], None


class FailWindow(Machine):
    state_schema = _schema(first_us=LONG, last_us=LONG, cnt=LONG)
    output_schema = state_schema

    def __init__(self, failed: str, length: timedelta, at_least: int = 2) -> None:
        self.failed, self.length, self.at_least = failed, micros(length), at_least

    def on_row(self, state: tuple, at: int, row: Row):
        if not row[self.failed]:
            return self.start(), [], None
        first, _, count = state
        state = (at, at, 1) if first is None else (first, at, count + 1)
        return state, [], state[0] + self.length

    def on_deadline(self, state: tuple, at: int):
        return self.start(), [state] if state[2] >= self.at_least else [], None


class OrderTimeout(Machine):
    """Every create is open until ``within`` after it; the first pay up to then pays all creates that are open.

    At equal times creates come before pays: give the row that says so first in the machine's order.
    """

    state_schema = _schema(open_us=T.ArrayType(LONG), create_us=LONG)
    output_schema = _schema(status=STRING, create_us=LONG, pay_us=LONG)

    def __init__(self, created: str, paid: str, within: timedelta) -> None:
        self.created, self.paid, self.within = created, paid, micros(within)

    def _next(self, unpaid: list[int], last: int | None) -> int | None:
        return unpaid[0] + self.within if unpaid else None if last is None else last + self.within

    def on_row(self, state: tuple, at: int, row: Row):
        unpaid, last, out = list(state[0] or []), state[1], []
        if row[self.created]:
            unpaid, last = [*unpaid, at], at
        elif row[self.paid] and last is None:
            out = [("pay_without_create", None, at)]
        elif row[self.paid]:
            out, unpaid = [("paid", create, at) for create in unpaid], []
        return (unpaid, last), out, self._next(unpaid, last)

    def on_deadline(self, state: tuple, at: int):
        unpaid, last = list(state[0] or []), state[1]
        over = [create for create in unpaid if create + self.within <= at]
        unpaid = unpaid[len(over):]
        last = None if last is None or last + self.within <= at else last
        return (unpaid, last), [("no_pay", create, None) for create in over], self._next(unpaid, last)


class Blacklist(Machine):
    """Daily limit per key: rows below it pass, the row that reaches it warns, later rows of the day are dropped."""

    state_schema = _schema(day=LONG, n=LONG)
    output_schema = _schema(kind=STRING, at_us=LONG, id=LONG)

    def __init__(self, row_id: str, limit: int, utc_offset: timedelta = timedelta(hours=8)) -> None:
        self.row_id, self.limit, self.offset = row_id, limit, micros(utc_offset)

    def on_row(self, state: tuple, at: int, row: Row):
        day, n = state
        today = (at + self.offset) // 86_400_000_000
        n = n + 1 if day == today else 1
        midnight = (today + 1) * 86_400_000_000 - self.offset
        kind = "pass" if n < self.limit else "warn" if n == self.limit else None
        return (today, n), [(kind, at, row[self.row_id])] if kind else [], midnight

    def on_deadline(self, state: tuple, at: int):
        return self.start(), [], None


def with_times(df: DataFrame) -> DataFrame:
    """Microsecond columns ``x_us`` as timestamps ``x_ts``."""
    return df.select(*[
        F.timestamp_micros(c).alias(f"{c[:-3]}_ts") if c.endswith("_us") else F.col(c) for c in df.columns
    ])


__all__ = ["AdjacentFails", "Blacklist", "CountAndNoDecrease", "FailWindow", "Jump", "NoDecrease", "OrderTimeout", "run_machine", "with_times"]
