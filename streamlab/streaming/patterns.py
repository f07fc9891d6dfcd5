"""Sequence patterns on a stream: the specification of ``streamlab.operators.patterns`` as a machine."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.operators.durations import micros
from streamlab.operators.patterns import NEXT, Pattern
from streamlab.streaming.event_time import Machine, run_machine


class _Matches(Machine):
    """Partial matches in a map by (stages reached, deadline); those of one entry began at the same time.

    All partial matches at a stage move on together, so a row touches the entries of the stages it matches (or breaks, where
    the next row must match) and no others, and an entry is written once a stage.
    """

    state_schema = T.StructType([T.StructField("rows", T.LongType())])
    map_schemas = {"partials": ("stage int, deadline_us long", "paths array<array<long>>")}

    def __init__(self, pattern: Pattern, row_id: str) -> None:
        self.names = [s.name for s in pattern.stages]
        self.strict = [s.contiguity == NEXT for s in pattern.stages]
        self.absent = pattern.absent is not None
        self.limit, self.row_id = micros(pattern.limit), row_id
        self.output_schema = T.StructType(
            [T.StructField(f"{n}_id", T.LongType()) for n in self.names] + [T.StructField("status", T.StringType())]
        )

    def _row(self, ids: list, status: str) -> tuple:
        return (*ids, *[None] * (len(self.names) - len(ids)), status)

    def begin(self) -> None:
        # deadlines of each stage, earliest first
        self.at = {n: deque() for n in range(1, len(self.names) + 1)}
        for stage, deadline in self.maps["partials"]:
            self.at[stage].append(deadline)

    def _take(self, stage: int) -> list[tuple[int, list]]:
        found = [(t, self.maps["partials"].get((stage, t))[0]) for t in self.at[stage]]
        for t in self.at[stage]:
            self.maps["partials"].remove((stage, t))
        self.at[stage].clear()
        return found

    def _wait(self, stage: int, deadline: int, paths: list) -> None:
        held = self.maps["partials"].get((stage, deadline))
        if held is None:
            self.at[stage].append(deadline)
        self.maps["partials"].put((stage, deadline), ([*(held[0] if held else []), *paths],))

    def _next(self) -> int | None:
        return min((d[0] for d in self.at.values() if d), default=None)

    def on_row(self, state: tuple, at: int, row: Row):
        complete, out = len(self.names), []
        for n in range(complete, 0, -1):  # from behind, so that what moves on is not met again
            if not self.at[n]:
                continue
            if n == complete:  # waiting for the absent stage
                if row[f"_is{n}"]:
                    self._take(n)
            elif row[f"_is{n}"]:
                for deadline, paths in self._take(n):
                    longer = [[*p, row[self.row_id]] for p in paths]
                    if n + 1 == complete and not self.absent:
                        out += [self._row(p, "matched") for p in longer]
                    else:
                        self._wait(n + 1, deadline, longer)
            elif self.strict[n]:
                self._take(n)
        if row["_is0"]:
            ids = [row[self.row_id]]
            if complete == 1 and not self.absent:
                out.append(self._row(ids, "matched"))
            else:
                self._wait(1, at + self.limit - 1, [ids])
        return ((state[0] or 0) + 1,), out, self._next()

    def on_deadline(self, state: tuple, at: int):
        out = []
        for n, deadlines in self.at.items():
            while deadlines and deadlines[0] <= at:
                key = (n, deadlines.popleft())
                out += [self._row(p, "matched" if n == len(self.names) else "timeout") for p in self.maps["partials"].get(key)[0]]
                self.maps["partials"].remove(key)
        return state, out, self._next()


def match_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, pattern: Pattern, row_id: str
) -> DataFrame:
    """Matches and timeouts of a pattern with a limit: keys, ``<stage>_id`` per stage (a bigint id) and ``status``."""
    if pattern.limit is None:
        raise ValueError("a stream needs a limit, or partial matches would stay in state for ever")
    stages = [*pattern.stages, *([pattern.absent] if pattern.absent else [])]
    flags = {f"_is{i}": F.coalesce(F.expr(s.where), F.lit(False)) for i, s in enumerate(stages)}
    flagged = stream.select(*keys, ts, row_id, *[c.alias(n) for n, c in flags.items()])
    if not any(s.contiguity == NEXT for s in stages):
        # naming the time column keeps this filter above the watermark, which all rows should move
        flagged = flagged.where(F.when(F.col(ts).isNotNull(), F.expr(" or ".join(flags))))
    return run_machine(flagged, keys, ts, _Matches(pattern, row_id), [row_id, *flags], order=[row_id])
