"""Sequence patterns per key.

A pattern is a list of stages. ``match_pattern`` finds, for every row that satisfies the first stage, the earliest way
to satisfy the others (every start is tried, later starts may overlap), as neighbour columns from ``scan``: the last
stage is looked up first, so each stage row already carries the rest of its match. ``streamlab.streaming.patterns``
runs the same specification on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.operators.history import History, following, next_match

NEXT, FOLLOWED_BY, NOT_FOLLOWED_BY = "next", "followed_by", "not_followed_by"


@dataclass(frozen=True)
class Stage:
    name: str
    where: str
    contiguity: str = FOLLOWED_BY


@dataclass(frozen=True)
class Pattern:
    """Built stage by stage: ``Pattern.begin("a", "x > 1").followed_by("b", "x < 0").within(timedelta(minutes=5))``."""

    stages: tuple[Stage, ...]
    limit: timedelta | None = None
    absent: Stage | None = field(default=None)

    @staticmethod
    def begin(name: str, where: str) -> Pattern:
        return Pattern((Stage(name, where),))

    def _add(self, stage: Stage) -> Pattern:
        if self.absent is not None:
            raise ValueError("not_followed_by must be the last stage")
        if stage.name in [s.name for s in self.stages]:
            raise ValueError(f"stage {stage.name!r} is declared twice")
        return replace(self, stages=(*self.stages, stage))

    def next(self, name: str, where: str) -> Pattern:
        """The very next row of the key must match."""
        return self._add(Stage(name, where, NEXT))

    def followed_by(self, name: str, where: str) -> Pattern:
        """The first later row that matches; rows between are ignored."""
        return self._add(Stage(name, where, FOLLOWED_BY))

    def not_followed_by(self, name: str, where: str) -> Pattern:
        """Last stage: no later row within the limit matches. The match is known at the deadline."""
        if name in [s.name for s in self.stages]:
            raise ValueError(f"stage {name!r} is declared twice")
        return replace(self, absent=Stage(name, where, NOT_FOLLOWED_BY))

    def times(self, n: int, consecutive: bool = False) -> Pattern:
        """The last stage ``n`` times, on adjacent rows if ``consecutive``."""
        last, how = self.stages[-1], NEXT if consecutive else FOLLOWED_BY
        copies = [Stage(f"{last.name}_{i}", last.where, last.contiguity if i == 1 else how) for i in range(1, n + 1)]
        return replace(self, stages=(*self.stages[:-1], *copies))

    def within(self, limit: timedelta) -> Pattern:
        """The last row must come less than ``limit`` after the first."""
        return replace(self, limit=limit)

    def stage(self, name: str) -> Stage:
        for s in self.stages:
            if s.name == name:
                return s
        raise KeyError(f"no stage {name!r}; stages are {[s.name for s in self.stages]}")


def match_pattern(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pattern: Pattern, columns: Sequence[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Matches and timeouts: keys, one struct of ``columns`` per stage, and ``status``.

    ``matched``: all stages found in time. ``timeout``: the match was still waiting when its time ran out (or the input
    ended); stages not reached are NULL. Starts broken by a row that violates ``next`` give no row.
    """
    if pattern.absent is not None and pattern.limit is None:
        raise ValueError("not_followed_by needs a limit")
    ts = order[0]
    stages = [*pattern.stages, *([pattern.absent] if pattern.absent else [])]
    flags = {f"_is{i}": F.coalesce(F.expr(s.where), F.lit(False)) for i, s in enumerate(stages)}
    carried = list(dict.fromkeys([*keys, *order, *columns]))
    rows = df.select(*carried, *[c.alias(n) for n, c in flags.items()])
    if not any(s.contiguity == NEXT for s in stages):
        rows = rows.where(reduce(lambda a, b: a | b, [F.col(n) for n in flags]))
    history = History.of(rows, keys, order, hot_rows)
    event = list(dict.fromkeys([ts, *columns]))
    for i in range(len(stages) - 1, 0, -1):
        rest = [f"_s{i + 1}"] if i + 1 < len(stages) else []
        if stages[i].contiguity == NEXT:
            found = following(*event, f"_is{i}", *rest)
        else:
            found = next_match(F.col(f"_is{i}"), *event, f"_is{i}", *rest)
        history = history.scan(**{f"_s{i}": found}).drop(*rest)

    start = F.col(ts)
    path, ok, waiting, alive = "", {}, F.lit(False), F.lit(True)
    for i in range(1, len(stages)):
        path = f"{path}.`_s{i}`" if path else f"_s{i}"
        at = F.col(f"{path}.`{ts}`")
        there = at.isNotNull()
        if pattern.limit is not None:
            there = there & (at - start < F.lit(pattern.limit))
        there = F.coalesce(there, F.lit(False))
        good = there & F.coalesce(F.col(f"{path}.`_is{i}`"), F.lit(False))
        waiting = waiting | (alive & ~there)
        alive = alive & good
        ok[i] = (alive, path)

    out = [F.struct(*columns).alias(stages[0].name)]
    for i in range(1, len(pattern.stages)):
        reached, path = ok[i]
        value = F.struct(*[F.col(f"{path}.`{c}`").alias(c) for c in columns])
        out.append(F.when(reached, value).alias(stages[i].name))
    if pattern.absent is not None:
        reached = ok[len(stages) - 2][0] if len(stages) > 2 else F.lit(True)
        found = ok[len(stages) - 1][0]
        status = F.when(reached & ~found, "matched").when(~reached & waiting, "timeout")
    else:
        status = F.when(alive, "matched").when(waiting, "timeout")
    return history.rows.where("_is0").select(*keys, *out, status.alias("status")).where("status is not null")


def joined_events(pattern: Pattern, column: str, separator: str = "->") -> str:
    """SQL expression that writes one field of all reached stages in order, e.g. ``add->order``."""
    parts = ", ".join(f"`{s.name}`.`{column}`" for s in pattern.stages)
    return f"concat_ws('{separator}', {parts})"
