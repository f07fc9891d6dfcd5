"""Running and neighbour columns over the ordered history of each key.

A plain window function sends all rows of a key to one task. That is fine until one key holds a large share of the
table, so a ``History`` splits the rows of such *hot* keys into slices along the order column:

1. Rows are counted per key (partial aggregation, only the key is read). Without a key above ``hot_rows`` nothing more is
   done. Else ``hot_keys`` reads the rows of such keys once more for quantiles of their order column, up to four times as
   many as a key needs slices. There can be at most ``rows / hot_rows`` hot keys. The busiest are broadcast, up to ``MOST_SENT`` cuts
   in all; the others are joined by key, past which the rows of the busiest are led. The result is checkpointed.
2. Rows are grouped by (key, slice); keys that are not hot have the single slice NULL. This is the only shuffle of whole
   rows, also when several scans follow each other.
3. Each slice of a hot key is reduced to one summary row, and what a slice needs to know about its neighbours (running
   total so far, last value seen, next match ahead) is carried over these few rows.
4. The usual window functions run per (key, slice) and the carried value is joined on and combined with theirs. The rows
   are already partitioned and sorted for this join; a small carry table is turned into a broadcast at run time.

This is done at every size. Every column is exact but for sums of doubles, which may be added in another order; slicing
only changes how the work is spread. Rows with a NULL key count as one key; rows with NULL in the first order column come
before all others of their key and share a slice.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.session import checkpointed

HOT_ROWS = 1_000_000
#: Cuts of hot keys that are broadcast (under 20 MB); the keys beyond are joined by key.
MOST_SENT = 1_000_000
#: A key is cut into a power of two of segments by its quantiles, at most 2 ** DEPTH; up to 2 ** SHALLOW few quantiles do.
SHALLOW, DEPTH = 4, 12

PARTS = "_parts"
SLICE = "_slice"
KEY = "_key"


@dataclass(frozen=True)
class Scan:
    """One derived column: ``fn`` over the rows before (or after) the current one.

    ``first`` and ``last`` skip nulls; wrap the value in a struct to keep null values. ``peers`` gives rows that tie in
    the order columns the same value (RANGE instead of ROWS).
    """

    fn: str
    value: Column
    inclusive: bool = True
    ahead: bool = False
    peers: bool = False

    def over(self, value: Column) -> Column:
        """The aggregate in scan direction: rows ahead are read in descending order, so *first* becomes *last*."""
        if self.fn in ("first", "last"):
            return (F.last if self._nearest() else F.first)(value, ignorenulls=True)
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.fn](value)

    def summary(self, value: Column, order: Sequence[str]) -> Column:
        """The aggregate over a whole slice."""
        at = F.when(value.isNotNull(), F.struct(*order))
        return {
            "first": lambda: F.min_by(value, at),
            "last": lambda: F.max_by(value, at),
            "sum": lambda: F.sum(value),
            "max": lambda: F.max(value),
            "min": lambda: F.min(value),
        }[self.fn]()

    def combine(self, carried: Column, local: Column) -> Column:
        if self.fn in ("first", "last"):
            return F.coalesce(local, carried) if self._nearest() else F.coalesce(carried, local)
        if self.fn == "sum":
            return F.coalesce(carried + local, carried, local)
        return (F.greatest if self.fn == "max" else F.least)(carried, local)

    def _nearest(self) -> bool:
        """Whether the value closest to the current row wins."""
        return (self.fn == "last") != self.ahead


def running_sum(value: Column, inclusive: bool = True, peers: bool = False) -> Scan:
    return Scan("sum", value, inclusive, peers=peers)


def running_count(inclusive: bool = True, peers: bool = False) -> Scan:
    return Scan("sum", F.lit(1).cast("long"), inclusive, peers=peers)


def running_max(value: Column, inclusive: bool = True, peers: bool = False) -> Scan:
    return Scan("max", value, inclusive, peers=peers)


def running_min(value: Column, inclusive: bool = True, peers: bool = False) -> Scan:
    return Scan("min", value, inclusive, peers=peers)


def first_so_far(value: Column) -> Scan:
    return Scan("first", value)


def last_so_far(value: Column, inclusive: bool = True) -> Scan:
    return Scan("last", value, inclusive)


def previous(*columns: str) -> Scan:
    """Struct of the named columns of the row before this one (NULL on the first row)."""
    return Scan("last", F.struct(*columns), inclusive=False)


def following(*columns: str) -> Scan:
    """Struct of the named columns of the row after this one (NULL on the last row)."""
    return Scan("first", F.struct(*columns), inclusive=False, ahead=True)


def next_match(condition: Column, *columns: str | Column) -> Scan:
    """Struct of the named columns of the first later row that satisfies ``condition``."""
    return Scan("first", F.when(condition, F.struct(*columns)), inclusive=False, ahead=True)


def position(df: DataFrame, column: str) -> Column:
    """Order column as a number, for slicing."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


def hot_counts(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of slices each needs."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    return counted.select(*keys, F.ceil(F.col("_n") / hot_rows).alias(PARTS))


def _depth() -> Column:
    """A key has 2 ** depth segments: two to four times the slices it needs, or the most there are."""
    # one more than the digits of (slices - 1) in base two, counted without a logarithm's rounding
    return F.least(F.length(F.bin(F.col(PARTS) - 1)) + 1, F.lit(DEPTH))


def _two_to(depth: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), depth)


def _busy_depth(sizes: dict[int, int]) -> int:
    """The least depth from which on all hot keys can be broadcast; ``sizes`` has the number of keys by depth."""
    sent = 0
    for depth in sorted(sizes, reverse=True):
        # a key is counted with its cuts, both ends and itself
        sent += sizes[depth] * (2**depth + 2)
        if sent > MOST_SENT:
            return depth + 1
    return 0


def _beside(rows: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], busy: int) -> DataFrame:
    """Rows with the columns of their hot key, NULL for other keys.

    Hot keys at least ``busy`` deep are broadcast. If there are others they are joined by key, and a row that has found its key
    already goes to a task by its place in the order instead. So no task gets all rows of a busy key, and as
    the rows are not left partitioned by key alone, slices are dealt out afterwards.
    """
    found = rows.join(F.broadcast(hot.where(_depth() >= busy)), list(keys), "left")
    if not busy:
        return found
    added = [c for c in hot.columns if c not in keys]
    # always 0, but not a literal, which Spark would take out of the join's keys
    home = (F.col(PARTS) < 1).cast("long")
    others = hot.where(_depth() < busy).select(
        *keys, home.alias("_way"), *[F.col(c).alias(f"_by_key{c}") for c in added])
    way = F.when(F.col(PARTS).isNull(), F.lit(0).cast("long")).otherwise(F.abs(F.xxhash64(*order) % 1_000_000) + 1)
    both = found.withColumn("_way", way).join(others, [*keys, "_way"], "left")
    return both.select(*rows.columns, *[F.coalesce(c, f"_by_key{c}").alias(c) for c in added])


def hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, busy: int = 0) -> DataFrame:
    """The ``hot`` keys with the places of their rows in order: the quantiles that cut them, and both ends."""
    pos, shallow = F.col("_pos"), _depth() <= SHALLOW

    def quantiles(kept: Column, depth: int) -> Column:
        n = 2**depth
        return F.percentile_approx(F.when(kept, pos), [i / n for i in range(1, n)], 20 * n)

    rows = _beside(df.select(*dict.fromkeys([*keys, *order]), position(df, order[0]).alias("_pos")), hot, keys, order, busy)
    places = rows.where(F.col(PARTS).isNotNull()).groupBy(*keys, PARTS).agg(
        F.min(pos).alias("_lo"), F.max(pos).alias("_hi"),
        quantiles(shallow, SHALLOW).alias("_few"), quantiles(~shallow, DEPTH).alias("_many"))

    def thinned(cuts: str, depth: int) -> Column:
        step = _two_to(F.lit(depth) - _depth())
        return F.filter(cuts, lambda _, i: (i + 1) % step == 0)

    cuts = F.when(shallow, thinned("_few", SHALLOW)).otherwise(thinned("_many", DEPTH))
    return places.select(*keys, PARTS, "_lo", cuts.alias("_cuts"), "_hi")


def _with_slice(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], deepest: int, busy: int) -> DataFrame:
    """Add the slice: rows of a hot key are cut at quantiles of the key and evenly in between.

    The quantiles follow bursts, the even cuts give the number of slices. Rows that tie in the first order column share
    a slice; those with NULL there come first and have slice -1. The segment is searched in halves, so a row never walks all
    cuts; each half is its own projection, so Spark computes it once per row. A place beyond the cuts of a key counts
    as not passed.
    """
    pos, segments = F.col("_pos"), _two_to(_depth())
    parts = F.ceil(F.col(PARTS) / segments)
    last = segments - 1
    rows = _beside(df.withColumn("_pos", position(df, order[0])), hot, keys, order, busy).withColumn("_segment", F.lit(0))
    for step in (2**i for i in reversed(range(deepest))):
        passed = F.coalesce(pos >= F.get("_cuts", F.col("_segment") + (step - 1)), F.lit(False))
        rows = rows.withColumn("_segment", F.col("_segment") + F.when(passed, F.lit(step)).otherwise(F.lit(0)))
    low = F.when(F.col("_segment") == 0, F.col("_lo")).otherwise(F.get("_cuts", F.col("_segment") - 1))
    high = F.when(F.col("_segment") == last, F.col("_hi")).otherwise(F.get("_cuts", F.col("_segment")))
    share = (pos - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    within = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * parts), parts - 1)
    number = F.when(pos.isNull(), F.lit(-1)).otherwise(F.col("_segment") * parts + within)
    return (
        rows.withColumn("_low", low).withColumn("_high", high)
        .withColumn(SLICE, F.when(F.col(PARTS).isNotNull(), number))
        .select(*df.columns, PARTS, SLICE)
    )


@dataclass(frozen=True)
class History:
    """Rows with their slice. ``scan`` and the row-wise methods give a new History over the same slices.

    ``order`` must be ascending and total within a key (add an id as the last column); its first column must be a
    number, date or timestamp.
    """

    sliced: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool = True

    @staticmethod
    def of(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> History:
        """``hot_rows`` sets when a key is split; by default it is ``HOT_ROWS``."""
        counted = hot_counts(df, keys, HOT_ROWS if hot_rows is None else hot_rows)
        unkeyed = F.lit(False)
        for k in keys:
            unkeyed = unkeyed | F.col(k).isNull()
        found = counted.groupBy(_depth().alias("_depth")).agg(F.count("*").alias("_n"), F.max(unkeyed).alias("_unkeyed")).collect()
        if not found:
            return History(df, tuple(keys), tuple(order), split=False)
        if any(r["_unkeyed"] for r in found):
            # a struct of NULLs equals another one, so the joins below also find a hot NULL key
            df = df.withColumn(KEY, F.struct(*keys))
            counted = counted.select(F.struct(*keys).alias(KEY), PARTS)
            keys = [KEY]
        sizes = {r["_depth"]: r["_n"] for r in found}
        busy = _busy_depth(sizes)
        # approximate quantiles may differ between two runs, so all branches of the plan read one stored result
        hot = checkpointed(hot_keys(df, keys, order, counted, busy))
        sliced = _with_slice(df, hot, keys, order, max(sizes), busy)
        return History(sliced, tuple(keys), tuple(order))

    @property
    def rows(self) -> DataFrame:
        return self.sliced.drop(PARTS, SLICE, KEY)

    def with_columns(self, **columns: Column) -> History:
        return replace(self, sliced=self.sliced.withColumns(columns))

    def where(self, condition: Column) -> History:
        return replace(self, sliced=self.sliced.where(condition))

    def drop(self, *columns: str) -> History:
        return replace(self, sliced=self.sliced.drop(*columns))

    def scan(self, **columns: Scan) -> History:
        """Add the columns to every row."""
        group = [*self.keys, PARTS, SLICE] if self.split else list(self.keys)
        forward = Window.partitionBy(*group).orderBy(*self.order)
        backward = Window.partitionBy(*group).orderBy(*[F.desc(o) for o in self.order])
        local = []
        for name, s in columns.items():
            window = backward if s.ahead else forward
            if s.peers:
                window = window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
            else:
                window = window.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
            local.append(s.over(s.value).over(window).alias(f"_local_{name}"))
        kept = [c for c in self.sliced.columns if c not in columns]
        if not self.split:
            results = [F.col(f"_local_{n}").alias(n) for n in columns]
            return replace(self, sliced=self.sliced.select("*", *local).select(*kept, *results))
        carried = self._carried(columns)
        joined = self.sliced.select("*", *local).join(carried, group, "left")
        results = [s.combine(F.col(f"_carry_{n}"), F.col(f"_local_{n}")).alias(n) for n, s in columns.items()]
        return replace(self, sliced=joined.select(*kept, *results))

    def _carried(self, columns: dict[str, Scan]) -> DataFrame:
        """Per slice of a hot key, each column's value over all slices before it (or after it)."""
        # PARTS is NULL for other keys: this filter passes through earlier scans, as PARTS is one of their partitioning
        # columns, and turns the join with the hot keys into an inner one
        group = [*self.keys, PARTS, SLICE]
        summary = (
            self.sliced.where(F.col(PARTS).isNotNull())
            .groupBy(*group)
            .agg(*[s.summary(s.value, self.order).alias(f"_carry_{n}") for n, s in columns.items()])
        )
        by_key = Window.partitionBy(*self.keys)
        earlier = by_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        later = by_key.orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
        carries = [
            s.over(F.col(f"_carry_{n}")).over(later if s.ahead else earlier).alias(f"_carry_{n}")
            for n, s in columns.items()
        ]
        return summary.select(*group, *carries)


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, Scan], hot_rows: int | None = None
) -> DataFrame:
    """One scan over ``df``; use ``History`` for several in a row."""
    return History.of(df, keys, order, hot_rows).scan(**columns).rows
