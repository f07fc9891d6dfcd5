"""Tumbling, sliding, session, day-offset and count windows (batch forms).

Aggregates are given as ``{name: Agg}`` so that every window kind can combine partial results. ``window_start`` and
``window_end`` are plain columns of the type of the time column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta
from math import gcd

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streamlab.operators import durations as d
from streamlab.operators.arrow_runs import Batches, by_key
from streamlab.operators.history import (
    History,
    Scan,
    last_so_far,
    running_count,
    scan,
)


@dataclass(frozen=True)
class Agg:
    """A mergeable aggregate: ``first`` and ``last`` (needs ``by``) are merged by their order value."""

    fn: str
    value: Column | None = None
    by: Column | None = None

    def _value(self) -> Column:
        return F.lit(1) if self.value is None else self.value

    def over(self) -> Column:
        """The aggregate over input rows."""
        v = self._value()
        return {
            "count": lambda: F.count(v),
            "sum": lambda: F.sum(v),
            "min": lambda: F.min(v),
            "max": lambda: F.max(v),
            "first": lambda: F.min_by(v, self.by),
            "last": lambda: F.max_by(v, self.by),
        }[self.fn]()

    def partial(self, name: str) -> list[Column]:
        columns = [self.over().alias(name)]
        if self.fn in ("first", "last"):
            columns.append((F.min if self.fn == "first" else F.max)(self.by).alias(f"{name}__by"))
        return columns

    def merge(self, name: str) -> Column:
        """The aggregate over partial results."""
        fn = "sum" if self.fn == "count" else self.fn
        return Agg(fn, F.col(name), F.col(f"{name}__by")).over().alias(name)


def _bounds(df: DataFrame) -> DataFrame:
    at = df.columns.index("window")
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return df.select(*df.columns[:at], *bounds, *df.columns[at + 1:])


def window_of(ts: str, size: timedelta, slide: timedelta | None = None, offset: timedelta | None = None) -> Column:
    return F.window(ts, d.text(size), d.text(slide or size), d.text(offset) if offset else None).alias("window")


def tumble(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: timedelta,
    aggs: dict[str, Agg],
    offset: timedelta | None = None,
) -> DataFrame:
    """One row per key and tumbling window; ``offset`` moves the bounds, e.g. 16 hours for UTC+8 days."""
    grouped = df.groupBy(*keys, window_of(ts, size, offset=offset))
    return _bounds(grouped.agg(*[a.over().alias(n) for n, a in aggs.items()]))


def hop_plain(
    df: DataFrame, keys: Sequence[str], ts: str, size: timedelta, slide: timedelta, aggs: dict[str, Agg]
) -> DataFrame:
    """Sliding windows by copying every row into its windows; right for any aggregate, heavy for a large fan-out."""
    grouped = df.groupBy(*keys, window_of(ts, size, slide))
    return _bounds(grouped.agg(*[a.over().alias(n) for n, a in aggs.items()]))


def hop(
    df: DataFrame, keys: Sequence[str], ts: str, size: timedelta, slide: timedelta, aggs: dict[str, Agg]
) -> DataFrame:
    """Sliding windows in two steps: aggregate per pane, then merge the panes of each window.

    A pane is the greatest common divisor of size and slide, so it lies wholly inside or outside a window and rows are
    shuffled once per pane instead of once per window. Panes are copied with one ``explode``; the expression Spark
    generates for a sliding ``window`` has a branch per copy and does not compile for hundreds of them.

    Panes are dealt out by key and stretch of ``STRETCH`` slides before they are copied, so copies are not shuffled, to as many
    tasks as keep a task's windows below about ``COPIES``.
    """
    pane = timedelta(microseconds=gcd(d.micros(size), d.micros(slide)))
    partials = [column for n, a in aggs.items() for column in a.partial(n)]
    panes = df.groupBy(*keys, window_of(ts, pane)).agg(*partials).withColumn("_pane", F.col("window.start"))
    fan_out, step = -(-d.micros(size) // d.micros(slide)), d.micros(slide)
    kind = panes.schema["_pane"].dataType.simpleString()
    length = STRETCH * step
    panes = (
        panes.withColumn("window", window_of("_pane", slide))
        .withColumn("_newest", F.unix_micros(F.col("window.start").cast("timestamp")))
        .drop("window")
        .withColumn("_oldest", F.col("_newest") - (fan_out - 1) * step)
        .withColumn("_stretch", F.explode(F.sequence(_stretch_of("_oldest", length), _stretch_of("_newest", length))))
    )
    tasks = -(-df.count() * fan_out // COPIES)
    dealt = panes.repartition(*([tasks] if tasks > 1 else []), *keys, "_stretch")
    first, last = F.greatest("_oldest", F.col("_stretch") * length), F.least("_newest", (F.col("_stretch") + 1) * length - step)
    copies = dealt.withColumn("window_start", F.explode(F.sequence(first, last, F.lit(step))))
    copies = copies.withColumn("window_start", F.timestamp_micros("window_start").cast(kind))
    if d.micros(size) % d.micros(slide):
        copies = copies.where(F.col("window_start") + F.lit(size) > F.col("_pane"))
    # the stretch follows from the start; naming it lets the grouping stay where the panes are
    merged = copies.groupBy(*keys, "_stretch", "window_start").agg(*[a.merge(n) for n, a in aggs.items()])
    return merged.select(*keys, "window_start", (F.col("window_start") + F.lit(size)).alias("window_end"), *aggs)


def hop_count(
    df: DataFrame, keys: Sequence[str], ts: str, size: timedelta, slide: timedelta, name: str = "cnt"
) -> DataFrame:
    """Sliding counts without copying rows or panes (``slide`` must divide ``size``).

    Each pane raises the count of its windows at one window end and lowers it again ``size`` later. A running sum over
    these changes gives the level between two of them, and the windows are written out from there, so the shuffle
    carries two rows per pane instead of one per window. A key has at most two change rows per slide of the time
    covered, however many input rows it has.
    """
    if d.micros(size) % d.micros(slide):
        raise ValueError("slide must divide size; use hop")
    spans = (
        df.select(*keys, window_of(ts, slide))
        .select(*keys, F.col("window.end").alias("_rise"), (F.col("window.end") + F.lit(size)).alias("_fall"))
    )
    counted = count_levels(spans, keys, slide, name)
    start = (F.col("window_end") - F.lit(size)).alias("window_start")
    return counted.select(*keys, start, "window_end", name)


#: Slides in a stretch of time that one task counts.
STRETCH = 1000
#: Copies of panes that a task of ``hop`` merges, about.
COPIES = 1_000_000


def _stretch_of(at: str, length: int) -> Column:
    return F.expr(f"(({at}) - pmod({at}, {length})) div {length}")


def count_levels(spans: DataFrame, keys: Sequence[str], slide: timedelta, name: str) -> DataFrame:
    """For every window end, the number of spans (rows with ``_rise <= end < _fall``) of the key that cover it.

    Time is cut into stretches of ``STRETCH`` slides. A span is cut where stretches meet, so each stretch of a key is counted
    by itself, without anything carried in, and a busy key is spread over as many groups as it has stretches.
    """
    step = d.micros(slide)
    length = STRETCH * step
    kind = spans.schema["_rise"].dataType.simpleString()
    grouped = spans.groupBy(*keys, "_rise", "_fall").agg(F.count("*").alias("_c"))
    cut = grouped.select(*keys, *[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("_rise", "_fall")], "_c")

    cut = cut.withColumn("_stretch", F.explode(F.sequence(_stretch_of("_rise", length), _stretch_of("_fall - 1", length))))
    rise = F.struct(F.greatest("_rise", F.col("_stretch") * length).alias("_at"), F.col("_c").alias("_by"))
    fall = F.struct(F.least("_fall", (F.col("_stretch") + 1) * length).alias("_at"), (-F.col("_c")).alias("_by"))
    # dealt out by stretch at once: neither the sums nor the levels need another shuffle
    changes = cut.select(*keys, "_stretch", F.inline(F.array(rise, fall))).repartition(*keys, "_stretch")
    changes = changes.groupBy(*keys, "_stretch", "_at").agg(F.sum("_by").alias("_by"))
    in_time = Window.partitionBy(*keys, "_stretch").orderBy("_at")
    levels = changes.select(
        *keys,
        "_at",
        F.sum("_by").over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(name),
        F.lead("_at").over(in_time).alias("_until"),
    ).where((F.col(name) > 0) & F.col("_until").isNotNull())
    ends = F.sequence("_at", F.col("_until") - step, F.lit(step))
    return levels.select(*keys, F.explode(ends).alias("window_end"), name).withColumn(
        "window_end", F.timestamp_micros("window_end").cast(kind))


def with_session(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    gap: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``session_start`` to every row: a session ends when the key is silent for more than ``gap``."""
    ts = order[0]
    history = History.of(df, keys, order, hot_rows).scan(_before=Scan("last", F.col(ts), inclusive=False))
    opens = F.col("_before").isNull() | (F.col(ts) - F.col("_before") > F.lit(gap))
    return history.scan(session_start=last_so_far(F.when(opens, F.col(ts)))).drop("_before").rows


def session(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    gap: timedelta,
    aggs: dict[str, Agg],
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per session; rows exactly one gap apart share a session. ``window_end`` is the last row plus the gap.

    Sessions are labelled with ``scan`` and then grouped with partial aggregation, so neither a busy key nor a long
    session ends up in one task, which a sort-based session window would do.
    """
    ts = order[0]
    labelled = with_session(df, keys, order, gap, hot_rows)
    return (
        labelled.groupBy(*keys, "session_start")
        .agg(F.max(ts).alias("_last"), *[a.over().alias(n) for n, a in aggs.items()])
        .select(
            *keys,
            F.col("session_start").alias("window_start"),
            (F.col("_last") + F.lit(gap)).alias("window_end"),
            *aggs,
        )
    )


def count_tumble(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    aggs: dict[str, Agg],
    hot_rows: int | None = None,
) -> DataFrame:
    """Groups of ``size`` consecutive rows per key; an unfinished group gives no row."""
    numbered = scan(df, keys, order, {"_n": running_count()}, hot_rows)
    return (
        numbered.groupBy(*keys, F.expr(f"(_n - 1) div {size}").alias("window_no"))
        .agg(F.count("*").alias("_rows"), *[a.over().alias(n) for n, a in aggs.items()])
        .where(F.col("_rows") == size)
        .drop("_rows")
    )


def count_hop(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    slide: int,
    aggs: dict[str, Agg],
    hot_rows: int | None = None,
) -> DataFrame:
    """Every ``slide`` rows of a key, the aggregate over its last ``size`` rows (fewer at the start).

    Without hot keys this is a moving frame over the rows of a key. Else windows may reach over slices: rows are reduced to
    panes, as many rows as divide both numbers, and these are copied to their windows.
    """
    history = History.of(df, keys, order, hot_rows)
    if not history.split:
        in_order = Window.partitionBy(*keys).orderBy(*order)
        frame = in_order.rowsBetween(1 - size, Window.currentRow)
        moving = [a.over().over(frame).alias(n) for n, a in aggs.items()]
        rows = df.select(*keys, F.row_number().over(in_order).cast("long").alias("window_no"), *moving)
        return rows.where(F.col("window_no") % slide == 0)
    pane = gcd(size, slide)
    numbered = history.scan(_n=running_count()).rows
    partials = [column for n, a in aggs.items() for column in a.partial(n)]
    panes = numbered.groupBy(*keys, F.expr(f"(_n - 1) div {pane}").alias("_pane")).agg(F.max("_n").alias("_last"), *partials)
    first = F.expr(f"((_pane * {pane} + {pane + slide - 1}) div {slide}) * {slide}")
    last = F.expr(f"_pane * {pane} + {size}")
    fired = F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long")))).alias("window_no")
    return (
        panes.select("*", fired)
        .groupBy(*keys, "window_no")
        .agg(F.max("_last").alias("_reached"), *[a.merge(n) for n, a in aggs.items()])
        .where(F.col("_reached") == F.col("window_no"))
        .drop("_reached")
    )


def fold_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: timedelta,
    value: str,
    start: str = "Start:",
    separator: str = " - ",
    chunk: int = 1000,
    hot_rows: int | None = None,
) -> DataFrame:
    """Text fold of a window in arrival order, e.g. ``Start: - a - b``.

    A busy window would give a cell without bound, so the text comes in numbered pieces of ``chunk`` values; joining
    the pieces of a window in order gives the whole fold.
    """
    ts = order[0]
    w = df.withColumn("window", window_of(ts, size)).select(
        "*", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
    ).drop("window")
    numbered = scan(w, [*keys, "window_start", "window_end"], order, {"_n": running_count()}, hot_rows)
    piece = F.expr(f"(_n - 1) div {chunk}")
    items = F.array_sort(F.collect_list(F.struct("_n", F.col(value).cast("string").alias("_v"))))
    folded = F.array_join(F.transform(items, lambda x: F.concat(F.lit(separator), x["_v"])), "")
    return (
        numbered.groupBy(*keys, "window_start", "window_end", piece.alias("piece"))
        .agg(folded.alias("_text"))
        .select(
            *keys, "window_start", "window_end", "piece",
            F.concat(F.when(F.col("piece") == 0, F.lit(start)).otherwise(F.lit("")), "_text").alias("folded"),
        )
    )


WindowFunction = Callable[[dict, Batches], Iterator[tuple]]
#: Result rows of a window function that are passed on together.
_OUT_ROWS = 10_000


def apply_rows(
    df: DataFrame, keys: Sequence[str], ts: str, size: timedelta, order: Sequence[str], fn: WindowFunction, schema: str,
    slide: timedelta | None = None, offset: timedelta | None = None,
) -> DataFrame:
    """A user's function over all rows of each window: keys, ``window_start``, ``window_end`` and the fields of ``schema``.

    ``fn`` gets the key and bounds of a window (a dict) and an iterator over its rows, sorted by ``order``, as Arrow batches;
    it yields result rows as tuples and need not read to the end. Rows are sorted by Spark, which spills, and a task
    holds one batch, so a window may have any number of rows; what ``fn`` itself keeps is up to it.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema
    bounds = ["window_start", "window_end"]
    rows = df.select("*", window_of(ts, size, slide, offset))
    rows = rows.select(*df.columns, *[F.col(f"window.{b[7:]}").alias(b) for b in bounds])
    group = [*keys, *bounds]
    output = T.StructType([*[rows.schema[c] for c in group], *fields.fields])
    kinds = to_arrow_schema(fields)

    def run(batches: Batches) -> Batches:
        def window(key: tuple, own: Batches) -> Batches:
            head = next(own)

            def all_rows() -> Batches:
                yield head
                yield from own

            def batch(found: list[tuple]) -> pa.RecordBatch:
                names = [pa.array([k] * len(found), head[g].type) for k, g in zip(key, group, strict=True)]
                values = [pa.array(list(v), f.type) for v, f in zip(zip(*found, strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([*names, *values], [*group, *kinds.names])

            found = []
            for row in fn(dict(zip(group, key, strict=True)), all_rows()):
                found.append(row)
                if len(found) == _OUT_ROWS:
                    yield batch(found)
                    found = []
            if found:
                yield batch(found)

        return by_key(batches, group, window)

    return rows.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(run, output)
