"""Keyed alerts over the history of each key (batch forms)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.operators import durations as d
from streamlab.operators.history import (
    HOT_ROWS,
    History,
    Scan,
    following,
    last_so_far,
    next_match,
    previous,
    running_count,
    running_sum,
    scan,
)
from streamlab.session import checkpointed


def jump_alarm(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, threshold: float,
    upward_only: bool = False, hot_rows: int | None = None,
) -> DataFrame:
    """Rows whose value differs from the previous one of the key by more than ``threshold``."""
    seen = scan(df, keys, order, {"_p": previous(value)}, hot_rows)
    change = F.col(value) - F.col(f"_p.{value}")
    big = (change if upward_only else F.abs(change)) > threshold
    return seen.where(big).withColumn(f"previous_{value}", F.col(f"_p.{value}")).drop("_p")


def _anchor_windows(rows: DataFrame, keys: Sequence[str], ts: str, length: timedelta, hot_rows: int | None = None) -> DataFrame:
    """Windows anchored at the first row not covered by the window before: [t0, t0 + length].

    Input columns: keys, ``_chain`` (rows of two chains never share a window), ``ts`` and ``_stop`` (time of the event
    that ends the chain, if any). Output: keys, ``first_ts``, ``last_ts``, ``cnt``, ``stop_ts``.

    Rows of a chain that share a time are reduced to one. A chain no longer than a window is one window. In the others
    every row links to the first row after its own window, and an anchor is a row that links reach from the chain's first
    row. Links are doubled: after round k the rows up to 2^k links away are known and links lead 2^k rows further, so
    the number of rounds is the logarithm of the windows in a chain, and each is a join of links by chain and time. Rows
    then take the last anchor before them.
    """
    span = d.micros(length)
    group = [*keys, "_chain"]

    def as_us(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    # one key for the chain, in which NULL keys are equal in joins too
    merged = checkpointed(
        rows.groupBy(F.struct(*group).alias("_c"), as_us(ts).alias("_us"))
        .agg(F.count("*").alias("_n"), F.max(as_us("_stop")).alias("_stop_us"))
    )
    chain = merged.groupBy("_c").agg(
        F.min("_us").alias("first_us"), F.max("_us").alias("last_us"), F.sum("_n").alias("cnt"), F.max("_stop_us").alias("stop_us"),
        F.count("*").alias("_rows"))
    long = F.col("last_us") - F.col("first_us") > span
    # anchors of a chain lie more than a window apart
    most, hops = chain.where(long).agg(F.max("_rows"), F.max(F.expr(f"(last_us - first_us) div {span + 1}"))).first()
    found = chain.where(~long).drop("_rows")
    if most is not None:
        def history(df: DataFrame, order: list[str]) -> History:
            if most <= (HOT_ROWS if hot_rows is None else hot_rows):
                return History(df, ("_c",), tuple(order), split=False)
            return History.of(df, ["_c"], order, hot_rows)

        heads = chain.where(long).select("_c", F.col("first_us").alias("_us"))
        walked = merged.join(heads.select("_c"), "_c", "left_semi")
        anchors = _reached(_window_links(walked, span, history), heads, hops.bit_length())
        marked = walked.join(anchors.withColumn("_anchor", F.col("_us")), ["_c", "_us"], "left")
        own = history(marked, ["_us"]).scan(_anchor=last_so_far(F.col("_anchor"))).rows
        found = found.unionByName(own.groupBy("_c", F.col("_anchor").alias("first_us")).agg(
            F.max("_us").alias("last_us"), F.sum("_n").alias("cnt"), F.max("_stop_us").alias("stop_us")))
    kind = rows.schema[ts].dataType.simpleString()
    return found.select(
        *[F.col(f"_c.{k}").alias(k) for k in keys],
        F.timestamp_micros("first_us").cast(kind).alias("first_ts"),
        F.timestamp_micros("last_us").cast(kind).alias("last_ts"),
        "cnt",
        F.timestamp_micros("stop_us").cast(kind).alias("stop_ts"),
    )


def _window_links(rows: DataFrame, span: int, history: Callable[[DataFrame, list[str]], History]) -> DataFrame:
    """(_c, _us, _to): the first row of the chain later than ``span`` after each row."""
    # a mark at the end of each row's window, behind rows of the same time, sees the next row as its following one
    both = rows.select("_c", "_us", F.inline(F.array(
        F.struct(F.col("_us").alias("_at"), F.lit(0).alias("_mark")), F.struct((F.col("_us") + span).alias("_at"), F.lit(1).alias("_mark")))))
    seen = history(both, ["_at", "_mark"]).scan(_to=next_match(F.col("_mark") == 0, F.col("_us"))).rows
    return seen.where("_mark = 1 and _to is not null").select("_c", "_us", F.col("_to._us").alias("_to"))


def _reached(links: DataFrame, heads: DataFrame, rounds: int) -> DataFrame:
    """(_c, _us) of all rows that ``links`` reach from ``heads``, these included, in fewer than 2^rounds links."""
    reached = heads
    if rounds > 1:
        links = checkpointed(links)
    for k in range(rounds):
        # rows reached so far are fewer links away than the new ones, so none comes twice
        new = reached.join(links, ["_c", "_us"]).select("_c", F.col("_to").alias("_us"))
        reached = reached.unionByName(new if rounds == 1 else checkpointed(new))
        if k + 1 < rounds:
            further = links.select("_c", F.col("_us").alias("_to"), F.col("_to").alias("_then"))
            links = checkpointed(links.join(further, ["_c", "_to"]).select("_c", "_us", F.col("_then").alias("_to")))
    return reached


def no_decrease_alarm(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, length: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Alarm when ``length`` passes after a rise without a fall. A first reading counts as a rise.

    A rise starts the clock unless it runs; a fall stops it; after an alarm the next rise starts it again. NULL readings
    are left out.
    """
    ts = order[0]
    seen = History.of(df.where(F.col(value).isNotNull()), keys, order, hot_rows).scan(_p=previous(value, ts))
    before, gap = F.col(f"_p.{value}"), F.col(ts) - F.col(f"_p.{ts}")
    seen = seen.with_columns(
        _fall=F.coalesce(F.col(value) < before, F.lit(False)),
        _rise=F.coalesce(F.col(value) > before, F.lit(True)),
        _far=F.coalesce(gap > F.lit(length), F.lit(False)),
    )
    # no window reaches over a fall or over a silence longer than itself, so chains are cut there
    cut = (F.col("_fall") | F.col("_far")).cast("long")
    chained = seen.scan(_chain=running_sum(cut), _f=next_match(F.col("_fall"), ts))
    rises = chained.rows.where("_rise").select(*keys, ts, "_chain", F.col(f"_f.{ts}").alias("_stop"))
    clocks = _anchor_windows(rises, keys, ts, length, hot_rows)
    due = F.col("first_ts") + F.lit(length)
    return clocks.where(F.col("stop_ts").isNull() | (F.col("stop_ts") > due)).select(
        *keys, F.col("first_ts").alias("rise_ts"), due.alias("alarm_ts")
    )


def adjacent_fails(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, failed: Column, within: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Alert on a failed row whose predecessor failed too, at most ``within`` away in either direction."""
    marked = df.withColumn("_fail", failed)
    seen = scan(marked, keys, order, {"_p": previous("_fail", ts)}, hot_rows)
    distance = F.abs(d.seconds_between(ts, F.col(f"_p.{ts}")))
    hit = F.col("_fail") & F.col("_p._fail") & (distance <= within.total_seconds())
    return seen.where(hit).select(*keys, F.col(f"_p.{ts}").alias("first_ts"), F.col(ts).alias("second_ts"))


def fail_windows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column, length: timedelta, at_least: int = 2,
    hot_rows: int | None = None,
) -> DataFrame:
    """The first failure opens a window of ``length``; a success inside it cancels; else it alerts when it closes.

    Gives the first and last failure and their number for windows with ``at_least`` failures.
    """
    ts = order[0]
    marked = df.withColumn("_fail", failed)
    seen = History.of(marked, keys, order, hot_rows).scan(_p=previous("_fail", ts), _f=following("_fail", ts))
    adjacent = F.col("_p._fail") & (F.col(ts) - F.col(f"_p.{ts}") <= F.lit(length))
    cut = (F.col("_fail") & ~F.coalesce(adjacent, F.lit(False))).cast("long")
    fails = seen.scan(_chain=running_sum(cut)).rows.where("_fail")
    fails = fails.select(*keys, ts, "_chain", F.when(~F.col("_f._fail"), F.col(f"_f.{ts}")).alias("_stop"))
    opened = _anchor_windows(fails, keys, ts, length, hot_rows)
    cancelled = F.coalesce(F.col("stop_ts") <= F.col("first_ts") + F.lit(length), F.lit(False))
    return opened.where(~cancelled & (F.col("cnt") >= at_least)).drop("stop_ts")


def order_timeout(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], created: Column, paid: Column, within: timedelta,
    hot_rows: int | None = None,
) -> DataFrame:
    """Status of each create (``paid`` or ``no_pay``) and of each pay without a create in the time before it.

    A create is paid by the first pay at most ``within`` after it, both ends included; at equal times creates come
    before pays.
    """
    ts = order[0]
    events = df.withColumn("_create", created).withColumn("_pay", paid).where("_create or _pay")
    events = events.withColumn("_kind", F.when(F.col("_create"), 0).otherwise(1))
    in_order = [ts, "_kind", *order[1:]]
    last_create = Scan("last", F.when(F.col("_create"), F.col(ts)), inclusive=False)
    seen = scan(
        events, keys, in_order, {"_c": last_create, "_f": next_match(F.col("_pay"), ts)}, hot_rows
    )
    pay = F.col(f"_f.{ts}")
    in_time = F.coalesce(pay - F.col(ts) <= F.lit(within), F.lit(False))
    live = F.coalesce(F.col(ts) - F.col("_c") <= F.lit(within), F.lit(False))
    return (
        seen.withColumn(
            "status",
            F.when(F.col("_create"), F.when(in_time, "paid").otherwise("no_pay")).when(~live, "pay_without_create"),
        )
        .where("status is not null")
        .select(
            *keys,
            "status",
            F.when(F.col("_create"), F.col(ts)).alias("create_ts"),
            F.when(F.col("status") == "paid", pay).when(F.col("_pay"), F.col(ts)).alias("pay_ts"),
        )
    )


def _ranked_by_day(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, utc_offset: timedelta, hot_rows: int
) -> DataFrame:
    dated = df.withColumn("local_day", F.to_date(F.col(ts) + F.lit(utc_offset)))
    return scan(dated, [*keys, "local_day"], order, {"_n": running_count()}, hot_rows)


def blacklist_pass(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, limit: int,
    utc_offset: timedelta = timedelta(hours=8), hot_rows: int | None = None,
) -> DataFrame:
    """Rows below the daily ``limit`` of their key; the count starts again at local midnight."""
    return _ranked_by_day(df, keys, order, ts, utc_offset, hot_rows).where(F.col("_n") < limit).drop("_n")


def blacklist_warnings(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, limit: int,
    utc_offset: timedelta = timedelta(hours=8), hot_rows: int | None = None,
) -> DataFrame:
    """One row per key and local day that reaches the ``limit``: the row that did."""
    return _ranked_by_day(df, keys, order, ts, utc_offset, hot_rows).where(F.col("_n") == limit).drop("_n")
