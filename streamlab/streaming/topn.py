"""Top-N of each window as the stream itself gives it: every change of a ranking is withdrawn and added at once.

Two stateful operators in a row. The first counts a window's rows by item, in shards that hold many items in an entry of the state, so
that calls of the state do not grow with the items, and passes on the best counts of items that changed. The
second holds a window's ranking in map state: counts only grow, so the new ranking is the best of the old one and the changed
items, and no list of all items is kept. Both let go of a window when the watermark passes its end; delay the stream's watermark by
out-of-orderness and lateness, and a late row changes the ranking until then.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta
from heapq import nsmallest
from zlib import crc32

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlab.operators.windows import window_of
from streamlab.streaming.map_state import MapView

_EPOCH = datetime(1970, 1, 1)


def _millis(at: datetime) -> int:
    return (at.replace(tzinfo=None) - _EPOCH) // timedelta(milliseconds=1)


def _order(counts: Mapping[str, int], n: int) -> list[tuple[str, int]]:
    return nsmallest(n, counts.items(), key=lambda x: (-x[1], x[0].encode()))


#: Items in an entry of the state, on average, before the entries are doubled.
_FULL = 1000


class _Counts(StatefulProcessor):
    """Counts of a window's items of one shard, many items to an entry of the state; passes on the best of those that changed.

    Counts only grow, so an item behind ``n`` others that changed with it is in no ranking until it changes again.
    """

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "items long, entries long")
        self.counts = handle.getMapState("counts", "entry long", "items array<string>, cnts array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = Counter(row["item"] for row in rows)
        held = self.held.get()
        items, entries = (0, 1) if held is None else held
        changed = {}
        for entry, own in self._by_entry(new, entries).items():
            stored = self.counts.getValue((entry,))
            counts = {} if stored is None else dict(zip(*stored, strict=True))
            items -= len(counts)
            for item, n in own.items():
                changed[item] = counts[item] = counts.get(item, 0) + n
            items += len(counts)
            self._put(entry, counts)
        if items > _FULL * entries:
            while items > _FULL * entries:
                entries *= 2
            whole = {item: n for _, stored in self.counts.iterator() for item, n in zip(*stored, strict=True)}
            self.counts.clear()
            for entry, counts in self._by_entry(whole, entries).items():
                self._put(entry, counts)
        if held is None:
            self.handle.registerTimer(_millis(key[0]))
        if held is None or tuple(held) != (items, entries):
            self.held.update((items, entries))
        for item, n in _order(changed, self.n):
            yield Row("window_end", "item", "cnt")(key[0], item, n)

    def _by_entry(self, counts: Mapping[str, int], entries: int) -> dict[int, dict[str, int]]:
        found: dict[int, dict[str, int]] = {}
        for item, n in counts.items():
            found.setdefault(crc32(item.encode()) % entries, {})[item] = n
        return found

    def _put(self, entry: int, counts: dict[str, int]) -> None:
        self.counts.updateValue((entry,), (list(counts), list(counts.values())))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


class _Ranking(StatefulProcessor):
    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ranked = MapView(handle.getMapState("ranked", "item string", "cnt long"))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self.ranked.begin()
        before = _order({item: cnt for (item,), (cnt,) in self.ranked.items()}, self.n)
        counts = dict(before)
        for row in rows:
            counts[row["item"]] = max(row["cnt"], counts.get(row["item"], 0))
            if len(counts) > 1000 + 2 * self.n:
                counts = dict(_order(counts, self.n))
        after = _order(counts, self.n)
        if not before:
            self.handle.registerTimer(_millis(key[0]))
        for item, _ in before:
            if item not in dict(after):
                self.ranked.remove((item,))
        for item, cnt in after:
            if self.ranked.get((item,)) != (cnt,):
                self.ranked.put((item,), (cnt,))
        self.ranked.write()
        change = Row("window_end", "rank", "item", "cnt", "is_add")
        for rows_of, other, is_add in ((before, after, False), (after, before, True)):
            for rank, (item, cnt) in enumerate(rows_of):
                if rank >= len(other) or other[rank] != (item, cnt):
                    yield change(*key, rank + 1, item, cnt, is_add)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.ranked.begin()
        for entry in list(self.ranked):
            self.ranked.remove(entry)
        self.ranked.write()
        return iter(())

    def close(self) -> None:
        pass


def top_n_changes(stream: DataFrame, item: str, ts: str, size: timedelta, slide: timedelta, n: int, shards: int = 4) -> DataFrame:
    """Changes of the top ``n`` items of each sliding window: window_end, rank, item, cnt and whether the row is added or withdrawn.

    Rows are copied to their windows, so keep ``size / slide`` moderate. Ties go to the smaller item.
    """
    windowed = stream.select(F.col(item).alias("item"), window_of(ts, size, slide))
    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard")
    windowed = windowed.select("item", "window", F.col("window.end").alias("window_end"), shard)
    stamp, count = T.TimestampType(), T.StructField("cnt", T.LongType())
    counted = T.StructType([T.StructField("window_end", stamp), T.StructField("item", T.StringType()), count])
    counts = windowed.groupBy("window_end", "shard").transformWithState(
        _Counts(n), counted, "append", "eventTime", eventTimeColumnName="window_end")
    changed = T.StructType([
        T.StructField("window_end", stamp), T.StructField("rank", T.IntegerType()), T.StructField("item", T.StringType()), count,
        T.StructField("is_add", T.BooleanType())])
    return counts.groupBy("window_end").transformWithState(_Ranking(n), changed, "append", "eventTime")


def current(changes: DataFrame) -> DataFrame:
    """The rankings that a table of changes comes to."""
    net = F.sum(F.when(F.col("is_add"), 1).otherwise(-1))
    rows = changes.groupBy("window_end", "rank", "item", "cnt").agg(net.alias("_net"))
    return rows.where("_net > 0").drop("_net")
