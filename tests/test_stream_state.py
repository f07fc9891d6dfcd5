"""Map-state machines, process functions, late rows and rankings on streams that arrive in pieces and out of order."""

import random
import tempfile
from collections import Counter
from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T
from streams import Replay

from streamlab.operators import alerts as batch_alerts
from streamlab.operators import late as batch_late
from streamlab.operators import patterns
from streamlab.streaming import alerts, late, topn
from streamlab.streaming.event_time import _InOrder, run_machine
from streamlab.streaming.map_state import MapView
from streamlab.streaming.patterns import match_stream
from streamlab.streaming.process import ProcessFunction, output_of, process

SECOND = timedelta(seconds=1)
START = 1_700_000_000
SCHEMA = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("ts", T.TimestampType())])
FAR = [(-1, -1 - i, "x", 10_000_000 * (i + 1)) for i in range(2)]


def feed(spark, rows, slices):
    """Rows (k, id, kind, seconds) in order of arrival, in so many files, and two far ones behind."""
    source = Replay(spark, SCHEMA)
    step = -(-len(rows) // slices)
    for part in [rows[i:i + step] for i in range(0, len(rows), step)] + [[r] for r in FAR]:
        source.add(pd.DataFrame(
            {"k": [r[0] for r in part], "id": [r[1] for r in part], "kind": [r[2] for r in part],
             "ts": [pd.Timestamp(START + r[3], unit="s") for r in part]}).astype({"ts": "datetime64[us]"}))
    return source


def frame(spark, rows):
    df = spark.createDataFrame([(*r[:3], START + r[3]) for r in rows], "k bigint, id bigint, kind string, at long")
    return df.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def mixed(seed, n, kinds, span, keys=4, disorder=30):
    rng = random.Random(seed)
    rows = [(rng.randrange(keys), 0, rng.choice(kinds), rng.randrange(span)) for _ in range(n)]
    rows = [(k, i, kind, at) for i, (k, _, kind, at) in enumerate(sorted(rows, key=lambda r: r[3]))]
    return sorted(rows, key=lambda r: r[3] + rng.randrange(disorder))


@pytest.mark.parametrize("slices", [1, 5])
@pytest.mark.parametrize("slot", [SECOND, timedelta(hours=1)])
def test_open_creates_of_one_key(spark, slices, slot):
    rows = mixed(1, 160, ["create", "create", "pay"], 900, keys=3)
    within = timedelta(seconds=20)

    def build(s):
        flagged = s.withWatermark("ts", "2 minutes").selectExpr("k", "id", "ts", "kind = 'create' AS c", "kind = 'pay' AS p", "if(kind = 'create', 0, 1) AS place")
        return alerts.with_times(run_machine(flagged, ["k"], "ts", alerts.OrderTimeout("c", "p", within), ["c", "p"], ["place", "id"], slot))

    got = feed(spark, rows, slices).run(build).where("k >= 0")
    want = batch_alerts.order_timeout(frame(spark, rows), ["k"], ["ts", "id"], F.expr("kind = 'create'"), F.expr("kind = 'pay'"), within)
    assert rows_of(got) == rows_of(want) and {r.status for r in got.collect()} == {"paid", "no_pay", "pay_without_create"}


@pytest.mark.parametrize("slices", [1, 4])
def test_many_partial_matches_of_one_key(spark, slices):
    rows = [(k, i, kind, at // 3) for k, i, kind, at in mixed(2, 200, ["a", "a", "a", "b", "c"], 900, keys=2)]
    begin = patterns.Pattern.begin("a", "kind = 'a'")
    for name, spec in {
        "long": begin.followed_by("b", "kind = 'b'").followed_by("c", "kind = 'c'").within(20 * SECOND),
        "next": begin.next("b", "kind <> 'c'").next("c", "kind = 'b'").within(30 * SECOND),
        "absent": begin.not_followed_by("b", "kind = 'c'").within(4 * SECOND),
    }.items():
        got = feed(spark, rows, slices).run(lambda s, p=spec: match_stream(s.withWatermark("ts", "2 minutes"), ["k"], "ts", p, "id"), name=name)
        found = patterns.match_pattern(frame(spark, rows), ["k"], ["ts", "id"], spec, ["id"])
        want = found.select("k", *[F.col(f"{s.name}.id") for s in spec.stages], "status")
        assert rows_of(got.where("k >= 0")) == rows_of(want) and want.count(), name


@pytest.mark.parametrize("slices", [1, 6])
def test_kept_and_late_rows_are_all_rows(spark, slices):
    rows = mixed(3, 200, ["x"], 2000, disorder=60) + [(1, 500, "x", 0), (2, 501, "x", -5_000_000)]
    arrived = {r[1]: n for n, r in enumerate(rows)}
    source = feed(spark, rows, slices)
    place = F.create_map(*[F.lit(x) for i, n in arrived.items() for x in (i, n)])

    def build(s):
        s = s.where("k >= 0").withColumn("seq", place[F.col("id")])
        return late.split_late(s, F.col("k") % 2, ["seq"], "ts", late.window_closes("ts", 10 * SECOND), 20 * SECOND, ["k", "id"])

    got = source.run(build)
    batch = frame(spark, rows).withColumn("seq", place[F.col("id")])
    want = [batch_late.late_split(batch.where(f"k % 2 = {i}"), ["seq"], "ts", 10 * SECOND, 20 * SECOND) for i in (0, 1)]
    assert rows_of(got) == rows_of(want[0].unionByName(want[1]).select("k", "id", "is_late"))
    assert got.where("is_late").count() > 1 and got.count() == len(rows)


@pytest.mark.parametrize("slices", [1, 7])
def test_rankings_follow_late_rows(spark, slices):
    rows = mixed(4, 300, list("abcdefgh"), 600, disorder=200)
    size, slide = 60 * SECOND, 30 * SECOND
    got = feed(spark, rows, slices).run(
        lambda s: topn.top_n_changes(s.where("k >= 0").withWatermark("ts", "10 minutes"), "kind", "ts", size, slide, 3))
    count = Counter()
    for _, _, kind, at in rows:
        end = (START + at) // 30 * 30 + 30
        count[end, kind] += 1
        count[end + 30, kind] += 1
    want = []
    for end in {e for e, _ in count}:
        best = sorted(((-n, kind) for (e, kind), n in count.items() if e == end))[:3]
        want += [(end, place + 1, kind, -n) for place, (n, kind) in enumerate(best)]
    assert rows_of(topn.current(got).select(F.unix_seconds("window_end"), "rank", "item", "cnt")) == sorted(want, key=repr)
    assert bool(got.where("not is_add").count()) == (slices > 1)


def test_process_function(spark):
    class Visits(ProcessFunction):
        """Greets a key's first row, repeats odd ids, and says how many rows came when a key was silent for 100 s."""

        outputs = {"hello": "at_ms long", "odd": "id long, n int", "bye": "at_ms long, rows long, marked boolean"}
        state = "rows long, timer_ms long"

        def on_row(self, ctx, row):
            rows, timer = ctx.get() or (0, None)
            if not rows:
                ctx.emit("hello", row["ms"])
            for n in range(3 * (row["id"] % 2)):
                ctx.emit("odd", row["id"], n)
            if timer is None or row["ms"] + 100_000 > timer:
                if timer is not None:
                    ctx.drop_timer(timer)
                timer = row["ms"] + 100_000
                ctx.set_timer(timer)
            ctx.put(rows + 1, timer)

        def on_timer(self, ctx, at_ms):
            ctx.emit("bye", at_ms, ctx.get()[0], ctx.watermark_ms >= at_ms)
            ctx.clear()

    rows = [(1, 1, "x", 0), (1, 2, "x", 50), (2, 3, "x", 60), (1, 4, "x", 149)]
    # a timer is called in the first micro-batch that begins with the watermark behind it
    rows += [(3, 8, "x", 390), (3, 10, "x", 391), (2, 5, "x", 400), (1, 6, "x", 401)]
    source = feed(spark, rows, len(rows))
    done = source.run(lambda s: process(
        s.withWatermark("ts", "1 seconds").withColumn("ms", F.unix_millis("ts")), ["k"], Visits())).where("k in (1, 2)")
    ms = F.col("at_ms") - START * 1000
    def same(got, want):
        assert rows_of(got) == sorted(want, key=repr)

    same(output_of(done, ["k"], "hello").select("k", ms), [(1, 0), (1, 401_000), (2, 60_000), (2, 400_000)])
    same(output_of(done, ["k"], "odd"), [(k, i, n) for k, i in ((1, 1), (2, 3), (2, 5)) for n in range(3)])
    same(output_of(done, ["k"], "bye").select("k", ms, "rows", "marked"), [
        (1, 249_000, 3, True), (1, 501_000, 1, True), (2, 160_000, 1, True), (2, 500_000, 1, True)])


class _Store:
    """A map, list of calls, in place of the state store's."""

    def __init__(self):
        self.held, self.calls = {}, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            key = tuple(args[0]) if args else None
            if name == "updateValue":
                self.held[key] = args[1]
            return {"getValue": lambda: self.held.get(key), "removeKey": lambda: self.held.pop(key, None), "keys": lambda: iter(list(self.held)),
                    "iterator": lambda: iter(list(self.held.items())), "containsKey": lambda: key in self.held}.get(name, lambda: None)()
        return call


def test_sparse_slots_share_entries():
    """100 rows in 100 slots: a few calls of the state store, not some for every row; a slot in part due stays in part."""
    row_schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("_us", T.LongType())])
    machine = _InOrder(alerts.Jump("id", 1.0), ["id"], row_schema, ["at_us"], timedelta(hours=1))
    machine.waiting = _Store()
    hour = 3_600_000_000
    machine._put([(i, i * hour + 5) for i in reversed(range(100))], 1)
    due, later = machine._due(40 * hour + 5)
    assert [r.id for r in due] == list(range(41)) and later == 41 * hour + 5
    assert len(machine.waiting.calls) <= 8
    machine._put([(200, 3 * hour)], 1)
    due, later = machine._due(1000 * hour)
    assert [r.id for r in due] == [200, *range(41, 100)] and later is None and not machine.waiting.held


def test_map_view_reads_single_entries():
    store = _Store()
    store.held = {(i,): (i,) for i in range(50)}
    view = MapView(store)
    assert view.get((7,)) == (7,)
    view.remove((7,))
    view.put((60,), (60,))
    view.write()
    assert "iterator" not in store.calls and (7,) not in store.held and store.held[(60,)] == (60,)
    view.begin()
    view.put((3,), (33,))
    assert [view.get((k,)) for k in (1, 2, 4, 3, 60, 99)] == [(1,), (2,), (4,), (33,), (60,), None]
    assert len(list(view)) == 50


def test_split_batches_like_split_late(spark):
    """Three micro-batches, shards cut into slices: the same rows are late as one by one, and no Python worker holds a shard."""
    rng = random.Random(3)
    rows = [(i, i % 3 if i % 7 else None, datetime(2024, 1, 1) + timedelta(seconds=i * 5 - rng.randrange(400))) for i in range(300)]
    folder = tempfile.mkdtemp(prefix="streamlab-test-")
    split = late.split_batches(F.col("k") % 2, ["seq"], "ts", F.col("ts"), timedelta(seconds=60), ["seq", "k"], folder, 20)
    for batch in range(3):
        df = spark.createDataFrame(rows[batch * 100:batch * 100 + 100], "seq long, k long, ts timestamp")
        split(df, batch)
        if batch == 1:
            split(df, batch)  # a replay
    got = {(r.seq, side) for side in ("kept", "late") for r in spark.read.parquet(f"{folder}/{side}").collect()}
    top, want = {}, set()
    for seq, k, at in rows:
        shard = None if k is None else k % 2
        want.add((seq, "late" if shard in top and at <= top[shard] - timedelta(seconds=60) else "kept"))
        top[shard] = max(at, top.get(shard, at))
    assert got == want and any(side == "late" for _, side in want)


class _FakeState:
    """Value or map state in memory, counting its calls."""

    def __init__(self, calls) -> None:
        self.calls, self.value, self.entries = calls, None, {}

    def _called(self, result=None):
        self.calls.append(1)
        return result

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)

    def getValue(self, key):
        return self._called(self.entries.get(key))

    def updateValue(self, key, value):
        self.entries[key] = self._called(value)

    def iterator(self):
        return self._called(list(self.entries.items()))

    def clear(self):
        self.value = self._called()
        self.entries.clear()


class _FakeHandle:
    def __init__(self) -> None:
        self.calls = []

    def getValueState(self, *names):
        return _FakeState(self.calls)

    getMapState = getValueState

    def registerTimer(self, at):
        self.calls.append(1)


def test_state_calls_of_rankings_do_not_grow_with_items():
    rng, key, handle, total = random.Random(6), (datetime(2024, 1, 1), 0), _FakeHandle(), Counter()
    counts = topn._Counts(3)
    counts.init(handle)
    for _ in range(4):
        items = [f"i{rng.randrange(20_000)}" for _ in range(6000)] + ["hot"] * 50
        before = len(handle.calls)
        got = [(r["item"], r["cnt"]) for r in counts.handleInputRows(key, iter([{"item": i} for i in items]), None)]
        total.update(items)
        assert got == sorted(((i, total[i]) for i in set(items)), key=lambda x: (-x[1], x[0].encode()))[:3]
        assert len(handle.calls) - before < 100
    stored = {i: n for _, entry in counts.counts.iterator() for i, n in zip(*entry, strict=True)}
    assert stored == total and counts.held.get()[0] == len(total) and counts.held.get()[1] > 1
    assert sum(len(e[0]) for e in counts.counts.entries.values()) == len(total)
    list(counts.handleExpiredTimer(key, None, None))
    assert counts.held.get() is None and not counts.counts.entries
