"""Removal of repeated passages: every byte covered by a string of ``LENGTH`` bytes that also starts earlier goes.

Documents are ordered by id; a string starts earlier if it starts in a document of a smaller id, or before in the same one.

Candidates. Texts equal as a whole are reduced to the first of them; the others are repeats from end to end. In every window of
``LENGTH`` bytes the ``GRAM`` bytes of smallest hash are an anchor, chosen by the window's content alone, so two equal windows share
their anchor at the same place. Anchors that occur once lead nowhere; around each of the others the passage of
``SIDE`` bytes to the left and right holds every window that has the anchor.

Construction, column by column. The passages of an anchor are aligned at it. Each round inserts one symbol per passage, first
outwards to the right, then to the left, and updates the passages' order and the borders where common prefixes end: the
order after a symbol follows from the order before it by one stable sort, as in the column-wise construction of a
collection's Burrows-Wheeler transform. The columns of the right side are kept; with each column of the left side the one that
completes ``LENGTH`` bytes gives the classes of equal windows, and all but the first of a class repeat. A construction over
whole unaligned documents would take as many rounds over all data as the longest document has bytes; aligned passages need
2 * ``SIDE``, whatever the documents' lengths, and each task reads its passages once, in sorted order, from Spark's shuffle files.

An anchor with over ``CROWD`` occurrences is not brought together at all: equal passages are reduced to the earliest, by a
grouping with partial aggregation; the windows of these are hashed (128 bits) and grouped in the same way. The busiest anchors
are not even counted in one place: a first pass over the texts names those that make up over 1 / ``SHARE`` of some stretch of
anchors, and these are dealt out by place. Which way an anchor takes changes the work, not the result. Documents are kept in a table bucketed by id, so that candidates and spans
come to the texts without the texts being shuffled again.

Defined cases: a null text is empty; a null id comes after all others; texts shorter than ``LENGTH`` lose nothing; rows that repeat
a whole row are the same document; different texts under one id count as one after the other in the order of their digests, but
no string reaches from one into the other. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, checkpointed, fresh_folder, run_starts, sorted_runs, task_count

LENGTH, GRAM = 100, 32
SIDE = LENGTH - GRAM
CROWD = 5000
#: Anchors of a stretch; a hash is busy with over 1 / ``SHARE`` of a stretch, if that is over ``LEAST_BUSY``.
STRETCH, SHARE, LEAST_BUSY = 1 << 18, 1024, 64
#: Bytes of a text whose anchors are looked for at once.
PIECE = 1 << 22
NO_ID = 2**63 - 1


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each position; strings of twice the length are made of two."""
    h = data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    size, factor = 1, 0xD6E8FEB86659FD93
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = size * 2, factor * factor % 2**64
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all windows."""
    positions, hashes = [], []
    width = SIDE + 1
    for at in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        piece = np.frombuffer(data, dtype=np.uint8)[at:at + PIECE + LENGTH - 1]
        h = _gram_hashes(piece)
        # the place in the low bits: the leftmost of equal hashes is the smallest
        low = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
        places = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        places = places[np.concatenate([[True], places[1:] != places[:-1]])]
        positions.append(places + at)
        hashes.append(h[places].view(np.int64))
    if not positions:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    places, first = np.unique(np.concatenate(positions), return_index=True)
    return places, np.concatenate(hashes)[first]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, bases = batch["id"].to_numpy(), batch["base"].to_numpy()
        for row in range(batch.num_rows):
            places, hashes = anchors(batch["text"][row].as_py().encode())
            if len(places):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), pa.array(np.full(len(places), ids[row])), pa.array(places + bases[row])], ["hash", "id", "start"])


def _busy_hashes(least: int):
    def busy(stretch: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(stretch), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(hashes[counts > max(least, counts.sum() // SHARE)], pa.int64())], ["hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, n = [np.zeros(0, dtype=np.int64)], 0
        for batch in batches:
            for text in batch["text"]:
                stretch.append(anchors(text.as_py().encode())[1])
                n += len(stretch[-1])
                if n >= STRETCH:
                    yield busy(stretch)
                    stretch, n = stretch[:1], 0
        yield busy(stretch)
    return run


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The aligned passages of a text; ``left`` and ``right`` tell how much of the sides lies in the text.

    ``here`` marks passages that an earlier place of the same text holds with the same sides.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            data, base = batch["text"][row].as_py().encode(), batch["base"][row].as_py()
            places, hashes = (np.array(batch[c][row].as_py(), dtype=np.int64) for c in ("starts", "hashes"))
            order = np.argsort(places, kind="stable")
            order = order[(places[order] >= base) & (places[order] < base + len(data))]
            places, hashes = places[order], hashes[order]
            if not len(places):
                continue
            padded = bytes(SIDE) + data + bytes(SIDE)
            local = (places - base).tolist()
            found = [padded[p:p + SIDE + LENGTH] for p in local]
            left, right = [min(SIDE, p) for p in local], [min(SIDE, len(data) - p - GRAM) for p in local]
            seen: set[tuple[bytes, int, int]] = set()
            here = [key in seen or seen.add(key) is not None for key in zip(found, left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes), pa.array(np.full(len(places), batch["id"][row].as_py())), pa.array(places),
                pa.array(found, pa.binary()), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(here),
            ], ["hash", "id", "start", "passage", "left", "right", "here"])


def _ranks(key: np.ndarray) -> np.ndarray:
    """Rank of each key among the different keys."""
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[0], np.diff(key[order]) != 0])
    ranks = np.empty(len(key), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def repeated_spans(group: np.ndarray, passages: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) window offset per passage that repeats an earlier passage of its group; last is -1 where none does.

    The rows of a group are in the order of their starts.
    """
    n = len(group)
    first, last = np.full(n, LENGTH), np.full(n, -1)
    sides = [group.astype(np.int64)]
    for column in range(SIDE + GRAM, SIDE + LENGTH):
        sides.append(_ranks(sides[-1] * 256 + passages[:, column]))
    rank = group.astype(np.int64)
    for offset in range(SIDE + 1):
        if offset:
            rank = _ranks(rank * 256 + passages[:, SIDE - offset])
        inside = np.flatnonzero((left >= offset) & (right >= SIDE - offset))
        key = rank[inside] * n + sides[SIDE - offset][inside]
        order = np.argsort(key, kind="stable")
        again = inside[order[1:][np.diff(key[order]) == 0]]
        first[again] = np.minimum(first[again], offset)
        last[again] = offset
    return first, last


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in sorted_runs(batches, ["hash"]):
        starts = run_starts(table["hash"].to_numpy())
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        column = table["passage"].combine_chunks().cast(pa.binary(SIDE + LENGTH))
        raw = np.frombuffer(column.buffers()[1], dtype=np.uint8).reshape(-1, SIDE + LENGTH)
        passages = raw[column.offset:column.offset + len(column)]
        first, last = repeated_spans(group, passages, table["left"].to_numpy(), table["right"].to_numpy())
        hit = np.flatnonzero(last >= 0)
        at = table["start"].to_numpy()[hit]
        # windows that share the anchor overlap, so they cover one stretch
        yield pa.RecordBatch.from_arrays(
            [pa.array(table["id"].to_numpy()[hit]), pa.array(at - last[hit]), pa.array(at - first[hit] + LENGTH)], ["id", "start", "stop"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, ids, starts = [], [], []
        columns = (batch[c].to_pylist() for c in ("id", "start", "passage", "left", "right"))
        for doc, start, passage, left, right in zip(*columns, strict=True):
            for offset in range(SIDE - right, left + 1):
                names.append(xxhash.xxh3_128_digest(passage[SIDE - offset:SIDE - offset + LENGTH]))
                ids.append(doc)
                starts.append(start - offset)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(ids, pa.int64()), pa.array(starts, pa.int64())], ["name", "id", "start"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that touch or overlap made one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(s) for s in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {"first_id": batch["id"].to_pylist(), "digest": batch["digest"].to_pylist(), "removed": [], "spans": [], "kept": []}
        for base, text, starts, stops in zip(*(batch[c].to_pylist() for c in ("base", "text", "starts", "stops")), strict=True):
            data = text.encode()
            own = [(a - base, b - base) for a, b in zip(starts or [], stops or [], strict=True) if base <= a < base + len(data)]
            found, kept, at = merged(own), [], 0
            for start, stop in found:
                kept.append(data[at:start])
                at = stop
            kept.append(data[at:])
            rows["removed"].append(sum(b - a for a, b in found))
            rows["spans"].append(len(found))
            rows["kept"].append(hashlib.sha256(b"".join(kept)).hexdigest())
        yield pa.RecordBatch.from_pydict(rows)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("own_id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), as_text(text_col).alias("text"))
    docs = docs.withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    narrow = checkpointed(docs.select("own_id", "id", "digest", "n_bytes"))
    firsts = narrow.groupBy("digest").agg(F.min("id").alias("id"), F.first("n_bytes").alias("n_bytes"))
    in_id = Window.partitionBy("id").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("base", F.coalesce(F.sum("n_bytes").over(in_id), F.lit(0)))
    buckets, table, folder = task_count(spark), f"passages_{uuid.uuid4().hex}", fresh_folder(spark, "passages")
    texts = docs.select("id", "digest", "text").join(firsts.select("id", "digest", "base").hint("merge"), ["id", "digest"]).dropDuplicates(["id", "digest"])
    writer = texts.repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id").option("compression", "zstd").option("path", folder)
    writer.saveAsTable(table)
    texts = spark.table(table)

    found = texts.select("id", "base", "text").mapInArrow(_anchor_rows, "hash bigint, id bigint, start bigint")
    # as files, so that Spark sees their size when it plans the join
    busy = fresh_folder(spark, "passages-busy")
    texts.select("text").mapInArrow(_busy_hashes(LEAST_BUSY), "hash bigint").distinct().write.parquet(busy)
    found = found.join(spark.read.parquet(busy).withColumn("busy", F.lit(True)), "hash", "left")
    found = found.withColumn("part", F.when(F.col("busy"), F.pmod(F.xxhash64("id", "start"), F.lit(buckets))))
    found = found.withColumn("n", F.count("*").over(Window.partitionBy("hash", "part"))).where("busy or n > 1")
    found = checkpointed(found.select("id", "start", "hash", (F.col("busy").isNotNull() | (F.col("n") > CROWD)).alias("crowd")))

    def passages(rows: DataFrame) -> DataFrame:
        places = rows.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("hash").alias("hashes"))
        with_text = texts.select("id", "base", "text").join(places.hint("merge"), "id")
        return with_text.mapInArrow(_passage_rows, "hash bigint, id bigint, start bigint, passage binary, left int, right int, here boolean")

    few = passages(found.where("not crowd")).drop("here").repartition("hash").sortWithinPartitions("hash", "id", "start")
    spans = few.mapInArrow(_spans, "id bigint, start bigint, stop bigint")
    # of equal passages the earliest stands for all; the others repeat it in every window they hold
    crowd = checkpointed(passages(found.where("crowd")).withColumn("name", F.md5("passage")))
    alike = ["name", "left", "right"]
    whole = (F.col("start") - F.col("left")).alias("start"), (F.col("start") + F.col("right") + GRAM).alias("stop")
    inside = crowd.where(f"here and left + right >= {SIDE}").select("id", *whole)
    crowd = crowd.where("not here")
    firsts_alike = checkpointed(crowd.groupBy(*alike).agg(F.min(F.struct("id", "start", "passage")).alias("first")))
    again = crowd.select("id", "start", *alike).join(firsts_alike.select(*alike, F.struct("first.id", "first.start").alias("first")), alike)
    again = again.where(f"left + right >= {SIDE} and struct(id, start) > first")
    spans = spans.unionByName(inside).unionByName(again.select("id", *whole))
    windows = firsts_alike.select("first.id", "first.start", "first.passage", "left", "right")
    windows = checkpointed(windows.mapInArrow(_window_rows, "name binary, id bigint, start bigint").distinct())
    earliest = windows.groupBy("name").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = windows.join(earliest, "name").where("struct(id, start) > first")
    spans = spans.unionByName(again.select("id", "start", (F.col("start") + LENGTH).alias("stop")))
    spans = spans.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    cut = texts.select("id", "digest", "base", "text").join(spans.hint("merge"), "id", "left")
    cut = cut.mapInArrow(_cut, "first_id bigint, digest string, removed bigint, spans bigint, kept string")
    result = fresh_folder(spark, "passages-cut")
    cut.write.parquet(result)
    spark.sql(f"DROP TABLE {table}")

    rows = narrow.join(spark.read.parquet(result), "digest", "left")
    copy = (F.col("id") != F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = F.col("id") != F.col("first_id")
    # a copy under LENGTH bytes is as long as its first text, which has lost nothing either
    return rows.select(
        F.col("own_id").alias("id"), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.when(whole, F.lit(0)).otherwise(F.col("removed"))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("spans")).cast("bigint").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.col("kept")).alias("kept_sha256"))
