"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint has 64 bits per word of ``words``; a bit is set if it is set in over half of the hashes of the document's word
shingles (repeats included). Equal fingerprints are reduced to one row before any pairs are looked for. The bits are split
into blocks; two fingerprints that differ in at most ``blocks - agree`` bits agree in at least ``agree`` whole blocks, so
every fingerprint is dealt out once for each choice of ``agree`` blocks and only those with the same choice and the same
bits meet. Fingerprints that meet are verified by their Hamming distance in numpy; what is passed on is a spanning tree of
the links inside a bucket, never all pairs of a group.

Buckets are counted before any rows are brought together, by a grouping with partial sums. One of more than ``bucket_rows``
fingerprints (many near copies of one text) is split again from where its rows lie: its members differ in the remaining
bits only, and the same argument holds for these. So a task holds at most ``bucket_rows`` rows of a bucket of the first
round; with 64 bits in 5 blocks, 3 of them shared, at most 2^11 different fingerprints can be left in one of the second.

Defined cases: a null or blank text has fingerprint zero, which is linked like any other; a text of fewer words than a shingle
is hashed whole; a null id never becomes a component's id unless all ids of the component are null. Repeated rows have the
same fingerprint and component. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, checkpointed, run_starts, shingle_hashes, sorted_runs, unused_name
from streamlab.llm.components import labelled


@dataclass(frozen=True)
class Settings:
    """``max_bits``: fingerprints link at so many differing bits or fewer."""

    shingle: int = 3
    words: int = 1
    max_bits: int = 2
    blocks: int = 5
    agree: int = 3
    bucket_rows: int = 4096


#: Three-word shingles, 64 bits, at most 2 of them different: every link is found.
CLOSE = Settings()


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """The hashes for a further word of the fingerprint; word 0 takes them as they are."""
    if word == 0:
        return h
    x = h + np.uint64(word) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority_bits(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per run of ``hashes`` the bits set in over half of it. Eight byte-wide counters at a time are summed in one integer."""
    out = np.zeros(len(lengths), dtype=np.uint64)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    sizes = lengths[full].astype(np.int64)
    pieces = (sizes + 254) // 255
    first_piece = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    inner = np.arange(pieces.sum()) - np.repeat(first_piece, pieces)
    starts = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), pieces) + 255 * inner
    ones, result = np.uint64(0x0101010101010101), np.zeros(len(full), dtype=np.uint64)
    for bit in range(8):
        packed = np.add.reduceat((hashes >> np.uint64(bit)) & ones, starts)
        counts = np.add.reduceat(packed.view(np.uint8).reshape(-1, 8).astype(np.int64), first_piece)
        for byte in range(8):
            result |= (counts[:, byte] * 2 > sizes).astype(np.uint64) << np.uint64(8 * byte + bit)
    out[full] = result
    return out


def _fingerprint(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts, lengths = batch["text"], [], []
            for i in range(batch.num_rows):
                found = shingle_hashes(texts[i].as_py(), settings.shingle)
                lengths.append(len(found))
                if found:
                    parts.append(np.array(found, dtype=np.uint64))
            hashes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
            prints = np.empty((batch.num_rows, settings.words), dtype=">u8")
            for word in range(settings.words):
                prints[:, word] = majority_bits(_mixed(hashes, word), np.array(lengths))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["text_key"], _binary(prints)], ["id", "text_key", "print"])
    return run


def _binary(prints: np.ndarray) -> pa.Array:
    width = 8 * prints.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(prints), [None, pa.py_buffer(np.ascontiguousarray(prints).tobytes())]).cast(pa.binary())


def _numbers(column: pa.Array | pa.ChunkedArray, words: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fixed = column.cast(pa.binary(8 * words))
    raw = np.frombuffer(fixed.buffers()[1], dtype=">u8")[fixed.offset * words:(fixed.offset + len(fixed)) * words]
    return raw.astype(np.uint64).reshape(-1, words)


def _masks(bits: list[int], settings: Settings, blocks: int) -> list[tuple[list[int], np.ndarray]]:
    """For each choice of blocks of ``bits``: its bit numbers, and the masks of the fingerprint's words."""
    cuts = np.array_split(np.array(bits), min(blocks, len(bits)))
    found = []
    for choice in combinations(cuts, settings.agree):
        chosen = np.concatenate(choice).tolist()
        mask = np.zeros(settings.words, dtype=np.uint64)
        for b in chosen:
            mask[b // 64] |= np.uint64(1) << np.uint64(b % 64)
        found.append((chosen, mask))
    return found


def _tables(settings: Settings) -> list[tuple[list[int], np.ndarray]]:
    return _masks(list(range(64 * settings.words)), settings, settings.blocks)


def _keys(prints: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """A number for the masked bits; equal bits give equal numbers."""
    key = np.zeros(len(prints), dtype=np.uint64)
    for word in np.flatnonzero(mask):
        key = _mixed(key ^ (prints[:, word] & mask[word]), 1 + int(word))
    return key.view(np.int64)


def _bucket_batch(table: np.ndarray, key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(table), pa.array(key), _binary(prints.astype(">u8"))], ["bucket", "key", "print"])


def _deal(settings: Settings):
    tables = _tables(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = _numbers(batch["print"], settings.words)
            for number, (_, mask) in enumerate(tables):
                yield _bucket_batch(np.full(len(prints), number, dtype=np.int32), _keys(prints, mask), prints)
    return run


def _deal_again(settings: Settings):
    """For rows of overfull buckets: the same for the bits that the bucket leaves free."""
    tables = _tables(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, old = _numbers(batch["print"], settings.words), batch["bucket"].to_numpy()
            for number in np.unique(old):
                own, (chosen, mask) = prints[old == number], tables[number]
                free = sorted(set(range(64 * settings.words)) - set(chosen))
                finer = _masks(free, settings, settings.blocks)
                for sub, (_, more) in enumerate(finer):
                    label = len(tables) + int(number) * len(finer) + sub
                    yield _bucket_batch(np.full(len(own), label, dtype=np.int32), _keys(own, mask | more), own)
    return run


def spanning_links(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Index pairs within ``max_bits`` that connect everything connected; one less than the size of each component."""
    n = len(prints)
    if n == 2:
        return [(0, 1)] if int(np.bitwise_count(prints[0] ^ prints[1]).sum()) <= max_bits else []
    links, rest = [], np.arange(n)
    while len(rest):
        wave, rest = [int(rest[0])], rest[1:]
        while wave and len(rest):
            node = wave.pop()
            near = np.bitwise_count(prints[rest] ^ prints[node]).sum(axis=1, dtype=np.int64) <= max_bits
            if near.any():
                found = rest[near].tolist()
                links.extend((node, other) for other in found)
                wave.extend(found)
                rest = rest[~near]
    return links


def _verify(settings: Settings):
    """Links (a, b) of each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_runs(batches, ["bucket", "key"]):
            starts = run_starts(table["bucket"].to_numpy(), table["key"].to_numpy())
            sizes = np.diff(starts)
            prints = _numbers(table["print"], settings.words)
            left, right = [], []
            for at, size in zip(starts[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                for i, j in spanning_links(prints[at:at + size], settings.max_bits):
                    left.append(at + i)
                    right.append(at + j)
            if left:
                yield pa.RecordBatch.from_arrays([_binary(prints[side].astype(">u8")) for side in (left, right)], ["a", "b"])
    return run


_BUCKET = "bucket int, key bigint, print binary"
#: Broadcast is asked for up to so many crowded buckets.
_BROADCAST_ROWS = 50_000


def dealt(prints: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, key, print) of both rounds: no bucket of the first has over ``bucket_rows`` rows, crowded ones are in the second."""
    prints = checkpointed(prints)
    rows = prints.mapInArrow(_deal(settings), _BUCKET)
    crowded = checkpointed(rows.groupBy("bucket", "key").agg(F.count("*").alias("n")).where(F.col("n") > settings.bucket_rows).select("bucket", "key"))
    found = crowded.count()
    if not found:
        return rows
    if found <= _BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    again = rows.join(crowded, ["bucket", "key"], "left_semi").select("bucket", "key", "print")
    rest = rows.join(crowded, ["bucket", "key"], "left_anti").select("bucket", "key", "print")
    return rest.unionByName(again.mapInArrow(_deal_again(settings), _BUCKET))


def links(prints: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``prints`` (print) as all links together do."""
    rows = dealt(prints, settings).repartition("bucket", "key").sortWithinPartitions("bucket", "key", "print")
    return rows.mapInArrow(_verify(settings), "a binary, b binary").distinct()


def mark(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = CLOSE) -> DataFrame:
    """Per row of ``df``: id, text_key (hash of the text), print (fingerprint, binary), component_id, component_key.

    component_id is the smallest id of all documents that links reach, component_key the hash of that document's text.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), as_text(text_col).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    prints = checkpointed(rows.mapInArrow(_fingerprint(settings), "id bigint, text_key bigint, print binary"))
    return labelled(prints, links(prints.select("print").distinct(), settings))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = CLOSE) -> DataFrame:
    """One row of ``df`` for each component: the one with the smallest id; all columns as they were."""
    kept = mark(df, id_col, text_col, settings).where("id <=> component_id and text_key = component_key")
    names = {c: unused_name(df, f"kept_{c}") for c in ("id", "text_key")}
    kept = kept.select(*[F.col(c).alias("k_" + n) for c, n in names.items()]).distinct()
    keyed = df.withColumns({names["id"]: F.col(id_col).cast("bigint"), names["text_key"]: F.xxhash64(as_text(text_col))})
    same = [F.col(n).eqNullSafe(F.col("k_" + n)) for n in names.values()]
    return keyed.join(kept, same, "left_semi").dropDuplicates(list(names.values())).drop(*names.values())
