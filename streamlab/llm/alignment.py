"""Alignment of two tokenizers' tokens over a corpus, by inverted bitmaps of id pairs.

A byte-level merge tokenizer (A) and a piece model (B) cut the same bytes. Where tokens of both end together a group ends; every token of
A is linked with every token of B in its group. An id pair counts once for each document that links it.

Documents are numbered within blocks. For each pair a block keeps a compressed bitmap of its documents: sorted 16-bit numbers for up
to ``SPARSE`` of them, else plain bits. How often a document links the pair stands in multiplicity planes over the
bitmap's documents: plane k has bit k of the number less one. A task builds bitmaps from slices of text as sorted (pair, document)
numbers; merging slices is the OR of their bitmaps and the sum of their planes. A block is closed at ``BLOCK_DOCS`` documents or ``BLOCK_POSTINGS``
bits, so blocks are disjoint and a pair's corpus-wide count is the sum of its bitmaps' population counts (partial sums before the
shuffle). A pair in every document is one row a block. The counts are joined back to the bitmaps, and these postings return the
scores: block by block they are unpacked into two dense arrays, one number a document.

A group of very many tokens (a long run without a common end) is linked by distinct ids and their counts, in pieces of ``PIECE`` links.

Defined cases: a text that is null or empty, or whose tokens of A or B do not spell it byte for byte behind one blank, has no
tokens: zeros and no links. Strings of special tokens are plain text. Repeated rows count as documents of their own, also
with one id or none. Other columns are ignored, whatever their names. An empty table gives an empty result. A text is tokenized whole;
memory grows with the longest text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, fresh_folder

BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 3_000_000
#: Bytes of text tokenized at a time (or one text), and links spelled out at a time.
SLICE, PIECE = 1 << 19, 1 << 21
#: Links of a group that is spelled out token by token.
GROUP = 1024
#: A bitmap of so many documents is a list of numbers.
SPARSE = 4096
#: Bits of an id in a pair's number.
ID_BITS = 21


@dataclass(frozen=True)
class Tokenizers:
    """Contents of the two files: a byte-level tokenizer as JSON with the pattern that cuts words, and a piece model."""

    json_text: str
    pattern: str
    model: bytes


def read_tokenizers(json_path: str, pattern: str, model_path: str) -> Tokenizers:
    """Read on the driver; tasks get the contents."""
    with open(json_path, encoding="utf-8") as a, open(model_path, "rb") as b:
        return Tokenizers(a.read(), pattern, b.read())


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(others)}}


def byte_ranks(json_text: str) -> dict[bytes, int]:
    """Token bytes to id. Ids must follow the order of merges, so that the ids alone say which merge comes first."""
    model, letter = json.loads(json_text)["model"], byte_of_letter()
    vocabulary = model["vocab"]
    for k, merge in enumerate(model["merges"]):
        parts = merge.split(" ") if isinstance(merge, str) else merge
        if vocabulary["".join(parts)] != 256 + k:
            raise ValueError("the ids do not follow the merges")
    return {bytes(letter[c] for c in token): i for token, i in vocabulary.items()}


class Pair:
    """Both tokenizers in a task, with tables by id."""

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken

        ranks = byte_ranks(files.json_text)
        self.a = tiktoken.Encoding("bytes", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        # decimal ids with what stands behind them: inside and at the end of a group
        self.a_text = [b"%d%c" % (i, sep) for i in range(len(self.a_bytes)) for sep in b",|"]
        self.b_text = [b"%d%c" % (i, sep) for i in range(len(self.b_bytes)) for sep in b",;"]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both; None for a text without tokens."""
        out: list[tuple[list[int], list[int]] | None] = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            spaced = b" " + text.encode()
            a = self.a.encode_ordinary(" " + text) if text else []
            spelled = text and b"".join([self.b_bytes[i] for i in b]) == spaced and b"".join([self.a_bytes[i] for i in a]) == spaced
            out.append((a, b) if spelled else None)
        return out


@lru_cache(maxsize=1)
def _pair(files: Tokenizers) -> Pair:
    return Pair(files)


@dataclass
class Groups:
    """Tokens of some texts laid end to end, and the groups that common ends cut them into."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    doc: np.ndarray  # of each group

    @staticmethod
    def of(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, sizes: np.ndarray) -> Groups:
        """``sizes``: bytes of each text; all ids of a text spell as many."""
        a_ends, b_ends = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        ends = np.zeros(int(sizes.sum()) + 1, dtype=bool)
        ends[a_ends] = True
        common = b_ends[ends[b_ends]]
        place = np.searchsorted
        return Groups(a, b, place(common, a_ends), place(common, b_ends), place(np.cumsum(sizes), common))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.doc)
        return np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)

    def spelled(self) -> np.ndarray:
        """Numbers of the group text's entries, group by group: 2 * id (+ 1 at the end), B's as negative numbers less one."""
        n_a, n_b = self.counts()
        first = np.cumsum(n_a + n_b) - n_a - n_b
        at_a = np.arange(len(self.a)) + (first - (np.cumsum(n_a) - n_a))[self.group_a]
        at_b = np.arange(len(self.b)) + (first + n_a - (np.cumsum(n_b) - n_b))[self.group_b]
        out = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (self.group_a, self.group_b))
        out[at_a] = 2 * self.a + last_a
        out[at_b] = -(2 * self.b + last_b) - 1
        return out

    def linked(self, first_doc: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers, times): each (pair, document) as one sorted number, and how often the document links the pair there."""
        n_a, n_b = self.counts()
        start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        size = n_a * n_b
        large = size > GROUP
        for g in np.flatnonzero(large).tolist():
            a, times_a = np.unique(self.a[start_a[g]:start_a[g] + n_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[start_b[g]:start_b[g] + n_b[g]], return_counts=True)
            step = max(1, PIECE // len(b))
            for k in range(0, len(a), step):
                pair = (a[k:k + step, None] << ID_BITS) + b
                yield (pair.ravel() << 16) + first_doc + self.doc[g], (times_a[k:k + step, None] * times_b).ravel()
        size = np.where(large, 0, size)
        total, done = np.cumsum(size), 0
        while done < len(size):
            to = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PIECE, "right")))
            lo, hi = int(start_a[done]), int(start_a[to - 1] + n_a[to - 1])
            group = self.group_a[lo:hi]
            repeat = np.where(large[group], 0, n_b[group])
            at = np.repeat(start_b[group] - np.cumsum(repeat) + repeat, repeat) + np.arange(int(repeat.sum()))
            pair = (np.repeat(self.a[lo:hi], repeat) << ID_BITS) + self.b[at]
            yield np.unique((pair << 16) + first_doc + np.repeat(self.doc[group], repeat), return_counts=True)
            done = to


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all parts once, in order, with their times added."""
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    numbers, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(numbers, kind="stable")
    numbers, times = numbers[order], times[order]
    starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.zeros(0, dtype=np.int64)
    return numbers[starts], np.add.reduceat(times, starts) if len(starts) else times


def _binaries(data: bytes, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def packed(docs: np.ndarray, times: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Bitmaps and planes of the runs of ``docs`` (sorted in each run) that begin at ``starts``; the last entry is the end."""
    n = np.diff(starts)
    numbers = docs.astype("<u2")
    if (n > SPARSE).any():
        bitmaps = pa.array([
            numbers[a:b].tobytes() if b - a <= SPARSE else np.packbits(np.bincount(docs[a:b]).astype(bool), bitorder="little").tobytes()
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)], pa.binary())
    else:
        bitmaps = _binaries(numbers.tobytes(), 2 * n)
    extra = times - 1
    most = np.maximum.reduceat(extra, starts[:-1]) if len(n) else np.zeros(0, dtype=np.int64)
    planes = np.ceil(np.log2(most + 1)).astype(np.int64)
    width = (n + 7) // 8
    first = np.cumsum(planes * width) - planes * width
    bits = np.zeros(8 * int((planes * width).sum()), dtype=bool)
    inner = np.arange(len(docs)) - np.repeat(starts[:-1], n)
    for k in range(int(planes.max(initial=0))):
        has = np.repeat(planes > k, n)
        bits[(np.repeat(8 * (first + k * width), n) + inner)[has]] = (extra[has] >> k) & 1
    return bitmaps, _binaries(np.packbits(bits, bitorder="little").tobytes(), planes * width)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes as one array, and the length of each value."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], np.diff(offsets).astype(np.int64)


def unpacked(n: np.ndarray, bitmaps: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Documents and times of all rows, one row behind the other."""
    data, sizes = _bytes_of(bitmaps)
    if (n > SPARSE).any():
        ends = np.cumsum(sizes)
        docs = np.concatenate([
            data[e - s:e].view("<u2") if k <= SPARSE else np.flatnonzero(np.unpackbits(data[e - s:e], bitorder="little"))
            for k, e, s in zip(n.tolist(), ends.tolist(), sizes.tolist(), strict=True)])
    else:
        docs = np.frombuffer(data.tobytes(), dtype="<u2")
    data, sizes = _bytes_of(planes)
    bits = np.unpackbits(data, bitorder="little")
    width = (n + 7) // 8
    first, height = np.cumsum(sizes) - sizes, sizes // width
    inner = np.arange(len(docs)) - np.repeat(np.cumsum(n) - n, n)
    times = np.ones(len(docs), dtype=np.int64)
    for k in range(int(height.max(initial=0))):
        has = np.repeat(height > k, n)
        times[has] += bits[(np.repeat(8 * (first + k * width), n) + inner)[has]].astype(np.int64) << k
    return docs.astype(np.int64), times


_INVERTED = (
    "block bigint, doc int, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "a int, b int, n int, bitmap binary, planes binary")


class _Block:
    def __init__(self, number: int):
        self.number, self.docs, self.parts, self.held = number, [], [], 0

    def add(self, parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> None:
        for part in parts:
            self.parts.append(part)
            self.held += len(part[0])
            if self.held > 2 * BLOCK_POSTINGS:  # slices of one long text
                self.parts = [merged(self.parts)]
                self.held = len(self.parts[0][0])

    def full(self) -> bool:
        return len(self.docs) + 4096 > BLOCK_DOCS or self.held > BLOCK_POSTINGS

    def written(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def batch(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            columns["block"] = pa.array(np.full(n, self.number))
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        if self.docs:
            columns = {c: pa.array(list(v), schema.field(c).type) for c, v in zip(names, zip(*self.docs, strict=True), strict=True)}
            yield batch(len(self.docs), columns | {"doc": pa.array(range(len(self.docs)), pa.int32())})
        numbers, times = merged(self.parts)
        pairs, docs = numbers >> 16, numbers & 0xFFFF
        starts = np.append(np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])), len(pairs)) if len(pairs) else np.zeros(1, dtype=np.int64)
        for k in range(0, len(starts) - 1, 50_000):
            own = starts[k:k + 50_001]
            lo, hi = own[0], own[-1]
            bitmaps, planes = packed(docs[lo:hi], times[lo:hi], own - lo)
            pair = pairs[own[:-1]]
            yield batch(len(pair), {
                "a": pa.array((pair >> ID_BITS).astype(np.int32)), "b": pa.array((pair & ((1 << ID_BITS) - 1)).astype(np.int32)),
                "n": pa.array(np.diff(own).astype(np.int32)), "bitmap": bitmaps, "planes": planes})


def _invert(files: Tokenizers):
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _INVERTED.split(", "))])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch["id"], batch["text"], strict=True):
                ids.append(i.as_py())
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= SLICE or len(texts) == 1024:
                    yield ids, texts
                    ids, texts, size = [], [], 0
            if ids:
                yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for ids, texts in slices(batches):
            block.add(_aligned(pair, ids, texts, block.docs))
            if block.full():
                yield from block.written(schema)
                number += 1
                block = _Block(number)
        yield from block.written(schema)

    return run


def _aligned(pair: Pair, ids: list, texts: list[str], docs: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The links of some texts, with their documents appended to ``docs``."""
    first, tokens = len(docs), pair.encode(texts)
    spelled = [k for k, t in enumerate(tokens) if t]
    stats = {}
    if spelled:
        a = np.fromiter((i for k in spelled for i in tokens[k][0]), dtype=np.int64)
        b = np.fromiter((i for k in spelled for i in tokens[k][1]), dtype=np.int64)
        sizes = np.array([1 + len(texts[k].encode()) for k in spelled])
        groups = Groups.of(a, b, pair.a_size, pair.b_size, sizes)
        groups.doc = np.array(spelled)[groups.doc]
        n_a, n_b = groups.counts()
        n_groups, n_links = np.bincount(groups.doc, minlength=len(texts)), np.zeros(len(texts), dtype=np.int64)
        np.add.at(n_links, groups.doc, n_a * n_b)
        entries, at = groups.spelled().tolist(), 0
        for k in spelled:
            sizes_k = [len(x) for x in tokens[k]]
            own = entries[at:at + sum(sizes_k)]
            at += sum(sizes_k)
            text = b"".join([pair.a_text[e] if e >= 0 else pair.b_text[-1 - e] for e in own])[:-1]
            stats[k] = (*sizes_k, int(n_groups[k]), int(n_links[k]), hashlib.sha256(text).hexdigest())
    docs.extend((i, *stats.get(k, (0, 0, 0, 0, ""))) for k, i in enumerate(ids))
    if spelled:
        yield from groups.linked(first)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of documents from postings sorted by block."""
    open_block, sums = None, np.zeros((0, 0), dtype=np.int64)

    def written() -> Iterator[pa.RecordBatch]:
        docs = np.flatnonzero(sums[0]) if len(sums) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(docs), open_block or 0)), pa.array(docs.astype(np.int32)), *[pa.array(s[docs]) for s in (sums if len(sums) else np.zeros((2, 0), dtype=np.int64))]],
            ["block", "doc", "count_sum", "n_best"])

    for batch in batches:
        blocks = batch["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if blocks[lo] != open_block:
                if open_block is not None:
                    yield from written()
                open_block, sums = int(blocks[lo]), np.zeros((2, BLOCK_DOCS), dtype=np.int64)
            part = batch.slice(lo, hi - lo)
            n = part["n"].to_numpy().astype(np.int64)
            docs, times = unpacked(n, part["bitmap"], part["planes"])
            np.add.at(sums[0], docs, times * np.repeat(part["held_by"].to_numpy(), n))
            np.add.at(sums[1], docs, times * np.repeat(part["best"].to_numpy(zero_copy_only=False).astype(np.int64), n))
    yield from written()


def postings(df: DataFrame, files: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table of document rows (``doc`` is set) and of bitmaps (``a`` and ``b`` are set)."""
    spark = df.sparkSession
    folder = fresh_folder(spark, "alignment")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), as_text(text_col).alias("text"))
    rows.mapInArrow(_invert(files), _INVERTED).write.parquet(folder)
    return spark.read.parquet(folder)


def pair_counts(inverted: DataFrame) -> DataFrame:
    """(a, b, held_by, best): documents that link the pair, and whether no pair of its ``a`` is in more."""
    counts = inverted.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("held_by"))
    # a window over one id of A has at most as many rows as B has ids
    return counts.withColumn("best", F.col("held_by") == F.max("held_by").over(Window.partitionBy("a")))


def align(df: DataFrame, files: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    inverted = postings(df, files, id_col, text_col)
    bitmaps = inverted.where("a is not null").select("a", "b", "block", "n", "bitmap", "planes")
    found = bitmaps.join(pair_counts(inverted), ["a", "b"]).drop("a", "b")
    scores = found.repartition("block").sortWithinPartitions("block").mapInArrow(_score, "block bigint, doc int, count_sum bigint, n_best bigint")
    docs = inverted.where("doc is not null").select("block", "doc", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    joined = docs.join(scores, ["block", "doc"], "left").fillna(0, ["n_best", "count_sum"])
    return joined.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
