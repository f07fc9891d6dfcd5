"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into three parts. The normaliser rewrites the input (white-space marks, one in front). The piece
transducer has an arc for each piece that can be read at a position; its state is the position and the last piece, and
the weight of an arc is 0 if the two pieces may stand side by side and infinite otherwise. Characters without a piece
take the byte-fallback arc, one id for each UTF-8 byte. The composition with an input is built lazily, and its shortest
path in the tropical semiring is the encoding.

For a model of merges, two pieces may stand side by side if merging their joined text by the model's scores gives back just
these two. The encoding of a text up to any of its cuts is the encoding of that part, so every position is reached by just one path of
finite weight, and one last piece per position is all the state that a search from left to right needs. For a unigram model all
neighbours are allowed and an arc weighs minus the piece's score; the shortest path is found position by position too.

An input is cut where no piece reaches over: before each run of white-space marks, and between letters and other characters
if the model has no such piece. The paths of the parts are independent. New parts of a batch are searched in sorted order,
so that a part starts from the states of the prefix it shares with the one before; recent parts are kept.

Defined cases: null and empty texts have no ids and decode to the empty text. A white-space mark in a text is the same as a
blank, and so comes back as one. Ids of control pieces decode to nothing, the unknown id to " ⁇ ", bytes that are not UTF-8
to the replacement character. Rows with repeated ids are encoded each on its own; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, slices

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of encoded parts and words, and neighbour pairs, that a worker keeps; it begins anew when it has more.
KEPT_BYTES, KEPT_PAIRS = 112 << 20, 600_000
#: Of an entry beside its text and ids, about.
ENTRY_BYTES = 200
#: Texts that are encoded together.
ROWS = 512
UNKNOWN_TEXT = " ⁇ ".encode()


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialised message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if not data[at - 1] & 128:
                return value, at
    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """The pieces, scores and flags of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        if normalizer.get(2) or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only models with the identity normaliser, of merges or unigrams, can be compiled")


class Transducer:
    """Encoder and decoder compiled from a model."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k in (NORMAL, USER)}
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.unknown = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        self.weights = {p: -model.scores[i] for p, i in self.ids.items()}
        # a character without a piece costs more than any piece
        self.unknown_weight = max(self.weights.values(), default=0.0) + 10.0
        self._build_trie()
        self.part = re.compile(self._cuts())
        self._parts: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._pairs: dict[int, bool] = {}
        self._kept = 0
        self.texts = [self._decoded(i) for i in range(len(model.pieces))]

    def _cuts(self) -> str:
        """A pattern of parts that no piece reaches over."""
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(a != MARK and b == MARK for a, b in pairs):
            return r"(?s).+"
        # what the pattern takes for a letter, without the numerals among it that stand beside other characters
        letter = re.compile(r"[^\W\d_]")
        mixed = {p for p in pairs if p[0] != MARK and bool(letter.match(p[0])) != bool(letter.match(p[1]))}
        others = {c for c in "".join(mixed) if letter.match(c) and not c.isalpha()}
        if any(others.isdisjoint(p) for p in mixed) or any(not others.isdisjoint(p) for p in pairs - mixed if letter.match(p[0]) and letter.match(p[1])):
            return r" *[^ ]+| +"
        others = "".join(re.escape(c) for c in sorted(others))
        return rf" *[^\W\d_{others}]+| *(?:[^ \w]|[\d_{others}])+| +"

    def _build_trie(self) -> None:
        """The pieces read backwards: ``next_nodes[node]`` leads on by a character, ``ends[node]`` is the piece that ends there or -1.

        A character without a piece has the number ``size`` plus its code point.
        """
        self.size = len(self.model.pieces)
        self.next_nodes: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for piece, i in self.ids.items():
            node = 0
            for c in reversed(piece):
                if c not in self.next_nodes[node]:
                    self.next_nodes[node][c] = len(self.ends)
                    self.next_nodes.append({})
                    self.ends.append(-1)
                node = self.next_nodes[node][c]
            self.ends[node] = i

    def _decoded(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind in (CONTROL, UNUSED):
            return b""
        return UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        text = text.replace(MARK, " ")
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return " " + text if text and self.model.dummy_prefix else text

    def merge(self, text: str) -> list[str]:
        """Encoding by merging: always the neighbours whose joined piece has the best score, from the left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                weight = self.weights.get(parts[i] + parts[i + 1])
                if weight is not None and (best is None or weight < best):
                    best, at = weight, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _text(self, number: int) -> str:
        return self.model.pieces[number] if number < self.size else chr(number - self.size)

    def _allowed(self, before: int, piece: int) -> bool:
        """Whether the arc's weight is finite; ``before`` is -1 at the start."""
        left, right = self._text(before) if before >= 0 else "", self._text(piece)
        found = self.merge(left + right) == ([left, right] if left else [right])
        if len(self._pairs) >= KEPT_PAIRS:
            self._pairs.clear()
        self._pairs[before * 0x200000 + piece] = found
        return found

    def _merge_paths(self, parts: list[str]) -> Iterator[list[int]]:
        """The path of each of the sorted ``parts``; states of the prefix shared with the part before are taken over."""
        next_nodes, ends, known, size = self.next_nodes, self.ends, self._pairs, self.size
        last, start, before = [-1], [0], ""
        for part in parts:
            text = part.replace(" ", MARK)
            shared, n = 0, min(len(text), len(before))
            while shared < n and text[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], start[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                # the pieces that end here, the shortest first
                at, node = end - 1, next_nodes[0].get(text[end - 1], 0)
                piece = ends[node] if node and ends[node] >= 0 else size + ord(text[at])
                while True:
                    if piece >= 0:
                        allowed = known.get(last[at] * 0x200000 + piece)
                        if allowed is None:
                            allowed = self._allowed(last[at], piece)
                        if allowed:
                            break
                    node = next_nodes[node].get(text[at - 1], 0) if at and node else 0
                    if not node:
                        raise ValueError("pieces of this model do not follow from merges")
                    at -= 1
                    piece = ends[node]
                last.append(piece)
                start.append(at)
            before, path, at = text, [], len(text)
            while at:
                path.append(last[at])
                at = start[at]
            path.reverse()
            yield path

    def _unigram_path(self, part: str) -> list[int]:
        text = part.replace(" ", MARK)
        best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        for end in range(1, len(text) + 1):
            arcs = [(best[end - 1][0] + self.unknown_weight, end - 1, self.size + ord(text[end - 1]))]
            node, at = 0, end
            while at and (node := self.next_nodes[node].get(text[at - 1], 0)):
                at -= 1
                if self.ends[node] >= 0:
                    arcs.append((best[at][0] + self.weights[self._text(self.ends[node])], at, self.ends[node]))
            best.append(min(arcs))
        path, end = [], len(text)
        while end:
            _, end, piece = best[end]
            path.append(piece)
        return path[::-1]

    def _ids(self, path: list[int]) -> list[int]:
        if not path or max(path) < self.size:
            return path
        ids: list[int] = []
        for piece in path:
            if piece < self.size:
                ids.append(piece)
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in chr(piece - self.size).encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def _learn_parts(self, parts: set[str]) -> None:
        new = sorted(parts.difference(self._parts))
        paths = self._merge_paths(new) if self.model.kind == BPE else map(self._unigram_path, new)
        for part, path in zip(new, paths, strict=True):
            self._parts[part] = array("i", self._ids(path)).tobytes()
            self._kept += ENTRY_BYTES + len(part) + len(self._parts[part])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Words that one blank sets apart are looked up whole, and cut into parts if they are new."""
        if self._kept > KEPT_BYTES:
            self._parts.clear()
            self._words.clear()
            self._kept = 0
        units: list[tuple[dict[str, bytes], list[str]]] = []
        words: set[str] = set()
        parts: set[str] = set()
        for text in map(self.normalise, texts):
            if text.startswith(" ") and "  " not in text and not text.endswith(" "):
                units.append((self._words, text[1:].split(" ")))
                words.update(units[-1][1])
            else:
                units.append((self._parts, self.part.findall(text)))
                parts.update(units[-1][1])
        cut = {w: self.part.findall(" " + w) for w in words.difference(self._words)}
        self._learn_parts(parts.union(*cut.values()))
        known = self._parts.__getitem__
        for word, own in cut.items():
            self._words[word] = b"".join(map(known, own))
            self._kept += ENTRY_BYTES + len(word) + len(self._words[word])
        return [np.frombuffer(b"".join(map(kept.__getitem__, own)), dtype="<i4") for kept, own in units]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.texts.__getitem__, ids))
        text = data.decode(errors="replace")
        return text.removeprefix(" ") if self.model.dummy_prefix else text


@lru_cache(maxsize=2)
def compiled(data: bytes) -> Transducer:
    """One transducer per worker and model file; its kept paths serve all tasks of the worker."""
    return Transducer(PieceModel(data))


def read_model(path: str) -> bytes:
    """The model file, read on the driver and shipped with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(batches: Iterator[pa.RecordBatch], transducer: Transducer) -> Iterator[tuple[pa.RecordBatch, list[str], list[np.ndarray]]]:
    """Small slices of rows with their texts and ids."""
    collects = gc.isenabled()
    gc.disable()  # the kept paths are many and hold no cycles
    try:
        for batch in slices(batches, ROWS):
            texts = batch["text"].to_pylist()
            yield batch, texts, transducer.encode_batch(texts)
    finally:
        if collects:
            gc.enable()


def _id_lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    # Spark's array type has 32-bit offsets
    if ends[-1] >= 2**31:
        raise ValueError(f"{len(found)} texts have over 2^31 ids")
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), as_text(text_col).alias("text"))


def encode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found in _encoded(batches, compiled(model)):
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], _id_lists(found)], ["id", "text", "ids"])
    return _texts(df, id_col, text_col).mapInArrow(run, "id bigint, text string, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` (id, text, ids) with the column decoded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        for batch in slices(batches, ROWS):
            texts = [transducer.decode(ids.values.to_numpy().tolist()) for ids in batch["ids"]]
            columns = [batch["id"], batch["text"], batch["ids"], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text", "ids", "decoded"])
    return encoded.select("id", "text", "ids").mapInArrow(run, "id bigint, text string, ids array<int>, decoded string")


def round_trip(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids, decoded_sha256 (hex) and round_trip, whether decoding gives the text with marks taken as blanks.

    Encoding and decoding in one worker: no text leaves it, and a task holds the ids of ``ROWS`` texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        for batch, texts, found in _encoded(batches, transducer):
            digests, same = [], []
            for text, ids in zip(texts, found, strict=True):
                decoded = transducer.decode(ids.tolist())
                digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                same.append(decoded == text.replace(MARK, " "))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], _id_lists(found), pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                ["id", "ids", "decoded_sha256", "round_trip"])
    return _texts(df, id_col, text_col).mapInArrow(run, "id bigint, ids array<int>, decoded_sha256 string, round_trip boolean")
