"""Language-model scores: a unigram base and a hashed maximum-entropy model with class-factored softmax.

p(word | history) = p(class | history) * p(word | class, history). The class of a word is a hash of its last two bytes (the end of a
text has its own). Both factors use three hashed features of the history: the word before, the two words before, and the word
before the last with the last one skipped. The class factor is a softmax over their weights. The word factor is a hierarchical
softmax over the words of the class: bits of a word's hash lead through ``DEPTH`` two-way choices to a leaf, each a softmax
of the log odds of the words below, by frequency, and of the weights of the features joined with the node. Words of one leaf,
which are few but for rare ones, are told apart by frequency. Every class has one place for unknown words, so each factor sums to one.

Data flow: documents are tokenised once, into blocks of about ``BLOCK_BYTES`` of text that are written to shared storage. A block
holds its distinct words, its texts as numbers of these, and each word's count in training texts. Corpus counts are a
grouping over the blocks' words. What a block needs from them comes back by a join on the word (one row per block and
distinct word, so no word is hot) and meets the block's texts in one group. In both, a word is 96 bits of two hashes of it, so that
two words could only be taken for one if they agreed in all of them. No vocabulary is ever held whole anywhere.

Training: one pass counts feature and class together and sets the class weights to smoothed log ratios; then the blocks are dealt
into ``ROUNDS`` parts, and each round adds up, task by task, the difference of observed and expected counts over its part
and moves the weights of both factors along it, scaled by how often a feature occurred (at a node: by the variance of the
choice). Every training text takes part in both. The weights have a fixed size, and so has what a task sends.

Defined cases: a null or blank text is the end alone; repeated rows count and are scored each on its own; without training texts
the base is 0 for every token. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, checkpointed, fresh_folder

CLASSES, FEATURES, BUCKETS = 32, 3, 1 << 14
ROUNDS, RATE, PRIOR = 2, 0.5, 4.0
#: Two-way choices on the way to a word in its class, places for their weights by feature, and how these move.
DEPTH, SLOTS = 8, 1 << 18
WORD_RATE, WORD_PRIOR = 0.5, 4.0
#: Shares of the features' log ratios in the first weights.
FIRST = (0.5, 0.5, 0.2)
BLOCK_BYTES = 16 << 20
END = b" "
#: Files of blocks that a training task takes, on tables with more than two for every core.
FILES = 4
#: Weights go through the shuffle in pieces of so many.
PIECE = 1 << 15
_STEP = 1 << 14

BLOCK = ("block bigint, ids array<bigint>, trains array<boolean>, lengths array<int>, codes binary, "
         "words array<binary>, counts array<int>")


def word_class(word: bytes) -> int:
    return CLASSES - 1 if word == END else zlib.crc32(word[-2:]) % (CLASSES - 1)


def _class_of(word: Column) -> Column:
    """The same for a column."""
    return F.when(word == F.lit(END), CLASSES - 1).otherwise(F.crc32(F.substring(word, -2, 2)) % (CLASSES - 1)).cast("int")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    number = TaskContext.get().partitionId() << 32
    ids, trains, lengths, codes, places, size = [], [], [], [], defaultdict(count().__next__), 0

    def close() -> pa.RecordBatch:
        flat = np.concatenate(codes)
        on = np.repeat(np.array(trains), lengths)
        counts = np.bincount(flat[on], minlength=len(places)).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([trains], pa.list_(pa.bool_())),
            pa.array([lengths], pa.list_(pa.int32())), pa.array([pack.compress(flat.tobytes())], pa.binary()),
            pa.array([list(places)], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int32())),
        ], ["block", "ids", "trains", "lengths", "codes", "words", "counts"])

    for batch in batches:
        for doc_id, train, text in zip(batch["id"].to_pylist(), batch["train"].to_pylist(), batch["text"], strict=True):
            data = text.as_py().encode().lower()
            words = data.split()
            words.append(END)
            codes.append(np.fromiter(map(places.__getitem__, words), dtype=np.int32, count=len(words)))
            ids.append(doc_id)
            trains.append(train)
            lengths.append(len(words))
            size += len(data) + 1
            if size >= BLOCK_BYTES:
                yield close()
                number += 1
                ids, trains, lengths, codes, places, size = [], [], [], [], defaultdict(count().__next__), 0
    if ids:
        yield close()


@dataclass
class Block:
    """The arrays of one block; ``classes`` and ``hashes`` are per distinct word, as are ``nodes`` and ``sides`` by step to the leaf."""

    ids: list
    trains: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    classes: np.ndarray
    hashes: np.ndarray

    def training(self) -> Block:
        return Block(self.ids, self.trains[self.trains], self.lengths[self.trains], self.codes[np.repeat(self.trains, self.lengths)], self.classes, self.hashes)

    def choices(self) -> tuple[np.ndarray, np.ndarray]:
        """[word, step] nodes on the way to each distinct word's leaf, and whether the upper side is taken."""
        leaves = self.hashes & np.uint32((1 << DEPTH) - 1)
        steps = np.arange(DEPTH, dtype=np.uint32)
        nodes = (np.uint32(1) << steps) | (leaves[:, None] >> (np.uint32(DEPTH) - steps))
        nodes += self.classes.astype(np.uint32)[:, None] << np.uint32(DEPTH)
        return nodes, (leaves[:, None] >> (np.uint32(DEPTH - 1) - steps) & np.uint32(1)).astype(bool)

    def stretches(self, step: int = _STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(histories by feature, codes) of ``step`` tokens at a time."""
        if not len(self.codes):
            return
        own = self.hashes[self.codes]
        starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        before = np.concatenate([[0], own[:-1]]).astype(np.uint32)
        second = np.concatenate([[0, 0], own[:-2]]).astype(np.uint32)[:len(own)]
        before[starts] = 1
        second[starts] = 1
        second[starts[self.lengths > 1] + 1] = 1
        histories = np.stack([
            before * np.uint32(2654435761), ((before * np.uint32(2246822519)) ^ (second * np.uint32(3266489917) >> np.uint32(3))) * np.uint32(668265263),
            second * np.uint32(374761393)])
        for at in range(0, len(own), step):
            yield histories[:, at:at + step], self.codes[at:at + step]


def _buckets(histories: np.ndarray) -> np.ndarray:
    return histories >> np.uint32(32 - BUCKETS.bit_length() + 1)


#: Class by the last byte and the one before it.
_CLASS_OF = np.array([[zlib.crc32(bytes([b, a])) % (CLASSES - 1) for b in range(256)] for a in range(256)])
_CLASS_OF_BYTE = np.array([zlib.crc32(bytes([a])) % (CLASSES - 1) for a in range(256)])


def word_classes(ends: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``word_class`` of all words, which end at ``ends`` in ``data``."""
    last = data[ends - 1]
    classes = np.where(lengths > 1, _CLASS_OF[last, data[np.maximum(ends - 2, 0)]], _CLASS_OF_BYTE[last])
    return np.where((lengths == 1) & (last == END[0]), CLASSES - 1, classes)


def _opened(batch: pa.RecordBatch | pa.Table, row: int) -> Block:
    words = batch["words"][row].values.cast(pa.binary())
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    data = memoryview(words.buffers()[2])
    # slices of the buffer: a Python object per word would cost more than the hash
    hashes = np.array([zlib.crc32(data[a:b]) for a, b in pairwise(bounds.tolist())], dtype=np.uint32)
    return Block(
        batch["ids"][row].as_py(), np.array(batch["trains"][row].as_py(), dtype=bool), np.array(batch["lengths"][row].as_py(), dtype=np.int64),
        np.frombuffer(zstandard.decompress(batch["codes"][row].as_py()), dtype=np.int32),
        word_classes(bounds[1:], np.frombuffer(data, dtype=np.uint8), np.diff(bounds)), hashes)


@dataclass
class Tree:
    """The word factor: log odds of the upper side by node, and weights [feature, slot]."""

    odds: np.ndarray
    weights: np.ndarray

    def scores(self, histories: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """[token, step] log odds of the upper side, and the slots of their weights by feature."""
        keys, z, slots = nodes * np.uint32(2654435761), self.odds[nodes], []
        for f in range(FEATURES):
            slots.append(((histories[f][:, None] ^ keys) * np.uint32(2246822507)) >> np.uint32(32 - SLOTS.bit_length() + 1))
            z += np.take(self.weights[f], slots[f], mode="clip")
        return z, slots

    def log_chances(self, histories: np.ndarray, nodes: np.ndarray, sides: np.ndarray) -> np.ndarray:
        """Per token, the logarithm of taking all ``sides``."""
        z = self.scores(histories, nodes)[0]
        odds = 1 + np.exp(np.where(sides, -z, z))
        return -np.log(np.multiply.reduce(odds, axis=1, dtype=np.float64))


def node_odds(mass: np.ndarray) -> np.ndarray:
    """Log odds of the upper side by node (a class's nodes are numbered as a heap), from the leaves' masses [class, leaf]."""
    odds = np.zeros((CLASSES, 1 << DEPTH), dtype=np.float32)
    for step in range(DEPTH):
        below = mass.reshape(CLASSES, 1 << step, 2, -1).sum(axis=3)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = np.log(below[..., 1] / below[..., 0])
        odds[:, 1 << step:2 << step] = np.clip(np.nan_to_num(at, posinf=40, neginf=-40), -40, 40)
    return odds.ravel()


@dataclass
class Model:
    """Class biases and weights [feature, bucket, class], natural logarithms, and the word factor."""

    bias: np.ndarray
    weights: np.ndarray
    tree: Tree | None = None

    def _scores(self, buckets: np.ndarray) -> np.ndarray:
        z = np.take(self.weights[0], buckets[0], axis=0)
        for f in range(1, FEATURES):
            z += np.take(self.weights[f], buckets[f], axis=0)
        z += self.bias
        return z

    def log_chances(self, buckets: np.ndarray) -> np.ndarray:
        """[token, class]"""
        z = self._scores(buckets)
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def log_chance(self, buckets: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Of each token's own class. Trained scores are log ratios of counts and a few steps of at most 1, so no exponential overflows."""
        z = self._scores(buckets)
        own = z[np.arange(len(classes)), classes]
        return own - np.log(np.exp(z, out=z) @ np.ones(CLASSES, dtype=z.dtype))

    def chances(self, buckets: np.ndarray) -> np.ndarray:
        """[token, class]"""
        z = self._scores(buckets)
        np.exp(z, out=z)
        z /= (z @ np.ones(CLASSES, dtype=z.dtype))[:, None]
        return z


def short_floats(values: np.ndarray) -> np.ndarray:
    """The upper 16 bits of 32-bit floats, rounded: 8 bits of precision at every size. Whole numbers up to 256 stay exact."""
    bits = np.ascontiguousarray(values, dtype=np.float32).view(np.uint32)
    return ((bits + np.uint32(0x7FFF) + ((bits >> np.uint32(16)) & np.uint32(1))) >> np.uint32(16)).astype(np.uint16)


def long_floats(values: np.ndarray) -> np.ndarray:
    return (values.astype(np.uint32) << np.uint32(16)).view(np.float32)


def _pieces(table: np.ndarray) -> pa.RecordBatch:
    """A task's table in pieces, shortened and packed, as every task sends one of the full size."""
    flat, pack = short_floats(table.ravel()), zstandard.ZstdCompressor(level=3)
    parts = [pack.compress(flat[i:i + PIECE].tobytes()) for i in range(0, len(flat), PIECE)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["piece", "data"])


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(PIECE)
    for data in table["data"]:
        part = long_floats(np.frombuffer(zstandard.decompress(data.as_py()), dtype=np.uint16))
        total[:len(part)] += part
    return pa.table({"piece": table["piece"][:1], "data": pa.array([total[:len(part)].astype(np.float32).tobytes()], pa.binary())})


def _sum_over(blocks: DataFrame, size: int, table_of_task) -> np.ndarray:
    """The sum of the tasks' tables of ``size``. A task takes several files of blocks, as each sends a whole table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _pieces(table_of_task(batches))
    rows = blocks.select("ids", "trains", "lengths", "codes", "words")
    tasks = max(2 * blocks.sparkSession.sparkContext.defaultParallelism, -(-len(blocks.inputFiles()) // FILES))
    sums = rows.coalesce(tasks).mapInArrow(run, "piece int, data binary")
    total = np.zeros(size, dtype=np.float32)
    for row in sums.groupBy("piece").applyInArrow(_added, "piece int, data binary").collect():
        part = np.frombuffer(row.data, dtype=np.float32)
        total[row.piece * PIECE:row.piece * PIECE + len(part)] = part
    return total


def _observed(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    table = np.zeros((FEATURES, BUCKETS * CLASSES), dtype=np.int64)
    for batch in batches:
        for row in range(batch.num_rows):
            block = _opened(batch, row).training()
            for histories, codes in block.stretches(1 << 20):
                buckets, classes = _buckets(histories).astype(np.int64), block.classes[codes]
                for f in range(FEATURES):
                    table[f] += np.bincount(buckets[f] * CLASSES + classes, minlength=BUCKETS * CLASSES)
    return table


def _gradient(model: Model):
    def table_of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        """Observed minus expected counts of classes [feature, bucket, class], then of sides [feature, slot], then these sides' variance."""
        table = np.zeros((FEATURES, BUCKETS, CLASSES), dtype=np.float32)
        moves = np.zeros((2, FEATURES, SLOTS), dtype=np.float32)
        for batch in batches:
            for row in range(batch.num_rows):
                block = _opened(batch, row).training()
                nodes, sides = block.choices()
                for histories, codes in block.stretches():
                    buckets, classes = _buckets(histories), block.classes[codes]
                    rest = -model.chances(buckets)
                    rest[np.arange(len(classes)), classes] += 1
                    for f in range(FEATURES):
                        order = np.argsort(buckets[f].astype(np.uint16), kind="stable")
                        own = buckets[f][order]
                        starts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
                        # pairs of floats added as one complex number
                        added = np.add.reduceat(np.take(rest, order, axis=0).view(np.complex64), starts, axis=0)
                        table[f, own[starts]] += added.view(np.float32)
                    z, slots = model.tree.scores(histories, nodes[codes])
                    upper = 1 / (1 + np.exp(-z))
                    miss, spread = (sides[codes] - upper).ravel(), (upper * (1 - upper)).ravel()
                    for f in range(FEATURES):
                        at = slots[f].ravel().astype(np.int64)
                        np.add.at(moves[0, f], at, miss)
                        np.add.at(moves[1, f], at, spread)
        return np.concatenate([table.ravel(), moves.ravel()])
    return table_of_task


def train(blocks: DataFrame, class_counts: np.ndarray, odds: np.ndarray) -> Model:
    p = (class_counts + 0.5) / (class_counts.sum() + 0.5 * CLASSES)
    bias = np.log(p).astype(np.float32)
    shape = (FEATURES, BUCKETS, CLASSES)
    seen = _sum_over(blocks, int(np.prod(shape)), _observed).reshape(shape)
    often = seen.sum(axis=2, keepdims=True)
    ratio = np.log((seen + PRIOR * p) / (often + PRIOR)) - bias
    tree = Tree(odds, np.zeros((FEATURES, SLOTS), dtype=np.float32))
    model = Model(bias, (ratio * np.array(FIRST)[:, None, None]).astype(np.float32), tree)
    for part in range(ROUNDS):
        own = blocks.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == part)
        model = moved(model, _sum_over(own, seen.size + 2 * tree.weights.size, _gradient(model)), often, p)
    return model


def moved(model: Model, sums: np.ndarray, often: np.ndarray, p: np.ndarray) -> Model:
    step, (miss, spread) = sums[:often.size * CLASSES].reshape(model.weights.shape), sums[often.size * CLASSES:].reshape(2, FEATURES, SLOTS)
    scale = RATE * ROUNDS / FEATURES / (often * (p * (1 - p)) + PRIOR)
    weights = (model.weights + np.clip(step * scale, -1, 1)).astype(np.float32)
    slots = model.tree.weights + np.clip(WORD_RATE * miss / (spread + WORD_PRIOR), -1, 1)
    return Model(model.bias, weights, Tree(model.tree.odds, slots.astype(np.float32)))


RESULT = "id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _scorer(model: Model, n: int, v: int, class_counts: np.ndarray, class_words: np.ndarray, leaf_mass: np.ndarray):
    def score(block_rows: pa.Table, known: pa.Table) -> pa.Table:
        parts = []
        for row in range(block_rows.num_rows):
            block = _opened(block_rows, row)
            counts = np.zeros(len(block.classes))
            counts[known["place"].to_numpy()] = known["count"].to_numpy()
            base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
            in_class = class_counts[block.classes] + 0.5 * (class_words[block.classes] + 1)
            # a known word: not the unknown, then its leaf, then the word in the leaf
            in_leaf = np.where(counts > 0, leaf_mass[block.classes, block.hashes & np.uint32((1 << DEPTH) - 1)], 1)
            fixed = np.log10(np.where(counts > 0, (1 - 0.5 / in_class) * (counts + 0.5) / in_leaf, 0.5 / in_class))
            starts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]]).astype(np.int64)
            (nodes, sides), picked = block.choices(), []
            for histories, codes in block.stretches():
                of_class = model.log_chance(_buckets(histories), block.classes[codes]).astype(np.float64)
                of_leaf = model.tree.log_chances(histories, nodes[codes], sides[codes])
                picked.append(of_class + np.where(counts[codes] > 0, of_leaf, 0))
            chosen = np.concatenate(picked) / np.log(10) + fixed[block.codes]
            parts.append(pa.table({
                "id": pa.array(block.ids, pa.int64()), "n_tokens": block.lengths,
                "n_known": np.add.reduceat((counts > 0).astype(np.int64)[block.codes], starts),
                "base_score": np.add.reduceat(base[block.codes], starts), "score": np.add.reduceat(chosen, starts)}))
        return pa.concat_tables(parts) if parts else pa.table({c.split()[0]: pa.array([], pa.int64() if "big" in c else pa.float64()) for c in RESULT.split(", ")})
    return score


def score(df: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_tokens, n_known, base_score, score, train_tokens. ``trains`` says which rows are learned from."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(trains, F.lit(False)).alias("train"), as_text(text_col).alias("text"))
    folder = fresh_folder(spark, "language-model")
    rows.mapInArrow(_blocks, BLOCK).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.parquet(folder)
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    # words travel as 96 bits of hash
    word = F.col("w.words")
    words = words.select(
        "block", "place", F.xxhash64(word).alias("h"), F.crc32(word).alias("c"), _class_of(word).alias("class"), F.col("w.counts").alias("count"))
    counts = checkpointed(words.where("count > 0").groupBy("h", "c", "class").agg(F.sum("count").alias("count")))
    leaf = F.col("c").bitwiseAND(F.lit((1 << DEPTH) - 1))
    by_leaf = counts.groupBy("class", leaf.alias("leaf")).agg(F.sum("count").alias("tokens"), F.count("*").alias("words")).collect()
    tokens, kinds = np.zeros((CLASSES, 1 << DEPTH)), np.zeros((CLASSES, 1 << DEPTH))
    for r in by_leaf:
        tokens[r["class"], r.leaf], kinds[r["class"], r.leaf] = r.tokens, r.words
    class_counts, class_words, leaf_mass = tokens.sum(axis=1), kinds.sum(axis=1), tokens + 0.5 * kinds
    n, v = int(class_counts.sum()), int(class_words.sum())
    model = train(blocks, class_counts, node_odds(leaf_mass))
    known = words.select("block", "place", "h", "c").join(counts, ["h", "c"]).select("block", "place", "count")
    texts = spark.read.parquet(folder).select("block", "ids", "trains", "lengths", "codes", "words")
    scored = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_scorer(model, n, v, class_counts, class_words, leaf_mass), RESULT)
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))
