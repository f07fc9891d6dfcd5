"""Toxic texts by a support vector machine with a gap-weighted subsequence kernel and Nyström landmarks.

The kernel compares two words by the subsequences of four characters they share, each counted with ``DECAY`` to the power of the
characters it skips, within a window of ``SPAN``; so "stupid", "stuxpid" and "s*t*u*p*i*d" share most of theirs. A mark in front of
the word makes its beginning count. Subsequences are hashed to ``BUCKETS`` places, which makes the kernel's feature vectors explicit,
and words are scaled by the norm that their length alone gives. Nyström: a word is represented by its kernel values with the
landmarks, whitened by the landmarks' own kernel matrix, and a linear machine with squared hinge loss is trained there. As the
whole is linear in the word's subsequences it folds into one weight per bucket, so scoring a word is a sum of table look-ups.

Training: labels are known for documents. All words of a clean document's sentences are clean; a toxic document has at least one
sentence with an insult, and its best word stands for it (the machine chooses it anew in each round). The first choice
goes by how surely a word, or the beginning it shares with others, tells toxic from clean documents. Landmarks are such words
and the clean words nearest to them. Words weigh by the documents that hold them. A document's value is that of its best word, so one insult is
enough; words that training documents show to be likelier clean than toxic, though they look like insults, have the value of no word.
A logistic curve, fitted to the training documents with their true shares, gives the chance; there each document's own words are judged by the others alone. The training sample is bounded: ``SAMPLE`` documents of each class, the first by hash of the id, if of at most
``SAMPLE_CHARS`` characters, and of several rows with one id the smallest text; everything is scored, whole.

Defined cases: a null text counts as the empty text; a text without words gets the score of its class of value, the smallest
one. Labels that are null or not 0 or 1 are ignored; repeated label rows count once. Without a sample of both classes
every score is the share of toxic labels (0 without any). Repeated rows are scored each on its own; other columns are ignored, and
ids, sources, languages and labels are never inputs of a score.
"""

from __future__ import annotations

import gc
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, slices

SAMPLE, SAMPLE_CHARS = 3000, 1 << 16
DECAY, SPAN, BUCKETS = 0.6, 6, 1 << 20
#: Longest stretch of a word that is compared at once; longer words are compared in overlapping stretches.
LONGEST = 24
KEPT_WORDS = 400_000
#: Weight of clean documents against as many toxic ones, and of the penalty for large weights.
CLEAN_WEIGHT, PENALTY = 10.0, 2e-3
#: Words of a smaller value need not be known as clean ones.
NEAR = -0.5
#: Signed root of the likelihood ratio from which a word counts as telling.
SURE = 4.0

_OFFSETS = [(a, b, c) for a, b, c in combinations(range(1, SPAN), 3)]
_PAD, _FRONT = 64, 63
_WORD = re.compile(r"[^\W_]+")
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:\s+[^\W\d_](?!\S)){2,}")


def _symbols() -> np.ndarray:
    """A symbol of 6 bits for each code point below 65536; letters a-z and digits have their own."""
    table = 36 + np.arange(65536) % 27
    table[ord("a"):ord("z") + 1] = np.arange(26)
    table[ord("0"):ord("9") + 1] = 26 + np.arange(10)
    table[ord("^")], table[0] = _FRONT, _PAD
    return table.astype(np.uint8)


_SYMBOLS = _symbols()


def _length_norms() -> np.ndarray:
    """Root of the sum of squared weights of all subsequences of a word of each length."""
    norms = np.ones(LONGEST + 2)
    for n in range(4, LONGEST + 2):
        norms[n] = sum(max(0, n - c) * DECAY ** (2 * (c - 3)) for _, _, c in _OFFSETS) ** 0.5
    return norms


_NORMS = _length_norms()


def stretches(token: str) -> list[str]:
    """The strings to compare for one lower-case token: its words, and all of them joined if marks part them."""
    if len(token) <= LONGEST and token.isalpha():
        return ["^" + token] if len(token) >= 3 else []
    words = _WORD.findall(token)
    if len(words) > 1:
        words.append("".join(words))
    found = []
    for w in words:
        if len(w) >= 3:
            w = "^" + w
            found.extend(w[at:at + LONGEST + 1] for at in range(0, max(1, len(w) - LONGEST // 2), LONGEST // 2) if at == 0 or len(w) > LONGEST + 1)
    return found


def tokens(text: str) -> list[str]:
    """Lower-case tokens, and letters standing alone in a row as one token more."""
    text = text.lower()
    found = text.split()
    found.extend("".join(m.split()) for m in _SPACED.findall(text))
    return found


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(positions of the words, buckets, weight) for each way to skip characters; ``BUCKETS`` stands beyond a word's end."""
    by_size: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_size[-(-len(w) // 4) * 4].append(i)
    for size, places in by_size.items():
        text = "".join(words[i].ljust(size + SPAN, "\0") for i in places)
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).reshape(len(places), size + SPAN)
        codes = _SYMBOLS[np.minimum(points, 65535)].astype(np.uint32)
        first = codes[:, :size]
        at = np.array(places)
        for a, b, c in _OFFSETS:
            last = codes[:, c:c + size]
            h = first | codes[:, a:a + size] << 6 | codes[:, b:b + size] << 12 | last << 18
            h = (h * np.uint32(2654435761)) >> np.uint32(12)
            h[last == _PAD] = BUCKETS
            yield at, h, DECAY ** (c - 3)


def weigh(words: list[str], table: np.ndarray) -> np.ndarray:
    """For each word the scaled sum of its subsequences' weights; the last entry of ``table`` must be 0."""
    total = np.zeros(len(words))
    for at, buckets, weight in subsequences(words):
        total[at] += weight * np.take(table, buckets).sum(axis=1)
    return total / _NORMS[np.fromiter(map(len, words), dtype=np.int64, count=len(words))]


def sparse_features(words: list[str]) -> list[dict[int, float]]:
    """The explicit feature vector of each word."""
    found: list[dict[int, float]] = [defaultdict(float) for _ in words]
    for at, buckets, weight in subsequences(words):
        for i, row in zip(at.tolist(), buckets.tolist(), strict=True):
            own = found[i]
            for h in row:
                if h < BUCKETS:
                    own[h] += weight / _NORMS[len(words[i])]
    return found


@dataclass(frozen=True)
class Machine:
    """Bucket weights, the value of no word, the logistic curve of a document's best word (slope, shift), and the words known as clean."""

    table: np.ndarray
    bias: float
    slope: float
    shift: float
    clean: frozenset[str] = frozenset()

    def chance(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(value * self.slope + self.shift, -700, 700)))


def train_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights (the last one for a constant) of a machine with squared hinge loss, by Newton steps; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(30):
        gap = 1 - y * (x @ w)
        on = gap > 0
        own, scale = x[on], weight[on]
        gradient = penalty * w - own.T @ (scale * y[on] * gap[on])
        hessian = penalty * np.eye(len(w)) + (own * scale[:, None]).T @ own
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _gain(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """seen * log(seen / expected), 0 where nothing was seen."""
    return seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))


class Trainer:
    """Trains on (toxic 0 or 1, text) pairs; ``share`` is the true share of toxic documents."""

    LANDMARKS, NEGATIVES, ROUNDS = 256, 8_000, 4

    def __init__(self, labels: list[int], texts: list[str], share: float):
        self.y = np.array(labels)
        self.texts = texts
        self.share = share
        self.numbers: dict[str, int] = {}
        self.docs = []
        for text in texts:
            own = {s for t in set(tokens(text)) for s in stretches(t)}
            self.docs.append(np.array([self.numbers.setdefault(w, len(self.numbers)) for w in sorted(own)], dtype=np.int64))
        self.words = list(self.numbers)

    def sureness(self) -> np.ndarray:
        """Per word, how surely it or a beginning of at least five letters tells toxic from clean documents: the root of the
        likelihood ratio, negative where clean documents have it more often. Fewer clean hits always make it larger."""
        n_toxic, n_clean = (self.y == 1).sum(), (self.y == 0).sum()
        beginnings: dict[str, int] = {}
        of_word = []
        for w in self.words:
            of_word.append([beginnings.setdefault(w[:n], len(beginnings)) for n in range(6, 10) if n < len(w)]
                           + [beginnings.setdefault(w + "$", len(beginnings))])
        seen = np.zeros((2, len(beginnings)))
        for label, own in zip(self.y, self.docs, strict=True):
            seen[label, list({b for i in own for b in of_word[i]})] += 1
        common = seen.sum(axis=0) / (n_toxic + n_clean)
        ratio = sum(_gain(hits, n * common) + _gain(n - hits, n * (1 - common)) for hits, n in zip(seen, (n_clean, n_toxic), strict=True))
        z = np.sign(seen[1] * n_clean - seen[0] * n_toxic) * np.sqrt(np.maximum(2 * ratio, 0))
        return np.array([max(z[b] for b in own) for own in of_word])

    def train(self) -> Machine:
        prior = Machine(np.zeros(BUCKETS + 1, dtype=np.float32), 0.0, 0.0, float(np.log((self.share + 1e-9) / (1 - self.share + 1e-9))))
        if len(set(self.y.tolist())) < 2 or not self.words:
            return prior
        toxic = [own for label, own in zip(self.y, self.docs, strict=True) if label == 1 and len(own)]
        clean_times = np.bincount(np.concatenate([own for label, own in zip(self.y, self.docs, strict=True) if label == 0] or [np.zeros(0, dtype=np.int64)]), minlength=len(self.words))
        z = self.sureness()
        witness = Counter(int(i) for own in toxic for i in own if z[i] > SURE)
        sure = [i for i, _ in sorted(witness.items(), key=lambda x: (-x[1] * z[x[0]], self.words[x[0]]))][:self.LANDMARKS // 2]
        if not sure:
            return prior
        table = np.zeros(BUCKETS + 1)
        for own in sparse_features([self.words[i] for i in sure]):
            for h, v in own.items():
                table[h] += v / len(sure)
        clean = np.flatnonzero(clean_times)
        likeness = weigh([self.words[i] for i in clean], table)
        order = clean[np.lexsort((clean, -likeness))]
        near = [int(i) for i in order if z[i] < 1][:self.LANDMARKS // 2]
        landmarks = [self.words[i] for i in [*sure, *near]]
        features = sparse_features(landmarks)
        kernel = np.array([[sum(v * b.get(h, 0.0) for h, v in a.items()) for b in features] for a in features])
        values, directions = np.linalg.eigh(kernel)
        whiten = directions / np.sqrt(np.maximum(values, 1e-6 * values.max()))
        # landmark feature table: bucket -> columns, for the kernel values of many words at once
        used = sorted({h for f in features for h in f})
        place = np.full(BUCKETS + 1, len(used))
        place[used] = np.arange(len(used))
        dense = np.zeros((len(used) + 1, len(landmarks)))
        for j, f in enumerate(features):
            for h, v in f.items():
                dense[place[h], j] = v

        rows: dict[int, np.ndarray] = {}

        def mapped(numbers: list[int]) -> np.ndarray:
            new = [i for i in numbers if i not in rows]
            words = [self.words[i] for i in new]
            out = np.zeros((len(words), len(landmarks)))
            for at, buckets, weight in subsequences(words):
                for column in range(buckets.shape[1]):
                    near_by = place[buckets[:, column]]
                    some = near_by < len(used)
                    out[at[some]] += weight * dense[near_by[some]]
            rows.update(zip(new, out / _NORMS[[len(w) for w in words]][:, None] @ whiten, strict=True))
            return np.stack([rows[i] for i in numbers])

        hard = [int(i) for i in order[:self.NEGATIVES // 2]]
        rng = np.random.default_rng(3)
        negatives = sorted(set(hard) | set(rng.choice(clean, min(len(clean), self.NEGATIVES // 2), replace=False).tolist()))
        chosen = list(witness.elements())
        for _ in range(self.ROUNDS):
            positives = sorted(Counter(chosen).items())
            x = mapped([i for i, _ in positives] + negatives)
            y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
            # a word counts by the share of its class's documents
            counts = np.array([n for _, n in positives], dtype=float)
            weight = np.concatenate([counts / (self.y == 1).sum(), CLEAN_WEIGHT * clean_times[negatives] / (self.y == 0).sum()])
            w = train_linear(x, y, weight, PENALTY / weight.sum())
            table = np.zeros(BUCKETS + 1, dtype=np.float32)
            table[used] = dense[:-1] @ (whiten @ w[:-1])
            value = weigh(self.words, table) + w[-1]
            best = [int(own[value[own].argmax()]) for own in toxic]
            chosen = [i for i in best if value[i] > -0.5] + list(witness.elements())
            worst = clean[np.argsort(-value[clean], kind="stable")][:self.NEGATIVES // 4]
            negatives = sorted(set(negatives) | {int(i) for i in worst})
        return self._curve(table, float(w[-1]), value)

    def _clean(self, value: np.ndarray, left_out: int | None = None) -> frozenset[str]:
        """Words like insults that are likelier in a clean document; ``left_out``: as one document less of that class shows it."""
        hits = np.array([np.bincount(np.concatenate([own for y, own in zip(self.y, self.docs, strict=True) if y == label]), minlength=len(self.words)) for label in (0, 1)])
        if left_out is not None:
            hits[left_out] -= 1
        shares = (1 - self.share) * hits[0] / (self.y == 0).sum(), self.share * hits[1] / (self.y == 1).sum()
        return frozenset(self.words[i] for i in np.flatnonzero((value > NEAR) & (hits[0] > 0) & (shares[0] > shares[1])))

    def _curve(self, table: np.ndarray, bias: float, value: np.ndarray) -> Machine:
        """Logistic curve by Newton steps, the classes weighted to their true shares."""
        best = np.zeros(len(self.texts))
        for label in (0, 1):
            scorer = Scorer(Machine(table, bias, 0.0, 0.0, self._clean(value, label)))
            places = np.flatnonzero(self.y == label)
            for i in range(0, len(places), 512):
                best[places[i:i + 512]] = scorer.values([self.texts[j] for j in places[i:i + 512]])
        y = self.y.astype(float)
        weight = np.where(y == 1, self.share / max(y.sum(), 1), (1 - self.share) / max((1 - y).sum(), 1))
        x = np.column_stack([best, np.ones(len(best))])
        held = 1e-4 * np.array([1.0, 1e-2])
        part = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ part, -30, 30)))
            gradient = x.T @ (weight * (p - y)) + held * part
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(held)
            part = part - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        return Machine(table, bias, *map(float, part), self._clean(value))


class Scorer:
    """Values of the best words of texts; words already weighed are kept."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.kept: dict[str, float] = {}

    def values(self, texts: list[str]) -> np.ndarray:
        """The value of each text's best word; without such a word that of no word."""
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        found = [tokens(t) for t in texts]
        new = list(set().union(*found).difference(self.kept))
        parts, ends = [], []
        for t in new:
            parts.extend(stretches(t))
            ends.append(len(parts))
        bias, table = self.machine.bias, self.machine.table
        weighed = np.concatenate([weigh(parts[i:i + 50_000], table) for i in range(0, len(parts), 50_000)] or [np.zeros(0)])
        if self.machine.clean:
            weighed[[i for i, w in enumerate(parts) if w in self.machine.clean]] = 0.0
        best = np.full(len(new), 0.0)
        if len(parts):
            sizes = np.diff([0, *ends])
            full = np.flatnonzero(sizes)
            best[full] = np.maximum.reduceat(weighed, np.concatenate([[0], ends])[:-1][full])
            best[sizes == 0] = 0.0
        self.kept.update(zip(new, (best + bias).tolist(), strict=True))
        known = self.kept.__getitem__
        return np.array([max(map(known, own), default=bias) for own in found])


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """From documents and ``labels`` (id, label); the sample alone comes to the driver."""
    labels = labels.where("label in (0, 1) and id is not null").select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("int").alias("label")).distinct()
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    first = [labels.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for c in (0, 1)]
    # at most 2 * SAMPLE ids: small enough to send to every task
    sample = F.broadcast(first[0].unionByName(first[1]).withColumnRenamed("id", "sample_id"))
    rows = df.select(F.col(id_col).cast("bigint").alias("doc"), as_text(text_col).alias("text"))
    rows = rows.join(sample, F.col("doc") == F.col("sample_id")).where(F.length("text") <= SAMPLE_CHARS)
    # one text an id and label, so at most 2 * SAMPLE rows
    found = sorted({(r.label, r.text) for r in rows.groupBy("label", "doc").agg(F.min("text").alias("text")).collect()})
    return Trainer([label for label, _ in found], [text for _, text in found], share).train()


def score(df: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, value and score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        gc.disable()  # the kept words are many and hold no cycles
        for batch in slices(batches):
            value = scorer.values(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(value), pa.array(machine.chance(value))], ["id", "value", "score"])
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), as_text(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, value double, score double")
