"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

A document is reduced to a fixed vector of statistics of its whole text (lengths, shares of kinds of characters, repetition of
words and lines, entropy), each brought near a normal shape by a logarithm or logit. Class means and covariances are
sums over the labelled training rows, added up per task and then over tasks, so training reads all of them and gathers a few
hundred numbers. Each class covariance is shrunk towards the pooled one and the pooled one towards its diagonal. The score is
the logistic of the difference of the two log densities (Mahalanobis distances through Cholesky factors that are computed
once and shipped with the model) plus the log prior odds, tempered by ``temper`` because the statistics are not
independent of each other.

Defined cases: a null text counts as the empty text, and an empty text is scored like any other (its statistics are
all defined); a null or repeated label row counts once per distinct (id, label), null labels not at all; rows with repeated ids
are scored each on its own. With no labelled row of a class every score is the prior (0.5 without any label). Other
columns are ignored; ids, sources, languages and labels are never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, checkpointed, unused_name

#: Shares of the pooled covariance in a class covariance, and of the diagonal in the pooled one.
TO_POOLED, TO_DIAGONAL = 0.02, 0.05
FEATURES = 18


def _logit(share: float, of: float) -> float:
    """Log odds of a share of ``of`` things, with half a thing added to both sides."""
    return float(np.log((share * of + 0.5) / ((1 - share) * of + 0.5)))


def statistics(text: str) -> list[float]:
    """The vector of ``FEATURES`` numbers of one text."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = len(data)
    words = data.lower().split()
    m = len(words)
    seen = Counter(words)
    top = max(seen.values(), default=0)
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper, digits, high = int(counts[65:91].sum()), int(counts[48:58].sum()), int(counts[128:].sum())
    lower, blank = int(counts[97:123].sum()), int(counts[9:14].sum() + counts[32])
    marks = n - upper - lower - digits - blank - high
    stops = int(counts[46] + counts[44])
    p = counts[counts > 0] / max(n, 1)
    size, tokens = max(n, 1), max(m, 1)
    following = words[1:]
    again = sum(map(eq, words, following))
    last = np.frombuffer(bytes([w[-1] for w in words]), dtype=np.uint8)
    alpha = int(((last >= 97) & (last <= 122) | (last >= 128)).sum())
    short = int((np.fromiter(map(len, words), dtype=np.int64, count=m) <= 3).sum())
    pairs = len(set(zip(words, following, strict=False)))
    return [
        float(np.log1p(n)), float(np.log(size / tokens)), _logit(upper / size, size), _logit(digits / size, size),
        _logit(blank / size, size), _logit(high / size, size), _logit((marks - stops) / size, size), _logit(stops / size, size),
        _logit(len(seen) / tokens, tokens), _logit(top / tokens, tokens), _logit(again / tokens, tokens),
        _logit(len(set(lines)) / max(len(lines), 1), max(len(lines), 1)), float(np.log(size / max(len(lines), 1))),
        float(-(p * np.log(p)).sum()) if n else 0.0, _logit(alpha / tokens, tokens), _logit(short / tokens, tokens),
        _logit(pairs / max(m - 1, 1), max(m - 1, 1)) if m > 1 else 0.0, float(np.log(len(lines) + 1)),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors of the covariances, log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    temper: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1."""
        logs = []
        for mean, factor, log_det, prior in zip(self.means, self.factors, self.log_dets, self.log_priors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(self.temper * -0.5 * ((z * z).sum(axis=0) + log_det) + prior)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """From per-class counts, sums and sums of outer products. A class without rows takes the other's shape."""
    total = counts.sum()
    d = sums.shape[1]
    if not counts.all():
        priors = np.log((counts + 0.5) / (total + 1))
        return Discriminant(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), priors)
    means = sums / counts[:, None]
    within = squares / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (within * (counts / total)[:, None, None]).sum(axis=0)
    pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
    # few rows of a class lean more on the pooled shape
    weights = np.maximum(TO_POOLED, d / (d + counts))[:, None, None]
    shrunk = (1 - weights) * within + weights * pooled
    factors = np.linalg.cholesky(shrunk)
    log_dets = 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    return Discriminant(means, factors, log_dets, np.log(counts / total))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [statistics(t.as_py()) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["text_key"], pa.array(vectors, pa.list_(pa.float64()))], ["id", "text_key", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, sums, squares = np.zeros(2), np.zeros((2, FEATURES)), np.zeros((2, FEATURES, FEATURES))
    for batch in batches:
        if batch.num_rows:
            x, y = _matrix(batch["x"]), batch["label"].to_numpy()
            for c in (0, 1):
                own = x[y == c]
                counts[c] += len(own)
                sums[c] += own.sum(axis=0)
                squares[c] += own.T @ own
    flat = np.concatenate([counts, sums.ravel(), squares.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["place", "value"])


def vectors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_key and the statistics x."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), as_text(text_col).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(_vectors, "id bigint, text_key bigint, x array<double>")


def fit(points: DataFrame, labels: DataFrame) -> Discriminant:
    """From ``points`` (id, x) and ``labels`` (id, label 0 or 1)."""
    labelled = points.select("id", "x").join(labels.select("id", "label").where("label in (0, 1)").distinct(), "id")
    sums = labelled.select("x", F.col("label").cast("int").alias("label")).mapInArrow(_moments, "place int, value double")
    flat = np.zeros(2 + 2 * FEATURES + 2 * FEATURES**2)
    for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect():
        flat[row.place] = row.value
    a, b = 2, 2 + 2 * FEATURES
    return discriminant(flat[:a], flat[a:b].reshape(2, FEATURES), flat[b:].reshape(2, FEATURES, FEATURES))


def score(points: DataFrame, model: Discriminant) -> DataFrame:
    """``points`` with the column score instead of x."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch["x"])) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text_key"], pa.array(found)], ["id", "text_key", "score"])
    return points.select("id", "text_key", "x").mapInArrow(run, "id bigint, text_key bigint, score double")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, text_key, score; ``labels`` (id, label) are the rows to learn from."""
    points = checkpointed(vectors(df, id_col, text_col))
    return score(points, fit(points, labels))


def keep_good(df: DataFrame, labels: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with a score of ``least`` or more; all columns as they were."""
    good = classify(df, labels, id_col, text_col).where(F.col("score") >= least).select("id", "text_key").distinct()
    names = {c: unused_name(df, f"good_{c}") for c in good.columns}
    good = good.select(*[F.col(c).alias("k_" + n) for c, n in names.items()])
    keyed = df.withColumns({names["id"]: F.col(id_col).cast("bigint"), names["text_key"]: F.xxhash64(as_text(text_col))})
    same = [F.col(n).eqNullSafe(F.col("k_" + n)) for n in names.values()]
    return keyed.join(good, same, "left_semi").drop(*names.values())
