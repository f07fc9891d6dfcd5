"""Nearest neighbours by inner product with multi-index hashing over learned binary codes.

Codes: vectors are scaled by the largest norm and given one more component that makes them unit length, so that the inner
product with a query orders them as the angle does. Signs of rotated components are the bits; each rotation is learned by
iterative quantisation on a bounded sample (``sample`` vectors by hash of their id). Index: every vector is coded; vectors are
dealt into blocks by hash of the id, and each block holds, for each byte of the code and each of its values, the vectors with it.
Search: a code within radius r of the query's agrees with it up to r // bytes bits in at least one byte, so probing the keys
that near in every byte retrieves all codes within r; they are verified by their whole Hamming distance and reranked by the
inner product of the original vectors in double precision. r is the distance within which ``cover`` of the true neighbours
of sample queries lie; it widens in a block until ``k`` candidates or the whole block are found.

The queries meet all blocks of the index, chunk by chunk; each meeting returns at most k rows per query, which one grouping
by query merges. Every vector is sent once per ``chunk`` queries and every query once per block, so what is shuffled is the number
of vectors times that of queries, divided by the sizes of chunks and blocks: a scan in blocks.

Defined cases: vectors that are null, all zero, hold null or non-finite components, or do not have the most frequent number of
components (ties: the smaller) take no part. Of rows with one id the smallest vector in array order counts. A null id takes
no part. Equal scores go to the smaller id. Fewer candidates than k give all of them; no queries or no vectors an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import checkpointed

RESULT = "query_id bigint, vec_id bigint, score double"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors the rotations and the radius are learned from; ``rotations`` times 64 bits make a code."""

    k: int = 20
    sample: int = 4096
    rotations: int = 2
    cover: float = 0.98
    block: int = 65536
    least_block: int = 8192
    blocks: int = 64
    chunk: int = 16384

    def block_count(self, n: int) -> int:
        """Blocks for ``n`` vectors: ``blocks`` while these hold ``least_block`` to ``block`` vectors each. No session
        setting counts here, as the approximate answer depends on it."""
        return max(math.ceil(n / self.block), min(self.blocks, math.ceil(n / self.least_block)))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    rows = checkpointed(rows.groupBy("id").agg(F.min("v").alias("v")))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """A (dimensions, 64) projection: principal directions (random ones fill up), turned so that signs lose least."""
    d = x.shape[1]
    values, directions = np.linalg.eigh(x.T @ x / max(len(x), 1))
    basis = directions[:, ::-1][:, :64]
    while basis.shape[1] < 64:
        basis = np.hstack([basis, np.linalg.qr(rng.normal(size=(d, d)))[0]])[:, :64]
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    v = x @ basis
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.sign(v @ turn).T @ v)
        turn = (u @ w).T
    return basis @ turn


@dataclass(frozen=True)
class Coder:
    largest: float
    projection: np.ndarray
    radius: int = 0

    def items(self, x: np.ndarray) -> np.ndarray:
        x = x / self.largest
        rest = np.sqrt(np.clip(1 - (x * x).sum(axis=1, keepdims=True), 0, None))
        return self._bits(np.hstack([x, rest]))

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        return self._bits(np.hstack([x, np.zeros((len(x), 1))]))

    def _bits(self, x: np.ndarray) -> np.ndarray:
        """Rows of code bytes."""
        return np.packbits(x @ self.projection > 0, axis=1)


def learn(sample: np.ndarray, largest: float, settings: Settings) -> Coder:
    rng = np.random.default_rng(11)
    x = sample / largest
    full = np.hstack([x, np.sqrt(np.clip(1 - (x * x).sum(axis=1, keepdims=True), 0, None))])
    projection = np.hstack([learn_rotation(full, rng) for _ in range(settings.rotations)])
    coder = Coder(largest, projection)
    codes = coder.items(sample)
    probes = sample[:256]
    near = probes @ sample.T
    near[np.arange(len(probes)), np.arange(len(probes))] = -np.inf
    k = min(settings.k, max(len(sample) - 1, 1))
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    gaps = np.bitwise_count(codes[top] ^ coder.queries(probes)[:, None, :]).sum(axis=2, dtype=np.int64)
    return Coder(largest, projection, int(np.quantile(gaps, settings.cover)))


_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class CodeIndex:
    """The codes of one block, with a table per byte: for each of its 256 values the vectors that have it, as a bitmap."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.wide = codes.view(np.uint64)
        values = np.arange(256, dtype=np.uint8)[:, None]
        self.tables = [np.packbits(codes[:, b] == values, axis=1) for b in range(codes.shape[1])]
        self._probed: dict[tuple[int, int, int], np.ndarray] = {}

    def _probe(self, b: int, value: int, share: int) -> np.ndarray:
        """The vectors whose byte ``b`` is within ``share`` bits of ``value``."""
        key = (b, value, share)
        if key not in self._probed:
            self._probed[key] = np.bitwise_or.reduce(self.tables[b][_NEAR[value] <= share], axis=0)
        return self._probed[key]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within ``radius``."""
        share = radius // len(code)
        met = np.zeros_like(self.tables[0][0])
        for b, value in enumerate(code.tolist()):
            met |= self._probe(b, value, share)
        found = np.flatnonzero(np.unpackbits(met, count=len(self.codes)))
        gaps = np.bitwise_count(self.wide[found] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)
        return found[gaps <= radius]


def search_block(coder: Coder, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of up to k nearest of the block for each query."""
    index, codes = CodeIndex(coder.items(x)), coder.queries(q)
    bits = 8 * codes.shape[1]
    found_q, found_id, found_score = [], [], []
    for query, vector, code in zip(query_ids, q, codes, strict=True):
        radius = coder.radius
        while True:
            near = index.within(code, radius)
            near = near[ids[near] != query]
            if len(near) >= k or radius >= bits:
                break
            radius = min(bits, radius + max(4, bits // 16))
        rows = x[near]
        score = rows @ vector
        if len(near) > k:
            # the exact sums decide; the fast ones may differ in the last places
            least = np.partition(score, -k)[-k]
            close = score >= least - 1e-9 * (abs(least) + 1)
            near, rows = near[close], rows[close]
        score = np.einsum("ij,j->i", rows, vector)
        best = np.lexsort((ids[near], -score))[:k]
        found_q.append(np.full(len(best), query))
        found_id.append(ids[near][best])
        found_score.append(score[best])
    if not found_q:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return np.concatenate(found_q), np.concatenate(found_id), np.concatenate(found_score)


def _matrix(table: pa.Table) -> np.ndarray:
    column = table["v"].combine_chunks()
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _meeting(coder: Coder, k: int):
    def meet(items: pa.Table, queries: pa.Table) -> pa.Table:
        if not items.num_rows or not queries.num_rows:
            parts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        else:
            parts = search_block(coder, items["id"].to_numpy(), _matrix(items), queries["id"].to_numpy(), _matrix(queries), k)
        return pa.table({"query_id": parts[0], "vec_id": parts[1], "score": parts[2]})
    return meet


def search(vectors: DataFrame, queries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``k`` of ``vectors`` (id, v) to each of ``queries`` (id, v), an equal id left out."""
    spark = vectors.sparkSession
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, largest = vectors.agg(F.count("*"), F.max(norm)).first()
    n_queries = queries.count()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(settings.sample).toPandas()["v"]
    coder = learn(np.stack([np.asarray(v, dtype=float) for v in sample]), largest, settings)
    blocks = settings.block_count(n)
    chunks = math.ceil(n_queries / settings.chunk)
    deal = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    items = vectors.select("id", "v", deal(blocks).alias("block"), every(chunks).alias("chunk"))
    asked = queries.select("id", "v", every(blocks).alias("block"), deal(chunks).alias("chunk"))
    found = items.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(_meeting(coder, settings.k), RESULT)
    # ranks by a sorted list of at most k rows a block
    best = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("best"))
    best = best.select("query_id", F.posexplode(F.slice("best", 1, settings.k)).alias("place", "hit"))
    return best.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
