"""Approximate neighbours against brute force."""

import numpy as np
import pyarrow as pa

from streamlab.llm import ann
from streamlab.llm.queries import QUERIES


def brute(ids, x, queries, k):
    found = {}
    for q in queries:
        score = np.einsum("ij,j->i", x, x[list(ids).index(q)])
        order = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:k]
        found[q] = [(i, -s) for s, i in order]
    return found


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(len(v) for v in want.values())


def collected(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def test_recall_on_the_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = ann.valid_vectors(rows, "vec_id", "embedding")
    got = collected(ann.search(vectors, vectors.where("id % 20 = 0"), ann.Settings(least_block=300)))
    data = {r.id: np.array(r.v) for r in vectors.collect()}
    ids = sorted(data)
    x = np.stack([data[i] for i in ids])
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        assert all(abs(s - float(data[q] @ data[i])) < 1e-12 for i, s in found)


def test_lengths_differ(spark):
    """Inner product, not angle: long vectors come first."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 12)) * rng.lognormal(sigma=0.7, size=(3000, 1))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<double>")
    vectors = ann.valid_vectors(df, "vec_id", "embedding")
    got = collected(ann.search(vectors, vectors.where("id % 100 = 0")))
    assert recall(got, brute(range(3000), x, range(0, 3000, 100), 20)) >= 0.9


def test_within_finds_every_code():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, size=(500, 16), dtype=np.uint8)
    codes[250:] = codes[:250] ^ np.packbits(rng.random((250, 128)) < 0.1, axis=1)
    index = ann.CodeIndex(codes)
    for radius in (0, 5, 16, 40, 64, 128):
        for code in codes[:20]:
            want = np.flatnonzero(np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64) <= radius)
            assert index.within(code, radius).tolist() == want.tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [1.0]), (None, [1.0, 1.0]),
            (20, [1.0, 0.0]), (21, [1.0, 0.0]), (22, [1.0, 0.0]), (40, [0.5, 0.5]), (40, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, id int")
    vectors = ann.valid_vectors(df, "vec_id", "embedding")
    got = collected(ann.search(vectors, vectors.where("id % 20 = 0")))
    assert got == {20: [(21, 1.0), (22, 1.0), (40, 0.5)], 40: [(20, 0.5), (21, 0.5), (22, 0.5)]}
    empty = ann.valid_vectors(df.limit(0), "vec_id", "embedding")
    assert ann.search(empty, empty).count() == 0


def test_recall_of_the_registered_query(spark):
    folder = "/root/testdata/sf0.1"
    vectors = ann.valid_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id", "embedding")
    data = {r.id: np.array(r.v) for r in vectors.collect()}
    ids = sorted(data)
    want = brute(ids, np.stack([data[i] for i in ids]), [i for i in ids if i % 20 == 0], 20)
    assert recall(collected(QUERIES["op5_ann"](spark, folder)), want) >= 0.95


def test_recall_on_several_blocks(spark):
    settings = ann.Settings()
    assert [settings.block_count(n) for n in (1, 8192, 8193, 524_288, 4_194_304, 4_194_305)] == [1, 1, 2, 64, 64, 65]
    rng = np.random.default_rng(8)
    x = rng.normal(size=(34_000, 32))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": x.tolist()}))
    vectors = ann.valid_vectors(df, "vec_id", "embedding")
    assert settings.block_count(len(x)) == 5
    got = collected(ann.search(vectors, vectors.where("id % 400 = 0")))
    assert recall(got, brute(range(len(x)), x, range(0, len(x), 400), 20)) >= 0.95
