"""SimHash against a brute-force comparison of all fingerprints."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from streamlab.llm import simhash
from streamlab.llm.components import components


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(grams))


def brute_components(prints, max_bits=2):
    """prints: id -> fingerprint; id -> smallest id reachable."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if bin(prints[a] ^ prints[b]).count("1") <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: brute_print(r.text) for r in docs.collect()}
    groups = brute_components(want)
    got = simhash.mark(docs).select("id", F.hex("print").alias("p"), "component_id").collect()
    assert {r.id: int(r.p, 16) for r in got} == want
    assert {r.id: r.component_id for r in got} == groups


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "One  two", 0), (5, "one two", 0), (6, long, 0), (7, long + " end", 0),
            (8, "x", 0), (None, "x", 0), (8, "x", 0), (9, " ", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, print int")
    got = {(r.id, r.text_key): r for r in simhash.mark(df).collect()}
    ids = {}
    for (i, _), r in got.items():
        ids.setdefault(i, r)
        assert int(r.print.hex(), 16) == brute_print(dict((a, b) for a, b, _ in rows)[i])
    assert ids[1].component_id == ids[2].component_id == ids[3].component_id == 1
    assert ids[5].component_id == 4 and ids[None].component_id == 8
    assert simhash.mark(df).count() == len(rows)
    assert simhash.mark(df.limit(0)).count() == 0


def test_overfull_buckets(spark):
    """A dense cloud of fingerprints around one: with buckets of 8 rows everything goes through the second round."""
    rng = np.random.default_rng(5)
    centre, prints = int(rng.integers(0, 2**63)), {}
    for i in range(400):
        p = centre
        for b in rng.choice(64, size=int(rng.integers(0, 6)), replace=False):
            p ^= 1 << int(b)
        prints[i] = p
    prints |= {400 + i: int(rng.integers(0, 2**63)) for i in range(200)}
    want = brute_components(prints)
    df = spark.createDataFrame([(bytes.fromhex(f"{p:016x}"),) for p in set(prints.values())], "print binary")
    for limit in (8, 4096):
        group = components(simhash.links(df, simhash.Settings(bucket_rows=limit)))
        got = {int(r.node.hex(), 16): int(r.root.hex(), 16) for r in group.collect()}
        same = {}
        for i, p in prints.items():
            same.setdefault(got.get(p, p), set()).add(i)
        expected = {}
        for i, r in want.items():
            expected.setdefault(r, set()).add(i)
        assert sorted(map(sorted, same.values())) == sorted(map(sorted, expected.values()))


def test_crowded_buckets_are_split_before_rows_meet(spark):
    rng = np.random.default_rng(6)
    centre, prints = int(rng.integers(0, 2**63)), set()
    for _ in range(3000):
        p = centre
        for b in rng.choice(64, size=4, replace=False):
            p ^= 1 << int(b)
        prints.add(p)
    df = spark.createDataFrame([(bytes.fromhex(f"{p:016x}"),) for p in prints], "print binary")
    sizes = simhash.dealt(df, simhash.Settings(bucket_rows=20)).groupBy("bucket", "key").count()
    first, second = (sizes.where(which).agg(F.max("count")).first()[0] for which in ("bucket < 10", "bucket >= 10"))
    assert first <= 20 and 1 < second <= 2**11


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}}


def test_one_of_each_component_stays(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("kept_id", F.lit(1))
    rows = df.collect()
    root = brute_components({r.doc_id: brute_print(r.text) for r in rows})
    kept = simhash.drop_near_copies(df.unionByName(df.limit(20)))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values())) and len(set(root.values())) < len(rows)
