"""Repeated passages against a dictionary of all strings."""

import hashlib
import random

import pytest

from streamlab.llm import passages


def brute(rows):
    """(doc_id, text) rows with distinct ids -> id: (n_bytes, n_removed, n_spans, sha)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p:p + 100]
            if s in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def collected(df):
    return {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def sample():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdeé ", k=n))
    shared = [text(n) for n in (90, 99, 100, 101, 140, 400)]
    rows = [(1, None), (2, ""), (3, "x"), (None, shared[5]), (5, "a" * 700), (6, "ab" * 300), (7, "a" * 99), (8, "a" * 100)]
    for i in range(20, 60):
        parts = [text(rng.randint(0, 150))]
        for _ in range(rng.randint(1, 4)):
            parts += [rng.choice(shared), text(rng.randint(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(70, rows[10][1]), (71, rows[10][1]), (72, "aaa"), (73, "aaa")]
    return rows


@pytest.mark.parametrize(("crowd", "busy"), [(5000, 64), (5, 64), (5000, 3), (5, 1)])
def test_made_texts(spark, monkeypatch, crowd, busy):
    monkeypatch.setattr(passages, "CROWD", crowd)
    monkeypatch.setattr(passages, "LEAST_BUSY", busy)
    rows = sample()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, id int")
    assert collected(passages.remove_repeats(df)) == brute(rows)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert collected(passages.remove_repeats(df)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_tables(spark):
    line = "".join(random.Random(1).choices("abcdefgh", k=150))
    df = spark.createDataFrame([(1, line), (1, line), (2, line), (2, "x" + line)], "doc_id bigint, text string")
    got = sorted(tuple(r) for r in passages.remove_repeats(df).select("id", "n_removed", "n_spans").collect())
    assert got == [(1, 0, 0), (1, 0, 0), (2, 150, 1), (2, 150, 1)]
    assert passages.remove_repeats(df.limit(0)).count() == 0
