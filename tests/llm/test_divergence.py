"""Divergences against sums over every term, in Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from streamlab.llm import divergence

TAKEN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows):
    docs = [(lang or "", source or "", Counter(
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TAKEN.findall(text or "")))
        for lang, source, text in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(terms.keys())
        count[lang, source].update(terms)
    out = []
    for lang in seen.keys() | {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= 3)
        groups = sorted(s for a, s in count if a == lang)
        v = len(kept)

        def chances(counter, kept=kept, v=v):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // (n + v) for t in kept}

        p = {s: chances(count[lang, s]) for s in groups}
        q = chances(sum((count[lang, s] for s in groups), Counter()))
        for s in groups:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, divergence.TERMS)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], "doc_id int, lang string, source string, text string, term string, Idx int")
    return sorted(tuple(r) for r in divergence.divergence(df).collect())


def made(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdé日𝒳", k=rng.randint(1, 3))) for _ in range(300)]
    rows = []
    for _ in range(n):
        words = [vocabulary[int(len(vocabulary) * rng.random() ** 3)] for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "en", "de", None]), rng.choice(["s0"] * 5 + ["s1", "s2", "ß", "S", None]), rng.choice([" ", "1", "\n. "]).join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    rows += rows[:20] + [rows[3]] * 30
    rows += [("en", "empty", ""), ("en", "null", None), ("no", "a", "one two"), ("no", "b", "one two"), ("alone", "a", "x x x"), ("alone", "a", "x"), ("alone", "a", "X")]
    rows.append(("en", "long", "abc " * 30_000 + "z" * 100_000))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_pair_and_term(spark, seed):
    rows = made(seed)
    assert run(spark, rows) == brute(rows)


def test_small_slices(monkeypatch):
    """A walk over many small batches, written out often, gives the sums of one over a single slice."""
    rng = np.random.default_rng(4)
    rows = [(lang, f"t{t:03d}", g) for lang in ("de", "en") for t in range(80) for g in sorted(rng.choice(6, rng.integers(1, 6), replace=False).tolist())]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    columns += [pa.array([6] * len(rows), pa.int32()), pa.array(rng.integers(1, 10**9, len(rows))), pa.array(np.array([r[2] for r in rows]) * 11 + 5)]
    whole = pa.RecordBatch.from_arrays(columns, ["lang", "term", "idx", "peers", "p", "p0"])

    def sums(size, held, cells):
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "CELLS", cells)
        total = Counter()
        for batch in divergence._walk(iter([whole.slice(a, size) for a in range(0, whole.num_rows, size)])):
            for r in batch.to_pylist():
                total[r["lang"], r["g"], r["s"]] += r["value"]
        return total

    want = sums(10**6, 10**6, 10**6)
    assert len(want) == 72 and sums(7, 30, 10) == want and sums(1, 1, 1) == want


def test_slices_of_a_walk(monkeypatch):
    """Sums do not depend on how the index is cut."""
    rng = np.random.default_rng(0)
    terms = [np.sort(rng.choice(9, rng.integers(1, 9), replace=False)) for _ in range(50)]
    idx, starts = np.concatenate(terms), np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    p, p0 = rng.integers(100, 10**9, len(idx)), np.arange(1, 10)[idx] * 37
    want = np.zeros((9, 9), dtype=object)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        for i in range(a, b):
            for j in range(a, b):
                x, y, x0, y0 = (int(v) for v in (p[i], p[j], p0[i], p0[j]))
                want[idx[i], idx[j]] += sum(s * ((c - d) ** 2 // d) for s, c, d in ((1, x, y), (-1, x, y0), (-1, x0, y), (1, x0, y0)))
    for held in (1, 7, 1000):
        monkeypatch.setattr(divergence, "HELD", held)
        sums = {}
        divergence.corrections(idx, p, p0, starts, sums, 9)
        assert all((sums[g] == want[g].astype(np.int64)).all() for g in range(9))


def test_empty_table(spark):
    assert run(spark, []) == []
