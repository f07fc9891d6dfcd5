"""Hits of benchmark windows against a comparison of every window with every place."""

import random
import re

import pytest

from streamlab.llm import decontaminate

TAKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TAKEN.findall(lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for k in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, names = plain_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k:k + size]))
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        out.append((i, len(w), len(hit), tuple(sorted(names)), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, "z", 1) for x in docs], "doc_id bigint, text string, key string, Words int")
    b = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, gram string")
    got = decontaminate.mark(d, b).collect()
    return sorted(((r.id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got), key=repr)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "été", "ÉTÉ", "x9", "Straße", "日本", "w"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([12, 15, 30]))) for i in range(12)]
    items += [(3, "under the same id " * 3), (40, None), (41, " .,; "), (None, "an item that has no name but ten words in it"), (50, items[0][1])]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").split(" ")
            at = rng.randrange(len(w))
            parts += [" ".join(w[at:at + rng.randrange(8, 20)]).upper() if rng.random() < 0.3 else " ".join(w[at:]), text(rng.randrange(6))]
        docs.append((i, rng.choice(["--", " ", "\n"]).join(parts)))
    docs += [docs[5], (5, docs[6][1]), (None, docs[7][1]), (None, None), (70, ""), (71, "."), (72, "a " * 40), (-2**63, items[1][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_every_window(spark, seed):
    docs, items = made(seed)
    got = run(spark, docs, items)
    assert got == brute(docs, items) and any(r[4] for r in got)


def test_items_shorter_than_a_window(spark):
    docs, items = made(3)
    items += [(60, "b"), (61, "w été x9"), (62, "a " * 9), (63, "c b a c b")]
    assert run(spark, docs, items) == brute(docs, items)


def test_shuffled_join(spark, monkeypatch):
    docs, items = made(4)
    monkeypatch.setattr(decontaminate, "SENT_ROWS", -1)
    monkeypatch.setattr(decontaminate, "SENT_RUNS", -1)
    assert run(spark, docs, items) == brute(docs, items)


def test_one_word_over_and_over(spark):
    docs = [(1, "go " * 5000), (2, "go " * 9), (3, "stop " + "go " * 10)]
    items = [(1, "go " * 300)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = made(5)
    assert run(spark, [], items) == []
    assert all(not r[4] and r[3] == () for r in run(spark, docs[:5], []))
