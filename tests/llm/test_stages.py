"""Exact dedup, mixing, WARC, quality, toxicity and language model on made rows, and the pipeline end to end."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from streamlab.llm import exact_dedup, language_model, mixing, quality, toxicity, warc
from streamlab.llm.common import fresh_folder, task_count
from streamlab.llm.queries import PIECE_MODEL, QUERIES
from tests.llm.test_simhash import brute_components, brute_print

LONG = "word " * 50_000
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "One two", "a"), (5, "One  two ", "b"), (6, "Onetwo", "b"),
       (None, "one", "b"), (7, "one", "b"), (8, LONG, "c"), (8, LONG, "c"), (9, "ünï ▁ 中", None)]


@pytest.fixture()
def odd(spark):
    rows = [(i, t, s, "x", 0, "k") for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, id string, kept_id int, copies string")


def test_exact_dedup(spark, odd):
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"), 3)
    first = exact_dedup.mark(odd, index)
    got = {(r.id, r.chars): r for r in first.rows.collect()}
    assert {k: r.keep_id for k, r in got.items()} == {
        (1, 0): 3, (2, 0): 3, (3, 3): 3, (4, 7): 5, (5, 9): 5, (6, 6): 5, (None, 3): 7, (7, 3): 7, (8, 250_000): 8, (9, 7): 9}
    assert all(r.kept == (r.id == r.keep_id) for r in got.values() if r.id is not None)
    first.commit()
    assert {(r.id, r.chars): r for r in first.rows.collect()} == got
    # a second batch meets the first one's digests, also through a newly opened index
    index.forget()
    index = exact_dedup.DigestIndex(spark, index.path)
    more = spark.createDataFrame([(20, "o n e"), (21, "fresh"), (22, "fresh")], "doc_id bigint, text string")
    second = exact_dedup.mark(more, index)
    assert {r.id: (r.keep_id, r.kept) for r in second.rows.collect()} == {20: (7, False), 21: (21, True), 22: (21, False)}
    second.commit()
    assert exact_dedup.drop_copies(more, exact_dedup.mark(more, index)).count() == 0
    other = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"))
    kept = exact_dedup.drop_copies(odd, exact_dedup.mark(odd, other))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 8, 9]
    assert exact_dedup.mark(odd.limit(0), other).rows.count() == 0


def test_a_lost_answer_changes_nothing(spark):
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"), 2)
    batch = spark.range(200).selectExpr("id AS doc_id", "concat('text ', id % 150) AS text")
    lost = exact_dedup.mark(batch, index)
    again = exact_dedup.mark(batch, index)
    assert again.rows.where("kept").count() == lost.rows.where("kept").count() == 150
    again.commit()
    lost.commit()
    assert index.rows().count() == 150 and exact_dedup.mark(batch, index).rows.where("kept").count() == 0


def test_index_with_another_number_of_buckets(spark):
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"), 2)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, index.path, 5)
    assert exact_dedup.DigestIndex(spark, index.path).buckets == 2


def test_extreme_ids(spark):
    rows = [(-2**63, "a"), (2**63 - 1, "a"), (None, "a"), (2**63 - 1, "b"), (None, "b"), (None, "c"), (0, "d ")]
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"), 2)
    got = exact_dedup.mark(spark.createDataFrame(rows, "doc_id bigint, text string"), index).rows.collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in got) == sorted([
        (str(-2**63), str(-2**63), 3, True), (str(2**63 - 1), str(-2**63), 3, False), ("None", str(-2**63), 3, False),
        (str(2**63 - 1), str(2**63 - 1), 2, True), ("None", str(2**63 - 1), 2, False), ("None", "None", 1, True), ("0", "0", 1, True)])


def filled(sizes):
    """Targets by repeated sharing; (source, size) in order."""
    weight = {s: 1 + n % 3 for n, s in enumerate(sizes)}
    target, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return target


def test_mixing(spark, odd):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 80, 400])), rng.choice(["a"] * 9 + ["b", "c", "d", None])) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan(df).collect()
    again = {r.id: r.copies for r in mixing.plan(df.repartition(7)).collect()}
    assert {r.id: r.copies for r in got} == again and len(got) == len(rows)
    sizes, taken, target, docs, copies = Counter(), Counter(), {}, Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        docs[r.source] += 1
        copies[r.source] += r.copies
        assert 0 <= r.copies <= 3
    want = filled({s: sizes[s] for s in ["a", "b", "c", "d", None]})
    for s, t in want.items():
        assert math.isclose(t, target[s], rel_tol=1e-9)
        assert abs(taken[s] - t) <= 800
        assert abs(copies[s] - docs[s] * t / sizes[s]) <= 3
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    planned = sum(r.copies for r in mixing.plan(odd).collect())
    assert mixed.count() == planned
    assert mixing.plan(odd.limit(0)).count() == 0


def test_inclusion_probabilities():
    """The flight keeps every unit's chance, the size and the number."""
    sizes, probs = [1.0, 5.0, 2.0, 9.0, 3.0, 4.0, 7.0], [0.2, 0.5, 0.7, 0.1, 0.5, 0.6, 0.4]
    hits = np.zeros(len(sizes))
    for seed in range(4000):
        p = list(probs)
        mixing.flight(sizes, p, random.Random(seed))
        assert abs(sum(p) - sum(probs)) < 1e-6 and abs(np.dot(p, sizes) - np.dot(probs, sizes)) < 1e-6
        assert sum(0 < x < 1 for x in p) <= 2
        hits += p
    assert np.abs(hits / 4000 - probs).max() < 0.03


def test_warc(spark):
    big = "x" * 1500
    rows = [(1, "http://a/ b\r\n%41", big), (2, None, big), (3, "http://é", None), (4, "u", "small"), (5, "u", "small"), (6, "u", big + "é"), (7, "u", big),
            (None, "u", big), (8, "v", "y" * 3_000_000), (8, "v", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, payload string")
    index = warc.write_archive(df, fresh_folder(spark, "warc"))
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, url, html in rows:
        r, data = by_id[i], (html or "").encode()
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(data), hashlib.sha1(data).hexdigest())
        assert r.record_type == "revisit" or bytes(r.payload) == data
    assert {i: r.refers_to for i, r in by_id.items() if r.record_type == "revisit"} == {1: 7, 2: 7, None: 7}
    assert warc.read_records(index).rdd.getNumPartitions() >= task_count(spark)
    some = warc.read_records(index.where("page_id in (3, 6)")).collect()
    assert sorted(r.page_id for r in some) == [3, 6]
    assert warc.read_records(warc.write_archive(df.limit(0), fresh_folder(spark, "warc"))).count() == 0


def test_ranges():
    assert warc.coalesce_ranges([(0, 10), (10, 5), (15 + warc.GAP_BYTES, 5), (10**9, 3)]) == [
        (0, 3, 0, 20 + warc.GAP_BYTES), (3, 4, 10**9, 10**9 + 3)]


def held_out(found, labels, fold, remainder):
    pairs = [(found[i], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % fold == remainder]
    return np.array([s for s, _ in pairs]), np.array([y for _, y in pairs])


def test_quality(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").selectExpr("doc_id AS id", "quality AS label")
    found = {r.id: r.score for r in quality.classify(docs, labels.where("crc32(cast(id AS string)) % 5 <> 0")).collect()}
    score, y = held_out(found, {r.id: r.label for r in labels.collect()}, 5, 0)
    assert ((score >= 0.3) == y).mean() > 0.97
    scored = quality.classify(odd, labels).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    none = quality.classify(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(odd.limit(0), labels).count() == 0
    assert quality.keep_good(odd, labels.limit(0), 0.3).count() == len(ODD)


def test_quality_scores_by_hand(spark):
    """Every score of the registered query against the discriminant written out with covariances, inverses and determinants."""
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r.score for r in QUERIES["op1_quality"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    x = {r.doc_id: np.array(quality.statistics(r.text or "")) for r in docs}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    learned = [(x[i], y) for i, y in labels.items() if i in x and y in (0, 1) and zlib.crc32(str(i).encode()) % 5 != 0]
    rows = [np.stack([v for v, y in learned if y == c]) for c in (0, 1)]
    within = [np.cov(r.T, bias=True) for r in rows]
    pooled = sum(len(r) * w for r, w in zip(rows, within, strict=True)) / len(learned)
    pooled = 0.95 * pooled + 0.05 * np.diag(np.diag(pooled)) + 1e-4 * np.eye(quality.FEATURES)
    logs = {i: [] for i in x}
    for r, w in zip(rows, within, strict=True):
        lean = max(0.02, quality.FEATURES / (quality.FEATURES + len(r)))
        shape = (1 - lean) * w + lean * pooled
        inverse, log_det = np.linalg.inv(shape), np.linalg.slogdet(shape)[1]
        for i, v in x.items():
            away = v - r.mean(axis=0)
            logs[i].append(0.5 * -0.5 * (away @ inverse @ away + log_det) + np.log(len(r) / len(learned)))
    assert got.keys() == x.keys()
    for i, (bad, good) in logs.items():
        assert abs(got[i] - 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))) < 1e-6


def test_toxicity(spark, odd):
    rng = random.Random(5)
    words = ["".join(rng.choices("aeiourstlnmdp", k=rng.randint(3, 9))) for _ in range(3000)]
    insults = ["stupid", "worthless", "disgusting", "pathetic"]
    rows = []
    for i in range(1200):
        text = rng.choices(words, k=40)
        if i % 4 == 0:
            for _ in range(3):
                text[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, " ".join(text) + ".", int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    machine = toxicity.fit(df, df.selectExpr("doc_id AS id", "label").where("doc_id % 3 <> 1"))
    found = {r.id: r.score for r in toxicity.score(df, machine).collect()}
    held = [(found[i] >= 0.7) == bool(y) for i, _, y in rows if i % 3 == 1]
    assert np.mean(held) > 0.97
    odd_words = ["you stuxpid thing", "you s.t.u.p.i.d thing", "s t u p i d", "you wortthless thing", "you patheetic thing"]
    values = toxicity.Scorer(machine).values([*odd_words, "you rapid thing", "you united mindless", "words in a row"])
    assert values[:5].min() > values[5:].max()
    scored = toxicity.score(odd, machine).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.fit(df, df.selectExpr("doc_id AS id", "label").limit(0)).slope == 0
    assert toxicity.score(odd.limit(0), machine).count() == 0


def test_toxicity_of_one_insult():
    """Toxic texts hold three insults, some clean ones a word like an insult; one insult is still enough, and the word is not."""
    rng = random.Random(6)
    words = ["".join(rng.choices("aeiourstlnmdp", k=rng.randint(3, 9))) for _ in range(2000)]
    insults = ["stupid", "worthless", "disgusting", "pathetic"]
    labels, texts = [], []
    for i in range(900):
        text = rng.choices(words, k=30)
        if i % 3 == 0:
            text[:3] = rng.choices(insults, k=3)
        elif i % 3 == 1 and i % 2:
            text[0] = rng.choice(["stupids", "worthles", "disgustings", "pathetics"])
        labels.append(int(i % 3 == 0))
        texts.append(" ".join(text))
    machine = toxicity.Trainer(labels, texts, 0.1).train()
    one = [" ".join([w, *rng.choices(words, k=30)]) for w in insults]
    like = [" ".join([w, *rng.choices(words, k=30)]) for w in ("stupids", "worthles", "disgustings", "pathetics")]
    value = toxicity.Scorer(machine).values
    assert machine.chance(value(one)).min() >= 0.7
    assert machine.chance(value(like)).max() < 0.7


def test_toxicity_of_the_table(spark):
    """Held-out precision and recall; in some languages clean texts hold one of the words that toxic ones hold several of."""
    rows = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").select("doc_id", "predicted").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    y, found = np.array([toxic[r.doc_id] for r in rows if r.doc_id in toxic]), np.array([r.predicted for r in rows if r.doc_id in toxic])
    hits = (y * found).sum()
    assert hits / found.sum() > 0.9 and hits / y.sum() > 0.85


def test_sureness_rises_with_fewer_clean_hits():
    """Against the likelihood ratio of the four counts written out."""
    labels, texts = [1] * 40 + [0] * 400, []
    for i in range(440):
        own = [w for w, toxic, clean in (("aaaa", 14, 0), ("bbbb", 14, 2), ("cccc", 2, 300)) if (i < toxic if i < 40 else i - 40 < clean)]
        texts.append(" ".join(own))
    trainer = toxicity.Trainer(labels, texts, 0.1)
    z = dict(zip(trainer.words, trainer.sureness(), strict=True))
    for w, toxic, clean in (("^aaaa", 14, 0), ("^bbbb", 14, 2), ("^cccc", 2, 300)):
        all_ = (toxic + clean) / 440
        cells = [(toxic, 40 * all_), (clean, 400 * all_), (40 - toxic, 40 * (1 - all_)), (400 - clean, 400 * (1 - all_))]
        want = (2 * sum(k * np.log(k / e) for k, e in cells if k)) ** 0.5
        assert abs(z[w] - (want if toxic / 40 > clean / 400 else -want)) < 1e-9
    assert z["^aaaa"] > z["^bbbb"] > toxicity.SURE > 0 > z["^cccc"]


def test_kernel_folds_into_weights():
    """The value of a word is the sum of its explicit features' weights."""
    rng = np.random.default_rng(1)
    table = np.append(rng.normal(size=toxicity.BUCKETS), 0).astype(np.float32)
    words = ["^stupid", "^stupidity", "^abc", "^aaaaaaaa", "^" + "longestwordthere" * 1]
    want = [sum(v * float(table[h]) for h, v in f.items()) for f in toxicity.sparse_features(words)]
    assert np.allclose(toxicity.weigh(words, table), want, atol=1e-5)


def test_language_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = language_model.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1)
    counts, texts = Counter(), {r.doc_id: r.text.encode().lower().split() + [b" "] for r in docs.collect()}
    for i, words in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    gain = []
    for r in scored.collect():
        words = texts[r.id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
        if zlib.crc32(str(r.id).encode()) % 5 == 1:
            gain.append(r.score - r.base_score)
    assert np.mean(gain) > 0


def test_language_model_odd(spark, odd):
    got = language_model.score(odd, F.col("doc_id") > 3).collect()
    assert len(got) == len(ODD) and {r.train_tokens for r in got} == {2 * 50_001 + 3 + 3 + 2 + 2 + 4}
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert {r.base_score for r in language_model.score(odd, F.lit(False)).collect()} == {0.0}
    assert language_model.score(odd.limit(0), F.lit(True)).count() == 0


def test_short_floats():
    rng = np.random.default_rng(3)
    values = np.concatenate([np.arange(-256, 257), rng.normal(size=1000) * 10.0 ** rng.integers(-9, 9, 1000)]).astype(np.float32)
    got = language_model.long_floats(language_model.short_floats(values))
    assert (got[:513] == values[:513]).all() and np.allclose(got, values, rtol=2**-8, atol=0)


def test_class_chances_sum_to_one():
    rng = np.random.default_rng(2)
    model = language_model.Model(rng.normal(size=language_model.CLASSES), rng.normal(size=(language_model.FEATURES, language_model.BUCKETS, language_model.CLASSES)))
    chances = np.exp(model.log_chances(rng.integers(0, language_model.BUCKETS, size=(language_model.FEATURES, 50))))
    assert np.allclose(chances.sum(axis=1), 1)


def test_word_factor_sees_the_history(spark):
    """Two words of one class, equally frequent, each behind a word of its own: only a word factor with features tells them apart."""
    assert language_model.word_class(b"ark") == language_model.word_class(b"park")
    texts = ["red ark", "blue park"] * 300 + ["red ark", "red park", "blue ark", "blue park"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.id: r for r in language_model.score(docs, F.col("doc_id") < 600).where("id >= 600").collect()}
    assert math.isclose(got[600].base_score, got[601].base_score) and math.isclose(got[602].base_score, got[603].base_score)
    assert got[600].score > got[601].score + 0.2 and got[603].score > got[602].score + 0.2


def test_word_chances_sum_to_one():
    """Over all leaves of a class, and over the words of each leaf with the one unknown word."""
    rng = np.random.default_rng(4)
    mass = rng.integers(1, 9, size=(language_model.CLASSES, 1 << language_model.DEPTH)).astype(float)
    tree = language_model.Tree(language_model.node_odds(mass), np.zeros((language_model.FEATURES, language_model.SLOTS), dtype=np.float32))
    hashes = np.arange(1 << language_model.DEPTH, dtype=np.uint32)
    nodes, sides = language_model.Block([], None, None, None, np.full(len(hashes), 5), hashes).choices()
    history = np.repeat(rng.integers(0, 1 << 32, size=(language_model.FEATURES, 1), dtype=np.uint32), len(hashes), axis=1)
    assert np.allclose(np.exp(tree.log_chances(history, nodes, sides)), mass[5] / mass[5].sum(), rtol=1e-4)
    tree.weights = rng.normal(size=tree.weights.shape).astype(np.float32)
    chances = np.exp(tree.log_chances(history, nodes, sides))
    assert np.isclose(chances.sum(), 1, rtol=1e-4) and not np.allclose(chances, mass[5] / mass[5].sum(), rtol=0.1)


def test_classes_of_a_block():
    words = [b"a", b" ", b"ab", b"abc", b"a ", b"\xc3\xa9", b"xing"]
    data, lengths = np.frombuffer(b"".join(words), dtype=np.uint8), np.array([len(w) for w in words])
    assert language_model.word_classes(np.cumsum(lengths), data, lengths).tolist() == [language_model.word_class(w) for w in words]


def test_pipeline(spark):
    """Each stage, on what its predecessor kept, against a plain version of it."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.collect(), spark.read.parquet(_written(spark, stage(spark, docs, folder)))
        after = docs.collect()
        if name == "quality":
            known = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id AS id", "quality AS label")
            scores = {r.id: r.score for r in quality.classify(spark.createDataFrame(before), known).collect()}
            assert sorted(r.doc_id for r in after) == sorted(i for i, s in scores.items() if s >= 0.3)
            kept = {r.doc_id for r in after}
            assert np.mean([(i in kept) == bool(y) for i, y in labels.items()]) > 0.95
        elif name == "exact_dedup":
            best = {}
            for r in before:
                text = "".join(re.split("[\x20\x09-\x0D]", r.text))
                own = (-len(r.text), r.doc_id, r)
                best[text] = min(best.get(text, own), own, key=lambda x: x[:2])
            assert sorted(after) == sorted(x[2] for x in best.values()) and len(after) < len(before)
        elif name == "near_dedup":
            root = brute_components({r.doc_id: brute_print(r.text) for r in before})
            assert sorted(after) == sorted(r for r in before if root[r.doc_id] == r.doc_id)
        elif name == "mixing":
            copies = Counter(after)
            assert set(copies) <= set(before) and max(copies.values()) <= 3
            size, taken = Counter(), Counter()
            for r in before:
                size[r.source] += len(r.text.split())
            for r, n in copies.items():
                taken[r.source] += n * len(r.text.split())
            target, free, left = {}, {s: k % 3 + 1 for k, s in enumerate(sorted(size))}, sum(size.values())
            while free:
                share = {s: left * w / sum(free.values()) for s, w in free.items()}
                over = [s for s in free if share[s] > 3 * size[s]]
                target |= {s: 3 * size[s] for s in over} or share
                left -= sum(3 * size[s] for s in over)
                free = {s: w for s, w in free.items() if s not in over} if over else {}
            longest = max(len(r.text.split()) for r in before)
            assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], longest) for s in size)
        else:
            texts = {r.doc_id: r.text for r in before}
            assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
            assert all(r.ids == library.encode(texts[r.doc_id]) and r.round_trip and r.n_tokens == len(r.ids) for r in after)


def test_pipeline_without_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.read.parquet(_written(spark, stage(spark, docs, "/root/testdata/sf0.001")))
        assert docs.count() == 0


def test_pipeline_odd(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.read.parquet(_written(spark, stage(spark, docs, "/root/testdata/sf0.01")))
        if name != "sentence_pieces":
            assert docs.columns == odd.columns
    assert docs.columns == ["doc_id", "n_tokens", "ids", "round_trip"]


def _written(spark, df):
    folder = fresh_folder(spark, "stage")
    df.write.parquet(folder)
    return folder
