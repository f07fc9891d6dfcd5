"""Links and counts of two tokenizers against a plain walk over every text."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from streamlab.llm import alignment
from streamlab.llm.queries import BYTE_MODEL, PIECE_MODEL


@pytest.fixture(scope="module")
def files():
    return alignment.read_tokenizers(BYTE_MODEL, PATTERN, PIECE_MODEL)


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_MODEL)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        letter = alignment.byte_of_letter()
        self.a_bytes = {i: bytes(letter[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}

    def b_byte(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spaced = b" " + text.encode()
        if b"".join(self.a_bytes[i] for i in a) != spaced or b"".join(map(self.b_byte, b)) != spaced:
            return []
        out, at_a, at_b, own = [], 0, 0, ([], [])
        while a or b or own[0]:
            if at_a == at_b and own[0]:
                out.append(own)
                own = ([], [])
            elif at_a <= at_b:
                own[0].append(a[0])
                at_a += len(self.a_bytes[a.pop(0)])
            else:
                own[1].append(b[0])
                at_b += len(self.b_byte(b.pop(0)))
        return out


def brute(rows):
    plain = Plain()
    found = [(i, plain.groups(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in found]
    count = Counter(p for own in links for p in own)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (i, groups), own in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def run(spark, rows, files):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, A int, block string")
    return sorted((tuple(r) for r in alignment.align(df.repartition(3), files).collect()), key=repr)


ROWS = [
    (1, "The quick brown fox."), (2, "the the the  the\n\nthe"), (3, None), (4, ""), (5, " "), (6, "naïve café 日本語 🙂🙃 \U000103ff"),
    (7, "<|endoftext|> and <s> </s> <unk> <0x41>"), (8, "marks ▁ inside"), (9, "tabs\tand\r\nends "), (10, "nul \x00 here"),
    (1, "The quick brown fox."), (1, "Another text under the same id"), (None, "no id"), (-2**63, "least id"), (11, "x" * 30_000),
    (12, "1234567890" * 50), (13, "the quick " * 3000), (14, "́̀ combined é"), (15, "  lead"), (16, "don't we'LL I'm 's"),
    (17, " nbsp em​zero\x85nel"), (18, "ǅ ǅ½ ² ٣ Ⅷ"), (19, "!?" * 2000),
]


def test_given_rows(spark, files):
    assert run(spark, ROWS, files) == brute(ROWS)


def test_documents(spark, files):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows, files) == brute(rows)


def test_empty_table(spark, files):
    assert run(spark, [], files) == []


def test_words_are_cut_alike(files):
    """The pattern takes every character as the byte-level tokenizer does."""
    plain, pair = Plain(), alignment.Pair(files)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37] + list(range(0x3100))
    texts = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in points if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in plain.a.encode_batch(texts, add_special_tokens=False)]
    assert [pair.a.encode_ordinary(t) for t in texts] == want


def test_large_groups_and_small_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    cuts_a, cuts_b = (np.sort(np.concatenate([rng.choice(n, 20, replace=False), [n]])) for n in (400, 300))
    group_a, group_b = (np.searchsorted(c, np.arange(n), "right") for c, n in ((cuts_a, 400), (cuts_b, 300)))
    both = np.intersect1d(group_a, group_b)
    a, group_a = a[np.isin(group_a, both)], np.searchsorted(both, group_a[np.isin(group_a, both)])
    b, group_b = b[np.isin(group_b, both)], np.searchsorted(both, group_b[np.isin(group_b, both)])
    groups = alignment.Groups(a, b, group_a, group_b, np.sort(rng.integers(0, 4, len(both))))
    want = Counter()
    for g in range(len(both)):
        for x in a[group_a == g].tolist():
            for y in b[group_b == g].tolist():
                want[(((x << alignment.ID_BITS) + y) << 16) + 5 + int(groups.doc[g])] += 1
    for group, piece in ((1024, 1 << 21), (0, 3), (40, 10), (10**9, 1)):
        monkeypatch.setattr(alignment, "GROUP", group)
        monkeypatch.setattr(alignment, "PIECE", piece)
        numbers, times = alignment.merged(list(groups.linked(5)))
        assert dict(zip(numbers.tolist(), times.tolist(), strict=True)) == want and (np.diff(numbers) > 0).all()


@pytest.mark.parametrize("sparse", [3, 4096])
def test_bitmaps_and_planes(monkeypatch, sparse):
    monkeypatch.setattr(alignment, "SPARSE", sparse)
    rng = np.random.default_rng(2)
    runs = [np.sort(rng.choice(60_000, n, replace=False)) for n in (1, 2, 3, 5, 9, 300, 1)]
    docs, starts = np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    times = np.where(rng.random(len(docs)) < 0.5, 1, rng.integers(1, 900, len(docs)))
    times[:3] = 1
    bitmaps, planes = alignment.packed(docs, times, starts)
    table = pa.RecordBatch.from_arrays([bitmaps, planes], ["x", "y"])
    for lo, hi in ((0, 7), (2, 6), (0, 1)):
        part = table.slice(lo, hi - lo)
        got = alignment.unpacked(np.diff(starts)[lo:hi], part["x"], part["y"])
        own = slice(starts[lo], starts[hi])
        assert (got[0] == docs[own]).all() and (got[1] == times[own]).all()
