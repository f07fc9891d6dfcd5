"""The transducer against the public library and against brute force."""

import hashlib
import random
import struct

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from streamlab.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def message(*fields):
    """A serialised message of (number, value) with text, float, int or bytes values."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    data = b""
    for number, value in fields:
        if isinstance(value, float):
            data += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            data += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            data += varint(number << 3 | 2) + varint(len(value)) + value
    return data


def odd_texts():
    rng = random.Random(4)
    alphabet = "ab eéstr\n\t▁ing  .*ß中𐍈\x00"
    texts = ["", " ", "   ", "\n", "a", "Hello  world ", "▁▁x", "x" * 5000, "ab" * 3000, "é中𐍈" * 100, " <s></s><unk><0x41>"]
    return texts + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]


def test_same_ids_as_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = sp.Transducer(sp.PieceModel(sp.read_model(PATH)))
    texts = odd_texts() + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text, want in zip(texts, library.encode(texts), strict=True):
        ids = own.encode(text).tolist()
        assert ids == want, text[:80]
        assert own.decode(ids) == library.decode(want) == text.replace("▁", " ")


def test_unigram_takes_the_lightest_path():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -1.5, 1), ("b", -1.7, 1), ("ab", -2.0, 1), ("▁a", -2.2, 1), ("ba", -4.0, 1), ("bab", -2.9, 1)]
    data = b"".join(message((1, message((1, p), (2, s), (3, k)))) for p, s, k in pieces)
    own = sp.Transducer(sp.PieceModel(data + message((2, message((3, 1)))) + message((3, message((3, 1), (4, 0))))))
    weights = {p: -s for p, s, k in pieces if k == 1}

    def lightest(text):
        if not text:
            return 0.0
        return min((weights[text[:n]] + lightest(text[n:]) for n in range(1, len(text) + 1) if text[:n] in weights), default=float("inf"))
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choices("ab ", k=rng.randint(1, 10)))
        path = [own.model.pieces[i] for i in own.encode(text)]
        assert "".join(path) == "▁" + text.replace(" ", "▁")
        assert abs(sum(weights[p] for p in path) - lightest("▁" + text.replace(" ", "▁"))) < 1e-6
    assert own.encode("axxa").tolist() == [5, 0, 2]


def test_frames(spark):
    rows = [(1, "Some text", "x"), (None, None, "y"), (1, "Some text", "z"), (2, "", "z"), (3, "long " * 40_000, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    model = sp.read_model(PATH)
    got = sp.decode(sp.encode(df, model), model)
    assert got.columns == ["id", "text", "ids", "decoded"] and got.count() == 5
    assert got.where("decoded <> text").count() == 0
    assert got.where(F.size("ids") == 0).count() == 2
    assert sp.decode(sp.encode(df.limit(0), model), model).count() == 0
    both = sorted((tuple(r) for r in sp.round_trip(df, model).collect()), key=repr)
    assert both == sorted(((r.id, r.ids, hashlib.sha256(r.decoded.encode()).hexdigest(), True) for r in got.collect()), key=repr)
    assert sp.round_trip(df.limit(0), model).count() == 0


def test_small_caches_change_no_id(monkeypatch):
    texts = [f"word{i} and another{i % 7}  x{i * 31}" for i in range(300)]
    with open(PATH, "rb") as f:
        data = f.read()
    want = [ids.tolist() for ids in sp.Transducer(sp.PieceModel(data)).encode_batch(texts)]
    monkeypatch.setattr(sp, "KEPT_BYTES", 2000)
    monkeypatch.setattr(sp, "KEPT_PAIRS", 10)
    small = sp.Transducer(sp.PieceModel(data))
    assert [small.encode(t).tolist() for t in texts] == want
