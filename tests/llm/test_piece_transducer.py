import random

import pytest
import sentencepiece

from textengine.llm import piece_transducer as T
from textengine.llm import registry

PATH = registry.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        return T.Transducer(f.read()), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_same_as_the_library(both):
    own, library = both
    rng = random.Random(6)
    parts = [" ", "  ", "▁", "\n", "\t", "a", "the", "é", "日本", "😀", "\x00", "<s>", "<0x41>", "ing", "ation", "\xa0", "ß", "0", "...", "--", "==", "    ", "}\n", "import ", "é", "ﬁ", "א"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(8000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x24F), rng.randint(0x370, 0x1000), rng.randint(0x3040, 0x9FFF)])) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["", " ", "a" * 3000, "-" * 777, " " * 333, "\n" * 100]
    for t, want in zip(texts, library.encode(texts, num_threads=1), strict=True):
        got = own.encode(t)
        assert got == want, repr(t)
        assert own.decode(got) == library.decode(want) == t.replace("▁", " ")


def test_weights_are_those_of_the_merges(both):
    own, _ = both
    rng = random.Random(7)
    pieces = [p for p in own.ids if len(p) < 6]
    for _ in range(5000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        assert own.stay_apart(a, b) == (own.merges(a + b) == [a, b])


def test_decode_of_broken_bytes(both):
    own, library = both
    for ids in ([own.bytes[0xC3]], [1, own.bytes[0xE6], own.bytes[0x97], 264, 2], []):
        assert own.decode(ids) == library.decode(ids)


def test_byte_arcs_write_the_bytes_of_a_character(both):
    own, library = both
    for c in ["😀", "\x00", "\u0D15", "𐍈"]:
        assert own.written(c) == tuple(own.bytes[b] for b in c.encode()) or c in own.ids
        assert own.encode(c) == library.encode(c)
    assert own.written("ing") == (own.ids["ing"],)


def test_full_tables_lose_no_frequent_stretch(monkeypatch, both):
    monkeypatch.setattr(T, "KEPT", 16)
    with open(PATH, "rb") as f:
        own = T.Transducer(f.read())
    made, real = [], own.path
    own.path = lambda stretch: made.append(stretch) or real(stretch)
    for i in range(200):
        word = "".join(chr(97 + int(d)) for d in str(i))
        assert own.encode(f"the {word}x the") == both[1].encode(f"the {word}x the")
    assert made.count("▁the") == 1


def test_same_with_tables_that_are_always_full(monkeypatch, both):
    for name in ("KEPT", "HISTORIES", "APART"):
        monkeypatch.setattr(T, name, 4)
    with open(PATH, "rb") as f:
        own = T.Transducer(f.read())
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice([" ", "ation", "the", "é", "😀", "𐍈", "\u0D15", "日本", "--", "7"]) for _ in range(40))
        assert own.encode(text) == both[1].encode(text)
        assert own.encode_bytes(text) == b"".join(i.to_bytes(4, "little") for i in both[1].encode(text))
        assert own.decode(own.encode(text)) == text


def test_other_models_are_refused(both):
    with open(PATH, "rb") as f:
        model = f.read()
    with pytest.raises(ValueError):
        T.Transducer(model + bytes([0x12, 2, 0x18, 1]))  # a later field that says unigram
    with pytest.raises(ValueError):
        T.Transducer(model + bytes([0x1A, 3, 0x12, 1, 0x41]))  # a table of normalisation


def test_query(spark, both):
    rows = {r.doc_id: r for r in registry.op7_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert rows[d.doc_id].n_tokens == len(both[1].encode(d.text)) and rows[d.doc_id].round_trip


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "x y"), (None, "x y")], "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    out = T.decode(T.encode(df, PATH), PATH).collect()
    assert sorted((r.n_tokens, r.decoded) for r in out) == [(0, ""), (0, ""), (2, "x y"), (2, "x y")]
    assert T.decode(T.encode(df.limit(0), PATH), PATH).count() == 0
    both = T.encode(df, PATH, keep_text=True, decoded=True)
    assert both.columns == ["doc_id", "n_tokens", "ids", "text", "decoded"]
    assert sorted(map(repr, both.drop("text").collect())) == sorted(map(repr, out))
