import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from textengine.llm import registry
from textengine.llm import token_output as O

PATH = registry.tokenizer_path("byte_bpe_50k.json")


def plain(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_query_matches_the_library(spark):
    rows = registry.op2_token_output(spark, "/root/testdata/sf0.01").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, d, ids in zip(rows, docs, plain([d.text or "" for d in docs]), strict=True):
        ids = [*ids, 2]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_pieces_give_what_whole_texts_give():
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "é", "日本", "😀", "\x00", "'s", "'S", "²", "½x", "\xa0", "12", "...", "_", "<|endoftext|>", "\r\n", " ", "é", "Ⅷ", "don't", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    e = O.Encoder(PATH, 2)
    assert e.by_piece
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == plain(texts)


def test_added_tokens_are_what_the_library_gives(spark):
    library = Tokenizer.from_file(PATH)
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "a", " the", "é", "日本", "😀", "'", "'s", "12", "...", "<", "|>", "<|", "endoftext", "<|endoftext|>", "<|endoftext|>", "\r\n", "\xa0"]
    texts = ["a <|endoftext|> b", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(2000))]
    rows = O.encode_and_read(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, 2).orderBy("doc_id").collect()
    start = 0
    for r, e in zip(rows, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = [*e.ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_parts_are_zstandard_and_checked():
    out = io.BytesIO()
    w = O.PartWriter(out, 2)
    docs = [[5, 6, 2], [2], list(range(1000))]
    for i, d in zip([3, None, 9], docs, strict=True):
        w.add(i, np.array(d, "<u2").tobytes())
    w.close()
    data = out.getvalue()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u2").tolist() == sum(docs, [])
    r = O.PartReader(io.BytesIO(data), len(data))
    assert r.ids == [3, None, 9] and r.lengths().tolist() == [3, 1, 1000]
    assert [r.document(i).tolist() for i in (2, 0, 1)] == [docs[2], docs[0], docs[1]]
    at = int(r.offsets[2]) + 20
    bad = data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]
    broken = O.PartReader(io.BytesIO(bad), len(bad))
    assert broken.document(0).tolist() == docs[0]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.document(2)


def test_edges(spark):
    rows = [(2, "b"), (1, None), (1, ""), (None, "n"), (3, "x" * 30000), (2, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS part")
    got = O.encode_and_read(df, PATH).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 2, 3] and [r.n_tokens for r in got][1:3] == [1, 1]
    assert O.encode_and_read(df.limit(0), PATH).count() == 0


def test_full_table_keeps_its_earlier_half(monkeypatch):
    monkeypatch.setattr(O, "KEPT_PIECES", 100)
    e = O.Encoder(PATH, 2)
    texts = [" the and of" + "".join(f" w{chr(97 + i % 26)}{chr(97 + i // 26)}x{k * 'z'}" for k in range(8)) for i in range(200)]
    for t in texts:
        assert [np.frombuffer(x, "<u2").tolist() for x in e.encode([t])] == plain([t])
        assert {" the", " and", " of"} <= set(e.kept)
        assert len(e.kept) <= 100


def test_plain_words_do_not_go_through_the_librarys_expression(monkeypatch):
    e = O.Encoder(PATH, 2)
    seen = []
    whole = e._ids
    monkeypatch.setattr(e, "_ids", lambda library, texts: seen.append((library is e.library, texts)) or whole(library, texts))
    text = "Some plain words, étés ÀÖ ǆ ªº ×2 ĀɏɐЖ naïve日本 don't"
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode([text])] == plain([text])
    given = " ".join(t for own, texts in seen if own for t in texts)
    assert not any(w in given for w in ("plain", "words", "étés", "ÀÖ", "Some")) and "日本" in given
