import random
import re

import numpy as np
import pyarrow as pa

from textengine.llm import wordhash as H

W = re.compile(r"[^\x20\x09-\x0D]+")
PARTS = [" ", "\t", "\n", "\x0b", "\r", "a", "B", "word", "WORD", "é", "\xa0", "😀", "\x1c", ""]


def texts():
    rng = random.Random(1)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(2000)] + [None, "", " ", "x" * 5000, "one two " * 3000]


def hashed(values, lower=False, most=0):
    """The word hashes of each text."""
    out = []
    for at, to, w in H.slices(pa.array(values, pa.string()), lower):
        h = w.hashes(most)
        out += [h[w.first[i] : w.first[i + 1]].tolist() for i in range(to - at)]
    return out


def test_equal_words_have_equal_hashes(monkeypatch):
    values = texts()
    want = [W.findall(t or "") for t in values]
    for size in (H.SLICE, 300):  # whatever slice a text is in
        monkeypatch.setattr(H, "SLICE", size)
        got = hashed(values)
        assert [len(g) for g in got] == [len(w) for w in want]
        words, hashes = [x for w in want for x in w], [x for g in got for x in g]
        assert len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes))


def test_lower_case_and_beginnings():
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    values = texts()
    assert hashed(values, lower=True) == hashed([(t or "").translate(lower) for t in values])
    assert hashed(["abcdef abcd abcx"], most=4)[0][0] == hashed(["abcd"])[0][0]
    assert hashed(["abcdef abcd abcx"], most=4)[0][1] != hashed(["abcdef abcd abcx"], most=4)[0][2]


def test_runs_depend_on_items_and_order():
    rng = random.Random(2)
    items = np.array([rng.randrange(5) for _ in range(4000)], np.uint64)
    got = H.runs(items, 4).tolist()
    keys = [tuple(items[i : i + 4].tolist()) for i in range(len(items) - 3)]
    assert len(set(zip(keys, got, strict=True))) == len(set(keys)) == len(set(got))
    assert len(H.runs(items[:3], 4)) == 0


def test_sliced_columns():
    column = pa.array(["a b", None, "c", "d e f", ""]).slice(1, 3)
    data, offsets = H.column_bytes(column)
    assert bytes(data) == b"cd e f" and offsets.tolist() == [0, 0, 1, 6]
    assert [len(x) for x in hashed(column.to_pylist())] == [0, 1, 3]
