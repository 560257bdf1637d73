import random
import re

from textengine.llm import ngram_join as J
from textengine.llm import registry

W = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = W.findall((text or "").translate(UP))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, percent=85, n=4):
    sets = [(i, shingles(t, n)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    index = {}
    for i, s in sets:
        for g in s:
            index.setdefault(g, []).append(i)
    by = dict(sets)
    pairs = {(a, b) for g in index.values() for k, a in enumerate(g) for b in g[k + 1 :] if 100 * min(len(by[a]), len(by[b])) >= percent * max(len(by[a]), len(by[b]))}
    for a, b in pairs:
        if 100 * len(by[a] & by[b]) >= percent * len(by[a] | by[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len({c for _, c in want.values()}) < len(want)
    assert got(registry.op9_ngram_join(spark, "/root/testdata/sf0.01")) == want


def test_near_copies_match_brute_force(spark):
    rng = random.Random(11)
    common = [f"c{i}" for i in range(40)]
    rows, i = [], 0
    for _ in range(12):
        base = [f"{rng.choice('xyz')}{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 40)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 999)}"
            if rng.random() < 0.3:
                w += common
            rows.append((i := i + rng.randint(1, 3), " ".join(w).upper() if rng.random() < 0.3 else " ".join(w)))
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "one"), (9004, "ONE"), (9005, "one two"), (9006, "a b c d"), (9007, "A b  c\nd")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS cls", "2 AS n", "3 AS root")
    assert got(J.ngram_components(df)) == brute(rows)
    kept = {r.doc_id for r in J.drop_near(df).collect()}
    assert kept == {k for k, (n, c) in brute(rows).items() if k == c}


def test_edges(spark):
    assert J.ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a b c d e"), (7, "a b c d e"), (None, "alone is this one text"), (7, "a b c d e")]
    out = sorted(J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=repr)
    assert [r.component_id for r in out if r.doc_id == 7] == [7, 7]
    assert sorted((r.component_id for r in out if r.doc_id is None), key=repr) == [7, None]


def test_drop_near_with_repeated_and_null_ids(spark):
    text = lambda word, end="": " ".join(f"{word}{i}" for i in range(60)) + end
    rows = [(3, text("a")), (5, text("a", " x")), (5, text("b")), (5, text("b")), (None, text("a", " y"))]
    rows += [(7, text("c")), (7, text("c", " x")), (8, text("c", " y")), (None, text("d")), (None, text("d", " x")), (None, text("d"))]
    rows += [(None, text("e")), (9, ""), (9, ""), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS mark", "2 AS stays")
    kept = J.drop_near(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted([g for g in got if not g[1]], key=repr) == sorted(rows[-4:], key=repr)
    full = [g for g in got if g[1]]
    assert sorted(((i, t[0]) for i, t in full), key=repr) == [(3, "a"), (5, "b"), (7, "c"), (None, "d"), (None, "e")]
    assert set(full) <= set(rows)


def test_survey_holds_one_buffer(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    often = np.array([5, 9], np.uint64)
    made = lambda: np.unique(np.concatenate([often, rng.integers(0, 1 << 63, 2000, dtype=np.int64).astype(np.uint64)]))
    monkeypatch.setattr(J, "SURVEYED", 1_000_000)
    monkeypatch.setattr(J, "sets", lambda column, n: ((i, made()) for i in range(len(column))))
    texts = pa.record_batch({"doc": pa.array(range(1200), pa.int64()), "text": pa.array([""] * 1200)})
    tracemalloc.start()
    counts = {}
    for b in J._survey(4)(iter([texts])):
        for r in b.to_pylist():
            if r["shingle"]:
                counts[r["key"]] = counts.get(r["key"], 0) + r["n"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts == {5: 1200, 9: 1200}
    assert peak < 1.6 * 8 * J.SURVEYED, peak


def test_survey_of_sets_that_no_buffer_holds(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(J, "SURVEYED", 20)
    texts = ["a b c d e f", "a b c d e g", "a b c d e h", " ".join(f"w{i}" for i in range(99)), None, "a b c d e f"]
    rows = [r for b in J._survey(4)(iter([pa.record_batch({"doc": pa.array(range(6), pa.int64()), "text": pa.array(texts)})])) for r in b.to_pylist()]
    assert [(r["doc"], r["n"]) for r in rows if not r["shingle"]] == [(0, 3), (1, 3), (2, 3), (3, 96), (4, 0), (5, 3)]
    assert [r["n"] for r in rows if r["shingle"]] == [3, 3]


def test_profiles_are_handed_on_in_small_batches():
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    known = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(0, np.int32)))
    texts = [f"a{i} b c d e{i % 7}" if i % 5 else None for i in range(3000)]
    batch = pa.record_batch({"doc": pa.array(range(3000), pa.int64()), "text": pa.array(texts)})
    out = list(J._profiles(4, 85, known)(iter([batch])))
    assert sum(b.num_rows for b in out) == 2400 and max(b.num_rows for b in out) <= 1000
    want = [(J.class_of(s), len(s)) for _, s in J.sets(pa.array(texts)) if len(s)]
    assert [(r["cls"], r["n"]) for b in out for r in b.select(["cls", "n"]).to_pylist()] == want
