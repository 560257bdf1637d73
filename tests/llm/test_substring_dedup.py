import hashlib
import random
import re

from textengine.llm import registry
from textengine.llm import substring_dedup as S

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """rows (id, text), ids different -> id: (n_words, n_removed, sha)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        w = W.findall(text or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            if g in seen:
                gone[s : s + window] = [True] * window
            seen.add(g)
        kept = [x for x, y in zip(w, gone, strict=True) if not y]
        out[i] = len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_query_matches_brute_force(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert sum(x[1] for x in want.values())
        assert got(registry.op6_substring_dedup(spark, f"/root/testdata/{sf}")) == want


def test_small_alphabets_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    for shard, dealt in ((60_000, 2_000_000), (30, 50)):
        monkeypatch.setattr(S, "SHARD_WORDS", shard)
        monkeypatch.setattr(S, "DEALT_WORDS", dealt)
        passage = [f"p{i}" for i in range(60)]
        rows = []
        for i in range(300):
            w = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
            for _ in range(rng.randint(0, 2)):
                at, a, b = rng.randint(0, len(w)), rng.randint(0, 40), rng.randint(41, 60)
                w[at:at] = passage[a:b]
            rows.append((i * 3 - 50, rng.choice([" ", "\n", " \t "]).join(w)))
        rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "x " * 9000), (5004, "x " * 9000), (None, "x " * 19 + "y")]
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS th", "3 AS marks")
        assert got(S.substring_dedup(df)) == brute(rows)
        # With hot anchors dealt out over tasks.
        assert S.hot_anchors(S._key_columns(df, "doc_id", "text"), 20, 8, 1)
        assert got(S.substring_dedup(df, hot_least=1)) == brute(rows)


def test_a_passage_in_most_documents(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(45)]
    rows = [(i, " ".join([f"a{rng.randrange(10**6)}" for _ in range(rng.randint(0, 9))] + passage[rng.choice([0, 0, 0, 5]) :] + [f"b{rng.randrange(3)}" for _ in range(25)])) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert S.hot_anchors(S._key_columns(df, "doc_id", "text"), 20, 8, 8)
    assert got(S.substring_dedup(df, hot_least=8)) == brute(rows)


def test_null_ids_are_told_apart_and_come_first(spark):
    words = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(None, words), (None, f"x {words}"), (None, "other"), (-5, words)], "doc_id long, text string")
    out = {(r.doc_id, r.n_words): r.n_removed for r in S.substring_dedup(df).collect()}
    assert out[-5, 25] == 25 and out[None, 1] == 0 and sorted([out[None, 25], out[None, 26]]) == [0, 25]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.substring_dedup(empty).count() == 0
    words = " ".join(f"w{i}" for i in range(30))
    same = spark.createDataFrame([(1, words), (1, words), (2, words)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in S.substring_dedup(same).collect()) == [(1, 0), (1, 0), (2, 30)]


def test_automaton_against_search():
    rng = random.Random(5)
    for _ in range(200):
        passages = [[rng.choice("ab") for _ in range(rng.randint(1, 30))] for _ in range(4)]
        automaton = S.Automaton()
        for i, p in enumerate(passages):
            automaton.add(p, (i, 0))
        q = [rng.choice("ab") for _ in range(40)]
        want = [s for s in range(len(q) - 4) if any(q[s : s + 5] == p[j : j + 5] for p in passages for j in range(len(p) - 4))]
        assert automaton.earlier(q, (9, 0), 5) == want
