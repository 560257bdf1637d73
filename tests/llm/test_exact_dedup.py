import hashlib
import re

from compare import compare

from textengine.llm import exact_dedup as E
from textengine.llm import registry


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i, k))
    out = []
    for key, g in groups.items():
        best = min(g, key=lambda x: (x[0], x[1], x[2] or 0, x[3]))
        digest = hashlib.sha256(key.encode()).hexdigest()
        out += [(x[2], best[2], len(g), digest) for x in g]
    return sorted(out, key=repr)


def test_query_matches_sql(spark):
    compare(spark, "/root/testdata/sf0.01", registry.op1_exact_dedup, registry.OP1_SQL)


def test_odd_rows_with_few_counters(spark, monkeypatch):
    rows = [(1, "a b"), (2, "ab"), (3, "a\tb "), (3, "a\tb "), (4, None), (5, ""), (6, " \n"), (None, "ab"), (None, None), (7, "é" * 50000), (8, "x" * 9), (9, "a b")]
    rows += [(100 + i, f"copy {i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS kept", "3 AS row_no")
    for counters in (1, 4, 1024):
        got = E.exact_dedup(df, counters=counters).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got), key=repr) == brute(rows)
        assert sum(r.kept for r in got) == len({b[3] for b in brute(rows)})
    for sent in (E.SENT, 0):  # by a broadcast list and by a shuffle
        monkeypatch.setattr(E, "SENT", sent)
        kept = E.drop_copies(df)
        assert kept.columns == df.columns
        out = [(r.doc_id, r.text) for r in kept.collect()]
        assert len(out) == len({b[3] for b in brute(rows)}) and set(out) <= set(rows)
        assert {(i, t) for i, t in out if t and t[0] in "acé"} == {(3, "a\tb "), (7, "é" * 50000), *((100 + i, f"copy {i}") for i in range(3))}


def test_equal_ids_with_other_texts(spark):
    """Equal in id, digest and length, but not in text: one of them stays, the same every time."""
    rows = [(1, "a b c"), (1, "ab  c"), (1, "a  bc"), (1, "a  bc"), (2, "abc  "), (None, "x y"), (None, "xy "), (None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    outs = [sorted(((r.doc_id, r.text) for r in E.drop_copies(df.repartition(n)).collect()), key=repr) for n in (1, 3, 8)]
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) == 3
    assert [i for i, _ in outs[0]].count(1) == 1 and (None, "q") in outs[0]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert E.exact_dedup(df).count() == 0 and E.drop_copies(df).count() == 0


def test_counters_find_every_frequent_one():
    held = {}
    stream = [b"a"] * 60 + [b"b"] * 30 + [bytes([i]) for i in range(110)]
    for i in range(0, len(stream), 7):
        more = {}
        for x in stream[i : i + 7]:
            more[x] = more.get(x, 0) + 1
        held = E.merge_counters(held, more, 8)
        assert len(held) <= 8
    assert b"a" in held and b"b" in held
