import re
from collections import Counter, defaultdict

import pytest
from compare import compare

from textengine.llm import registry
from textengine.llm import source_mixing as M

SF = "/root/testdata/sf0.01"


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        w = sum(weight[s] for s in order if s not in full)
        new = {s for s in order if s not in full and left * weight[s] / w > 2 * sizes[s]}
        if not new:
            return out | {s: left * weight[s] / w for s in order if s not in full}
        for s in new:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        full |= new


def check(rows, texts):
    size, sized, taken, target = {}, defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sized[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size is not None
        size[r.doc_id] = r.size
    want = brute_targets(sized)
    for s in sized:
        assert abs(want[s] - target[s]) <= 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 60, (s, taken[s], target[s])
    for d, t in texts:
        assert size[d] == len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = registry.op5_source_mixing(spark, SF).collect()
    check(a, [(r.doc_id, r.text) for r in docs.collect()])
    b = registry.op5_source_mixing(spark, SF).collect()
    assert {(r.doc_id, r.taken) for r in a} == {(r.doc_id, r.taken) for r in b}


def test_rates_are_tilted_exponentially(spark):
    import math

    rows = [r for r in registry.op5_source_mixing(spark, SF).collect() if r["size"] and 0 < r.rate < 2]
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(math.log(r.rate) / r["size"])
    assert by
    for x in by.values():
        assert max(x) - min(x) < 1e-6 * max(1e-9, abs(max(x))) + 1e-12


def test_edges(spark):
    rows = [(1, None, None), (2, "", "a"), (3, "x " * 5000, "a"), (4, "x y", None), (4, "x y", None), (None, "z", "b"), (5, "one two three", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS rate", "3 AS n")
    out = M.mix(df).selectExpr("*", "copies * size AS taken").collect()
    assert len(out) == len(rows)
    assert all(r.copies == 0 for r in out if r["size"] == 0)
    assert M.mix(df.limit(0)).count() == 0
    hot = spark.range(3000).selectExpr("id AS doc_id", "'same words here' AS text", "if(id % 3 = 0, 'a', 'b') AS source")
    got = M.mix(hot).groupBy("source").agg({"copies": "sum", "target": "max"}).collect()
    assert all(abs(3 * r["sum(copies)"] - r["max(target)"]) <= 3 for r in got), got


def test_mixed_tells_rows_apart_by_all_columns(spark):
    """Rows that agree in id, text and source, in another column they don't; null columns in different places."""
    rows = [(1, "a b c", "s", 10, None), (1, "a b c", "s", 11, None), (None, "a b c", "s", None, 5), (None, "a b c", "s", 5, None), (2, "d e", None, 1, 1), (2, "d e", None, 1, 1), (3, "", "s", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copies int")
    out = M.mixed(df, share=2.0, limit=2.0)
    assert out.columns == df.columns
    # Everything is taken twice: no row gives its copies to another one.
    assert Counter(map(tuple, out.collect())) == Counter({r: 2 * rows.count(r) for r in set(rows) if r[1]})
    assert M.mixed(df.limit(0)).count() == 0


def test_mixed_agrees_with_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Ties in a cell are broken by a hash that the key column gives, so the plan is made on the same one.
    keyed = docs.withColumn("k", M.row_key(docs))
    want = Counter({r.k: r.copies for r in M.mix(keyed.select("k", "text", "source"), "k").collect() if r.copies})
    out = M.mixed(docs)
    assert Counter(r.k for r in out.withColumn("k", M.row_key(docs)).collect()) == want


def test_copies_round_the_rates_cell_by_cell(spark):
    """In every cell the copies are all rows' whole parts and one more for some; what rounding leaves is at most half a document and the carry."""
    cells, carry = defaultdict(list), {}
    for r in registry.op5_source_mixing(spark, SF).collect():
        if r["size"]:
            cells[(r.source is None, r.source or "", -r["size"])].append(r)
    for (null, source, size), rows in sorted(cells.items(), key=lambda x: x[0]):
        size, n = -size, len(rows)
        exact = n * rows[0].rate + carry.get((null, source), 0.0) / size
        k = min(max(round(exact), 0), 2 * n)
        assert sum(r.copies for r in rows) == k
        assert {r.copies for r in rows} <= {k // n, k // n + (k % n > 0)}
        carry[null, source] = (exact - k) * size


def test_multipliers_that_do_not_settle_are_an_error(spark):
    cells = spark.createDataFrame([("a", s, 1) for s in range(1, 40)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 780, 39, 1, 900.0)], "source string, source_size long, n_sized long, least long, target double")
    assert M.multipliers(cells, goals).count() == 1
    with pytest.raises(RuntimeError):
        M.multipliers(cells, goals, tolerance=0.0, most_steps=1)


def test_targets_match_sql(spark):
    compare(spark, SF, registry.queries()["source_targets"], registry.oracle_sql()["source_targets"])
