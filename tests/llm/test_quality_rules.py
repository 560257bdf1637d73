import re
from collections import Counter
from math import comb

from compare import compare
from pyspark.sql import functions as F

from textengine.llm import quality_rules as Q
from textengine.llm import registry

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = W.findall(text)
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(g)
    hit = {i + k for i, x in enumerate(g) if n[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if W.search(x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


ODD = [None, "", " \t\n", "a", "a a a", "a a a a", "a b c a b c", "x y\nx y\n\nx y \n#|<>", "é" * 70000, "ab " * 30000, "a b c d e a b c x d e a b c", " nbsp em " * 60]


def test_counts_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = Q.base_metrics(docs.unionByName(odd)).select("text", *names).collect()
    assert len(rows) == 1000 + len(ODD)
    for r in rows:
        assert tuple(r[1:]) == brute(r.text)


def test_binomial_tail(spark):
    cases = [(0, 10), (1, 100), (2, 300), (30, 4000), (0, 1), (5, 100)]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.withColumn("p", Q.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect():
        want = sum(comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert (r.p is None) if r.k > r.n * 0.01 else abs(r.p - want) < 1e-9


def test_certified_cutoffs_reject_junk_and_keep_good(spark):
    # 4,000 good texts without symbols and junk full of them: the strictest cutoff is certified.
    good = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(1, 60), i -> concat('w', i * 7 + id)), ' ')").alias("text"))
    junk = spark.range(4000, 4100).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(1, 60), i -> concat('w', i * 7 + id, '###')), ' ')").alias("text"))
    docs = good.unionByName(junk).withColumn("lang", F.lit("xx")).withColumns({"passed": F.lit(1), "level": F.lit(2), "stratum": F.lit("x")})
    labels = docs.select("doc_id", F.expr("int(doc_id < 4000)").alias("quality"))
    out = Q.apply_rules(docs, labels).groupBy("kept", F.expr("doc_id < 4000").alias("good")).count().collect()
    assert {(r.kept, r.good): r["count"] for r in out} == {(True, True): 4000, (False, False): 100}
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4000


def test_few_labels_certify_nothing_and_edges(spark):
    odd = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)] + [(0, None, "x"), (None, "a " * 60, "y")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (None, None), (99, 0)], "doc_id long, quality int")
    rows = Q.apply_rules(odd, labels).collect()
    assert len(rows) == len(ODD) + 2 and all(r.kept == (not r.base_failed) for r in rows)
    assert Q.apply_rules(odd.limit(0), labels.limit(0)).count() == 0
    assert Q.keep_good(odd.limit(0), labels.limit(0)).count() == 0


def test_query(spark):
    rows = registry.op3_quality_rules(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200


def brute_level(passed, n_strata, risk, delta=Q.DELTA):
    """Of the levels passed by a stratum's good documents: the last level of the unbroken run of certified ones."""
    n = len(passed)
    for level in range(1, Q.LEVELS + 1):
        k = sum(p < level for p in passed)
        if n == 0 or k > n * risk or sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) > delta / n_strata:
            return level - 1
    return Q.LEVELS


def test_levels_match_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.apply_rules(docs, labels, risk=0.1).collect()
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    by = {}
    for r in rows:
        if r.doc_id in good and not r.base_failed:
            by.setdefault(r.stratum, []).append(r.passed)
    want = {s: brute_level(p, len(by), 0.1) for s, p in by.items()}
    assert any(want.values())  # some cutoff is certified here
    for r in rows:
        assert r.level == want.get(r.stratum, 0) and r.kept == (not r.base_failed and r.passed >= r.level)
    kept = sorted(r.doc_id for r in Q.keep_good(docs, labels, risk=0.1).collect())
    assert kept == sorted(r.doc_id for r in rows if r.kept)
    for s, p in by.items():  # and the good ones lose no more than the risk in the holdout
        assert sum(x < want[s] for x in p) <= 0.1 * len(p)


def test_small_strata_share_the_pooled_one(spark):
    docs = spark.range(1500).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 60), i -> concat('w', i * 7 + id)), ' ') AS text", "if(id < 1000, 'big', concat('s', id % 50)) AS lang")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    found = {r.stratum: r.n_good for r in Q.certified(Q.apply_rules(docs, labels).select("doc_id", "stratum", "passed", "base_failed"), labels, "doc_id", 0.01, 0.05, 1).collect()}
    assert found == {"big": 1000, "*": 500}


def test_query_with_certified_cutoffs_matches_sql(spark):
    name = "quality_rules_at_one_in_ten"
    compare(spark, "/root/testdata/sf0.01", registry.queries()[name], registry.oracle_sql()[name])
