import math
import random
import re
from collections import Counter, defaultdict

from compare import compare
from pyspark.sql import functions as F

from textengine.llm import pii as P
from textengine.llm import registry

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d))))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in p.finditer(text or "") if ok(k, m.group())]


def check(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS base", "3 AS spans")
    got = {r.doc_id: r.b for r in P.find(df).select("doc_id", P.written(F.col("base")).alias("b")).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        assert got[i] == ",".join(brute(t)), (t, got[i], brute(t))


def test_base_matches_brute_force(spark):
    rng = random.Random(9)
    parts = ["a", "b.", "@", "x@y.zz", "1", "22", ".", "255", "256", "-", " ", "+", "(", ")", "4216797744748693", "4111 1111 1111 1111", "é", "😀", "\n", "_", "%", "+1 (203) 555-8282", "1.2.3.4"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(spark, rows + docs + [None, "", "1" * 30000, "a" * 30000 + "@", "1 " * 20000, "a@" * 5000, "." * 9000, "+1" * 9000, "1.2.3.4 x@y.zz, " * 1500])


def test_ip_parts_of_zeros_match_brute_force(spark):
    rng = random.Random(10)
    parts = ["0", "00", "000", "1", "10", "010", "100", "0255", "00256", "255", "256", ".", ".", ".", " ", "10.0.0.1", "0.0.0.0"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    rows += [".".join(str(rng.choice(["0", "00", "007", "9", "199", "249", "0256", "300"])) for _ in range(4)) for _ in range(500)]
    known = ["10.0.0.1", "192.168.0.1", "127.0.0.1", "0.0.0.0", "1.2.00.3", "0.0.0.256"]
    assert [len(brute(t)) for t in known] == [1, 1, 1, 1, 1, 0]
    check(spark, rows + known + ["0" * 4000 + ".0.0." + "0" * 4000 + "256", ("0" * 300 + ".") * 100])


def test_method_adds_what_the_shapes_miss(spark):
    rng = random.Random(2)
    rows = [f"please call ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or mail jo{rng.randint(1, 99)}@mail{i % 9}.example.com now" for i in range(300)]
    rows += [f"write to ann{rng.randint(1, 99)} [at] host{i}.org for news" for i in range(100)]
    rows += [f"isbn 978{rng.randint(10**9, 10**10 - 1)} is a book" for _ in range(100)] + ["plain words only"] * 100
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in P.find(df).collect()}
    added = [len(got[i].added) for i in range(len(rows))]
    assert sum(added[:300]) >= 270 and sum(added[300:400]) >= 90
    assert sum(added[400:]) == 0


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.find(empty).count() == 0
    same = spark.createDataFrame([(1, "a@b.cc"), (1, "a@b.cc"), (None, None)], "doc_id long, text string")
    assert sorted(len(r.base) for r in P.find(same).collect()) == [0, 1, 1]


def brute_em(patterns):
    """Dawid-Skene: patterns {votes: n} -> {votes: posterior}."""
    pi, yes, no = 0.5, [[0.1, 0.3, 0.6] for _ in range(4)], [[0.6, 0.3, 0.1] for _ in range(4)]

    def posterior(v):
        a, b = pi, 1 - pi
        for j, x in enumerate(v):
            a, b = a * yes[j][x], b * no[j][x]
        return a / (a + b)

    for _ in range(P.EM_STEPS):
        q = {v: posterior(v) for v in patterns}
        up, down = sum(n * q[v] for v, n in patterns.items()), sum(n * (1 - q[v]) for v, n in patterns.items())
        pi = (up + 1) / (up + down + 2)
        yes = [[(sum(n * q[v] for v, n in patterns.items() if v[j] == x) + 1 + (x == 2)) / (up + 4) for x in range(3)] for j in range(4)]
        no = [[(sum(n * (1 - q[v]) for v, n in patterns.items() if v[j] == x) + 1 + (x == 0)) / (down + 4) for x in range(3)] for j in range(4)]
    return {v: posterior(v) for v in patterns}


def test_em_matches_brute_force(spark):
    rng = random.Random(3)
    for _ in range(3):
        patterns = {tuple(rng.randint(0, 2) for _ in range(4)): rng.randint(1, 500) for _ in range(30)}
        order = sorted(patterns)
        df = spark.createDataFrame([([(list(v), float(patterns[v])) for v in order],)], "p array<struct<v:array<int>,n:double>>")
        got = df.select(P._em(F.col("p")).alias("q")).first().q
        want = brute_em(patterns)
        assert all(abs(g - want[v]) < 1e-9 for g, v in zip(got, order, strict=True))


def test_classifier_and_scores_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = [(10_000 + i, t) for i, t in enumerate([f"mail ann{i} [at] host{i}.org or (203) 555-{1000 + i} now, card 4{i:014d}" for i in range(80)])]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    found, voted = P.candidates(docs)
    rows = [r.asDict() for r in voted.collect()]
    by_kind = defaultdict(Counter)
    for r in rows:
        by_kind[r["kind_no"]][tuple(r["v"])] += 1
    posts = {k: brute_em(p) for k, p in by_kind.items()}
    yes, no, fy, fn = Counter(), Counter(), Counter(), Counter()
    for r in rows:
        k, q = r["kind_no"], posts[r["kind_no"]][tuple(r["v"])]
        yes[k] += q
        no[k] += 1 - q
        for f in r["f"]:
            fy[k, f] += q
            fn[k, f] += 1 - q
    ids, want = {r.row_no: r.id for r in found.collect()}, defaultdict(dict)
    for r in rows:
        k = r["kind_no"]
        z = math.log((yes[k] + 1) / (no[k] + 1)) + sum(math.log((fy[k, f] + 0.5) / (yes[k] + 1) / ((fn[k, f] + 0.5) / (no[k] + 1))) for f in r["f"])
        p = 1 / (1 + math.exp(-z))
        assert abs(p - P.THRESHOLD) > 1e-6
        if not r["base"] and p >= P.THRESHOLD:
            want[ids[r["row_no"]]][k, r["start"], r["end"]] = p
    assert sum(map(len, want.values())) > 50
    for r in P.find(docs).collect():
        got = {(a.kind_no, a.start, a.end): a.p for a in r.added}
        assert got.keys() == want[r.doc_id].keys() and all(abs(got[x] - p) < 1e-9 for x, p in want[r.doc_id].items())


def test_base_spans_match_sql(spark):
    compare(spark, "/root/testdata/sf0.01", registry.queries()["pii_base_spans"], registry.oracle_sql()["pii_base_spans"])
