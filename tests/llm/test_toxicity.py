import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textengine.llm import registry
from textengine.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = registry.op10_toxicity(spark, SF).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in toxic])
    assert auc > 0.93, auc
    assert np.mean([s >= 0.5 for s in clean]) < 0.01
    assert np.mean([s >= 0.5 for s in toxic]) > 0.6


def test_pairs_are_learned():
    # Neither term alone says anything; both together do.
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        t = [*rng.integers(1000, 1200, 6), *([1] if a else [2]), *([3] if b else [4])]
        texts.append(np.unique(t).astype(np.int32))
        labels.append(float(a == b))
    m = T.train(texts, np.array(labels))
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert np.mean((m.scores(bounds, np.concatenate(texts)) >= 0.5) == np.array(labels)) > 0.9


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "x " * 50000), (1, "a")], "doc_id long, text string").selectExpr("*", "1 AS score")
    out = T.score(df, T.Machine()).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    labelled = df.selectExpr("doc_id", "text", "cast(null AS int) AS toxic")
    assert T.fit(labelled, "doc_id", "text", "toxic").weights is None
    assert T.score(df.limit(0), T.Machine()).count() == 0


def test_margins_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(4)
    m = T.Machine(-0.7, rng.normal(size=1 << T.BITS), rng.normal(size=(1 << T.BITS, T.K)))
    texts = [np.unique(rng.integers(0, 1 << T.BITS, n)) for n in (0, 1, 2, 7, 40)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = m.margins(bounds, np.concatenate(texts))
    for z, t in zip(got, texts, strict=True):
        x = len(t) ** -T.POWER if len(t) else 0.0
        want = -0.7 + sum(m.weights[i] * x for i in t) + sum(m.factors[i] @ m.factors[j] * x * x for a, i in enumerate(t) for j in t[a + 1 :])
        assert abs(z - want) < 1e-9


def test_terms_are_distinct_hashes_of_words_and_beginnings():
    import pyarrow as pa

    texts = ["Alpha beta ALPHA", "", None, "alpha", "beta alpha", "alpine", "x " * 200_000]
    out = {}
    for at, to, bounds, places in T.terms(pa.array(texts)):
        for i in range(at, to):
            out[i] = places[bounds[i - at] : bounds[i - at + 1]].tolist()
    assert [len(out[i]) for i in range(len(texts))] == [6, 0, 0, 3, 6, 3, 3]
    assert out[0] == out[4] and set(out[3]) < set(out[0])
    assert not set(out[3]) & set(out[5])  # "alph" and "alpi"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").selectExpr("*", "1 AS h", "2 AS label", "3 AS key", "4 AS places")


def test_training_rows_stay_within_both_bounds(spark):
    rows = [(i, "w " * (i % 9), i % 2) for i in range(200)] + [(7, "same text", 1)] * 30 + [(None, None, 1), (None, "a", None)]
    df = labelled(spark, rows)
    take = lambda **bounds: sorted(map(tuple, T.training_rows(df, "doc_id", "text", "toxic", **bounds).collect()))
    assert len(take()) == 231
    for n in (1, 3, 50, 230):
        assert len(take(max_train=n)) == n and take(max_train=n) == take(max_train=n)
    for chars in (0, 10, 400):
        got = take(max_chars=chars)
        assert len(got) == 1 or sum(len(t) for _, t in got) <= chars
    assert set(take(max_train=50)) <= set(take(max_train=100))


@pytest.mark.parametrize("label", [0, 1])
def test_one_label_only(spark, label):
    m = T.fit(labelled(spark, [(1, "a", label), (2, "b", label), (3, "c", None)]), "doc_id", "text", "toxic")
    got = [r.score for r in T.score(labelled(spark, [(1, "zz", 0), (1, None, 0)]), m).collect()]
    assert all(abs(s - label) < 1e-9 for s in got)


def test_repeated_rows_and_reruns_agree(spark):
    rows = [(i, f"plain words number {i % 40} here" if i % 3 else f"nasty bad thing {i % 40}", int(i % 3 == 0)) for i in range(400)]
    rows += rows[:100]
    df = labelled(spark, rows)
    scored = lambda n: {(r.doc_id, r.score) for r in T.score(df.repartition(n), T.fit(df.repartition(n), "doc_id", "text", "toxic")).collect()}
    a = scored(3)
    assert len(a) == 400 and a == scored(11)
    assert all((s >= 0.5) == (i % 3 == 0) for i, s in a)


def test_query_edges(spark, tmp_path):
    long = "bad " + "word " * 300_000
    docs = [(i, t) for i, t in enumerate([None, "", " \t", "a", long])] + [(3, "a"), (3, "a"), (None, "x")]
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("labels", [(1, 0), (3, 1), (4, None), (99, 1)], "doc_id long, toxic int")):
        spark.createDataFrame(rows, schema).selectExpr("*", "1 AS score", "2 AS held_out").write.parquet(f"{tmp_path}/{name}.parquet")
    out = registry.op10_toxicity(spark, str(tmp_path)).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0) for r in out)
    for name, schema in (("documents", "doc_id long, text string"), ("labels", "doc_id long, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert registry.op10_toxicity(spark, f"{tmp_path}/none").count() == 0


def test_labels_meet_hashes_and_not_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text number {i % 90} " * (i % 5)) for i in range(300)] * 2 + [(None, "x"), (7, "other"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 320, 2)] + [(7, 1), (7, 0), (8, 1), (8, 1), (9, None), (None, 1)], "doc_id long, toxic int")
    joined = docs.join(labels.withColumnRenamed("doc_id", "label_id"), docs.doc_id == F.col("label_id"))
    plans = []
    monkeypatch.setattr(T, "cut", lambda df, name, cut=T.cut: plans.append(df._jdf.queryExecution().optimizedPlan()) or cut(df, name))
    for bounds in ({}, {"max_train": 37}, {"max_chars": 900}, {"max_train": 1}):
        rows = lambda *a, b=bounds, **k: sorted(map(tuple, T.training_rows(*a, "doc_id", "text", "toxic", **b, **k).collect()))
        assert rows(docs, labels=labels) == rows(joined) != []
    joins = []

    def walk(node):
        if node.nodeName() == "Join":
            joins.extend(node.children().apply(k).output().mkString(" ") for k in range(2))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plans[0])
    assert len(joins) == 2 and not any("text#" in x for x in joins), joins
    assert len(T.training_rows(docs, "doc_id", "text", "toxic", labels=labels).collect()) == joined.where("toxic IS NOT NULL").count()
    asked = []
    monkeypatch.setattr(T, "fit", lambda d, *a, labels=None, **k: asked.append((d.columns, labels)) or T.Machine())
    registry.op10_toxicity(spark, "/root/testdata/sf0.001")
    assert asked[0][0] == ["doc_id", "text"] and asked[0][1] is not None
