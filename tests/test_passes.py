"""The corpus is read, and its lines rewritten, no more often than needed."""

from pyspark.sql import functions as F

from textengine.functions import profile as P
from textengine.functions import rewrite as R
from textengine.functions.patterns import prefix_of
from textengine.operators import documents as D
from textengine.operators import vocabulary as V
from textengine.sources import text as S


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def counted(spark, rows, schema):
    """A table of these rows, and a count of how often they were read."""
    reads = spark.sparkContext.accumulator(0)

    def tell(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).mapInArrow(tell, schema), reads


def test_words_of_pairs_are_made_once(spark):
    legacy, atomic = "അവന" + P.VIRAMA, "അവൻ"
    docs, reads = counted(spark, [(i, f"{legacy} {atomic}") for i in range(50)], "doc_id long, text string")
    assert [tuple(r) for r in V.chillu_pairs(V.chillu_words(docs)).collect()] == [(legacy, atomic)]
    assert reads.value == 50


def test_rewrite_reads_lines_once(spark):
    legacy, atomic = "അവന" + P.VIRAMA, "അവൻ"
    rows = [(None, 1, f"({legacy}) x  {legacy}"), (1, 1, f"{legacy} a"), (1, 1, f"b {legacy},"), (1, 1, f"{legacy} a"), (2, 1, legacy + legacy), (3, 1, "plain  line"), (4, 1, None)]
    lines, reads = counted(spark, rows, "doc_id long, line_no int, line string")
    pairs = spark.createDataFrame([(legacy, atomic), ("", "x")], "word string, atomic string")
    got = V.rewrite_tokens(lines, pairs).collect()
    want = [(None, 1, f"({atomic}) x {atomic}"), (1, 1, f"{atomic} a"), (1, 1, f"b {atomic},"), (1, 1, f"{atomic} a"), (2, 1, legacy + legacy), (3, 1, "plain line"), (4, 1, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and reads.value == len(rows)


def test_labels_are_made_once_for_both_sinks(spark, tmp_path):
    docs, reads = counted(spark, [(i, "Read More here\nഇത് ഒരു നല്ല വരിയാണ് എന്ന് ഞാൻ കരുതുന്നു") for i in range(20)], "doc_id long, text string")
    written = S.write_split(D.labelled_lines(docs), f"{tmp_path}/kept", f"{tmp_path}/log", ("doc_id", "line_no"))
    assert written.count() == 40 and reads.value == 20
    assert spark.read.text(f"{tmp_path}/kept").count() == spark.read.text(f"{tmp_path}/log").count() == 20


def test_blank_runs_need_two_passes(spark):
    rows = [(1, 1, "a line that is long enough"), (1, 2, ""), (1, 3, " "), (1, 4, "another line that is long enough"), (1, 5, ""), (None, 1, ""), (None, 2, ""), (2, 1, ""), (2, 1, "")]
    lines, reads = counted(spark, rows, "doc_id long, line_no int, line string")
    got = sorted(str(tuple(r)) for r in D.wiki_output(lines).collect())
    want = [(1, 1, rows[0][2]), (1, 2, ""), (1, 4, rows[3][2]), (1, 5, ""), (None, 1, ""), (2, 1, ""), (2, 1, "")]
    assert got == sorted(map(str, want)) and reads.value == 2 * len(rows)


def test_sums_compute_a_text_once(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert plan(D.clean_counts(docs)).count("Normalizer") == 1
    assert plan(D.structural_stats(docs)).count(P.BASES) == 1


def test_prefixes(spark):
    assert [prefix_of(p) for p in (r"\[\[a", "https?://", r"/a/|/b", "ab*", "a|b", r"[a]b", r"\d", "</?ref")] == ["[[a", "http", "/", "a", "", "", "", "<"]
    assert {n: prefix_of(P.WIKI[n]) for n in ("link", "template", "ref", "url", "inline_brackets", "inline_phonetic", "spaces")} == {"link": "[[", "template": "{{", "ref": "<", "url": "http", "inline_brackets": "[", "inline_phonetic": "/", "spaces": ""}
    texts = ["[[a|b]] [[c]]", "{{x}} {y}", "<ref name=x>y</ref>", "see https://a.b c", "[p] []", "/ai/ /~~/ /", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    for n, p in P.WIKI.items():
        rows = df.select(R.sub(F.col("x"), p).alias("a"), F.regexp_replace("x", R.java(p), "").alias("b")).collect()
        assert all(r.a == r.b for r in rows), n
