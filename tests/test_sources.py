import json

from pyspark.sql import functions as F

from textengine.operators import documents as D
from textengine.operators import metrics as M
from textengine.operators import vocabulary as V
from textengine.sources import text as S
from textengine.streaming import clean as C


def texts(df):
    return sorted(r[0] for r in df.collect())


def test_documents_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("one\ntwo",), ("three",), (None,)], "text string")
    S.write_escaped_documents(docs, f"{tmp_path}/escaped")
    assert texts(S.read_escaped_documents(spark, f"{tmp_path}/escaped")) == ["", "one\ntwo", "three"]
    S.write_documents(docs.where("text IS NOT NULL").coalesce(1), f"{tmp_path}/plain")
    assert texts(S.read_documents(spark, f"{tmp_path}/plain")) == ["one\ntwo", "three"]
    assert S.count_lines(spark, f"{tmp_path}/escaped") == 3


def test_lines_and_bad_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\xffy\r\nz\rw\n")
    assert texts(S.read_lines(spark, str(tmp_path / "a.txt"))) == ["w", "x�y", "z"]
    assert [(r.line_no, r.line) for r in S.read_numbered_lines(spark, str(tmp_path / "a.txt")).orderBy("line_no").collect()] == [(1, "x�y"), (2, "z"), (3, "w")]


def test_vocabulary_mapping_and_dictionary(spark, tmp_path):
    (tmp_path / "v.txt").write_text(" b \n\na\nb\n")
    assert texts(S.read_vocabulary(spark, str(tmp_path / "v.txt"))) == ["a", "b"]
    (tmp_path / "m.json").write_text('{\n "x": "y",\n "z": "w"\n}')
    assert sorted(map(tuple, S.read_mapping(spark, str(tmp_path / "m.json")).collect())) == [("x", "y"), ("z", "w")]
    assert S.read_mapping(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("[1")
    assert S.read_mapping(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "d.tsv").write_text("അന്തഃ\t{noun}\tinside\nക\t{n}\t\"q\n")
    rows = S.read_dictionary(spark, str(tmp_path / "d.tsv")).collect()
    assert {(r.headword, r.pos, r.gloss) for r in rows} == {("അന്തഃ", "{noun}", "inside"), ("ക", "{n}", '"q')}
    assert V.visarga_headwords(S.read_lines(spark, str(tmp_path / "d.tsv"))).count() == 1


def test_split_sink_and_words(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Read More here\nഇത് ഒരു നല്ല വരിയാണ് എന്ന് ഞാൻ കരുതുന്നു\n\nabc")], "doc_id long, text string")
    labelled = D.labelled_lines(docs)
    S.write_split(labelled, f"{tmp_path}/kept", f"{tmp_path}/log")
    assert texts(spark.read.text(f"{tmp_path}/log")) == ["[remove_empty] L3: ", "[remove_heuristic] L4: abc", "[remove_keyword] L1: Read More here"]
    assert spark.read.text(f"{tmp_path}/kept").count() == 1
    S.write_sorted_words(spark.createDataFrame([("b",), ("a",), ("ക",)], "word string"), f"{tmp_path}/words")
    assert texts(spark.read.text(f"{tmp_path}/words")) == ["a", "b", "ക"]


def test_mapping_round_trip(spark, tmp_path):
    pairs = [("k", "v"), ("a\"b", "c,d"), ("{x", "}"), ("", "\\"), ("ക്", "ൿ\n")]
    S.write_mapping(spark.createDataFrame(pairs, "word string, atomic string").repartition(3), f"{tmp_path}/map")
    files = list((tmp_path / "map").glob("part-*"))
    assert len(files) == 1 and json.loads(files[0].read_text()) == dict(pairs)
    assert sorted(map(tuple, S.read_mapping(spark, f"{tmp_path}/map").collect())) == sorted(pairs)
    S.write_mapping(spark.createDataFrame([], "word string, atomic string"), f"{tmp_path}/none")
    assert S.read_mapping(spark, f"{tmp_path}/none").count() == 0
    for i, text in enumerate([json.dumps(dict(pairs)), json.dumps(dict(pairs), indent=2, ensure_ascii=False), "\n".join(json.dumps({k: v}) for k, v in pairs)]):
        (tmp_path / f"{i}.json").write_text(text)
        assert sorted(map(tuple, S.read_mapping(spark, f"{tmp_path}/{i}.json").collect())) == sorted(pairs)


def test_numbers_of_a_file_read_in_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i * 37 % 90) if i % 11 else "" for i in range(5000)]
    for name, end in (("a.txt", "\n"), ("b.txt", "\r\n")):
        (tmp_path / name).write_bytes(end.join(lines).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = S.read_numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in ("a.txt", "b.txt"):
        assert sorted((r.line_no, r.line) for r in rows if r.file.endswith(name)) == list(enumerate(lines, 1))


def test_bounded_scan(spark):
    lines = D.lines_of(spark.createDataFrame([(1, "a []\nb\nc"), (2, "d []\ne []")], "doc_id long, text string"))
    assert [r.line for r in M.noise_lines(lines, 4).orderBy("doc_id").collect()] == ["a []", "d []"]


def test_rewrite_keeps_order_and_punctuation(spark):
    lines = spark.createDataFrame([(1, 1, "  (അവന്‍,) അവന് “അവന്” x"), (1, 2, " \t"), (1, 3, "no change   here")], "doc_id long, line_no int, line string")
    pairs = spark.createDataFrame([("അവന്", "അവൻ")], "word string, atomic string")
    rows = {r.line_no: r.line for r in V.rewrite_tokens(lines, pairs).collect()}
    assert rows == {1: "(അവന്‍,) അവൻ “അവൻ” x", 2: "", 3: "no change here"}
    assert {r.line_no: r.line for r in V.clean_crawl_lines(lines, pairs).collect()}[2] == " \t"
    assert {r.line_no: r.line for r in V.clean_crawl_lines(lines, pairs.limit(0)).collect()}[3] == "no change   here"


def test_reports(spark):
    lines = D.lines_of(spark.createDataFrame([(1, "a bb\n\nccc")], "doc_id long, text string"))
    report = {r.name: r.value for r in S.report(M.line_metrics(lines)).collect()}
    assert report["total_lines"] == "3" and report["blank_lines"] == "1"
    assert S.sample_report(M.audit_sample(lines)).count() == 2
    empty = lines.where("false")
    assert M.word_metrics(M.word_counts(empty)).first().total_words == 0


def test_stream_cleans_as_batch(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from textengine.plans.inputs import noisy_documents

    docs = noisy_documents(spark, "/root/testdata/sf0.001")
    S.write_escaped_documents(docs, f"{tmp_path}/in")
    C.write_stream(C.clean_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/log").awaitTermination(120)
    want = D.clean_documents(S.read_lines(spark, f"{tmp_path}/in").select(F.col("line").alias("text")))
    assert texts(spark.read.parquet(f"{tmp_path}/out").select("text")) == texts(want.select("text"))
