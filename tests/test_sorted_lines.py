from textengine.operators import documents as D
from textengine.sources import text as S


def test_numbered_lines_are_written_by_many_tasks(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws('\\n', id, repeat('x', int(id % 50)), '') AS text").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.write_sorted_lines(D.lines_of(docs), f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(list((tmp_path / "out").glob("part-*"))) > 4
    rows = S.read_numbered_lines(spark, f"{tmp_path}/out", across=True).collect()
    want = [x for i in range(3000) for x in (str(i), "x" * (i % 50), "")]
    assert sorted((r.line_no, r.line) for r in rows) == list(enumerate(want, 1))
