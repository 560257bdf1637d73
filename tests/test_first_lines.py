from pyspark.sql import functions as F

from textengine.operators import documents as D
from textengine.operators import metrics as M


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_first_lines_are_those_of_a_sort(spark):
    rows = [(d, i, f"{d} {i} []") for d in (None, 3, 1, 7, 5) for i in range(1, 5)] + [(3, 2, "again []"), (3, 2, "and again []")]
    lines = spark.createDataFrame(rows, "doc_id long, line_no int, line string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for n in (1, 4, 5, 10, 11, 12, 21, 22, 23, 100):
        assert [tuple(r) for r in M.noise_lines(lines, n).orderBy(F.asc_nulls_first("doc_id"), "line_no", "line").collect()] == order[:n], n


def test_first_lines_of_one_file(spark):
    lines = spark.createDataFrame([("f", i, f"line {i}") for i in range(1, 301)], "doc_id string, line_no long, line string").repartition(7)
    assert [r.line_no for r in M.head_lines(lines, 120).collect()] == list(range(1, 121))


def test_no_task_takes_all_first_lines(spark):
    df = M.noise_lines(D.lines_of(spark.range(2000).selectExpr("id AS doc_id", "'a []' AS text")), 1500)
    assert df.count() == 1500 and "Limit" not in plan(df)
