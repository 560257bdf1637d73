"""Scans and sinks of text corpora. All are distributed: files are split and written by tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textengine.functions import rewrite as R
from textengine.storage import cut


def read_lines(spark: SparkSession, path: str, replace_bad_bytes: bool = True) -> DataFrame:
    """(line): \\n, \\r\\n and \\r end lines; every line once, however files are split."""
    lines = spark.read.text(path)
    return lines.select((F.make_valid_utf8("value") if replace_bad_bytes else F.col("value")).alias("line"))


def read_numbered_lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """(file, line_no from 1, line). A file is read in splits; its splits' line counts, a small table, give where each begins.

    across: the numbers run on from file to file, in the order of the parts of a table that was written sorted.

    The files are scanned once for the counts and once for the lines; a split's rows come from one task, in
    order, so their running ids are consecutive in both scans.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.make_valid_utf8("value").alias("line")
    )
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    order = Window.orderBy(F.length("file"), "file", "block") if across else Window.partitionBy("file").orderBy("block")
    before = F.sum("n").over(order) - F.col("n")
    blocks = blocks.select(F.col("file").alias("f"), F.col("block").alias("b"), (before - F.col("first") + 1).alias("shift"))
    numbered = rows.join(blocks, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return numbered.select("file", (F.col("at") + F.col("shift")).alias("line_no"), "line")


def read_escaped_documents(spark: SparkSession, path: str) -> DataFrame:
    """(text): one document a line, its newlines written as backslash and n."""
    return read_lines(spark, path).select(R.unescape_newlines(R.strip(F.col("line"))).alias("text"))


def read_documents(spark: SparkSession, path: str, separator: str = "\n\n") -> DataFrame:
    """(text): documents apart by a blank line, as write_documents leaves them."""
    rows = spark.read.text(path, lineSep=separator).select(F.col("value").alias("text"))
    return rows.where(R.strip(F.col("text")) != "")


def read_table(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """A parquet dataset's documents; a missing text is empty."""
    rows = spark.read.parquet(path)
    return rows.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).select(R.strip(F.col("line")).alias("word")).where("word != ''").distinct()


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(word, atomic) of JSON objects with text values; none if the file is missing or holds no such object.

    Read line by line, so files are split: a line may be a whole object, one entry of an object
    printed over lines, or a bracket. A line that is none of these gives nothing.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "word string, atomic string")
    body = F.regexp_replace(R.strip(F.col("line")), r"^,\s*|,$", "")
    whole = F.concat(F.when(body.startswith("{"), "").otherwise("{"), body, F.when(body.endswith("}"), "").otherwise("}"))
    return read_lines(spark, path).select(F.explode(F.from_json(whole, "map<string,string>")).alias("word", "atomic"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(headword, pos, gloss) of a tab-separated file without quoting."""
    part = F.split("line", "\t")
    return read_lines(spark, path).select(*[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(("headword", "pos", "gloss"))])


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def write_escaped_documents(docs: DataFrame, path: str, text: str = "text") -> None:
    docs.select(R.escape_newlines(F.col(text)).alias("value")).write.text(path)


def write_documents(docs: DataFrame, path: str, text: str = "text", separator: str = "\n\n") -> None:
    docs.select(F.col(text).alias("value")).write.text(path, lineSep=separator)


def write_lines(lines: DataFrame, path: str, line: str = "line") -> None:
    lines.select(F.col(line).alias("value")).write.text(path)


def write_sorted_lines(lines: DataFrame, path: str, by: Sequence[str] = ("doc_id", "line_no"), line: str = "line") -> None:
    """Lines in order over all files; each task sorts and writes a range of them."""
    write_lines(lines.orderBy(*by), path, line)


def write_split(labelled: DataFrame, kept_path: str, log_path: str, by: Sequence[str] = ()) -> DataFrame:
    """Kept lines to one place, the removal log to another, each in the order of `by`. Returns labelled, which is written first, as labels cost the most."""
    from textengine.operators.documents import removal_log

    labelled = written = cut(labelled, "labelled")
    if by:
        labelled = labelled.orderBy(*by)
    write_lines(labelled.where("label = 'keep'"), kept_path)
    write_lines(removal_log(labelled), log_path, "entry")
    return written


def write_mapping(pairs: DataFrame, path: str) -> None:
    """One JSON object {word: atomic}, an entry a line in the order of words, in one file, as a vocabulary is small beside its corpus."""
    entry = F.expr("substring(to_json(map(word, atomic)), 2, length(to_json(map(word, atomic))) - 2)")
    first = pairs.agg(F.min("word").alias("first"))
    entries = pairs.crossJoin(F.broadcast(first)).select(F.lit(1).alias("kind"), "word", F.concat(F.when(F.col("word") == F.col("first"), "").otherwise(","), entry).alias("value"))
    ends = pairs.sparkSession.createDataFrame([(0, "", "{"), (2, "", "}")], "kind int, word string, value string")
    entries.unionByName(ends).repartition(1).sortWithinPartitions("kind", "word").select("value").write.text(path)


def write_sorted_words(words: DataFrame, path: str) -> None:
    """One word a line in code point order over all files."""
    words.orderBy("word").select(F.col("word").alias("value")).write.text(path)


def report(metrics: DataFrame) -> DataFrame:
    """(name, value) of a one-row table of metrics, as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in metrics.columns])
    return metrics.select(F.explode(cells).alias("x")).select("x.*")


def sample_report(sample: DataFrame) -> DataFrame:
    return sample.select("sample_no", F.format_string("SAMPLE #%d:\n%s\n", "sample_no", "line").alias("block"))


def write_report(metrics: DataFrame, path: str) -> None:
    """A line for each metric: its name, padded, and its value."""
    report(metrics).select(F.concat(F.rpad("name", 24, " "), "value").alias("value")).write.text(path)


def write_sample_report(sample: DataFrame, path: str) -> None:
    """The samples in order, each under its number, with a blank line after it; samples are few, so they are one file."""
    sample_report(sample.repartition(1).sortWithinPartitions("sample_no")).select(F.col("block").alias("value")).write.text(path)
