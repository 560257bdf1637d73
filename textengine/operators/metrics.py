"""Corpus metrics, top lists and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import rewrite as R
from textengine.functions.patterns import portable
from textengine.functions.profile import BOM, NOISE_COUNTS, ZWJ, ZWNJ
from textengine.storage import cut

CLASSES = {"native": r"\x{0D00}-\x{0D7F}", "english": "A-Za-z", "digits": r"0-9\x{0D66}-\x{0D6F}", "spaces": r" \t"}


def line_metrics(lines: DataFrame) -> DataFrame:
    words = F.size(R.tokens(F.col("line")))
    blank = R.strip(F.col("line")) == ""
    size = F.length("line")
    out = lines.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(blank).alias("blank_lines"),
        F.count_if(~blank).alias("non_blank_lines"),
        F.max(size).cast("long").alias("longest_line"),
        F.min(F.when(~blank, size)).cast("long").alias("shortest_line"),
        F.sum(words).alias("words"),
    )
    return out.withColumn("words_per_line", F.round(F.col("words") / F.col("total_lines"), 6)).drop("words")


def char_metrics(lines: DataFrame) -> DataFrame:
    """Characters by class; classes may overlap, as native digits are native too."""
    counts = {n: T.count_of(F.col("line"), c) for n, c in CLASSES.items()}
    punctuation = F.length(F.regexp_replace("line", portable(r"[\w\s]+"), ""))
    return lines.agg(F.sum(F.length("line")).alias("total_chars"), *[F.sum(c).alias(n) for n, c in counts.items()], F.sum(punctuation).alias("punctuation"))


def word_counts(lines: DataFrame) -> DataFrame:
    """(word, n): one shuffle, combined on the map side; the word metrics all follow from it."""
    return lines.select(F.explode(R.tokens(F.col("line"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_metrics(counts: DataFrame) -> DataFrame:
    size, native = F.length("word"), F.col("word").rlike(r"[\x{0D00}-\x{0D7F}]")
    out = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"),
        F.count(F.lit(1)).alias("unique_words"),
        F.coalesce(F.sum(F.when(native, F.col("n"))), F.lit(0)).alias("native_words"),
        F.sum(size * F.col("n")).alias("chars"),
        F.min(F.struct((-size).alias("size"), F.col("word").alias("word")))["word"].alias("longest_word"),
    )
    each = lambda c, f=1.0: F.round(F.when(F.col("total_words") > 0, f * F.col(c) / F.col("total_words")).otherwise(0.0), 6)
    return out.select("total_words", "unique_words", "native_words", "longest_word", each("unique_words").alias("type_token_ratio"), each("native_words", 100.0).alias("native_percent"), each("chars").alias("average_length"))


def top_words(counts: DataFrame, n: int = 20) -> DataFrame:
    """(rank, word, n): the most frequent words; equal counts by word."""
    top = counts.orderBy(F.desc("n"), "word").limit(n)
    return top.select(F.row_number().over(Window.orderBy(F.desc("n"), "word")).cast("long").alias("rank"), "word", "n")


def length_histogram(counts: DataFrame, n: int = 25) -> DataFrame:
    """(length, n, percent, bar): the first n lengths that occur."""
    by = counts.groupBy(F.length("word").cast("long").alias("length")).agg(F.sum("n").alias("n"))
    every = Window.partitionBy()
    by = by.select("length", "n", F.round(100.0 * F.col("n") / F.sum("n").over(every), 6).alias("percent"), F.floor(F.col("n") / F.max("n").over(every) * 30).alias("bar"))
    return by.orderBy("length").limit(n)


def zero_width_counts(docs: DataFrame) -> DataFrame:
    count = lambda c: F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit(c), F.lit("")))).cast("long")
    return docs.agg(count(ZWJ).alias("zwj"), count(ZWNJ).alias("zwnj"), count(BOM).alias("bom"))


def noise_counts(lines: DataFrame) -> DataFrame:
    return lines.agg(*[F.sum(F.regexp_count("line", F.lit(p))).cast("long").alias(n) for n, p in NOISE_COUNTS.items()])


def noise_lines(lines: DataFrame, most: int = 1_000_002) -> DataFrame:
    """Noisy ones among the first lines of the scan, in the order of documents and lines."""
    return cut(first_lines(lines, most).where(T.has_noise(F.col("line"))), "noisy").orderBy("doc_id", "line_no")


def head_lines(lines: DataFrame, n: int = 1000) -> DataFrame:
    return cut(first_lines(lines, n), "head").orderBy("doc_id", "line_no")


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first n by document and line, in no order, and without sorting lines: numbers of lines tell where the n end."""
    doc = _reached(lines, "doc_id", n)
    if doc is None:
        return lines
    last, before = doc
    own = lines.where(F.col("doc_id").eqNullSafe(F.lit(last)))
    line_no, earlier = _reached(own, "line_no", n - before)
    at_end = own.where(F.col("line_no").eqNullSafe(F.lit(line_no))).orderBy("line").limit(n - before - earlier)  # more than one only where a document's number is not its own
    return lines.where(_below("doc_id", last)).unionByName(own.where(_below("line_no", line_no))).unionByName(at_end)


def _below(key: str, value) -> Column:
    """Whether a key comes before a value, nulls first."""
    return F.lit(False) if value is None else F.col(key).isNull() | (F.col(key) < F.lit(value))


def _reached(rows: DataFrame, key: str, n: int) -> tuple | None:
    """The key of the n-th row in the order of keys, and how many rows come before that key; None if there are fewer than n rows.

    Counts by key are written in ranges of keys; the sums of the ranges tell in which the n-th row is, and one task looks there.
    """
    counts = cut(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).repartitionByRange(key).withColumn("range", F.spark_partition_id()), "counts")
    before = 0
    for of_range, total in counts.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        if before + total >= n:
            so_far = F.sum("n").over(Window.orderBy(F.col(key).asc_nulls_first())) + before
            found = counts.where(F.col("range") == of_range).select(key, "n", so_far.alias("so_far")).where(F.col("so_far") >= n)
            k, own, so_far = found.orderBy("so_far").first()
            return k, so_far - own
        before += total
    return None


def audit_sample(lines: DataFrame, n: int = 100, seed: str = "audit") -> DataFrame:
    """(sample_no, doc_id, line_no, line): n lines by their hash, the same every time; blank ones go after that."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("line_no").cast("string")).cast("binary"))
    chosen = lines.withColumn("key", key).orderBy("key").limit(n).select("doc_id", "line_no", R.strip(F.col("line")).alias("line")).where("line != ''")
    return chosen.select(F.row_number().over(Window.orderBy("doc_id", "line_no")).cast("long").alias("sample_no"), "doc_id", "line_no", "line")


def ratios(lines: DataFrame) -> DataFrame:
    """Lines with the letter and native-script ratios that the heuristics use."""
    x = R.strip(F.col("line"))
    return lines.select("doc_id", "line_no", F.round(T.letter_ratio(x), 6).alias("letters"), F.round(T.native_ratio(x), 6).alias("native"))
