"""The flows on paths: python -m textengine FLOW INPUT [OUTPUT ...]. INPUT is a file, a folder or a pattern; OUTPUT a new folder."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.functions import rewrite as R
from textengine.operators import documents as D
from textengine.operators import metrics as M
from textengine.operators import vocabulary as V
from textengine.sources import text as X


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id: the file, line_no, line)."""
    return X.read_numbered_lines(spark, path).withColumnRenamed("file", "doc_id")


def write_in_order(lines: DataFrame, path: str, line: str = "line") -> None:
    X.write_sorted_lines(lines, path, line=line)


def show(table: DataFrame) -> None:
    """A small table, tab-separated."""
    print("\t".join(table.columns))
    for row in table.collect():
        print("\t".join(str(v) for v in row))


def clean_documents(spark, a):
    X.write_documents(D.clean_documents(X.read_lines(spark, a.input).select(F.col("line").alias("text"))), a.output)


def clean_wiki(spark, a):
    write_in_order(D.wiki_output(numbered(spark, a.input)), a.output, "output")


def split_boilerplate(spark, a):
    lines = numbered(spark, a.input)
    labelled = lines.withColumn("label", F.explode(F.array(D.T.line_label(F.col("line")))))
    show(D.label_counts(X.write_split(labelled, a.output, a.log, ("doc_id", "line_no"))))


def rewrite(column):
    """A rewrite of lines, each where it is."""
    return lambda spark, a: X.write_lines(X.read_lines(spark, a.input).select(column(F.col("line")).alias("line")), a.output)


def structure(spark, a):
    docs = X.read_lines(spark, a.input).select(F.col("line").alias("text"))
    X.write_documents(docs.select(R.structural_standalone(F.col("text")).alias("text")), a.output)
    show(D.structural_stats(docs))


def words(spark, a):
    X.write_sorted_words(V.chillu_words(X.read_lines(spark, a.input).select(F.lit(0).alias("doc_id"), F.col("line").alias("text"))), a.output)


def pairs(spark, a):
    X.write_mapping(V.chillu_pairs(X.read_vocabulary(spark, a.input)), a.output)


def replace(spark, a):
    write_in_order(V.rewrite_tokens(numbered(spark, a.input), X.read_mapping(spark, a.pairs)), a.output)


def crawl(spark, a):
    write_in_order(V.clean_crawl_lines(numbered(spark, a.input), X.read_mapping(spark, a.pairs)), a.output)


def headwords(spark, a):
    X.write_lines(V.visarga_headwords(X.read_lines(spark, a.input)), a.output)


def metrics(spark, a):
    lines = X.read_lines(spark, a.input)
    counts = M.word_counts(lines)
    for table in (M.line_metrics(lines), M.word_metrics(counts), M.char_metrics(lines)):
        show(X.report(table))
    show(M.top_words(counts, a.top))
    show(M.length_histogram(counts))


def count(spark, a):
    lines = numbered(spark, a.input)
    show(X.report(M.zero_width_counts(lines.select(F.col("line").alias("text")))))
    show(X.report(M.noise_counts(lines)))


def noise(spark, a):
    show(M.noise_lines(numbered(spark, a.input), a.most).select("line_no", "line"))


def sample(spark, a):
    X.write_sample_report(M.audit_sample(numbered(spark, a.input), a.n, a.seed), a.output)


#: Flow: function, what it does, its paths after the input, its options.
FLOWS = {
    "clean-documents": (clean_documents, "escaped documents, one a line, cleaned", ["output"], {}),
    "clean-wiki": (clean_wiki, "lines of an encyclopedia's dump cleaned", ["output"], {}),
    "split-boilerplate": (split_boilerplate, "kept lines, and a log of the others", ["output", "log"], {}),
    "structure": (structure, "the structural cleanup alone, with what it removed", ["output"], {}),
    "zwj": (rewrite(R.zwj_to_chillu), "joiner sequences as single letters", ["output"], {}),
    "visarga": (rewrite(R.visarga_to_colon), "a visarga at a word's end as a colon", ["output"], {}),
    "chillu-rules": (rewrite(R.chillu_rules), "the rules for chillu letters", ["output"], {}),
    "words": (words, "the distinct words with a chillu form", ["output"], {}),
    "pairs": (pairs, "of a list of words, those whose single-letter form is listed too, as a JSON object", ["output"], {}),
    "replace": (replace, "tokens replaced by such pairs", ["pairs", "output"], {}),
    "crawl": (crawl, "visarga, then tokens replaced, blank lines as they are", ["pairs", "output"], {}),
    "headwords": (headwords, "dictionary lines whose headword ends in a visarga", ["output"], {}),
    "metrics": (metrics, "line, word and character metrics, top words, lengths", [], {"top": 20}),
    "count": (count, "zero-width characters and noise", [], {}),
    "noise": (noise, "noisy lines among the first", [], {"most": 1_000_002}),
    "sample": (sample, "lines to look at, the same every time", ["output"], {"n": 100, "seed": "audit"}),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="textengine", description=__doc__)
    flows = parser.add_subparsers(dest="flow", required=True)
    for name, (_, what, paths, options) in FLOWS.items():
        flow = flows.add_parser(name, help=what)
        for path in ["input", *paths]:
            flow.add_argument(path)
        for option, default in options.items():
            flow.add_argument(f"--{option}", default=default, type=type(default))
    args = parser.parse_args(argv)
    FLOWS[args.flow][0](spark or SparkSession.builder.appName(f"textengine {args.flow}").getOrCreate(), args)


if __name__ == "__main__":
    main()
