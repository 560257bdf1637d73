"""A training corpus from documents: good ones, without exact and near copies, mixed to weights, as pieces.

Each stage gets what the one before kept, as a table read again; all but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.llm.common import scratch, table
from textengine.llm.exact_dedup import drop_copies
from textengine.llm.ngram_join import drop_near
from textengine.llm.piece_transducer import encode
from textengine.llm.quality_rules import keep_good
from textengine.llm.registry import tokenizer_path
from textengine.llm.source_mixing import mixed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles, Jaccard similarity 0.8 or more, one stays."""
    return drop_near(docs, n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (little-endian uint32) and whether they decode to the text."""
    model = tokenizer_path("piece_bpe_32k.model")
    keyed = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    rows = encode(keyed, model, id_col="key", keep_text=True, decoded=True)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    return rows.select("key.doc_id", "key.source", "n_tokens", "ids", (F.col("decoded") == plain).alias("round_trip"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing to weights", mixture), ("SentencePiece", pieces)]
#: Neither certified cutoffs, the entropy balancing nor the pieces can be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
