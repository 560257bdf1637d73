"""The document cleaner on a stream: its steps need no state, so the batch expressions run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textengine.functions.profile import MASTER, STANDALONE, Profile
from textengine.operators.documents import clean_documents, labelled_lines


def clean_stream(spark: SparkSession, path: str, profile: Profile = MASTER, files_at_once: int = 64) -> DataFrame:
    """Cleaned documents of escaped-document files as they arrive in path."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(path)
    return clean_documents(lines.select(F.col("value").alias("text")), profile)


def label_stream(docs: DataFrame, profile: Profile = STANDALONE) -> DataFrame:
    """Lines of a stream of documents (doc_id, text) with their labels."""
    return labelled_lines(docs, profile)


def write_stream(cleaned: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each document once, by the sink's log; ends when all that is there has been read."""
    return cleaned.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
