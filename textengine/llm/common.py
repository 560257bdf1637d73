"""What the operators of this subpackage share: tables, shared storage, small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.storage import cut, scratch, shared_dir

__all__ = ["NOT_WS", "WS", "cut", "let", "partitions", "scratch", "shared_dir", "table", "words_of"]

#: The characters that separate words everywhere in this subpackage, as a Java class.
WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use refers to it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS + "+"), lambda w: w != "")


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    """How many tasks a wide step gets: the session's own setting."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
