"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries, one for each partition, find the digests that may be frequent; a second look
counts them exactly, and the winners of those that are frequent (at most ``counters`` rows, so a
bounded broadcast) settle their groups on the map side. Only the other digests are shuffled, and none
of their groups holds more than about 2 / counters of all rows. Texts are shuffled only where more than
SENT rows are told to go: up to then a list of those is broadcast.

Defined results: a null text counts as empty; texts are equal when they agree without white space
[\\x20\\x09-\\x0D]; the longest original stays, then the smallest id (null ids last), then the one whose
text has the smallest hash, and of rows that agree in id and text any one. An empty table gives an empty table. Other columns pass by, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textengine.llm.common import WS, cut

COUNTERS, SENT = 1024, 250_000


def merge_counters(held: dict[bytes, int], more: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """The Misra-Gries merge: add, then take the (counters + 1)-th largest count off all."""
    for key, n in more.items():
        held[key] = held.get(key, 0) + n
    if len(held) <= counters:
        return held
    off = np.partition(np.fromiter(held.values(), np.int64, len(held)), -counters - 1)[-counters - 1]
    return {k: n - int(off) for k, n in held.items() if n > off}


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            counts = batch.column(0).value_counts()
            more = dict(zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist(), strict=True))
            held = merge_counters(held, more, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "n"])

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): at most `counters` digests, with every one that more than 2 / counters of the rows have."""
    parts = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """A row for each row of docs: id, keep_id, group_size, kept, n_chars, digest (binary sha-256), mark (a hash of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row_no"),
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(F.regexp_replace(text, WS + "+", ""), 256)).alias("digest"),
            F.length(text).cast("long").alias("n_chars"),
            F.xxhash64(text).alias("mark"),
        ),
        "digests",
    )
    rank = F.struct((-F.col("n_chars")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id"), F.col("mark").alias("mark"), F.col("row_no").alias("row_no"))
    summary = [F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size")]
    total = digests.count()
    candidates = F.broadcast(frequent(digests, counters))
    winners = cut(
        digests.join(candidates, "digest").groupBy("digest").agg(*summary).where(F.col("group_size") * counters >= total),
        "winners",
    )
    heavy = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = rest.join(rest.groupBy("digest").agg(*summary), "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        "n_chars",
        "digest",
        "mark",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    What is told of (id, length, hash of the text): all rows of it go, or all but one of those that repeat.
    """
    found = exact_dedup(docs, id_col, text_col, counters).where("group_size > 1")
    by_row = found.groupBy(F.col(id_col).alias("__te_i"), F.col("n_chars").alias("__te_n"), F.col("mark").alias("__te_m"))
    told = cut(by_row.agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")).where("NOT stays OR rows > 1"), "told")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = {"__te_id": F.col(id_col), "__te_chars": F.length(text).cast("long"), "__te_mark": F.xxhash64(text)}
    same = F.col("__te_id").eqNullSafe(F.col("__te_i")) & (F.col("__te_chars") == F.col("__te_n")) & (F.col("__te_mark") == F.col("__te_m"))

    def side(rows: DataFrame) -> DataFrame:
        rows = rows.drop("stays", "rows")
        return F.broadcast(rows) if rows.count() <= SENT else rows

    rows = docs.withColumns(keys)
    kept = rows.join(side(told), same, "left_anti")
    again = told.where("stays")
    if not again.isEmpty():
        kept = kept.union(rows.join(side(again), same, "left_semi").dropDuplicates(list(keys)))
    return kept.drop(*keys)
