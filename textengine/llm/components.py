"""Connected components of a link table: union-find within tasks, large-star and small-star steps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textengine.llm.common import cut

TASK_LINKS = 500_000  # links that one task holds, of 16 bytes each
MOST_ROUNDS = 60


def smallest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): of each node of the links u - v the smallest node of its component."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], low)
        np.minimum.at(now, root[b], low)
        while (now[now] != now).any():
            now = now[now]
        if (now == root).all():
            return nodes, nodes[root]
        root = now


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links -> links of each node with its component's smallest, in shares of at most TASK_LINKS."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def stars() -> pa.RecordBatch:
        nodes, roots = smallest(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= TASK_LINKS:
            yield stars()
            held, size = [], 0
    if held:
        yield stars()


def _moved(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step. A centre's smallest neighbour is a plain aggregate, so no star is one task's."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).withColumn("m", F.least("c", "m"))
    large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = cut(large, "links")
    least = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    ends = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))))
    return large.join(least, F.col("u") == F.col("c")).select(ends.alias("e")).select("e.*").where("u != v").distinct()


def components(links: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """links(u, v), any direction, no nulls -> (node, root): each linked node with the smallest node of its component.

    Every task first makes stars of its own links. Links that fit one task are then done; more of them
    take steps between tasks, in rounds that grow in number with the logarithm of a component's
    diameter. If they haven't ended after most_rounds, that is an error. An empty table gives an empty one.
    """
    edges, told = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u != v"), None
    for _ in range(most_rounds):
        edges = cut(edges.mapInArrow(_stars, "u long, v long").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now[0] <= TASK_LINKS:
            return cut(edges.coalesce(1).mapInArrow(_stars, "u long, v long"), "roots").toDF("node", "root")
        if now == told:
            return edges.toDF("node", "root")
        told, edges = now, _moved(edges.where("u != v"))
    raise RuntimeError(f"components did not end in {most_rounds} rounds")
