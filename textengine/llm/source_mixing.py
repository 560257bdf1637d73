"""Mixing sources to target weights by entropy balancing.

Each document has a rate: how often the mix takes it. Of all rates between 0 and `limit` that meet the
token constraint of every source, those closest to 1 in relative entropy are rate = min(limit,
exp(lambda_source * size / mean size of the source)). The convex dual has one multiplier a source, and
its gradient and curvature are sums over documents, so each Newton step is one distributed aggregation
over the (source, size) histogram; steps that leave the bracket are halved instead, and multipliers that
do not settle are an error. The rates are then
rounded into copies: within a cell of equal source and size the copies total a whole number, and what
that rounding leaves over is carried from the cell of the largest size to the smallest, so a source
misses its target by about half of its smallest documents.

Defined results: a null text has size 0, and a document of size 0 is never taken; null sources are one
source, the last; which documents of a cell get the extra copy depends on a hash of the id only, and of rows
with one id, which have one result between them, any; an empty table gives an empty table; a text of any
length is counted whole; ``mixed`` keeps all columns, whatever their names but for those that begin with __te_.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textengine.llm.common import WS, cut, words_of

WEIGHTS, SHARE, LIMIT, BUCKETS = (5.0, 2.0, 1.0), 1.5, 2.0, 64


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """totals(source, source_size, ...) with target: shares by weight, none above limit times its source.

    The result of handing the excess on until none is above is min(limit * size, weight * level): sources
    by falling weight against their limit are full up to the first whose limit is above the level.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    at = (F.row_number().over(order) - 1) % len(weights)
    rows = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at + 1)).withColumn("top", limit * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    rows = rows.withColumns(
        {
            "before": F.coalesce(F.sum("top").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "rest": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
            "total": share * F.sum("source_size").over(every),
        }
    ).withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    level = F.min(F.when(F.col("top") > F.col("weight") * F.col("level"), F.struct(F.col("before"), F.col("level")))).over(every)["level"]
    return rows.withColumn("target", F.least("top", F.coalesce(F.col("weight") * level, F.col("top")))).drop("weight", "top", "before", "rest", "total", "level")


def multipliers(cells: DataFrame, goals: DataFrame, limit: float = LIMIT, tolerance: float = 1e-7, most_steps: int = 60) -> DataFrame:
    """(source, target, mean, lam): Newton steps on the dual, one aggregation over cells(source, size, n) each."""
    ln = F.log(F.lit(limit))
    z_min = F.col("least") / F.col("mean")
    state = goals.where("source_size > 0").select(
        "source",
        "target",
        (F.col("source_size") / F.col("n_sized")).alias("mean"),
        "least",
        "source_size",
    )
    done = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
    state = state.withColumns(
        {
            "hi": ln / z_min,
            "lo": F.least(F.lit(-1e-9), F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.col("source_size")) / z_min),
            "lam": F.when(done, ln / z_min).otherwise(F.lit(0.0)),
            "done": done,
        }
    )
    state = cut(state, "dual")
    if state.isEmpty():
        return state.select("source", "target", "mean", "lam")
    for _ in range(most_steps):
        z = F.col("size") / F.col("mean")
        e = F.exp(F.least(F.col("lam") * z, F.lit(50.0)))
        rate = F.least(e, F.lit(limit))
        sums = (
            cells.where("size > 0")
            .join(state.where("NOT done").select(F.col("source").alias("s"), "mean", "lam"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("s")
            .agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(F.when(e < limit, F.col("n") * F.col("size") * z * e).otherwise(0.0)).alias("slope"))
        )
        gap = F.col("got") - F.col("target")
        stepped = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").withColumns(
            {
                "hi": F.when(gap > 0, F.col("lam")).otherwise(F.col("hi")),
                "lo": F.when(gap <= 0, F.col("lam")).otherwise(F.col("lo")),
            }
        )
        newton = F.col("lam") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
        near = F.col("done") | (F.abs(gap) <= tolerance * F.col("target") + 1e-6) | (F.col("hi") - F.col("lo") < 1e-15)
        state = cut(
            stepped.withColumns({"lam": F.when(F.coalesce(near, F.lit(True)), F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2), "done": F.coalesce(near, F.lit(True))}).select(
                "source", "target", "mean", "least", "source_size", "hi", "lo", "lam", "done"
            ),
            "dual",
        )
        if state.where("NOT done").isEmpty():
            return state.select("source", "target", "mean", "lam")
    raise RuntimeError(f"the multipliers did not settle in {most_steps} Newton steps")


def _round_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells by source and falling size -> copies of each cell; what rounding leaves over goes on to the next cell."""
    last, carried = object(), 0.0
    for cells in batches:
        copies = []
        for source, size, n, rate, most in zip(cells.source_no, cells["size"], cells.n, cells.rate, cells.most, strict=True):
            if source != last:
                last, carried = source, 0.0
            exact = n * rate + carried / size
            k = min(max(round(exact), 0), int(most) * n)
            carried = (exact - k) * size
            copies.append(k)
        yield cells[["source_no", "size"]].assign(copies=copies)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """A row for each row of docs: id, size, source, source_size, target, rate, copies."""
    spark = docs.sparkSession
    size = F.size(words_of(F.col(text_col))).cast("long")
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.xxhash64(F.col(id_col)).alias("hash")), "sized")
    cells = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    totals = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n_sized"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    goals = cut(targets(totals, weights, share, limit), "targets")
    duals = multipliers(cells, goals, limit).select(F.col("source").alias("s"), "mean", "lam")
    rates = (
        cells.join(goals.select(F.col("source").alias("s0"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s0")), "left")
        .join(duals, F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("rate", F.when(F.col("size") > 0, F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(limit))).otherwise(0.0))
        .drop("s", "s0", "mean", "lam")
    )
    # A source's cells are as many as it has different sizes, whatever its documents: a short row each.
    name = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    lined = rates.where("size > 0").select(F.to_json(name).alias("source_no"), "size", "n", "rate", F.lit(limit).alias("most")).repartition("source_no").sortWithinPartitions("source_no", F.desc("size"))
    copies = lined.mapInPandas(_round_cells, "source_no string, size long, copies long")
    planned = rates.withColumn("no", F.to_json(name)).join(copies.withColumnRenamed("source_no", "no"), ["no", "size"], "left")
    planned = cut(planned.fillna(0, ["copies"]), "copies")
    # Ranks within a cell, counted in buckets of the hash so that a large cell is many short windows.
    dealt = sized.withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)))
    counted = dealt.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
    plan = counted.join(planned.withColumnsRenamed({"source": "s", "size": "z"}), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("b"), "before", "source_size", "target", "rate", F.floor(F.col("copies") / F.col("n")).alias("each"), (F.col("copies") % F.col("n")).alias("extra")
    )
    in_bucket = Window.partitionBy("source", "size", "bucket").orderBy("hash", "id")
    ranked = dealt.withColumn("rank", F.row_number().over(in_bucket))
    rows = ranked.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("b")))
    taken = (F.col("each") + F.when(F.col("before") + F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("long")
    return rows.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "rate", taken.alias("copies"))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns, and of which are null: rows with one key are the same row, but for a chance of 2^-64 a pair."""
    return F.xxhash64(F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in docs.columns]), *[F.col(f"`{c}`") for c in docs.columns])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """The mix itself: the rows of docs, each as often as the mix takes it, with all their columns.

    Rows are told apart by all their columns; id_col does not matter here. Rows that agree in all of them
    are taken as often as the mix takes them together, dealt out evenly between them.
    """
    keyed = docs.withColumn("__te_key", row_key(docs))
    chosen = mix(keyed.select("__te_key", F.col(text_col), F.col(source_col)), "__te_key", text_col, source_col, weights, share, limit)
    plan = chosen.groupBy(F.col("__te_key").alias("__te_of")).agg(F.sum("copies").alias("__te_copies"), F.count(F.lit(1)).alias("__te_rows")).where("__te_copies > 0")
    joined = keyed.join(plan, F.col("__te_key") == F.col("__te_of"))
    alone = joined.where("__te_rows = 1").withColumn("__te_times", F.col("__te_copies"))
    # Of repeated rows each has the whole part, and as many as are left over come from one of them.
    every = joined.where("__te_rows > 1").withColumn("__te_times", F.floor(F.col("__te_copies") / F.col("__te_rows")))
    left = joined.where("__te_rows > 1 AND __te_copies % __te_rows > 0").dropDuplicates(["__te_key"]).withColumn("__te_times", F.col("__te_copies") % F.col("__te_rows"))
    taken = alone.unionByName(every).unionByName(left).where("__te_times > 0")
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col("__te_times"))).alias("__te_copy")).drop("__te_copy")
