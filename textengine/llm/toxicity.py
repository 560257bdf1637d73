"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words, lower-cased (A-Z), and the first four and five bytes of each, hashed to
2^BITS places; each counts once. The machine gives a term a weight and each pair of terms the product of
their factors, so that it can learn that two terms together say more than their sum. It is trained here,
with Adagrad, on at most MAX_TRAIN labelled rows of at most MAX_CHARS characters together (those of the
smallest hashes of their ids, ties by id, text and label), a bounded sample whatever the input, and
scores every whole text. The model is 2^BITS * (K + 1) numbers, a bounded broadcast.

Defined results: null and empty texts, and texts without a term of the training, get the bias's score;
without both labels in the training rows every score is the share of toxic ones (nearly 0 without any);
null labels don't count; repeated rows are trained on and scored as often as they occur, and equal texts
have equal scores; null ids are ids like others; an empty table gives an empty table. Other columns don't
matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from textengine.llm.common import cut
from textengine.llm.wordhash import slices

BITS, K, MAX_TRAIN, MAX_CHARS, EPOCHS, BATCH, RATE, DECAY, SEED = 18, 4, 20_000, 100_000_000, 12, 64, 0.1, 1e-4, 7
POWER = 0.5  # a text of n terms gives each the value n ** -POWER
LEAST = 8  # a term that fewer training texts have says nothing
PREFIXES = (0, 4, 5)


def terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bounds, places): the distinct places of each text's terms, text after text."""
    for at, to, w in slices(column, lower=True):
        keys = []
        for i, most in enumerate(PREFIXES):
            h = (w.hashes(most) + np.uint64(i * 0x632BE5AB)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
            keys.append((w.doc.astype(np.int64) << BITS) | h.astype(np.int64))
        every = np.unique(np.concatenate(keys))
        bounds = np.searchsorted(every, np.arange(to - at + 1, dtype=np.int64) << BITS)
        yield at, to, bounds, (every & ((1 << BITS) - 1)).astype(np.int32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Machine:
    def __init__(self, bias: float = -30.0, weights: np.ndarray | None = None, factors: np.ndarray | None = None, common: np.ndarray | None = None):
        self.bias, self.weights, self.factors, self.common = bias, weights, factors, common
        self.slope, self.shift = 1.0, 0.0  # of the calibration

    def margins(self, bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        if self.common is not None:  # only terms that were common in training count, for the length too
            stays = self.common[places]
            bounds, places = np.concatenate([[0], np.cumsum(stays)])[bounds], places[stays]
        z = np.full(n, self.bias)
        full = np.flatnonzero(np.diff(bounds))
        if self.weights is not None and len(full):
            v = self.factors[places]
            at = bounds[full]
            total = np.add.reduceat(v, at, axis=0)
            scale = np.diff(bounds)[full] ** -POWER
            pairs = 0.5 * ((total**2).sum(1) - np.add.reduceat((v * v).sum(1), at))
            z[full] += scale * np.add.reduceat(self.weights[places], at) + scale**2 * pairs
        return z

    def scores(self, bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margins(bounds, places) + self.shift)


def calibrate(m: Machine, z: np.ndarray, labels: np.ndarray) -> None:
    """Slope and shift of a logistic fit of the labels on margins of texts that were not trained on, by Newton steps."""
    x = np.stack([z, np.ones_like(z)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ at)
        at = at - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), x.T @ (p - labels) + 1e-2 * (at - [1.0, 0.0]))
    if np.isfinite(at).all() and at[0] > 0:
        m.slope, m.shift = float(at[0]), float(at[1])


def train(texts: list[np.ndarray], labels: np.ndarray) -> Machine:
    """texts: each one's places. A tenth of them is kept back for the calibration."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Machine(30.0 if share else -30.0)
    back = np.arange(len(texts)) % 10 == 9
    if min(labels[back].sum(), (1 - labels[back]).sum()) < 10:
        return learn(texts, labels)
    m = learn([t for t, b in zip(texts, back, strict=True) if not b], labels[~back])
    held = [t for t, b in zip(texts, back, strict=True) if b]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in held])])
    calibrate(m, m.margins(bounds, np.concatenate(held)), labels[back])
    return m


def learn(texts: list[np.ndarray], labels: np.ndarray) -> Machine:
    share = min(max(float(labels.mean()), 0.001), 0.999)
    common = np.bincount(np.concatenate([*texts, np.zeros(0, np.int32)]), minlength=1 << BITS) >= LEAST
    texts = [t[common[t]] for t in texts]
    rng = np.random.default_rng(SEED)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(1 << BITS, np.float32), np.where(common[:, None], rng.normal(0, 0.01, (1 << BITS, K)), 0).astype(np.float32), common)
    gw, gv, gb = np.full(1 << BITS, 1e-6, np.float32), np.full((1 << BITS, K), 1e-6, np.float32), 1e-6
    for epoch in range(EPOCHS):
        for chunk in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            rows = [texts[i] for i in chunk]
            bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
            places = np.concatenate(rows) if bounds[-1] else np.zeros(0, np.int32)
            off = m.scores(bounds, places) - labels[chunk]
            sizes = np.diff(bounds)
            scale = np.maximum(sizes, 1) ** -POWER
            used, back = np.unique(places, return_inverse=True)
            if len(used):
                each = np.repeat(off * scale, sizes).astype(np.float32)
                v = m.factors[places]
                total = np.zeros((len(rows), K), np.float32)
                full = sizes > 0
                total[full] = np.add.reduceat(v, bounds[:-1][full], axis=0)
                pair = np.repeat(off * scale**2, sizes).astype(np.float32)[:, None] * (np.repeat(total, sizes, axis=0) - v)
                dw = np.bincount(back, each, len(used)).astype(np.float32) / len(rows) + DECAY * m.weights[used]
                dv = np.stack([np.bincount(back, pair[:, k], len(used)) for k in range(K)], 1).astype(np.float32) / len(rows) + DECAY * m.factors[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                m.weights[used] -= RATE * 4 * dw / np.sqrt(gw[used])
                m.factors[used] -= RATE * dv / np.sqrt(gv[used])
            db = float(off.mean())
            gb += db * db
            m.bias -= RATE * db / gb**0.5
    return m


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, bounds, places in terms(batch.column(1)):
            got = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(places))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), got], ["label", "places"])


def training_rows(labelled: DataFrame, id_col: str, text_col: str, label_col: str, max_train: int = MAX_TRAIN, max_chars: int = MAX_CHARS, labels: DataFrame | None = None) -> DataFrame:
    """(label, text): the first rows by hash of the id, then id, text and label, within both bounds; one row at least.

    With labels (ids and labels), labelled has no labels yet: these are joined by id, with hashes and lengths
    of the texts only. Texts are read again for the rows that were taken, and no others are shuffled.
    """
    text, kind = F.coalesce(F.col(text_col), F.lit("")), labelled.schema[id_col].dataType
    told = [F.col(id_col).alias("i"), F.xxhash64(text).alias("t"), F.length(text).alias("chars")]
    if labels is None:
        rows = labelled.select(*told, F.col(label_col).cast("int").alias("label"))
    else:
        known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where("label IS NOT NULL")
        rows = labelled.select(*told).join(known, F.col("i") == F.col("label_id"))
    order = F.struct(F.xxhash64("i").alias("h"), "i", "t", "label")
    # Written first, so that tasks merge what each of them takes; the driver gets max_train narrow rows at most.
    first = cut(rows.where("label IS NOT NULL").select(order.alias("key"), "chars").orderBy("key").limit(max_train), "first").orderBy("key").collect()
    taken = total = 0
    while taken < len(first) and (taken == 0 or total + first[taken].chars <= max_chars):
        total += first[taken].chars
        taken += 1
    wanted: dict[tuple, list[int]] = {}
    for r in first[:taken]:
        wanted.setdefault((r.key.i, r.key.t), []).append(r.key.label)
    schema = StructType([StructField("wi", kind), StructField("wt", LongType()), StructField("labels", ArrayType(IntegerType()))])
    chosen = F.broadcast(labelled.sparkSession.createDataFrame([(*k, found) for k, found in wanted.items()], schema))
    texts = labelled.select(F.col(id_col).alias("i"), F.xxhash64(text).alias("t"), text.alias("text"))
    same = F.col("i").eqNullSafe(F.col("wi")) & (F.col("t") == F.col("wt"))
    # Rows of equal ids and texts are the same row: one of them stands for all, as often as its labels say.
    once = texts.join(chosen, same).dropDuplicates(["i", "t"])
    return once.select(F.explode("labels").alias("label"), "text")


def fit(labelled: DataFrame, id_col: str, text_col: str, label_col: str, max_train: int = MAX_TRAIN, max_chars: int = MAX_CHARS, labels: DataFrame | None = None) -> Machine:
    """Trains on the bounded sample of labelled, which has ids, texts and labels 0 or 1, or gets them from labels by id."""
    chosen = training_rows(labelled, id_col, text_col, label_col, max_train, max_chars, labels)
    got = chosen.mapInArrow(_places, "label int, places array<int>").toArrow()
    marks = got.column("label").to_numpy().astype(float)
    texts = [x.values.to_numpy() for c in got.column("places").chunks for x in c]
    order = sorted(range(len(texts)), key=lambda i: (marks[i], len(texts[i]), texts[i].tobytes()))  # the same whatever the partitions
    return train([texts[i] for i in order], marks[order] if len(order) else marks)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.value.scores(bounds, places) for _, _, bounds, places in terms(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got) if got else np.zeros(0))], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, score double")
