"""N-gram Jaccard join by vertical partitioning.

A document is its set of distinct N-word shingles (64-bit hashes, A-Z lower-cased). Documents with the
same set are one class, so copies never make pairs. The global n-gram order is cut into FRAGMENTS; a
candidate pair's overlap is counted in each fragment on its own, from the two classes' segments there,
and the partial overlaps are summed per pair.

Candidates come in steps, so that groups of near copies don't make all their pairs:

1. Classes that share a shingle of their prefixes (the first |x| - ceil(0.85 |x|) + 1 in the global order:
   linked sets always share one) are the only ones that can be linked. Shingles known to repeat come last
   in the order, by count; the list of them is bounded (KNOWN), found by every task among its own
   documents, and only moves work: any order gives the same links.
2. Those classes are sorted by their sketches (the smallest hash in each of SKETCH ranges of the hashes),
   once for every rotation of them, and each is paired with the few before it whose sketches mostly agree.
   That is a linear number of pairs, and their links join nearly all near copies. What it misses is found
   by step 3, so no group need be whole in a task: the sorted rows are cut anywhere.
3. Of the classes that share a shingle of their prefixes, all that are not in one component yet are
   paired. In a shingle's group only the classes outside its largest component look for partners, so a
   group that is one component, but for a few, costs its size times those few. Before all partners are
   tried, growing blocks of them are (BLOCKS): what joins a component there needs no other partner of it.

Before any set is fetched, pairs must pass the length bound, a bound by where in the order
they first meet, and a bound by parity bits (a few hundred where they meet, about one for a shingle after
that): the bits that differ are never more than the shingles that differ. All are exact, none drops a link.

Defined results: null and empty texts have an empty set and are linked with nothing; fewer than N words
are one shingle; rows with equal ids are nodes of their own; null ids are never the smallest, and a
component of null ids only has null; an empty table gives an empty table; only the columns for ids and texts
are read, so names of others don't matter, and a text of any length is hashed whole. Class and shingle hashes have 64 bits, so of n documents about
n^2 / 2^65 pairs are taken for each other by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textengine.llm.common import cut, partitions
from textengine.llm.components import components
from textengine.llm.wordhash import mix, runs, slices

N, PERCENT = 4, 85
FRAGMENTS, KNOWN, FILTER_BITS = 4, 1 << 20, 1 << 24
PARITY_WORDS, NARROW = 4, 8  # of 64 bits: at least, and in rows of shared shingles
SKETCH, ROTATIONS, BACK, AGREE = 16, 8, 4, 10  # hashes a sketch, sorted orders, partners in each, hashes that agree
BLOCKS = [(0, 0), (1, 4), (0, 15)]  # of sixteen; the last one is all
SEEN, SURVEYED = 3, 6_000_000
ROWS = 1000  # profiles that a task holds before it hands them on
SENT = 250_000  # pairs or nodes of 16 to 40 bytes that are broadcast at most; more are joined by shuffling


def sets(column: pa.Array, n: int = N) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct hashes of its shingles) for each text of a column."""
    for at, to, w in slices(column, lower=True):
        h = w.hashes()
        grams = runs(h, n)
        for i in range(at, to):
            a, b = int(w.first[i - at]), int(w.first[i - at + 1])
            if b - a >= n:
                yield i, np.unique(grams[a : b - n + 1])
            elif b > a:
                yield i, runs(h[a:b], b - a)
            else:
                yield i, grams[:0]


def class_of(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(shingles ^ np.uint64(0x6A09E667F3BCC909)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(np.array([total], np.uint64).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles has each remainder, by the largest power of two that is not above their number."""
    size = max(64 * PARITY_WORDS, 1 << (max(len(shingles), 1).bit_length() - 1))
    bits = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def narrow_parities(shingles: np.ndarray) -> np.ndarray:
    """The same by the remainder modulo 64 * NARROW, whatever the set's size: NARROW words."""
    bits = np.bincount((shingles & np.uint64(64 * NARROW - 1)).astype(np.int64), minlength=64 * NARROW) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash in each of SKETCH equal ranges (of an empty range: in the next), of ascending hashes."""
    edges = np.arange(SKETCH, dtype=np.uint64) << np.uint64(64 - SKETCH.bit_length() + 1)
    return shingles[np.searchsorted(shingles, edges) % len(shingles)].view(np.int64)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cls, sketch, turn) rows -> pairs (u, v) of each with the BACK rows before it of its turn that mostly agree."""
    held = None
    for batch in batches:
        cls, turn = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        sketches = batch.column(1).flatten().to_numpy().reshape(-1, SKETCH)
        if held is not None:
            cls, sketches, turn = (np.concatenate([a, b]) for a, b in zip(held, (cls, sketches, turn), strict=True))
        old = 0 if held is None else len(held[0])
        u, v = [], []
        for k in range(1, BACK + 1):
            here = np.arange(max(old, k), len(cls))
            near = here[(turn[here] == turn[here - k]) & ((sketches[here] == sketches[here - k]).sum(1) >= AGREE) & (cls[here] != cls[here - k])]
            u.append(np.minimum(cls[near], cls[near - k]))
            v.append(np.maximum(cls[near], cls[near - k]))
        held = cls[-BACK:], sketches[-BACK:], turn[-BACK:]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])


def _survey(n: int, marked: bool = False):
    """Texts -> (doc, class, size) rows, and (null, shingle, count) rows of shingles that SEEN classes or more
    had among SURVEYED shingles of the task, which bounds what it holds. A third column goes along as mark."""

    def rows(docs: pa.Array, keys: np.ndarray, counts: np.ndarray, shingle: bool, marks: list[pa.Array]) -> pa.RecordBatch:
        columns = [docs, pa.array(keys), pa.array(counts), pa.array(np.full(len(docs), shingle)), *(marks if marked else [])]
        return pa.RecordBatch.from_arrays(columns, ["doc", "key", "n", "shingle", "mark"][: len(columns)])

    def frequent(every: np.ndarray) -> pa.RecordBatch:
        every.sort()  # in place: the buffer is all that a task holds
        found = np.unique(every[SEEN - 1 :][every[SEEN - 1 :] == every[: max(0, len(every) - SEEN + 1)]])
        counts = np.searchsorted(every, found, "right") - np.searchsorted(every, found)
        return rows(pa.nulls(len(found), pa.int64()), found.view(np.int64), counts.astype(np.int64), True, [pa.nulls(len(found), pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = np.empty(SURVEYED, np.uint64), 0
        for batch in batches:
            classes, sizes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, s in sets(batch.column(1), n):
                classes[i], sizes[i] = c, _ = class_of(s), len(s)
                if c in seen or not len(s):
                    continue
                if size + len(s) > len(held):
                    yield frequent(held[:size])
                    size, seen = 0, set()
                if len(s) <= len(held):  # a set that no buffer holds repeats no shingle by itself
                    seen.add(c)
                    held[size : size + len(s)] = s
                    size += len(s)
            yield rows(batch.column(0), classes, sizes, False, batch.columns[2:])
        if size:
            yield frequent(held[:size])

    return run


def _profiles(n: int, percent: int, known):
    """Texts -> (class, n, parity, narrow parity, sketch, prefix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = known.value

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in c])]), pa.int32()), pa.array(np.concatenate(c))) for c in columns[2:]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *lists], ["cls", "n", "parity", "narrow", "sketch", "prefix"])

        for batch in batches:
            rows: list[tuple] = []
            for _, s in sets(batch.column(1), n):
                if not len(s):
                    continue
                k = prefix_length(len(s), percent)
                prefix = s
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                    late = hashes[at] == s
                    prefix = np.concatenate([s[~late], s[late][np.argsort(ranks[at[late]], kind="stable")]]) if late.any() else s
                # A copy: a view would keep the whole set as long as its row.
                rows.append((class_of(s), len(s), parities(s), narrow_parities(s), sketch(s), prefix[:k].view(np.int64).copy()))
                if len(rows) == ROWS:
                    yield table(rows)
            if rows:
                yield table(rows)

    return run


def _places(keys: np.ndarray) -> np.ndarray:
    h = mix(keys.view(np.uint64))
    return np.concatenate([h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)]).astype(np.int64)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        bits[_places(batch.column(0).to_numpy())] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _segments(n: int, wanted, fragments: int):
    """Texts -> (class, fragment, shingles) of the documents whose ids pass the filter; only these are hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool)
        shift = np.uint64(64 - int(fragments).bit_length() + 1)
        for batch in batches:
            places = _places(batch.column(0).fill_null(-(1 << 63)).to_numpy()).reshape(2, -1)
            for _, s in sets(batch.column(1).filter(pa.array(bits[places].all(0))), n):
                if len(s):
                    edges = np.searchsorted(s >> shift, np.arange(fragments + 1, dtype=np.uint64))
                    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(s.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(fragments, class_of(s))), pa.array(np.arange(fragments), pa.int32()), lists], ["cls", "fragment", "shingles"])

    return run


def may_link(n1: Column, n2: Column, p1: Column, p2: Column, percent: int) -> Column:
    """Bounds that every link keeps: sizes, and differing parity bits against differing shingles.

    Sizes of links are less than a factor of two apart, so at most one of two parities is twice as long;
    its halves together are its parity by the smaller remainder.
    """

    def fold(p: Column, other: Column) -> Column:
        half = F.greatest((F.size(p) / 2).cast("int"), F.lit(1))
        return F.when(F.size(p) > F.size(other), F.zip_with(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half), lambda a, b: a.bitwiseXOR(b))).otherwise(p)

    p1, p2 = fold(p1, p2), fold(p2, p1)
    differ = F.aggregate(F.zip_with(p1, p2, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    sizes = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return F.when(sizes, (100 + percent) * differ <= (100 - percent) * (n1 + n2)).otherwise(False)


def mark_of(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


class Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, marked: bool = False):
        self.spark = docs.sparkSession
        self.n, self.percent = n, percent
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        #: What tells rows with equal ids apart, where that is asked for.
        self.mark = ["mark"] if marked else []
        told = self.docs.withColumn("mark", mark_of("text")) if marked else self.docs
        survey = cut(told.mapInArrow(_survey(n, marked), "doc long, key long, n long, shingle boolean" + (", mark long" if marked else "")), "survey")
        self.members = survey.where("NOT shingle").select("doc", F.col("key").alias("cls"), "n", *self.mark)
        self.reps = cut(self.members.where("n > 0").groupBy("cls").agg(F.coalesce(F.min("doc"), F.lit(-(1 << 63))).alias("rep")), "representatives")
        known = survey.where("shingle").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(KNOWN)
        got = known.toArrow()
        hashes, counts = got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy()
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int32)
        rank[np.lexsort((hashes, counts))] = np.arange(len(order), dtype=np.int32)
        late = self.spark.sparkContext.broadcast((hashes[order], rank[order]))
        self.profiles = cut(self.docs.mapInArrow(_profiles(n, percent, late), "cls long, n long, parity array<long>, narrow array<long>, sketch array<long>, prefix array<long>"), "profiles")

        facts = self.profiles.groupBy("cls").agg(F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("narrow").alias("narrow"))
        self.facts = cut(facts, "facts")

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        """(c, u, v, second): each pair once for either class; a broadcast only where there are at most SENT pairs."""
        pairs = cut(pairs, "pairs")
        side = lambda c, second: pairs.select(F.col(c).alias("c"), "u", "v", F.lit(second).alias("second"))
        ends = side("u", False).union(side("v", True))
        return F.broadcast(ends) if pairs.count() <= SENT else ends

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) of classes that the exact bounds let through, with n1 and n2."""
        ends = self._ends(pairs.distinct())
        of = lambda c, second: F.max(F.when(F.col("second") == second, F.col(c)))
        facts = self.facts.join(ends, F.col("cls") == F.col("c")).groupBy("u", "v").agg(of("n", False).alias("n1"), of("n", True).alias("n2"), of("parity", False).alias("p1"), of("parity", True).alias("p2"))
        return cut(facts.where(may_link(F.col("n1"), F.col("n2"), F.col("p1"), F.col("p2"), self.percent)).select("u", "v", "n1", "n2"), "near")

    def segments(self, near: DataFrame) -> DataFrame:
        """(cls, fragment, shingles) of the pairs' classes at least, from one document of each; no shuffle."""
        wanted = cut(near.select(F.explode(F.array("u", "v")).alias("cls")).distinct().join(self.reps, "cls"), "wanted")
        parts = wanted.select("rep").coalesce(16).mapInArrow(_bits, "bits binary").collect()  # at most 16 bit fields of a fixed size
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for p in parts:
            bits |= np.frombuffer(p.bits, np.uint8)
        every = self.docs.mapInArrow(_segments(self.n, self.spark.sparkContext.broadcast(bits.tobytes()), FRAGMENTS), "cls long, fragment int, shingles array<long>")
        return cut(every, "segments")  # those of a few other classes are among them, and those of repeated rows repeat

    def links(self, near: DataFrame, segments: DataFrame) -> DataFrame:
        """The pairs of near that are links: overlaps counted fragment by fragment and summed."""
        ends = self._ends(near.select("u", "v"))
        of = lambda second: F.first(F.when(F.col("second") == second, F.struct("size", "shingles")), ignorenulls=True)
        sized = segments.withColumn("size", F.size("shingles").cast("long"))
        both = sized.join(ends, F.col("cls") == F.col("c")).groupBy("u", "v", "fragment").agg(of(False).alias("a"), of(True).alias("b"))
        partial = both.select("u", "v", (F.col("a.size") + F.col("b.size")).alias("sizes"), F.size(F.array_intersect("a.shingles", "b.shingles")).cast("long").alias("overlap"))
        sums = partial.groupBy("u", "v").agg(F.sum("sizes").alias("sizes"), F.sum("overlap").alias("overlap"))
        return sums.where(100 * F.col("overlap") >= self.percent * (F.col("sizes") - F.col("overlap"))).select("u", "v")

    def sketches(self, classes: DataFrame) -> DataFrame:
        rows = self.profiles.select("cls", "sketch").join(classes.withColumnRenamed("cls", "c"), F.col("cls") == F.col("c"), "left_semi")
        turns = F.sequence(F.lit(0), F.lit(SKETCH - 1), F.lit(SKETCH // ROTATIONS))
        return cut(rows.dropDuplicates(["cls"]).select("cls", "sketch", F.explode(turns).alias("turn")), "sketches")

    def neighbours(self, sketches: DataFrame) -> DataFrame:
        """(u, v): classes next to each other in the sorted orders of their sketches."""
        order = ["turn", *[F.get("sketch", (F.col("turn") + i) % SKETCH) for i in range(BACK)], "cls"]
        ordered = sketches.repartitionByRange(partitions(self.spark), *order).sortWithinPartitions(*order)
        return ordered.mapInArrow(_neighbours, "u long, v long")

    def _rooted(self, rows: DataFrame, roots: DataFrame) -> DataFrame:
        roots = F.broadcast(roots) if roots.count() <= SENT else roots
        return rows.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls")).drop("node")

    def classes(self) -> DataFrame:
        """(node, root) of all classes that are linked with another one."""
        group = Window.partitionBy("shingle")
        rows = self.profiles.select("cls", "n", F.posexplode("prefix").alias("at", "shingle")).repartition(partitions(self.spark), "shingle")
        shared = rows.withColumn("more", F.min("cls").over(group) != F.max("cls").over(group)).where("more")
        shared = cut(shared.select("shingle", "cls", "n", (F.col("n") - F.col("at")).alias("rest")).distinct(), "shared")
        near = self.bounded(self.neighbours(self.sketches(shared.select("cls").distinct())))
        roots = components(self.links(near, self.segments(near)))
        for block in BLOCKS:
            near = self.bounded(self.apart(shared, roots, block))
            roots = self._join(roots, self.links(near, self.segments(near)))
        return roots

    def apart(self, shared: DataFrame, roots: DataFrame, block: tuple[int, int]) -> DataFrame:
        """(u, v): pairs that share a shingle of their prefixes and are not in one component, with partners of a block of hashes only."""
        rooted = cut(self._rooted(shared, roots), "rooted")
        sizes = rooted.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("members"))
        largest = sizes.groupBy(F.col("shingle").alias("s")).agg(F.max(F.struct("members", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
        mixed = rooted.join(largest.drop("roots"), F.col("shingle") == F.col("s")).drop("s")
        words = [F.get("narrow", F.lit(i)).alias(f"b{i}") for i in range(NARROW)]
        mixed = cut(mixed.join(self.facts.select(F.col("cls").alias("c"), *words), F.col("cls") == F.col("c")).drop("c"), "mixed")
        told = {"cls": "c", "n": "m", "rest": "rest", "root": "r"} | {f"b{i}": f"b{i}_" for i in range(NARROW)}
        side = lambda rows, k: rows.select("shingle", *[F.col(c).alias(f"{name}{k}") for c, name in told.items()], *(["largest"] if k == 2 else []))
        x = side(mixed.where("root != largest"), 1)
        y = side(mixed.where(F.pmod(F.xxhash64("cls"), F.lit(16)).between(*block)), 2)
        once = (F.col("r1") != F.col("r2")) & ((F.col("c1") < F.col("c2")) | (F.col("r2") == F.col("largest")))
        # At the first shingle in the order that two sets share, the overlap is at most what each has left.
        fit = (100 + self.percent) * F.least("rest1", "rest2") >= self.percent * (F.col("m1") + F.col("m2"))
        differ = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"b{i}_1").bitwiseXOR(F.col(f"b{i}_2"))) for i in range(NARROW)])
        alike = (100 + self.percent) * differ <= (100 - self.percent) * (F.col("m1") + F.col("m2"))
        return x.join(y, (x.shingle == y.shingle) & once & fit & alike).select(F.least("c1", "c2").alias("u"), F.greatest("c1", "c2").alias("v"))

    def _join(self, roots: DataFrame, found: DataFrame) -> DataFrame:
        return cut(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found)), "roots")


def _rooted_members(join: Join) -> DataFrame:
    """(doc, n, root) and the mark, if there is one, of each row."""
    roots = join.classes()
    return cut(join.members.join(roots, F.col("cls") == F.col("node"), "left").select("doc", "n", F.coalesce("root", "cls").alias("root"), *join.mark), "members")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """A row for each row of docs: id, n_shingles, component_id (the smallest id reachable by links)."""
    rows = _rooted_members(Join(docs, id_col, text_col, n, percent))
    # Written, so that the join with a large component's rows is one of two plain shuffles, which can be split.
    least = cut(rows.where("n > 0").groupBy(F.col("root").alias("r")).agg(F.min("doc").alias("least")), "least")
    out = rows.join(least, (F.col("root") == F.col("r")) & (F.col("n") > 0), "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay, one of each component: the one with the smallest id; rows without shingles all stay.

    Null ids come last, equal ids go by a 64-bit hash of their texts; of rows equal in both any one stays.
    """
    rows = _rooted_members(Join(docs, id_col, text_col, n, percent, marked=True)).where("n > 0")
    key = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "mark")
    least = cut(rows.groupBy(F.col("root").alias("r")).agg(F.min(key).alias("least")), "least")  # as in ngram_components
    keyed = rows.join(least, F.col("root") == F.col("r")).groupBy("doc", "mark").agg(F.min(key == F.col("least")).alias("stays"), F.count(F.lit(1)).alias("copies"))
    told = cut(keyed.where("NOT stays OR copies > 1").select(F.col("doc").alias("__te_d"), F.col("mark").alias("__te_m"), "stays"), "told")
    held = docs.select("*", F.col(id_col).cast("long").alias("__te_doc"), mark_of(text_col).alias("__te_mark"))
    same = F.col("__te_doc").eqNullSafe(F.col("__te_d")) & (F.col("__te_mark") == F.col("__te_m"))
    kept = held.join(told.drop("stays"), same, "left_anti")
    again = told.where("stays")
    if not again.isEmpty():
        kept = kept.union(held.join(again.drop("stays"), same, "left_semi").dropDuplicates(["__te_doc", "__te_mark"]))
    return kept.drop("__te_doc", "__te_mark")
