"""Substring dedup with suffix automata of reference shards.

A window is WINDOW consecutive words of one document. Every word that a window covers whose words also
start earlier (a smaller id, or earlier in the same document) is removed. Suffix automata over words
decide that: documents are streamed through the automaton of the reference passages that they can repeat,
and where the matching statistic reaches the window's length, the automaton's first position of the
match says whether it lies before.

Automata of the whole corpus against the whole corpus would take time with its square, so anchors route
each stretch to the one shard that matters. Each window's anchor is the smallest hash among its runs of
ANCHOR words (a minimizer), so equal windows have equal anchors. Anchors seen once end there. Of those
seen again, each distinct context (all words of the windows that the anchor stands for) has a first
occurrence; the passages of first occurrences are the references, in shards by document, and the other
occurrences are streamed through the shard of theirs. Contexts of one anchor that differ (where copies
begin, end or were edited) meet in a shard of that anchor, each streamed before it is added. A shard's
automaton goes only to the tasks that stream its documents, which is its broadcast: a shard has about
SHARD_WORDS words whatever the input, and queries of a shard with many are dealt over several tasks,
each with the automaton.

Anchors that many documents have (a common passage) are dealt over tasks by context and document: what is
first in its share is a reference of its own, and the first ones of all shares meet in the anchor's own
shard, where all but the earliest find an earlier one. So no task sorts all places of a hot anchor. Which
anchors are hot is estimated on one in HOT_SAMPLE documents; it moves work only, any choice gives the same
spans.

Defined results: a null text has no words; null ids come before all others, in an order of their texts'
hashes; rows with the same id are told apart by a hash of their texts (HASH_BITS bits, 62 for null ids), and
repeated rows are one document, each with its result; an empty table gives an empty table; only the
columns for ids and texts are read, so names of others don't matter. Ids are above -2^62.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textengine.llm.common import cut, partitions
from textengine.llm.wordhash import mix, powers, runs, slices

WINDOW, ANCHOR = 20, 8
SHARD_WORDS, DEALT_WORDS = 60_000, 2_000_000
#: A place packs 19 bits of the text's hash, the anchor's word, how far before it its first window starts, its windows.
HASH_BITS, LEFT_BITS, MANY_BITS = 19, 5, 5
WORD_SHIFT = LEFT_BITS + MANY_BITS
HASH_SHIFT = 63 - HASH_BITS
#: Anchors dealt out: how many at most, how often in the sample at least, into how many shares of documents.
HOT, HOT_SAMPLE, HOT_LEAST, HOT_SHARES = 1024, 16, 32, 16
NULL_IDS = -(1 << 62)


class Automaton:
    """Suffix automaton over words, with each state's first end position; passages are kept apart."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.last, self.size, self.where = 0, 0, []

    def add(self, words: list, place: tuple) -> None:
        """A passage whose first word is at place (document key, word); passages come in ascending order."""
        self.where.append((self.size, place))
        nxt, link, length, first, last, at = self.next, self.link, self.length, self.first, self.last, self.size
        for w in [*words, -len(self.where)]:  # the separator differs from all words and other separators
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            first.append(at)
            link.append(0)
            p = last
            while p != -1 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][w]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    first.append(first[q])
                    link.append(link[q])
                    link[q] = link[cur] = clone
                    while p != -1 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
            last, at = cur, at + 1
        self.last, self.size = last, at

    def place(self, position: int) -> tuple:
        """(document key, word) of a position."""
        lo, hi = 0, len(self.where)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if self.where[mid][0] <= position:
                lo = mid
            else:
                hi = mid
        start, (key, word) = self.where[lo]
        return key, word + position - start

    def earlier(self, words: list, place: tuple, window: int) -> list[int]:
        """Starts in words of the windows whose words are in a passage before their own place, by matching statistics."""
        nxt, link, length = self.next, self.link, self.length
        key, offset = place
        state = matched = 0
        out, known = [], {}
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                matched = min(matched, length[state])
                start = self.first[state] - window + 1
                found = known.get(start) or known.setdefault(start, self.place(start))
                if found < (key, offset + i - window + 1):
                    out.append(i - window + 1)
        return out


def spans(starts: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal runs of words under the windows at ascending starts, as (first word, one past the last)."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + window)
        else:
            out.append([s, s + window])
    return [(a, b) for a, b in out]


def anchors(w, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Of a slice's windows: each different anchor's hash, text, word, first window, number of windows and context hash."""
    h = w.hashes()
    grams, n = runs(h, k), len(h) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    starts = np.flatnonzero(w.doc[:n] == w.doc[window - 1 :])
    if not len(starts):
        return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)
    at = sliding_window_view(grams, window - k + 1)[starts].argmin(1) + starts
    edge = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    many = np.diff(np.append(edge, len(starts)))
    lo, word = starts[edge], at[edge]
    # The context's hash: its words' hashes weighted by their places in it.
    up, down = powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(h * up[: len(h)], out=sums[1:])
        context = mix((sums[lo + many + window - 1] - sums[lo]) * down[lo] + many.astype(np.uint64) * np.uint64(0x51ED270B) + (word - lo).astype(np.uint64))
    return grams[word], w.doc[lo], word, lo, many, context


def _key_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text): doc is the id, or for null ids a hash below all ids."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = F.xxhash64(text)
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(2 * NULL_IDS) + F.shiftrightunsigned(hashed, 2))
    return docs.select(doc.alias("doc"), F.pmod(hashed, F.lit(1 << HASH_BITS)).alias("th"), text.alias("text"))


def _anchor_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, to, w in slices(batch.column(2)):
                a, d, word, lo, many, context = anchors(w, window, k)
                place = (th[at:to][d] << HASH_SHIFT) | ((word - w.first[d]) << WORD_SHIFT) | ((word - lo) << MANY_BITS) | many
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc[at:to][d]), pa.array(place)], ["a", "s", "doc", "place"])

    return run


def _stretches(window: int, k: int, shards: int):
    """Rows (doc, th, text, marks) -> stretches for the shards; neighbouring windows of a kind and shard are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ths, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            bounds = marks.offsets.to_numpy()
            places, refs, kinds = (marks.values.field(j).to_numpy() for j in range(3))
            low = places & ((1 << HASH_SHIFT) - 1)
            word, many = low >> WORD_SHIFT, low & ((1 << MANY_BITS) - 1)
            lo = word - ((low >> MANY_BITS) & ((1 << LEFT_BITS) - 1))
            for at, to, w in slices(batch.column(2)):
                grams, data = runs(w.hashes(), k), w.data.tobytes()
                rows: list[list] = []
                for i in range(at, to):
                    mine, begin = slice(bounds[i], bounds[i + 1]), int(w.first[i - at])
                    order = np.lexsort((lo[mine], kinds[mine])) + bounds[i]
                    for t, r, start, m, p in zip(kinds[order].tolist(), refs[order].tolist(), lo[order].tolist(), many[order].tolist(), word[order].tolist(), strict=True):
                        shard, end = int(grams[begin + p].view(np.int64)) if t == SEVERAL else r % shards, start + m + window - 1
                        before = rows[-1] if rows else None
                        if t != SEVERAL and before and before[:4] == [t, shard, i, True] and start <= before[5] - window + 1:
                            before[5] = end
                        else:
                            rows.append([t, shard, i, True, start, end])
                if rows:
                    columns = [[r[0] for r in rows], [r[1] for r in rows], [keys[r[2]] for r in rows], [ths[r[2]] for r in rows], [r[4] for r in rows]]
                    columns.append([data[w.start[w.first[r[2] - at] + r[4]] : w.end[w.first[r[2] - at] + r[5] - 1]] for r in rows])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)], NAMES)

    return run


#: Kinds of stretches: the first of its context, a later one, the first of one of several contexts of its anchor.
FIRST, LATER, SEVERAL = 0, 1, 2
NAMES = ["kind", "shard", "doc", "th", "lo", "words"]
KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
STRETCH = "kind int, shard long, doc long, th long, lo long, words binary"


def _judge(window: int):
    """Stretches in order of shard, then references before queries -> removed spans (doc, th, first, past)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton = None, Automaton()
        for batch in batches:
            own, shard, deal, kind, doc, th, lo = (batch.column(i).to_pylist() for i in range(7))
            found: list[tuple] = []
            for i, words in enumerate(batch.column(7).to_pylist()):
                which = (own[i], shard[i], deal[i])
                if which != now:
                    now, automaton = which, Automaton()
                words, place = words.split(), ((doc[i], th[i]), lo[i])
                if kind[i] != FIRST:
                    starts = automaton.earlier(words, place, window)
                    found += [(doc[i], th[i], lo[i] + a, lo[i] + b) for a, b in spans(starts, window)]
                    if kind[i] == SEVERAL and len(starts) < len(words) - window + 1:
                        automaton.add(words, place)
                else:
                    automaton.add(words, place)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["doc", "th", "first", "past"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, spans gone) -> what is left of each document."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            n_words, n_removed, digests, texts = [], [], [], []
            for text, gone in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = text.encode().split()
                n_words.append(len(words))
                if gone:
                    stay = np.ones(len(words), bool)
                    for g in gone:
                        stay[g["first"] : g["past"]] = False
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                kept = b" ".join(words)
                n_removed.append(n_words[-1] - len(words))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())], ["doc", "n_words", "n_removed", "kept_sha256", "kept_text"])


ANCHOR_ROW = "a long, s long, doc long, place long"


def hot_anchors(keyed: DataFrame, window: int, k: int, least: int = HOT_LEAST) -> list[int]:
    """At most HOT anchors that many places of the sample have."""
    sample = keyed.where(F.pmod(F.xxhash64("doc", "th"), F.lit(HOT_SAMPLE)) == 0).mapInArrow(_anchor_rows(window, k), ANCHOR_ROW)
    counts = sample.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return [r.a for r in counts.orderBy(F.desc("n"), "a").limit(HOT).collect()]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = ANCHOR, hot_least: int = HOT_LEAST) -> DataFrame:
    """A row for each row of docs: id, n_words, n_removed, kept_sha256, kept_text (words joined by one space)."""
    spark = docs.sparkSession
    n = partitions(spark)
    keyed = _key_columns(docs, id_col, text_col)
    hot = hot_anchors(keyed, window, k, hot_least)
    dealt_out = F.col("a").isin(hot) if hot else F.lit(False)
    share = F.when(dealt_out, F.xxhash64(F.col("s"), F.pmod(F.xxhash64("doc"), F.lit(HOT_SHARES)))).otherwise(F.lit(0).cast("long"))
    rows = keyed.mapInArrow(_anchor_rows(window, k), ANCHOR_ROW).withColumn("share", share).repartition(n, "a", "share")
    # One exchange and one sort serve both windows. They hold no group in memory beyond what spills.
    of_anchor, of_context = Window.partitionBy("a", "share"), Window.partitionBy("a", "share", "s").orderBy("doc", "place")
    ranked = rows.select("*", F.row_number().over(of_context).alias("nth"), F.first("doc").over(of_context).alias("ref"))
    ranked = ranked.select("*", F.when(F.col("share") != 0, 2).otherwise(F.count(F.lit(1)).over(of_anchor)).alias("n"), ((F.col("share") != 0) | (F.min("s").over(of_anchor) != F.max("s").over(of_anchor))).alias("several"))
    kinds = F.when(F.col("nth") > 1, F.array(F.lit(LATER))).when(F.col("several"), F.array(F.lit(FIRST), F.lit(SEVERAL))).otherwise(F.array(F.lit(FIRST)))
    seen = ranked.where("n > 1").select("doc", F.shiftright("place", HASH_SHIFT).alias("th"), "place", "ref", F.explode(kinds).alias("kind"))
    seen = cut(seen, "repeated")
    many = F.col("place").bitwiseAND(F.lit((1 << MANY_BITS) - 1))
    words = seen.where(F.col("kind") == FIRST).agg(F.sum(many)).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    marks = seen.groupBy(F.col("doc").alias("d"), F.col("th").alias("t")).agg(F.collect_list(F.struct("place", "ref", "kind")).alias("marks"))
    marked = keyed.join(marks, (F.col("doc") == F.col("d")) & (F.col("th") == F.col("t"))).select("doc", "th", "text", "marks")
    stretches = marked.mapInArrow(_stretches(window, k, shards), STRETCH)
    # Shards with many queries: their references go to each of their deals.
    busy = seen.where(F.col("kind") == LATER).groupBy(F.pmod("ref", F.lit(shards)).alias("b")).agg(F.ceil(F.sum(many) / DEALT_WORDS).alias("deals")).where("deals > 1")
    dealt = stretches.join(cut(busy, "busy"), (F.col("shard") == F.col("b")) & (F.col("kind") != SEVERAL), "left").withColumn("deals", F.coalesce("deals", F.lit(1)))
    to = F.when(F.col("kind") == FIRST, F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc", "lo"), F.col("deals"))))
    dealt = dealt.select((F.col("kind") == SEVERAL).alias("own"), "shard", F.explode(to).alias("deal"), "kind", "doc", "th", "lo", "words")
    judged = dealt.repartition(n, "own", "shard", "deal").sortWithinPartitions("own", "shard", "deal", F.col("kind") != FIRST, "doc", "th", "lo")
    gone = judged.mapInArrow(_judge(window), "doc long, th long, first long, past long")
    by_doc = gone.groupBy(F.col("doc").alias("d"), F.col("th").alias("t")).agg(F.collect_set(F.struct("first", "past")).alias("gone"))
    joined = keyed.join(by_doc, (F.col("doc") == F.col("d")) & (F.col("th") == F.col("t")), "left").select("doc", "text", "gone")
    kept = joined.mapInArrow(_kept, "doc long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return kept.select(F.when(F.col("doc") > NULL_IDS, F.col("doc")).alias(id_col), "n_words", "n_removed", "kept_sha256", "kept_text")
