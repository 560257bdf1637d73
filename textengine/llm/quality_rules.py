"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

A base rule fails documents outright. Beyond it each rule of RULES scores a document with an integer
per mille. The rules' cutoffs go down together, from the most lenient to the strictest (LEVELS steps),
so a level is one vector of cutoffs, one for each rule, and rejects a document with any score above
its rule's. Which level holds comes from a labelled holdout: in each stratum the levels are tested in this
order, and a level is certified while the exact binomial tail P(Bin(n, risk) <= rejected good documents)
stays within the stratum's share of `delta`; the first failure ends the chain (fixed-sequence testing
needs no correction inside a chain). `delta` is divided by the number of strata (Bonferroni). So with
probability 1 - delta the cutoffs reject at most `risk` of the good documents of every stratum. That
counts documents that the base rule keeps: what the base rule fails is fixed beforehand, and
no cutoff changes it; ``certified`` gives how many good documents it fails beside it (base_rejected). A
stratum with too few labels (ln(delta / strata) / ln(1 - risk) good ones at least) gets no cutoffs and
keeps all that the base rule keeps.

The `max_strata` strata with most labels have cutoffs of their own and the others share those of one
pooled stratum, so the broadcast table of cutoffs has at most max_strata + 1 rows.

Defined results: a null text has no words, and fails; null strata are in the pooled stratum; labels of
unknown documents or null labels don't count; repeated labels count once for each row, and repeated
documents are each judged; a score equal to its cutoff passes; an empty table gives an empty table, and
without labels the base rule alone decides. Other columns pass by, whatever their names, but for names
that begin with __te_.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textengine.llm.common import NOT_WS, WS, cut, let, words_of

#: Rule: the SQL of its score, an integer per mille, and the score that the shares of STEPS are taken of.
RULES = {
    "symbols": ("1000 * n_symbols div word_chars", 500),
    "dup_lines": ("1000 * n_dup_lines div n_lines", 1000),
    "repeats": ("1000 * n_repeat_words div n_words", 1000),
    "capitals": ("1000 * n_capitals div word_chars", 1000),
    "shouts": ("1000 * n_shouts div n_words", 500),
}
#: Of each level, per mille, the most lenient first.
STEPS = [900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50, 30]
LEVELS = len(STEPS)
RISK, DELTA, MAX_STRATA, POOLED = 0.01, 0.05, 256, "*"


def cutoffs(rule: str) -> list[int]:
    """The rule's cutoffs, level by level."""
    return [step * RULES[rule][1] // 1000 for step in STEPS]


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that the array holds twice or more, each word once.

    Equal windows have equal hashes, so a text whose window hashes all differ has none; only the others
    sort their windows as text, which settles them exactly.
    """

    def window(w: Column, i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("p"))

    def covered(starts: Column) -> Column:  # ascending starts of repeated windows
        steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    def starts(s: Column) -> Column:  # of the sorted windows, those with an equal neighbour
        at = F.transform(s, lambda x, j: F.when((x["g"] == F.get(s, j - 1)["g"]) | (x["g"] == F.get(s, j + 1)["g"]), x["p"]))
        return F.array_sort(F.filter(at, lambda p: p.isNotNull()))

    def exact(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))
        return let(F.sort_array(every), lambda s: let(starts(s), covered))

    def run(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, 0).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact(w))))

    return let(words, run).cast("long")


def duplicate_lines(lines: Column) -> Column:
    """Lines of the array that equal an earlier one."""
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the counts of the base rule and of RULES; the columns are new or replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_WS))
    without = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")
    counts = let(words_of(F.col(text_col)), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), duplicate_lines(x).alias("d")))
    out = docs.withColumns(
        {
            "__te_w": counts,
            "__te_l": line_counts,
            "word_chars": F.length(F.regexp_replace(text, WS + "+", "")).cast("long"),
            "n_symbols": without(r"[#*$%&|<>]+"),
            "n_capitals": without(r"\p{Lu}+"),
            "n_shouts": without(r"!+"),
        }
    )
    out = out.withColumns({"n_words": F.col("__te_w.n"), "n_repeat_words": F.col("__te_w.r"), "n_lines": F.col("__te_l.n"), "n_dup_lines": F.col("__te_l.d")})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.drop("__te_w", "__te_l").withColumn("base_failed", failed)


def levels_passed() -> Column:
    """At how many levels a document passes: as cutoffs only go down, these are the first ones."""
    fits = [f"if(n_words > 0, {sql}, 0) <= element_at(array({', '.join(map(str, cutoffs(rule)))}), l)" for rule, (sql, _) in RULES.items()]
    return F.expr(f"size(filter(sequence(1, {LEVELS}), l -> {' AND '.join(fits)}))")


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z >= 1, by Stirling's series at z + 8."""
    x = z + 8
    product = reduce(lambda a, b: a * b, [z + i for i in range(8)])
    return (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k <= n p (else null): the terms fall from k down, and are added until they vanish."""
    kd, nd, odds = k.cast("double"), n.cast("double"), (1 - p) / p
    top = log_gamma(nd + 1) - log_gamma(kd + 1) - log_gamma(nd - kd + 1) + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(1 - p))
    steps = F.sequence(F.lit(0), F.least(k, (40 * F.sqrt(nd * p) + 50).cast("long")))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    added = F.aggregate(steps, start, lambda s, i: F.struct((s["term"] * (kd - i) / (nd - kd + i + 1) * odds).alias("term"), (s["sum"] + s["term"]).alias("sum")), lambda s: s["sum"])
    return F.when((n > 0) & (kd <= nd * p), F.exp(top) * added)


def certified(scored: DataFrame, labels: DataFrame, id_col: str, risk: float, delta: float, max_strata: int) -> DataFrame:
    """(stratum, n_good, base_rejected, level: of how many levels the last is certified, 0 for none) from id, stratum, passed, base_failed."""
    good = (
        labels.where("quality = 1")
        .select(F.col(id_col).alias("__te_label"))
        .join(scored, F.col(id_col) == F.col("__te_label"))
        .groupBy(F.coalesce("stratum", F.lit(POOLED)).alias("stratum"), F.when(~F.col("base_failed"), F.col("passed")).alias("passed"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    good = cut(good, "good")  # a row for each stratum and level
    own = good.where((F.col("stratum") != POOLED) & F.col("passed").isNotNull()).groupBy("stratum").agg(F.sum("n").alias("n_good")).orderBy(F.desc("n_good"), "stratum").limit(max_strata)
    named = good.join(F.broadcast(own.select(F.col("stratum").alias("own"))), F.col("stratum") == F.col("own"), "left").withColumn("stratum", F.coalesce("own", F.lit(POOLED)))
    rejected = F.array(*[F.coalesce(F.sum(F.when(F.col("passed") < level, F.col("n"))), F.lit(0)) for level in range(1, LEVELS + 1)])
    of = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    sums = named.groupBy("stratum").agg(of(F.col("passed").isNotNull()).alias("n_good"), of(F.col("passed").isNull()).alias("base_rejected"), rejected.alias("rejected"))
    sums = sums.crossJoin(F.broadcast(sums.agg(F.count(F.lit(1)).alias("n_strata"))))  # one row beside at most max_strata + 1
    holds = F.transform("rejected", lambda k: F.coalesce(binomial_tail(k, F.col("n_good"), risk) <= delta / F.col("n_strata"), F.lit(False)))
    first_failure = F.array_position(holds, F.lit(False))
    level = F.when(first_failure > 0, first_failure - 1).otherwise(F.lit(LEVELS))
    return sums.select("stratum", "n_good", "base_rejected", level.cast("int").alias("level"))


def _judged(scored: DataFrame, found: DataFrame) -> DataFrame:
    """scored with level and kept, from its stratum, passed and base_failed."""
    found = cut(found.select(F.col("stratum").alias("__te_of"), F.col("level").alias("__te_own")), "certified")
    pooled = found.where(F.col("__te_of") == POOLED).agg(F.coalesce(F.max("__te_own"), F.lit(0)).alias("__te_pooled"))
    rows = scored.join(F.broadcast(found), F.col("stratum") == F.col("__te_of"), "left").crossJoin(F.broadcast(pooled))
    rows = rows.withColumn("level", F.coalesce("__te_own", "__te_pooled")).drop("__te_of", "__te_own", "__te_pooled")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("passed") >= F.col("level")))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", risk: float = RISK, delta: float = DELTA, max_strata: int = MAX_STRATA) -> DataFrame:
    """A row for each row of docs: id, counts, base_failed, stratum, passed (levels), level (its stratum's certified one, 0 for none), kept."""
    narrow = docs.select(F.col(id_col).alias(id_col), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("__te_text"))
    scored = cut(base_metrics(narrow, "__te_text").drop("__te_text").withColumn("passed", levels_passed()), "quality")
    return _judged(scored, certified(scored, labels, id_col, risk, delta, max_strata))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", risk: float = RISK, delta: float = DELTA, max_strata: int = MAX_STRATA) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    Every text is scored once: the rows are written with their levels, the certification reads the narrow
    columns of them, and the verdict is a filter when they are read again. No text is shuffled.
    """
    rows = docs.select(F.struct("*").alias("__te_row"), F.col(text_col).alias("__te_text"), F.col(id_col).alias("__te_id"), F.col(stratum_col).cast("string").alias("stratum"))
    scored = base_metrics(rows, "__te_text").withColumn("passed", levels_passed()).select("__te_row", "__te_id", "stratum", "passed", "base_failed")
    scored = cut(scored, "scored")
    named = labels.select(F.col(id_col).alias("__te_id"), "quality")
    return _judged(scored, certified(scored.drop("__te_row"), named, "__te_id", risk, delta, max_strata)).where("kept").select("__te_row.*")
