r"""Personal data by weak supervision, in DataFrame operations only.

Base spans are what the four exact patterns of KINDS find and their checks pass; they always stay. Other
candidates come from looser shapes (written-out addresses, phone numbers without a plus, 13 to 15 digit
cards, long-form IPv6). Four labelers vote on every candidate, base spans included: a *shape* labeler
(the regex with its check), a *gazetteer* labeler (top-level domains, number ranges, issuer digits), a
*context* labeler (cue words before the span) and a *boundary* labeler (a span inside a longer token).
Expectation-maximisation over the at most 4 * 3^4 different vote patterns estimates each labeler's
reliability by kind without any labels. Their posteriors then train a final classifier, naive Bayes over
hashed features of the span and its surroundings (FEATURE_PLACES places, a bounded broadcast), which
scores each candidate; it does not see the votes. Candidates of at least `threshold` that touch no base
span are added.

The patterns are written so that none takes quadratic time on long runs: a run that a match cannot leave
is entered at its start, or where the match before ended (\G), and quantifiers that never need to give
back are possessive. Both leave the matches as they are.

Defined results: null text counts as empty and has no spans; repeated rows each get a row; without any
candidate beyond the base nothing is trained away: the base spans are the result. An empty table gives an
empty table; other columns don't matter, whatever their names. A text is whole in a task; comparing its
looser candidates with its base spans takes a step for each pair of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textengine.llm.common import cut, let

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns; what they match is fixed by the contract of the operator.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser shapes: kind and pattern.
LOOSE = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z.+-])[0-9](?:[\x20-]?[0-9]){12,14}(?![\x20-]?[0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z.+)(-])(?:\([0-9]{2,4}\)\x20?|00[0-9]{1,3}[\x20.-]?[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])"),
]
#: Cheap conditions that a text with a match always meets.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
#: Word lists of the labelers.
CUES = {
    "email": r"(?i)(?:mail|contact|write|reply|courriel|correo|kontakt|from:|to:)",
    "ip": r"(?i)(?:\bip\b|addr|host|server|login|visitor|client|peer)",
    "card": r"(?i)(?:card|visa|master|amex|credit|debit|carte|karte|tarjeta|payment)",
    "phone": r"(?i)(?:tel|phone|call|mobile|fax|cell|whatsapp|numéro|telefon|móvil)",
}
ANTI_CUES = r"(?i)(?:version|release|isbn|issn|doi|order|invoice|ticket|serial|model|page|section|chapter|rfc|token|commit|hash)\W{0,3}$"
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|info|biz|io|co|de|fr|es|uk|us|eu|ch|at|it|nl|be|ca|au|in|br|mx|jp)$"
LEFT, RIGHT, FEATURE_PLACES, EM_STEPS, THRESHOLD, BLOCK = 40, 12, 4096, 30, 0.95, 128


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, text>> of the leftmost non-overlapping matches; start in code points from 0.

    Starts are running sums, made in blocks so that a text of n matches takes n * BLOCK + (n / BLOCK)^2 steps.
    """

    def block(pairs: Column, i: Column) -> Column:
        """Of BLOCK gaps and matches: their characters, and the matches with their starts in the block."""
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,text:string>>").alias("out"))

        def step(s: Column, x: Column) -> Column:
            begin = s["at"] + F.length(x["gap"])
            one = F.struct(begin.alias("start"), x["found"].alias("text"))
            return F.struct((begin + F.length(x["found"])).alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

        return F.aggregate(F.slice(pairs, i * BLOCK + 1, F.lit(BLOCK)), start, step)

    def placed(blocks: Column) -> Column:
        def shifted(b: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(blocks, F.lit(1), i), F.lit(0).cast("long"), lambda s, x: s + x["at"])
            return let(before, lambda n: F.transform(b["out"], lambda m: F.struct((m["start"] + n).alias("start"), m["text"].alias("text"))))

        return F.flatten(F.transform(blocks, shifted))

    def positions(both: Column) -> Column:
        pairs = F.zip_with(F.slice(both["gaps"], 1, F.size(both["found"])), both["found"], lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
        numbers = F.sequence(F.lit(0), F.floor((F.size(both["found"]) - 1) / BLOCK).cast("int"))
        return let(pairs, lambda p: let(F.transform(numbers, lambda i: block(p, i)), placed))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(found, lambda b: F.when(F.size(b["found"]) > 0, positions(b)).otherwise(F.array().cast("array<struct<start:long,text:string>>")))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """The check that a match of the base pattern passes."""
    if kind == "ip":
        # Leading zeros, then a number from 1 to 255, or zeros alone: no two ways to read a part.
        byte = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
        return text.rlike(rf"^{byte}(?:\.{byte}){{3}}$")
    if kind == "card":
        return let(digits(text), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(text)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """array<struct<start, text>> of the base spans of a kind."""
    meets = text.contains(NEEDS[kind]) if kind in NEEDS else F.lit(True)
    if kind != "email":
        meets = meets & text.rlike("[0-9]")
    none = F.array().cast("array<struct<start:long,text:string>>")
    return F.when(meets, F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["text"]))).otherwise(none)


def _votes(kind: Column, text: Column, left: Column, right: Column, base: Column) -> Column:
    """array of four votes, 0 no, 1 abstains, 2 yes: shape, gazetteer, context, boundary."""
    n = digits(text)
    shape = F.when(base, 2).when(kind == "card", F.when(luhn(n), 2).otherwise(0)).when(kind == "phone", F.when(F.length(n).between(8, 15), 2).otherwise(0)).otherwise(1)
    dots = F.regexp_replace(text, r"\x20?[\[(]dot[\])]\x20?", ".")
    gazetteer = (
        F.when(kind == "email", F.when(dots.rlike(DOMAINS), 2).otherwise(1))
        .when(kind == "ip", F.when(text.rlike(r"^(?:0|127|255)\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"), 0).otherwise(2))
        .when(kind == "card", F.when(n.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|62|35)"), 2).otherwise(0))
        .otherwise(F.when(n.rlike("^([0-9])\\1*$"), 0).when(text.rlike(r"^(?:\+|00|\()"), 2).otherwise(1))
    )
    cue = F.coalesce(*[F.when(kind == k, left.rlike(c)) for k, c in CUES.items()])
    context = F.when(left.rlike(ANTI_CUES), 0).when(cue, 2).otherwise(1)
    boundary = F.when(left.rlike(r"[\p{L}\p{N}_@/=.-]$") | right.rlike(r"^[\p{L}\p{N}_@/=]"), 0).otherwise(2)
    return F.array(shape, gazetteer, context, boundary)


def _em(patterns: Column) -> Column:
    """patterns: array<struct<n, v array<int>>> -> array of posteriors, by Dawid-Skene with Laplace smoothing."""
    fit = f"""
    aggregate(sequence(1, {EM_STEPS}),
      named_struct('pi', 0.5D,
        'yes', flatten(array_repeat(array(0.1D, 0.3D, 0.6D), 4)),
        'no', flatten(array_repeat(array(0.6D, 0.3D, 0.1D), 4))),
      (s, step) -> transform(array(transform(p, x -> named_struct('n', x.n, 'v', x.v, 'q', {{post}}))), e ->
        named_struct(
          'pi', (aggregate(e, 0D, (a, x) -> a + x.n * x.q) + 1D) / (aggregate(e, 0D, (a, x) -> a + x.n) + 2D),
          'yes', transform(sequence(0, 11), j -> (aggregate(e, 0D, (a, x) -> a + if(x.v[int(j div 3)] = j % 3, x.n * x.q, 0D)) + 1D + if(j % 3 = 2, 1D, 0D)) / (aggregate(e, 0D, (a, x) -> a + x.n * x.q) + 4D)),
          'no', transform(sequence(0, 11), j -> (aggregate(e, 0D, (a, x) -> a + if(x.v[int(j div 3)] = j % 3, x.n * (1D - x.q), 0D)) + 1D + if(j % 3 = 0, 1D, 0D)) / (aggregate(e, 0D, (a, x) -> a + x.n * (1D - x.q)) + 4D))
        ))[0],
      s -> transform(p, x -> {{post}}))
    """
    yes = "s.pi * s.yes[x.v[0]] * s.yes[3 + x.v[1]] * s.yes[6 + x.v[2]] * s.yes[9 + x.v[3]]"
    no = "(1D - s.pi) * s.no[x.v[0]] * s.no[3 + x.v[1]] * s.no[6 + x.v[2]] * s.no[9 + x.v[3]]"
    return F.transform(F.array(patterns), lambda _: F.expr(fit.format(post=f"({yes}) / ({yes} + {no})")))[0]


def _features(kind: Column, text: Column, left: Column, right: Column) -> Column:
    """Places of the final classifier's features: hashed shape, length, surroundings and words before."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[0-9]+", "9"), "[A-Za-z]+", "a"), "(?:9[^0-9a]?)+", "9")
    last_words = F.slice(F.reverse(F.filter(F.split(F.lower(left), r"[^\p{L}]+"), lambda w: w != "")), 1, 2)
    raw = F.concat(
        F.array(
            F.concat(F.lit("s:"), shape),
            F.concat(F.lit("n:"), F.length(text).cast("string")),
            F.concat(F.lit("l:"), F.substring(left, -1, 1)),
            F.concat(F.lit("r:"), F.substring(right, 1, 1)),
        ),
        F.transform(last_words, lambda w: F.concat(F.lit("w:"), w)),
    )
    return F.array_distinct(F.transform(raw, lambda f: F.pmod(F.xxhash64(kind, f), F.lit(FEATURE_PLACES)).cast("int")))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row_no, id, spans) for each row of docs, and (row_no, kind_no, start, end, base, v: votes, f: places) for each candidate."""
    text = F.coalesce(F.col("__te_text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("id"), F.col(text_col).alias("__te_text"))

    def spans_of(found: Column, kind: str, base: bool) -> Column:
        return F.transform(
            found,
            lambda m: F.struct(
                F.lit(KINDS.index(kind)).alias("kind_no"),
                m["start"].alias("start"),
                (m["start"] + F.length(m["text"])).alias("end"),
                m["text"].alias("text"),
                F.substring(text, F.greatest(m["start"] - LEFT, F.lit(0)).cast("int") + 1, F.least(m["start"], F.lit(LEFT)).cast("int")).alias("left"),
                F.substring(text, (m["start"] + F.length(m["text"])).cast("int") + 1, F.lit(RIGHT)).alias("right"),
                F.lit(base).alias("base"),
            ),
        )

    # Most texts have nothing of the kind: one scan each for a digit or an @ settles those.
    loose_needs = {"email": text.rlike(r"[\[(]at[\])]"), "ip": text.contains(":"), "card": text.rlike("[0-9]"), "phone": text.rlike(r"\(|00")}
    none = F.array().cast("array<struct<start:long,text:string>>")
    arrays = [spans_of(base_spans(text, k), k, True) for k in KINDS]
    arrays += [spans_of(F.when(loose_needs[k], matches(text, p)).otherwise(none), k, False) for k, p in LOOSE]
    found = cut(rows.select("row_no", "id", F.concat(*arrays).alias("spans")), "spans")
    base = F.filter("spans", lambda s: s["base"])
    # A looser candidate that touches a base span is that span again, or a part of it.
    fresh = F.filter("spans", lambda s: ~s["base"] & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    spans = found.select("row_no", F.explode(F.concat(base, fresh)).alias("s")).select("row_no", "s.*").withColumn("kind", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1))
    args = [F.col(c) for c in ("kind", "text", "left", "right")]
    return found, cut(spans.select("row_no", "kind_no", "start", "end", "base", _votes(*args, F.col("base")).alias("v"), _features(*args).alias("f")), "votes")


def classifier(voted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k0, prior, ...) by kind and (k1, p1, w) by kind and place: log odds of the naive Bayes trained on the labelers' posteriors."""
    patterns = voted.groupBy("kind_no", "v").agg(F.count(F.lit(1)).alias("n"))
    by_kind = patterns.groupBy("kind_no").agg(F.sort_array(F.collect_list(F.struct(F.col("v"), F.col("n").cast("double").alias("n")))).alias("p"))
    posts = by_kind.select("kind_no", "p", _em(F.col("p")).alias("q")).select("kind_no", F.explode(F.arrays_zip("p", "q")).alias("x")).select(F.col("kind_no").alias("k"), F.col("x.p.v").alias("pv"), F.col("x.q").alias("q"))
    posts = F.broadcast(cut(posts, "posteriors"))
    weighted = voted.join(posts, (F.col("kind_no") == F.col("k")) & (F.col("v") == F.col("pv")))
    totals = weighted.groupBy("kind_no").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no"))
    odds = F.log((F.col("yes") + 1) / (F.col("no") + 1))
    prior = totals.select(F.col("kind_no").alias("k0"), odds.alias("prior"), "yes", "no")
    by_place = weighted.select("kind_no", "q", F.explode("f").alias("place")).groupBy("kind_no", "place").agg(F.sum("q").alias("fy"), F.sum(1 - F.col("q")).alias("fn"))
    places = by_place.join(F.broadcast(prior), F.col("kind_no") == F.col("k0")).select(
        F.col("kind_no").alias("k1"), F.col("place").alias("p1"), F.log((F.col("fy") + 0.5) / (F.col("yes") + 1) / ((F.col("fn") + 0.5) / (F.col("no") + 1))).alias("w")
    )
    return prior, cut(places, "features")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: id, base (array<struct<kind_no, start, end>>) and added (likewise, with p), in order."""
    found, voted = candidates(docs, id_col, text_col)
    prior, places = classifier(voted)
    places = F.broadcast(places)
    extra = voted.where("NOT base")
    scored = (
        extra.select("row_no", "kind_no", "start", "end", F.explode("f").alias("place"))
        .join(places, (F.col("kind_no") == F.col("k1")) & (F.col("place") == F.col("p1")))
        .groupBy("row_no", "kind_no", "start", "end")
        .agg(F.sum("w").alias("w"))
        .join(F.broadcast(prior.select("k0", "prior")), F.col("kind_no") == F.col("k0"))
        .withColumn("p", 1 / (1 + F.exp(-(F.col("w") + F.col("prior")))))
        .where(F.col("p") >= threshold)
    )
    added = scored.groupBy(F.col("row_no").alias("r")).agg(F.sort_array(F.collect_list(F.struct("kind_no", "start", "end", "p"))).alias("added"))
    base = F.filter("spans", lambda s: s["base"])
    short = F.transform(F.sort_array(F.transform(base, lambda s: F.struct(s["kind_no"].alias("kind_no"), s["start"].alias("start"), s["end"].alias("end")))), lambda s: s)
    out = found.select("row_no", "id", short.alias("base")).join(added, F.col("row_no") == F.col("r"), "left")
    return out.select(F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast("array<struct<kind_no:int,start:long,end:long,p:double>>")).alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
