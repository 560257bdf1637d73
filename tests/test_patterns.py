import random
import re

import pytest
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import profile as P
from textengine.functions.patterns import WS, alternatives, any_java, any_literal, first_of, java, lower_case_alone, outside, runs_outside, width

SLOW = re.compile(r"\[\^(?![^\]\\]\]|\\.\])")  # a negated class of more than one part: ten times as long in Java


def column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", f(F.col("x")).alias("y"))
    return [r.y for r in rows.orderBy("i").collect()]


CHARACTERS = [chr(c) for c in [*range(0x250), *range(0xCF0, 0xD90), *range(0x1FF0, 0x2070), 0x20B9, 0x2FFF, 0x3000, 0x3001, 0xD7FF, 0xE000, 0xFEFF, 0xFFFD, 0x10000, 0x1F600, 0x10FFFF]]


@pytest.mark.parametrize("inside", [P.ALLOWED, WS, P.NATIVE, "A-Za-z" + P.NATIVE, P.BASES, r"\x20\x09-\x0D", r"\-\]a", "a"])
def test_outside_is_the_negated_class(spark, inside):
    quoted = [c for c in CHARACTERS if c != "\0"]
    want = column(spark, quoted, lambda x: x.rlike(f"[^{inside}]"))
    assert column(spark, quoted, lambda x: x.rlike(outside(inside))) == want
    assert column(spark, quoted, lambda x: x.rlike(runs_outside(inside))) == want
    assert column(spark, ["".join(quoted)], lambda x: F.regexp_replace(x, runs_outside(inside), "")) == ["".join(c for c, w in zip(quoted, want, strict=True) if not w)]


def test_no_slow_class_is_left():
    for inside in (P.ALLOWED, WS, "A-Za-z" + P.NATIVE):
        assert not SLOW.search(runs_outside(inside))
    for patterns, fold in ((P.STANDALONE_PATTERNS, True), (P.MASTER_PATTERNS, True), (list(P.WIKI.values()), False)):
        assert not any(SLOW.search(p) for p in any_java(patterns, fold))
    assert SLOW.search(f"[^{P.ALLOWED}]")


def test_width():
    assert width(P.NATIVE) == 3 and width("a-z") == 1 and width("a-z" + P.NATIVE) is None and width(r"\p{L}") is None


def test_ratios(spark):
    lines = ["", "abc", "കa", "ക ക 1", "123", "കൂടുതൽ വായിക്കുക x", "日本"]
    n = lambda s: sum("\u0d00" <= c <= "\u0d7f" for c in s)
    a = lambda s: n(s) + sum(c.isascii() and c.isalpha() for c in s)
    assert column(spark, lines, T.native_ratio) == [n(s) / a(s) if a(s) else 0.0 for s in lines]
    assert column(spark, lines, T.letter_ratio) == [a(s) / len(s) if s else 0.0 for s in lines]


def test_keywords_are_found_as_in_lower_case(spark):
    rng = random.Random(5)
    fold = lambda w: "".join(rng.choice([c, c.upper(), "\u212a" if c == "k" else c, "\u017f" if c == "s" else c, "İ" if c == "i" else c, "ı" if c == "i" else c]) for c in w)
    lines = ["".join(fold(rng.choice(P.MASTER_KEYWORDS + P.STANDALONE_KEYWORDS)[: rng.choice([2, 5, 99])]) + rng.choice(["", " ", "x"]) for _ in range(2)) for _ in range(3000)]
    lower = column(spark, lines, F.lower)
    for profile in (P.MASTER, P.STANDALONE):
        want = [any(k in x for k in profile.keywords) for x in lower]
        assert True in want and False in want and column(spark, lines, lambda x, p=profile: T.has_keyword(x, p)) == want
    assert column(spark, ["SKİ", "ski", "ΑΣ"], lambda x: T.has_keyword(x, P.Profile(keywords=["ski", "ας"]))) == [True, True, True]
    assert not lower_case_alone(["ski"]) and not lower_case_alone(["Ad"]) and lower_case_alone(P.MASTER_KEYWORDS)
    assert any_literal([]) == "(?!)"


def test_any_java_finds_what_each_does(spark):
    rng = random.Random(6)
    parts = ["|", " ", "a", "1", "12", "2019", "-", "[", "]", "/", "~", "ക", "px", "http://", "HTTPS://", "$", "\\", "%", "{", "+", "© ", "Copyright ", "ALL RIGHTS reſerved", "all", " Rights", "+91 98765", "upright =", "alt=", "C:\\", "(Hindi)", "sTub", "/usr/", "\n"]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(2500)]
    for patterns, fold in ((P.STANDALONE_PATTERNS, True), (P.MASTER_PATTERNS, True), ([p for n, p in P.WIKI.items() if n != "spaces"], False), ([P.WIKI["stub"]], True), (P.NOISE_SCAN, False)):
        each = [column(spark, lines, lambda x, p=p, f=fold: x.rlike(java(p, f))) for p in patterns]
        assert column(spark, lines, lambda x, p=patterns, f=fold: T.has_any(x, p, f)) == [any(e) for e in zip(*each, strict=True)]
    assert len(any_java(P.MASTER_PATTERNS, True)) == 2 and all(p.startswith(("(?diu)^", "(?diu)(?=")) for p in any_java(P.MASTER_PATTERNS, True))


def test_alternatives_and_firsts():
    assert alternatives(r"a|(b|c)|[|]|\|d") == ["a", "(b|c)", "[|]", r"\|d"]
    assert [first_of(x) for x in ("ab", "a?b", "[ab]c", "[^a]", r"\d+", r"\+1", "(a)", "", r"\Sa", "^a", "-a")] == ["a", None, "ab", None, r"\d", r"\+", None, None, None, None, r"\-"]
