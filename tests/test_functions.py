import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import profile as P
from textengine.functions import rewrite as R
from textengine.functions.patterns import WS, WS_CHARACTERS, any_literal, portable


def run(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", f(F.col("x")).alias("y"))
    return [r.y for r in rows.orderBy("i").collect()]


VISARGA = [("അന്തഃ", "അന്ത:"), ("അന്തഃ ശരി", "അന്ത: ശരി"), ("ദുഃഖം", "ദുഃഖം"), ("അന്തഃ.", "അന്തഃ."), ("ഃ\nഃ", ":\n:"), ("", "")]


def test_visarga(spark):
    assert run(spark, [a for a, _ in VISARGA], R.visarga_to_colon) == [b for _, b in VISARGA]


@pytest.mark.parametrize("table", [P.CHILLU_ZWJ])
def test_zwj(spark, table):
    assert run(spark, [k + P.VIRAMA + P.ZWJ + "x" for k in table], R.zwj_to_chillu) == [v + "x" for v in table.values()]


def test_wiki_lines(spark):
    cases = [
        ("This is a line [p] with [c] marks", "This is a line with marks"),
        ("Say /ai/ and /au/ out loud now", "Say and out loud now"),
        ("A /t~t/ marker in this long line", "A marker in this long line"),
        ("A clean line that stays as it is", "A clean line that stays as it is"),
        ("[] [] []", None), ("short", None), ("", None), ("| a | b |", None), ("== Short ==", None),
        ("== A heading long enough ==", "A heading long enough"),
        ("See [[other page|the page]] for it", "See the page for it"),
        ("12 January 2019", None), ("costs $5 only, a bargain", None), ("* item that is long enough", "item that is long enough"),
    ]
    assert run(spark, [a for a, _ in cases], lambda x: R.wiki_line(x, T.wiki_removed)) == [b for _, b in cases]


def test_labels(spark):
    cases = [
        ("", "remove_empty"), (" \t", "remove_empty"), ("Read More here", "remove_keyword"), ("see http://x.y/z", "remove_regex"),
        ("12 Jan 2019", "remove_regex"), ("abc", "remove_heuristic"), ("ഇത് ഒരു നല്ല വരിയാണ് എന്ന് ഞാൻ കരുതുന്നു", "keep"),
        ("a line of latin letters that is longer than thirty", "remove_heuristic"), ("+91 98765 43210", "remove_regex"),
    ]
    assert run(spark, [a for a, _ in cases], T.line_label) == [b for _, b in cases]


def test_stray_signs_match_a_state_machine(spark):
    rng = random.Random(1)
    signs = [chr(c) for c in [*range(0x0D3E, 0x0D4E), 0x0D57]]
    bases = {chr(c) for c in [*range(0x0D15, 0x0D3A), *range(0x0D7A, 0x0D80)]} | set(signs)
    alphabet = [*signs, "ക", "ന", "ർ", "അ", " ", "a", "ം"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(500)]

    def machine(t):
        out = []
        for c in t:
            if c not in signs or (out and out[-1] in bases):
                out.append(c)
        return "".join(out)

    assert run(spark, texts, R.drop_stray_signs) == [machine(t) for t in texts]


def test_nfc_and_nulls(spark):
    texts = ["é", "K", "ൊ", "", None, "plain"]
    assert run(spark, texts, R.nfc) == [None if t is None else unicodedata.normalize("NFC", t) for t in texts]
    for f in (R.structural_master, R.structural_standalone, R.visarga_to_colon, R.chillu_rules, R.tidy_lines):
        assert run(spark, [None], f) == [None]


@pytest.mark.parametrize("f", [R.zwj_to_chillu, R.drop_stray_signs, R.collapse_ellipsis, R.collapse_repeated, R.collapse_spaces, R.visarga_to_colon, R.tidy_lines])
def test_idempotent(spark, f):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ക്‍നാഃ ..!!--\t\n*a") for _ in range(30)) for _ in range(200)]
    once = run(spark, texts, f)
    assert run(spark, once, f) == once


def test_python_reads_the_plain_patterns_alike(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice(["|", " ", "a", "1", "-", "[", "]", "/", "~", "ക", "\xa0", "px", "http://", "$", "\\", "%", "{", "}", "=", "*", "+", ";", "."]) for _ in range(rng.randint(0, 14))) for _ in range(800)]
    for name, p in P.WIKI.items():
        flags = re.IGNORECASE if name == "stub" else 0
        got = run(spark, lines, lambda x, n=name: T.wiki_matches(x, n))
        assert got == [re.search(p, x, flags) is not None for x in lines], name


def test_any_literal_finds_what_contains_does(spark):
    rng = random.Random(4)
    words = [*P.MASTER_KEYWORDS, "a.b", "a|", "(x", "-", "^q"]
    parts = [*words, *(w[:-1] for w in words), *"ad .|(-^q"]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 3))) for _ in range(1500)]
    assert run(spark, lines, lambda x: x.rlike(any_literal(words))) == [any(w in x for w in words) for x in lines]


def test_strip_is_python_strip(spark):
    texts = [c + "a" + c + "b" + c + c for c in [*WS_CHARACTERS, "\u200b", "\ufeff", "\u180e", "x"]] + ["", WS_CHARACTERS, "ക\u3000"]
    assert run(spark, texts, R.strip) == [t.strip() for t in texts]
    assert set(WS_CHARACTERS) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_portable():
    assert portable(r"[\s]\d\S") == f"[{WS}]" + r"[\p{Nd}]" + f"[^{WS}]"


def test_human_size(spark):
    sizes = spark.createDataFrame([(0.0,), (1023.0,), (1024.0,), (5e9,), (1e18,)], "n double").select(R.human_size(F.col("n"))).collect()
    assert [r[0] for r in sizes] == ["0.00 B", "1023.00 B", "1.00 KB", "4.66 GB", "888.18 PB"]
