"""Rewrites of documents, lines and words: Column -> Column, all inside the JVM. Null gives null."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textengine.functions import profile as P
from textengine.functions.patterns import WS, WS_CHARACTERS, java, outside, prefix_of, runs_outside
from textengine.functions.profile import MASTER, WIKIPEDIA, Profile, WikiProfile


def sub(x: Column, pattern: str, by: str = "", ignore_case: bool = False) -> Column:
    """x with what the pattern matches replaced; looked for only where x holds what every match begins with."""
    replaced = lambda x: F.regexp_replace(x, java(pattern, ignore_case), by)
    prefix = "" if ignore_case else prefix_of(pattern)
    return once(x, lambda x: F.when(x.contains(prefix), replaced(x)).otherwise(x)) if prefix else replaced(x)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use refers to it; the optimizer cannot write it out again."""
    return F.transform(F.array(value), use)[0]


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WS_CHARACTERS))


def rstrip_newlines(x: Column) -> Column:
    return F.regexp_replace(x, r"[\r\n]+\z", "")


def escape_newlines(x: Column) -> Column:
    """A document as one line: newlines as backslash and n. Null is an empty document."""
    return F.replace(F.coalesce(x, F.lit("")), F.lit("\n"), F.lit("\\n"))


def unescape_newlines(x: Column) -> Column:
    return F.replace(x, F.lit("\\n"), F.lit("\n"))


def zwj_to_chillu(x: Column) -> Column:
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0] + P.VIRAMA + P.ZWJ), F.lit(kv[1])), P.CHILLU_ZWJ.items(), x)


def atomic_form(word: Column) -> Column:
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0] + P.VIRAMA), F.lit(kv[1])), P.CHILLU_PAIR.items(), word)


def nfc(x: Column) -> Column:
    """Unicode NFC by the ICU library that Spark ships. Spark takes it for nondeterministic: use it in a first projection."""
    return F.when(x.isNotNull(), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False)))


def drop_bom(x: Column) -> Column:
    return F.replace(x, F.lit(P.BOM), F.lit(""))


def strip_html(x: Column) -> Column:
    return F.regexp_replace(x, r"</?[a-zA-Z][^>]*/?>", "")


def allow_characters(x: Column, profile: Profile = MASTER) -> Column:
    return F.regexp_replace(x, runs_outside(profile.allowed), "")


def drop_stray_signs(x: Column, profile: Profile = MASTER) -> Column:
    return F.regexp_replace(x, f"(?<![{profile.bases}])[{profile.signs}]+", "")


def collapse_ellipsis(x: Column) -> Column:
    return F.regexp_replace(x, r"[.\x{2026}]{2,}", ".")


def collapse_repeated(x: Column) -> Column:
    return F.regexp_replace(x, r"([.!?,;:\-*#])\1+", "$1")


def collapse_spaced(x: Column) -> Column:
    return F.regexp_replace(x, rf"([.!?,;:])(?:[{WS}]*[.!?,;:])+", "$1")


def collapse_spaces(x: Column) -> Column:
    return F.regexp_replace(x, r"[ \t]{2,}", " ")


def tidy_lines(x: Column) -> Column:
    """Lines trimmed; empty ones and those of asterisks only go."""
    lines = F.transform(F.split(x, "\n"), strip)
    return F.array_join(F.filter(lines, lambda line: (line != "") & ~line.rlike(rf"^[{WS}*]+\z")), "\n")


def structural_master(x: Column, profile: Profile = MASTER) -> Column:
    x = drop_stray_signs(allow_characters(strip_html(drop_bom(nfc(x))), profile), profile)
    return tidy_lines(collapse_spaces(collapse_spaced(collapse_repeated(collapse_ellipsis(x)))))


def structural_standalone(x: Column, profile: Profile = MASTER) -> Column:
    x = drop_stray_signs(allow_characters(drop_bom(unescape_newlines(nfc(x))), profile), profile)
    return tidy_lines(collapse_spaces(collapse_repeated(collapse_ellipsis(x))))


def visarga_to_colon(x: Column) -> Column:
    return F.regexp_replace(x, rf"{P.VISARGA}(?=[{WS}]|\z)", ":")


def chillu_rules(x: Column) -> Column:
    ahead = rf"(?![\x{{20}}-\x{{7E}}{P.NATIVE}])"
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0] + ahead, rule[1]), P.CHILLU_RULES, x)


def token_core(token: Column) -> Column:
    """A token without the punctuation around it."""
    return F.btrim(token, F.lit(P.TOKEN_PUNCTUATION))


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(f"{outside(WS)}+"), F.lit(0))


def wiki_line(line: Column, removed: Callable[[Column], Column], profile: WikiProfile = WIKIPEDIA) -> Column:
    """The cleaned line, or null where it goes; `removed` says of a trimmed line whether it goes before any rewrite."""
    p = profile.patterns
    short = lambda x: F.length(x) < profile.least_line

    def inline(x: Column) -> Column:
        z = sub(sub(sub(sub(x, p["ref"]), p["url"]), p["inline_brackets"]), p["inline_phonetic"])
        return once(strip(sub(z, p["spaces"], " ")), lambda z: F.when(~short(z), z))

    def bare(x: Column, pattern: str, content: Callable[[Column], Column]) -> Column:
        """x without the mark of a heading or a bullet; null if what is left is short."""
        return F.when(x.rlike(java(pattern)), once(content(x), lambda y: F.when(~short(y), y))).otherwise(x)

    def rewritten(x: Column) -> Column:
        x = sub(sub(x, p["link"], "$1"), p["template"])
        x = once(x, lambda x: bare(x, p["header"], lambda h: strip(F.regexp_extract(h, java(p["header"]), 2))))
        x = once(x, lambda x: bare(x, p["bullet"], lambda b: strip(sub(b, p["bullet"]))))
        return inline(x)

    return once(strip(line), lambda x: F.when(~removed(x), rewritten(x)))


def human_size(n: Column) -> Column:
    """A number of bytes in units of 1024, with two digits."""
    out = F.format_string("%.2f PB", n / F.lit(1024.0**5))
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(n < 1024.0 ** (power + 1), F.format_string(f"%.2f {unit}", n / F.lit(1024.0**power))).otherwise(out)
    return out
