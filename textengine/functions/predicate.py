"""Predicates and labels of lines: Column -> Column."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from textengine.functions import profile as P
from textengine.functions.patterns import WS, any_java, any_literal, java, lower_case_alone, outside, runs_outside, width
from textengine.functions.profile import MASTER, STANDALONE, WIKIPEDIA, Profile, WikiProfile
from textengine.functions.rewrite import once, strip


def count_of(x: Column, inside: str) -> Column:
    """Characters of x in a class, given as the inside of a character class."""
    return F.length(only(x, inside)).cast("long")


def only(x: Column, inside: str) -> Column:
    """x without the characters that are not in a class."""
    return F.regexp_replace(x, runs_outside(inside), "")


def has_any(x: Column, patterns: list[str], ignore_case: bool = False) -> Column:
    return reduce(or_, [x.rlike(p) for p in any_java(patterns, ignore_case)], F.lit(False))


def has_keyword(line: Column, profile: Profile = MASTER) -> Column:
    if lower_case_alone(profile.keywords):
        return line.rlike(any_literal(profile.keywords, in_lower_case=True))
    return F.lower(line).rlike(any_literal(profile.keywords))


def has_pattern(line: Column, profile: Profile = MASTER) -> Column:
    return has_any(line, profile.patterns, True)


def letters_of(line: Column, profile: Profile = MASTER) -> Column:
    return only(line, "A-Za-z" + profile.native)


def letter_ratio(line: Column, profile: Profile = MASTER, letters: Column | None = None) -> Column:
    """letters: those of the line, where they are at hand."""
    count = F.length(letters_of(line, profile) if letters is None else letters)
    return F.when(F.length(line) > 0, count / F.length(line)).otherwise(F.lit(0.0))


def native_ratio(line: Column, profile: Profile = MASTER, letters: Column | None = None) -> Column:
    def ratio(own: Column) -> Column:
        wide = width(profile.native) or 1  # if over 1, the bytes of letters beside A-Za-z tell how many there are
        native = (F.octet_length(own) - F.length(own)) / F.lit(wide - 1) if wide > 1 else count_of(own, profile.native)
        return F.when(own != "", native / F.length(own)).otherwise(F.lit(0.0))

    return once(letters_of(line, profile), ratio) if letters is None else ratio(letters)


def very_short(line: Column, profile: Profile = MASTER) -> Column:
    return (F.length(line) > 0) & (F.length(line) < profile.short_line)


def low_native(line: Column, profile: Profile = MASTER, letters: Column | None = None) -> Column:
    return (F.length(line) > profile.native_from) & (native_ratio(line, profile, letters) < profile.least_native)


def boilerplate_line(line: Column, profile: Profile = MASTER) -> Column:
    """Blank, or boilerplate by any of the document cleaner's rules, the cheap ones first."""
    return once(strip(line), lambda x: boilerplate_trimmed(x, profile))


def boilerplate_trimmed(x: Column, profile: Profile = MASTER) -> Column:
    def few_letters(letters: Column) -> Column:
        return ((F.length(x) > profile.ratio_from) & (letter_ratio(x, profile, letters) < profile.least_letters)) | low_native(x, profile, letters)

    return (
        (x == "")
        | very_short(x, profile)
        | ((F.length(x) < profile.foreign_below) & ~x.rlike(f"[{profile.native}]"))
        | once(letters_of(x, profile), few_letters)
        | has_keyword(x, profile)
        | has_pattern(x, profile)
    )


def line_label(line: Column, profile: Profile = STANDALONE) -> Column:
    def label(x: Column) -> Column:
        return (
            F.when(x == "", "remove_empty")
            .when(has_keyword(x, profile), "remove_keyword")
            .when(has_pattern(x, profile), "remove_regex")
            .when(very_short(x, profile) | low_native(x, profile), "remove_heuristic")
            .otherwise("keep")
        )

    return once(strip(line), label)


def wiki_matches(x: Column, name: str, profile: WikiProfile = WIKIPEDIA) -> Column:
    return x.rlike(java(profile.patterns[name], name == "stub"))


def wiki_removed(x: Column, profile: WikiProfile = WIKIPEDIA) -> Column:
    """Whether a trimmed line goes before any rewrite."""
    names = ["category", "table", "year", "date", "latex", "brackets", "wiki_image", "file_path", "phonetic"]
    at_once = has_any(x, [profile.patterns[n] for n in names])
    return (F.length(x) < profile.least_line) | at_once | has_any(x, [profile.patterns["stub"]], True) | (wiki_matches(x, "coordinates", profile) & (F.length(x) > 2))


def wiki_reason(line: Column, cleaned: Column, profile: WikiProfile = WIKIPEDIA) -> Column:
    def reason(x: Column) -> Column:
        out = F.when(x == "", "empty").when(cleaned.isNotNull(), "keep")  # wiki_removed has all that follows
        for name in ["category", "table", "latex", "brackets", "wiki_image", "file_path", "phonetic"]:
            out = out.when(wiki_matches(x, name, profile), name)
        return out.when(F.length(x) < profile.least_line, "short").otherwise("other")

    return once(strip(line), reason)


CHILLU_FORM = rf"[{P.CHILLU_CONSONANTS}]{P.VIRAMA}(?![{P.CHILLU_CONSONANTS}])|[\x{{0D7A}}-\x{{0D7F}}]"


def has_chillu(word: Column) -> Column:
    return word.rlike(CHILLU_FORM)


def may_have_chillu(line: Column) -> Column:
    """Necessary for has_chillu, and cheaper: filters lines before words are made."""
    return line.rlike(rf"[{P.VIRAMA}\x{{0D7A}}-\x{{0D7F}}]")


def convertible(word: Column) -> Column:
    return word.rlike(f"{P.VIRAMA}(?<=[{''.join(P.CHILLU_PAIR)}]{P.VIRAMA})")  # the rarer of the two first


def has_noise(line: Column) -> Column:
    return has_any(line, P.NOISE_SCAN)


def visarga_headword(line: Column) -> Column:
    """The first field of a dictionary line ends in a visarga (this script's or Devanagari's)."""
    return line.rlike(rf"^{outside(WS)}*[\x{{0D03}}\x{{0903}}](?:[{WS}]|\z)")
