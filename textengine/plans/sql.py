"""The same rewrites and predicates as SQL for an RE2 engine, to check the queries against.

RE2 has neither lookaround nor backreferences: lookahead is a captured group put back (what follows can
never start a match), repeated marks are one replacement for each.
"""

from __future__ import annotations

from functools import reduce

from textengine.functions import profile as P
from textengine.functions.patterns import WS, portable, re2
from textengine.functions.profile import MASTER, STANDALONE, WIKI
from textengine.plans.inputs import quoted as q


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def match(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def strip(x: str) -> str:
    return sub(x, rf"^[{WS}]+|[{WS}]+\z")


def replace_all(x: str, pairs: list[tuple[str, str]]) -> str:
    return reduce(lambda t, kv: f"replace({t}, {q(kv[0])}, {q(kv[1])})", pairs, x)


def zwj(x: str) -> str:
    return replace_all(x, [(k + P.VIRAMA + P.ZWJ, v) for k, v in P.CHILLU_ZWJ.items()])


def atomic(x: str) -> str:
    return replace_all(x, [(k + P.VIRAMA, v) for k, v in P.CHILLU_PAIR.items()])


def html(x: str) -> str:
    return sub(x, r"</?[a-zA-Z][^>]*/?>")


def allowed(x: str) -> str:
    return sub(x, f"[^{P.ALLOWED}]+")


def stray(x: str) -> str:
    return sub(x, f"(^|[^{P.BASES}])[{P.SIGNS}]+", r"\1")


def ellipsis(x: str) -> str:
    return sub(x, r"[.\x{2026}]{2,}", ".")


def repeated(x: str) -> str:
    return reduce(lambda t, c: sub(t, f"[{c}]{{2,}}" if c != "-" else "-{2,}", c), ".!?,;:-*#", x)


def spaced(x: str) -> str:
    return sub(x, rf"([.!?,;:])(?:[{WS}]*[.!?,;:])+", r"\1")


def spaces(x: str) -> str:
    return sub(x, r"[ \t]{2,}", " ")


def tidy(x: str) -> str:
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: {strip('l')})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> '' AND NOT {match('l', rf'^[{WS}*]+$')}), chr(10))"


def bom(x: str) -> str:
    return replace_all(x, [(P.BOM, "")])


def unescape(x: str) -> str:
    return f"replace({x}, '\\n', chr(10))"


def structural_master(x: str) -> str:
    return tidy(spaces(spaced(repeated(ellipsis(stray(allowed(html(bom(f"nfc_normalize({x})")))))))))


def structural_standalone(x: str) -> str:
    return tidy(spaces(repeated(ellipsis(stray(allowed(bom(unescape(f"nfc_normalize({x})"))))))))


def visarga(x: str) -> str:
    return sub(x, rf"{P.VISARGA}([{WS}]|\z)", r":\1")


def chillu_rules(x: str) -> str:
    after = rf"([^\x{{20}}-\x{{7E}}{P.NATIVE}]|\z)"
    return reduce(lambda t, rule: sub(t, rule[0] + after, rule[1] + r"\1"), P.CHILLU_RULES, x)


def count_of(x: str, inside: str) -> str:
    return f"length({sub(x, f'[^{inside}]+')})"


def any_of(conditions: list[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def keyword(x: str, profile=MASTER) -> str:
    return any_of([f"contains(lower({x}), {q(k)})" for k in profile.keywords])


def pattern(x: str, profile=MASTER) -> str:
    return any_of([match(x, re2(p, True)) for p in profile.patterns])


def letter_ratio(x: str) -> str:
    return f"(CASE WHEN length({x}) > 0 THEN {count_of(x, 'A-Za-z' + P.NATIVE)} / length({x}) ELSE 0 END)"


def native_ratio(x: str) -> str:
    letters = count_of(x, "A-Za-z" + P.NATIVE)
    return f"(CASE WHEN {letters} > 0 THEN {count_of(x, P.NATIVE)} / {letters} ELSE 0 END)"


def very_short(x: str) -> str:
    return f"(length({x}) > 0 AND length({x}) < 5)"


def low_native(x: str) -> str:
    return f"(length({x}) > 30 AND {native_ratio(x)} < 0.15)"


def boilerplate(x: str) -> str:
    """x is trimmed."""
    return any_of([f"{x} = ''", very_short(x), f"(NOT {match(x, f'[{P.NATIVE}]')} AND length({x}) < 80)", f"(length({x}) > 3 AND {letter_ratio(x)} < 0.3)", low_native(x), keyword(x), pattern(x)])


def label(x: str) -> str:
    """x is trimmed."""
    return f"""CASE WHEN {x} = '' THEN 'remove_empty' WHEN {keyword(x, STANDALONE)} THEN 'remove_keyword'
  WHEN {pattern(x, STANDALONE)} THEN 'remove_regex' WHEN {very_short(x)} OR {low_native(x)} THEN 'remove_heuristic' ELSE 'keep' END"""


def clean_text(x: str) -> str:
    structured = structural_master(zwj(unescape(strip(x))))
    return strip(f"array_to_string(list_filter(string_split({structured}, chr(10)), lambda k: NOT {boilerplate('k')}), chr(10))")


def wiki(x: str, name: str) -> str:
    return match(x, re2(WIKI[name], name == "stub"))


def wiki_removed(x: str) -> str:
    """x is trimmed."""
    names = ["category", "table", "stub", "year", "date", "latex", "brackets", "wiki_image", "file_path", "phonetic"]
    return any_of([f"length({x}) < 10", *[wiki(x, n) for n in names], f"({wiki(x, 'coordinates')} AND length({x}) > 2)"])


def wiki_cte(source: str = "lines") -> str:
    """CTE wiki_lines(doc_id, line_no, line, x, cleaned, reason) from lines."""
    w = {k: portable(v) for k, v in WIKI.items()}
    inline = sub(sub(sub(sub("c", w["ref"]), w["url"]), w["inline_brackets"]), w["inline_phonetic"])
    reasons = " ".join(f"WHEN {wiki('x', n)} THEN '{n}'" for n in ["category", "table", "latex", "brackets", "wiki_image", "file_path", "phonetic"])
    return f""",
w0 AS (SELECT *, {strip('line')} AS x FROM {source}),
w1 AS (SELECT *, {sub(sub('x', w['link'], chr(92) + '1'), w['template'])} AS a FROM w0),
w2 AS (SELECT *, {match('a', w['header'])} AS header,
  CASE WHEN {match('a', w['header'])} THEN {strip(f"regexp_extract(a, {q(w['header'])}, 2)")} ELSE a END AS b FROM w1),
w3 AS (SELECT *, {match('b', w['bullet'])} AS bullet, CASE WHEN {match('b', w['bullet'])} THEN {strip(sub('b', w['bullet']))} ELSE b END AS c FROM w2),
w4 AS (SELECT *, {strip(sub(inline, w['spaces'], ' '))} AS d FROM w3),
w5 AS (SELECT doc_id, line_no, line, x, CASE WHEN NOT ({wiki_removed('x')} OR (header AND length(b) < 10) OR (bullet AND length(c) < 10) OR length(d) < 10) THEN d END AS cleaned FROM w4),
wiki_lines AS (SELECT *, CASE WHEN x = '' THEN 'empty' {reasons} WHEN cleaned IS NULL THEN CASE WHEN length(x) < 10 THEN 'short' ELSE 'other' END ELSE 'keep' END AS reason FROM w5)
"""


NOT_SPACE = f"[^{WS}]+"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(NOT_SPACE)})"


def words_cte() -> str:
    """CTE words(word): the distinct native words with a chillu form."""
    c = P.CHILLU_CONSONANTS
    form = rf"[{c}]{P.VIRAMA}([^{c}]|\z)|[\x{{0D7A}}-\x{{0D7F}}]"
    return f""",
runs AS (SELECT unnest(regexp_extract_all(line, {q(f'[{P.NATIVE}]+')})) AS word FROM lines),
words AS (SELECT DISTINCT word FROM runs WHERE {match('word', form)})"""


def pairs_cte() -> str:
    keys = f"[{''.join(P.CHILLU_PAIR)}]{P.VIRAMA}"
    return f"{words_cte()},\npairs AS (SELECT word, {atomic('word')} AS atomic FROM words WHERE {match('word', keys)} AND {atomic('word')} IN (SELECT word FROM words) AND {atomic('word')} <> word)"


def rewritten(line: str, keep_blank: bool) -> str:
    """SELECT doc_id, line_no, line over lines and pairs."""
    blank = f"{strip('line')} = ''"
    punctuation = q(P.TOKEN_PUNCTUATION)
    return f""", source AS (SELECT doc_id, line_no, {line} AS line FROM lines),
toks AS (SELECT doc_id, line_no, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, line_no, {tokens('line')} AS t FROM source)),
cores AS (SELECT *, trim(token, {punctuation}) AS core, length(token) - length(ltrim(token, {punctuation})) AS before FROM toks),
news AS (SELECT doc_id, line_no, pos, CASE WHEN p.atomic IS NULL OR core = '' THEN token
  ELSE token[1:before] || p.atomic || substr(token, before + length(core) + 1) END AS token FROM cores LEFT JOIN pairs p ON core = p.word),
again AS (SELECT doc_id, line_no, string_agg(token, ' ' ORDER BY pos) AS joined FROM news GROUP BY ALL)
SELECT doc_id, line_no, CASE WHEN {blank} THEN {'line' if keep_blank else "''"} ELSE joined END AS line FROM source LEFT JOIN again USING (doc_id, line_no)"""
