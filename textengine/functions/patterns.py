r"""Regular expressions that mean the same in Java (Spark) and RE2 (DuckDB).

Patterns are written in plain notation with Unicode-aware ``\s \d \w``; ``portable`` spells these out,
because both engines read them as ASCII only. ``java`` adds the flags that make ``.`` and ``$`` mind
``\n`` alone.
"""

from __future__ import annotations

import re
from functools import cache
from os.path import commonprefix

#: White space as str.strip() and \s know it, as the inside of a character class.
WS = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The same characters.
WS_CHARACTERS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_INSIDE = {"s": WS, "d": r"\p{Nd}", "w": r"\p{L}\p{N}_"}


def portable(pattern: str) -> str:
    out, at, inside = [], 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            kind = pattern[at + 1]
            if kind.lower() in _INSIDE and (kind.islower() or not inside):
                body = _INSIDE[kind.lower()]
                out.append(body if inside else f"[{'^' if kind.isupper() else ''}{body}]")
            else:
                out.append(pattern[at : at + 2])
            at += 2
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "]" and inside and pattern[at - 1] != "[":
            inside = False
        out.append(c)
        at += 1
    return "".join(out)


_ESCAPED = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}
_ATOM = re.compile(r"\\x\{([0-9A-Fa-f]+)\}|\\x([0-9A-Fa-f]{2})|\\([tnrf])|\\([^A-Za-z0-9])|([^\\\[\]&^])", re.S)


def _ranges(inside: str) -> list[tuple[int, int]] | None:
    """The ranges of a character class given by its inside; None where it holds more than characters and ranges."""
    out, at = [], 0

    def character() -> int | None:
        nonlocal at
        m = _ATOM.match(inside, at)
        if not m:
            return None
        at = m.end()
        code, byte, name, mark, plain = m.groups()
        return int(code or byte, 16) if code or byte else ord(_ESCAPED[name] if name else mark or plain)

    while at < len(inside):
        low = high = character()
        if low is not None and inside[at : at + 1] == "-" and at + 1 < len(inside):
            at += 1
            high = character()
        if low is None or high is None:
            return None
        out.append((low, high))
    return out


def outside(inside: str) -> str:
    """A character class of all but those inside.

    Java takes ten times as long over a negated class of several parts as over the same characters listed as
    ranges, so it is written as ranges where it can be.
    """
    parts = _ranges(inside)
    if not parts or len(parts) == 1:
        return f"[^{inside}]"
    gaps, at = [], 0
    for low, high in sorted(parts):
        if low > at:
            gaps.append((at, low - 1))
        at = max(at, high + 1)
    if at <= 0x10FFFF:
        gaps.append((at, 0x10FFFF))
    return _nested(sorted(gaps, key=lambda r: (r[1] - r[0] < 64, r))) if gaps else f"[^{inside}]"


def _nested(ranges: list[tuple[int, int]]) -> str:
    """A class of ranges, each in a class with the rest, as Java tries a flat list from its end to its beginning and back."""
    return "".join(rf"[\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]" * len(ranges)


def runs_outside(inside: str) -> str:
    """A pattern of runs of characters that are not inside, where most are inside: the widest ranges are passed first."""
    parts = sorted(_ranges(inside) or [], key=lambda r: r[0] - r[1])[:2]
    widest = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in parts)
    return f"{f'(?![{widest}])' if len(parts) > 1 else ''}{outside(inside)}+"


def width(inside: str) -> int | None:
    """In how many bytes of UTF-8 each character of a class is written, where it is the same for all."""
    widths = {len(chr(c).encode("utf-8", "surrogatepass")) for r in _ranges(inside) or [] for c in r}
    return widths.pop() if len(widths) == 1 else None


def _classes_apart(pattern: str) -> list[str]:
    """The pattern in pieces: character classes, escapes, single characters."""
    return re.findall(r"\[\^?\]?(?:\\[pP]\{\w+\}|\\x\{\w+\}|\\.|[^\]\\])*\]|\\[pP]\{\w+\}|\\x\{\w+\}|\\.|.", pattern, re.S)


def java(pattern: str, ignore_case: bool = False) -> str:
    body = portable(pattern)
    plain = lambda c: c[:2] == "[^" and (not ignore_case or c[2:-1] == WS)  # noqa: E731  white space has no case
    body = "".join(outside(c[2:-1]) if plain(c) else c for c in _classes_apart(body))
    return ("(?diu)" if ignore_case else "(?d)") + body


def re2(pattern: str, ignore_case: bool = False) -> str:
    return ("(?i)" if ignore_case else "") + portable(pattern)


def alternatives(pattern: str) -> list[str]:
    """The pattern taken apart at the bars outside its groups."""
    out, depth = [""], 0
    for c in _classes_apart(pattern):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def first_of(alternative: str) -> str | None:
    """The inside of a class of the characters that a match begins with; None where that is not plain to see."""
    pieces = _classes_apart(alternative)
    if not pieces or "".join(pieces[1:2]) in ("?", "*", "{"):
        return None
    first = pieces[0]
    if first[0] == "[":
        return None if first[1] == "^" or "[" in first[1:] or "&&" in first or "-" in (first[1], first[-2]) else first[1:-1]
    if first[0] == "\\":
        return first if first[1] in "dsx" or first[:2] == r"\p" or not first[1].isalnum() else None
    return None if first in "^$.()|?*+{" else f"\\{first}" if first in "-&]" else first


def prefix_of(pattern: str) -> str:
    """Characters that every match of the pattern begins with; empty where that is not plain to see."""
    prefixes = []
    for alternative in alternatives(pattern):
        pieces, prefix = _classes_apart(alternative), ""
        for piece, then in zip(pieces, [*pieces[1:], ""], strict=True):
            literal = piece[1:] if piece[0] == "\\" and len(piece) == 2 and not piece[1].isalnum() else piece
            if len(literal) > 1 or literal == piece and piece in "^$.()|?*+{[" or then in ("?", "*", "{"):
                break
            prefix += literal
        prefixes.append(prefix)
    return commonprefix(prefixes)


def any_java(patterns: list[str], ignore_case: bool = False) -> list[str]:
    """Patterns, two at most, one of which is found where any of the given ones is.

    Java tries one that begins with ^ at one place only if all of it does. The rest are tried only where a
    character stands that one of them can begin with.
    """
    each = [a for p in patterns for a in alternatives(p)]
    held, free = [a[1:] for a in each if a[:1] == "^"], [a for a in each if a[:1] != "^"]
    firsts = [first_of(a) for a in free]
    ahead = "" if None in firsts else f"(?=[{''.join(dict.fromkeys(filter(None, firsts)))}])"
    group = lambda parts: "(?:" + "|".join(f"(?:{p})" for p in parts) + ")"
    return [java(p, ignore_case) for p in (held and "^" + group(held), free and ahead + group(free)) if p]


@cache
def _upper() -> dict[str, list[str]]:
    """By character, the others that are it in lower case."""
    out: dict[str, list[str]] = {}
    for x in map(chr, range(0x110000)):
        if x.lower() != x:
            out.setdefault(x.lower(), []).append(x)
    return out


def any_literal(words: list[str], in_lower_case: bool = False) -> str:
    """A pattern of all words, as a tree of their beginnings, so that most places are passed by their first two characters.

    in_lower_case: it is found where the text in lower case holds one of the words, which are lower_case_alone.
    """
    if not words or "" in words:
        return "" if words else r"(?!)"
    upper = _upper() if in_lower_case else {}

    def inside(c: str) -> str:
        return "".join(map(re.escape, [c, *upper.get(c, ())]))

    def one(c: str) -> str:
        return f"[{inside(c)}]" if c in upper else re.escape(c)

    def tree(rest: list[str]) -> str:
        if "" in rest:
            return ""
        by_first: dict[str, list[str]] = {}
        for w in rest:
            by_first.setdefault(w[0], []).append(w[1:])
        branches = [one(c) + tree(by_first[c]) for c in sorted(by_first)]
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    def ahead(k: int, of: list[str]) -> str:
        chars = sorted({c for w in of for c in (w[k], *upper.get(w[k], ()))})
        rest: list[tuple[int, int]] = []
        for c in (ord(c) for c in chars if not c.isascii()):
            rest[-1:] = [(rest[-1][0], c)] if rest and rest[-1][1] == c - 1 else [*rest[-1:], (c, c)]
        return "[" + "".join(re.escape(c) for c in chars if c.isascii()) + _nested(rest) + "]"

    short, rest = [w for w in words if len(w) == 1], [w for w in words if len(w) > 1]
    parts = [one(w) for w in short] + ([rf"(?=[\x{{0}}-\x{{10FFFF}}]{ahead(1, rest)}){tree(rest)}"] if rest else [])
    return f"(?={ahead(0, words)})(?:{'|'.join(parts)})"


def lower_case_alone(words: list[str]) -> bool:
    """Whether any_literal can tell the lower case of these words' letters by itself: not beside a dotted i or a sigma."""
    return all(w == w.lower() and w[-1:] != "i" and not set(w) & set("\u0307σς") for w in words)
