"""Profiles: the script, character classes, word lists, patterns and thresholds of the cleaning flows."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- Fixed values: character classes (insides of character classes, the same in Java and RE2) ----
NATIVE = r"\x{0D00}-\x{0D7F}"
ALLOWED = NATIVE + r"\x{20}-\x{7E}\t\n\r\x{B0}\x{A9}\x{AE}\x{BD}\x{BC}\x{20B9}\x{2026}\x{200D}\x{200C}"
SIGNS = r"\x{0D3E}-\x{0D4D}\x{0D57}"
BASES = r"\x{0D15}-\x{0D39}\x{0D7A}-\x{0D7F}" + SIGNS
VIRAMA, ZWJ, ZWNJ, BOM, VISARGA = "്", "‍", "‌", "﻿", "ഃ"

# ---- Fixed values: letters with virama and their single-letter forms ----
CHILLU_ZWJ = {"ണ": "ൺ", "ന": "ൻ", "ര": "ർ", "ല": "ൽ", "ള": "ൾ"}
CHILLU_PAIR = CHILLU_ZWJ | {"ക": "ൿ"}
CHILLU_CONSONANTS = "നണരളല"
#: Rules before anything but printable ASCII and native letters: first anywhere, then at ends, in this order.
CHILLU_RULES = [
    ("ങള്ക", "ങൾക"),
    ("കാര്ക", "കാർക"),
    ("ര്മ", "ർമ"),
    ("ര്ക", "ർക"),
    ("ള്ക", "ൾക"),
    ("ങള്", "ങൾ"),
    ("കള്", "കൾ"),
    ("ടാന്", "ടാൻ"),
    ("കാന്", "കാൻ"),
    ("കാര്", "കാർ"),
    ("ല്", "ൽ"),
    ("ില്", "ിൽ"),
]

# ---- Fixed values: boilerplate keywords, lower case ----
MASTER_KEYWORDS = [
    "©", "copyright", "all rights reserved", "terms of use", "privacy policy", "disclaimer", "cookie policy",
    "also read", "don't miss", "don’t miss", "read more", "click here", "read also", "subscribe", "sign up",
    "log in", "share this", "follow us", "join us", "see also", "previous:", "next:", "load more", "show more",
    "view more", "last modified", "last updated", "english edition", "published:", "updated:",
    "മറുനാടൻ ടിവിയുടെ ഫേസ്ബുക്ക് പേജ് ഹാക്ക് ചെയ്തു", "ഷാജൻ സ്കറിയയുടെ വീഡിയോ കാണാം", "കൂടുതൽ വായിക്കുക",
    "തുടർന്ന് വായിക്കുക", "സബ്സ്ക്രൈബ് ചെയ്യുക", "ഷെയർ ചെയ്യുക", "കമന്റ് ചെയ്യുക", "ലൈക്ക് ചെയ്യുക", "സെർച്ച്",
    "advertisement", "sponsored", "ad ", "keywords:", "top-headlines", "begin typing your search above",
    "your comment added successfully", "consectetur adipiscing elit", "save my name, email, and website",
    "press ctrl+m to toggle", "download the fanport app", "ഭാഷ തിരഞ്ഞെടുക്കുക", "കൂടുതൽ ഭാഷ",
]
#: The stand-alone classifier reads two of them as one word, and lacks the last two and the curly apostrophe.
FUSED = "സെർച്ച്advertisement"
STANDALONE_KEYWORDS = [k for k in MASTER_KEYWORDS[:-2] if k not in ("don’t miss", "സെർച്ച്", "advertisement")] + [FUSED]

# ---- Fixed values: boilerplate patterns, without regard to case ----
STANDALONE_PATTERNS = [
    r"©.*\d{4}",
    r"Copyright.*\d{4}",
    r"All\s+rights\s+reserved",
    r"^-\s*(News|Technology|Sports|Entertainment|Business|World|National|India)\s",
    r"^\s*[\-\|•·=]{3,}\s*$",
    r"^\s*\|?\s*\d{1,2}\s*[A-Za-z]+\s*\d{4}\s*$",
    r"^(Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)\s*,?\s+\d",
    r"https?://\S+",
    r"Archived\s+\d{4}-\d{2}-\d{2}\s+at\s+the\s+Wayback\s+Machine",
    r"^[^|]*\|[^|]*\|[^|]*\|",
    r"^-\s+.+;\s+.+;\s+.+;\s+.+;\s+",
    r"\+\d{1,4}[\s.-]?\d{1,4}[\s.-]?\d{1,4}[\s.-]?\d{1,9}",
]
MASTER_PATTERNS = STANDALONE_PATTERNS + [
    r"^\s*\(?\s*(Hindi|Marathi|Gujarati|Kannada|Bengali|Malayalam|Telugu|Punjabi|Urdu|Odia|Assamese|Tamil|English|Sanskrit)\s*\)?\)?\s*$",
    r"^[\s\(\)\[\]\{\}'.,:;!?\-_/*#@&|=+<>~`\\\"]+$",
]

# ---- Fixed values: patterns of the wiki line cleaner ----
WIKI = {
    "category": r"^\[?\[?\s*വർഗ്ഗം:",
    "table": r"^\s*[\{\|\}!\-\+]|\|.*\|.*\||^\s*\|",
    "stub": "അപൂർണ്ണമാണ്|അപൂർണമാണ്|അപൂർണ്ണം|അപൂർണം|stub",
    "coordinates": r"^[\d\s°'\"NSEW,.\-]+$",
    "year": r"^\d{4}\s*$",
    "date": r"^\d{1,2}\s+\S+\s*\d{0,4}\s*$",
    "latex": r"\$\\?\w|\\displaystyle|\\text\{|\\frac\{|\\mathbf|\\mathrm|\\begin\{|\\end\{",
    "brackets": r"^[\s\[\](){}]*$",
    "wiki_image": r"upright\s*=|\|\s*thumb\s*\||\d+px\s*\||alt\s*=|frame\s*\||frameless\s*\|",
    "file_path": r"%\w+%|[A-Z]:\\|/usr/|/etc/|/var/|\\debug\\|\\system32",
    "phonetic": r"^[\s]*(/[a-zA-Z~.ːˈˌ]+/[\s,]*)+$|^[\s]*(\[[a-zA-Z~.ːˈˌ]+\][\s,]*)+$",
    "link": r"\[\[(?:[^\]]*\|)?([^\]]+)\]\]",
    "template": r"\{\{[^}]*\}\}",
    "header": r"^(=+)\s*(.+?)\s*=+\s*$",
    "bullet": r"^[\*#]+\s*",
    "ref": r"</?ref[^>]*/?>",
    "url": r"https?://\S+",
    "inline_brackets": r"\[[pc]?\]",
    "inline_phonetic": r"/(?:[a-zA-Z~]+)/|/i~i~ai~aj~ej~oj/|/~~/",
    "spaces": r"[ \t]{2,}",
}
NOISE_COUNTS = {"brackets": r"\[[pc]?\]", "phonetic": r"/[a-zA-Z~]+/"}
NOISE_SCAN = [r"\[\]", r"\[p\]", r"\[c\]", r"/[a-z]{2}/", r"/t~t/", r"/d~d/", r"/~~/", r"/i~i~ai~aj~ej~oj/"]
#: What is stripped off tokens before they are looked up: ASCII punctuation and curly quotes.
TOKEN_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~‘’“”"


@dataclass(frozen=True)
class Profile:
    """The defaults are those of the document cleaner; other scripts and word lists are other profiles."""

    native: str = NATIVE
    allowed: str = ALLOWED
    signs: str = SIGNS
    bases: str = BASES
    keywords: list[str] = field(default_factory=lambda: MASTER_KEYWORDS)
    patterns: list[str] = field(default_factory=lambda: MASTER_PATTERNS)
    short_line: int = 5
    ratio_from: int = 3
    least_letters: float = 0.3
    foreign_below: int = 80
    native_from: int = 30
    least_native: float = 0.15
    least_document: int = 20


MASTER = Profile()
STANDALONE = Profile(keywords=STANDALONE_KEYWORDS, patterns=STANDALONE_PATTERNS)


@dataclass(frozen=True)
class WikiProfile:
    least_line: int = 10
    least_document: int = 50
    least_prose: int = 30
    patterns: dict[str, str] = field(default_factory=lambda: WIKI)


WIKIPEDIA = WikiProfile()
