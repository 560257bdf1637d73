"""Every registered query of the cleaning engine, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import profile as P
from textengine.functions import rewrite as R
from textengine.functions.patterns import WS, portable, re2
from textengine.functions.profile import WIKI
from textengine.operators import documents as D
from textengine.operators import metrics as M
from textengine.operators import vocabulary as V
from textengine.plans import inputs as I
from textengine.plans import sql as S
from textengine.plans.inputs import quoted as q
from textengine.plans.inputs import with_input
from textengine.sources import text as X
from textengine.storage import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
INPUTS = {"docs": I.documents, "native": I.native_documents, "noisy": I.noisy_documents, "html": I.pages}


def add(name: str, source: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(INPUTS[source](spark, sf_dir))
    SQL[name] = with_input(source, sql)


def rewrite(name: str, source: str, column: Callable, sql: Callable[[str], str]) -> None:
    """A query of one rewrite of whole documents."""
    add(name, source, lambda d: d.select("doc_id", column(F.col("text")).alias("text")), f"SELECT doc_id, {sql('text')} AS text FROM input")


# ---- Rewrites of documents ----
rewrite("escape_documents", "noisy", R.escape_newlines, lambda x: f"replace({x}, chr(10), '\\n')")
rewrite("unescape_documents", "noisy", lambda x: R.unescape_newlines(R.strip(x)), lambda x: S.unescape(S.strip(x)))
rewrite("zwj_normalize", "native", R.zwj_to_chillu, S.zwj)
rewrite("nfc_normalize", "noisy", R.nfc, lambda x: f"nfc_normalize({x})")
rewrite("drop_bom", "noisy", R.drop_bom, S.bom)
rewrite("html_strip", "html", R.strip_html, S.html)
rewrite("char_allowlist", "noisy", R.allow_characters, S.allowed)
rewrite("stray_vowel_signs", "native", R.drop_stray_signs, S.stray)
rewrite("ellipsis_collapse", "noisy", R.collapse_ellipsis, S.ellipsis)
rewrite("punct_collapse", "noisy", lambda x: R.collapse_repeated(R.collapse_ellipsis(x)), lambda x: S.repeated(S.ellipsis(x)))
rewrite("spaced_punct", "noisy", R.collapse_spaced, S.spaced)
rewrite("space_collapse", "noisy", R.collapse_spaces, S.spaces)
rewrite("tidy_lines", "noisy", R.tidy_lines, S.tidy)
rewrite("visarga_clean", "native", R.visarga_to_colon, S.visarga)
rewrite("chillu_rules", "noisy", R.chillu_rules, S.chillu_rules)
rewrite("structural_master", "noisy", R.structural_master, S.structural_master)
rewrite("structural_html", "html", R.structural_master, S.structural_master)
rewrite("structural_standalone", "noisy", R.structural_standalone, S.structural_standalone)
for _name in ("link", "template", "ref", "url", "inline_brackets", "inline_phonetic"):
    _by = ("$1", r"\1") if _name == "link" else ("", "")
    rewrite(f"wiki_{_name}", "noisy", lambda x, n=_name, b=_by: R.sub(x, WIKI[n], b[0]), lambda x, n=_name, b=_by: S.sub(x, portable(WIKI[n]), b[1]))
add(
    "human_sizes", "docs",
    lambda d: d.select("doc_id", R.human_size(F.pow(F.lit(7.0), F.pmod("doc_id", F.lit(20)))).alias("size")),
    "SELECT doc_id, CASE WHEN b < 1024 THEN format('{:.2f} B', b) WHEN b < 1024 ** 2 THEN format('{:.2f} KB', b / 1024) WHEN b < 1024 ** 3 THEN format('{:.2f} MB', b / 1024 ** 2) "
    "WHEN b < 1024 ** 4 THEN format('{:.2f} GB', b / 1024 ** 3) WHEN b < 1024 ** 5 THEN format('{:.2f} TB', b / 1024 ** 4) ELSE format('{:.2f} PB', b / 1024 ** 5) END AS size "
    "FROM (SELECT doc_id, pow(7.0, doc_id % 20)::DOUBLE AS b FROM input)",
)

# ---- Boilerplate ----
TRIMMED = f",\nt AS (SELECT doc_id, line_no, line, {S.strip('line')} AS x FROM lines)\n"
add("boilerplate_labels", "noisy", lambda d: D.labelled_lines(d).select("doc_id", "line_no", "label"), f"{TRIMMED}SELECT doc_id, line_no, {S.label('x')} AS label FROM t")
add("boilerplate_counts", "noisy", lambda d: D.label_counts(D.labelled_lines(d)), f"{TRIMMED}SELECT {S.label('x')} AS label, count(*) AS lines, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM t GROUP BY 1")
add(
    "boilerplate_removed_log", "noisy", lambda d: D.removal_log(D.labelled_lines(d)),
    f"{TRIMMED}, l AS (SELECT *, {S.label('x')} AS label FROM t) SELECT doc_id, line_no, '[' || label || '] L' || line_no || ': ' || x AS entry FROM l WHERE label <> 'keep'",
)
add("boilerplate_kept_lines", "noisy", lambda d: D.labelled_lines(d).where("label = 'keep'").select("doc_id", "line_no", "line"), f"{TRIMMED}SELECT doc_id, line_no, line FROM t WHERE {S.label('x')} = 'keep'")
add("boilerplate_master_kept", "noisy", lambda d: D.lines_of(d).where(~T.boilerplate_line(F.col("line"))), f"{TRIMMED}SELECT doc_id, line_no, line FROM t WHERE NOT {S.boilerplate('x')}")
add("script_ratio_lines", "noisy", lambda d: M.ratios(D.lines_of(d)), f"{TRIMMED}SELECT doc_id, line_no, round({S.letter_ratio('x')}, 6) AS letters, round({S.native_ratio('x')}, 6) AS native FROM t")

# ---- Whole documents ----
add("clean_documents_v1", "noisy", lambda d: D.clean_documents(d).select("doc_id", "text"), f"SELECT * FROM (SELECT doc_id, {S.clean_text('text')} AS text FROM input) WHERE length(text) >= 20")
add(
    "clean_documents_stats", "noisy", D.clean_counts,
    f", c AS (SELECT {S.clean_text('text')} AS text FROM input) SELECT count(*) AS total, count(*) FILTER (length(text) >= 20) AS kept, count(*) FILTER (length(text) < 20) AS dropped, "
    "100.0 * count(*) FILTER (length(text) >= 20) / count(*) AS keep_rate FROM c",
)
add(
    "structural_stats", "noisy", D.structural_stats,
    f""", a AS (SELECT text, nfc_normalize(text) AS f FROM input),
b AS (SELECT *, {S.unescape('f')} AS o FROM a), c AS (SELECT *, {S.bom('o')} AS ob FROM b),
d AS (SELECT *, {S.allowed('ob')} AS al, {S.sub('ob', f'[{P.ALLOWED}]+')} AS gone FROM c), e AS (SELECT *, {S.stray('al')} AS st FROM d),
g AS (SELECT *, {S.spaces(S.repeated(S.ellipsis('st')))} AS sp FROM e), h AS (SELECT *, {S.tidy('sp')} AS r,
  length(gone) - length({S.sub('gone', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{M}' + chr(92) + 'p{N}' + chr(92) + 'p{P}' + chr(92) + 'p{S}' + chr(92) + 'p{Z}]')}) AS ctl,
  length(gone) - length({S.sub('gone', '[' + chr(92) + 'p{So}' + chr(92) + 'p{Sk}]')}) AS dec FROM g)
SELECT sum(length(text))::BIGINT AS chars_before, sum(length(f) - length(o))::BIGINT AS literal_newlines, sum(length(o) - length(ob) + ctl)::BIGINT AS control_chars,
  sum(dec)::BIGINT AS decorative, sum(length(gone) - ctl - dec)::BIGINT AS "foreign", sum(length(al) - length(st))::BIGINT AS stray_signs,
  sum(len(string_split(sp, chr(10))))::BIGINT AS lines_before, sum(CASE WHEN r = '' THEN 0 ELSE len(string_split(r, chr(10))) END)::BIGINT AS lines_after,
  sum(length(r))::BIGINT AS chars_after, sum(strlen(r))::BIGINT AS bytes_after FROM h""",
)
add(
    "doc_boundaries", "noisy", D.split_on_blank_lines,
    f""", f AS (SELECT doc_id, {S.sub(f"array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN {S.strip('l')} = '' THEN '' ELSE l END), chr(10))", '^' + chr(92) + 'n+|' + chr(92) + 'n+' + chr(92) + 'z')} AS t FROM input),
p AS (SELECT doc_id, unnest(s) AS text, unnest(range(len(s))) AS part, len(s) AS n FROM (SELECT doc_id, regexp_split_to_array(t, {q(chr(92) + 'n{3,}')}) AS s FROM f)),
r AS (SELECT doc_id, part, {S.strip("CASE WHEN part + 1 < n THEN " + S.sub('text', chr(92) + 'n{2,}', chr(10)) + " ELSE text END")} AS text FROM p)
SELECT * FROM r WHERE text <> ''""",
)
add(
    "doc_boundary_counts", "noisy", D.count_documents,
    f"{TRIMMED}, b AS (SELECT doc_id, x = '' AND coalesce(lag(x) OVER (PARTITION BY doc_id ORDER BY line_no) = '', false) AS pair FROM t) SELECT doc_id, count(*) FILTER (pair) + 1 AS n FROM b GROUP BY doc_id",
)

# ---- Wiki ----
add("wiki_clean_lines", "noisy", lambda d: D.wiki_lines(d).where("cleaned IS NOT NULL").select("doc_id", "line_no", "cleaned"), f"{S.wiki_cte()}SELECT doc_id, line_no, cleaned FROM wiki_lines WHERE cleaned IS NOT NULL")
add("wiki_removal_reasons", "noisy", lambda d: D.wiki_reasons(D.wiki_lines(d)), f"{S.wiki_cte()}SELECT reason, count(*) AS lines FROM wiki_lines GROUP BY 1")
add(
    "wiki_markup_counters", "noisy", lambda d: D.wiki_markup(D.wiki_lines(d)),
    f"""{S.wiki_cte()}SELECT count(*) FILTER (contains(line, '[[') AND NOT contains(cleaned, '[[')) AS links, count(*) FILTER (contains(line, '{{{{') AND NOT contains(cleaned, '{{{{')) AS templates,
count(*) FILTER ({S.wiki('x', 'bullet')} AND NOT {S.wiki('cleaned', 'bullet')}) AS bullets,
count(*) FILTER ((contains(lower(line), '<ref') OR contains(lower(line), '</ref')) AND NOT contains(lower(cleaned), '<ref')) AS refs,
count(*) FILTER (contains(line, 'http') AND NOT contains(cleaned, 'http')) AS urls,
count(*) FILTER ({S.wiki('line', 'inline_brackets')} AND NOT {S.wiki('cleaned', 'inline_brackets')}) AS brackets,
count(*) FILTER ({S.wiki('line', 'inline_phonetic')} AND NOT {S.wiki('cleaned', 'inline_phonetic')}) AS phonetic FROM wiki_lines WHERE reason = 'keep'""",
)
add(
    "wiki_blank_collapse", "noisy", lambda d: D.wiki_output(D.lines_of(d)),
    f"""{S.wiki_cte()}, m AS (SELECT *, reason = 'empty' AND NOT coalesce(lag(reason = 'empty') OVER (PARTITION BY doc_id ORDER BY line_no), false) AS fb FROM wiki_lines)
SELECT doc_id, line_no, CASE WHEN fb THEN '' ELSE cleaned END AS output FROM m WHERE fb OR reason = 'keep'""",
)
add(
    "wiki_clean_documents", "noisy", lambda d: D.wiki_documents(d).select("doc_id", "text"),
    f"""{S.wiki_cte()}, g AS (SELECT doc_id, {S.strip("string_agg(cleaned, chr(10) ORDER BY line_no)")} AS text, max(length(cleaned)) AS longest FROM wiki_lines WHERE cleaned IS NOT NULL GROUP BY doc_id)
SELECT doc_id, text FROM g WHERE longest >= 30 AND length(text) >= 50""",
)

# ---- Vocabulary ----
add("chillu_words", "native", V.chillu_words, f"{S.words_cte()} SELECT word FROM words")
add("chillu_pairs", "native", lambda d: V.chillu_pairs(V.chillu_words(d)), f"{S.pairs_cte()} SELECT word, atomic FROM pairs")
add("chillu_pair_count", "native", lambda d: V.chillu_pairs(V.chillu_words(d)).agg(F.count(F.lit(1)).alias("pairs")), f"{S.pairs_cte()} SELECT count(*) AS pairs FROM pairs")
add("chillu_dictionary_rewrite", "native", lambda d: V.rewrite_tokens(D.lines_of(d), V.chillu_pairs(V.chillu_words(d))), S.pairs_cte() + S.rewritten("line", False))
_ends_off = S.sub("line", r"[\r\n]+\z")
add("clean_lines_v2", "native", lambda d: V.clean_crawl_lines(D.lines_of(d), V.chillu_pairs(V.chillu_words(d))), S.pairs_cte() + S.rewritten(S.visarga(_ends_off), True))
DICTIONARY = ("replace(line, ' ', chr(9))", lambda d: D.lines_of(d).select(F.replace("line", F.lit(" "), F.lit("\t")).alias("line")))
_ends = rf"^[^{WS}]*[\x{{0D03}}\x{{0903}}](?:[{WS}]|\z)"
add("visarga_headwords", "native", lambda d: V.visarga_headwords(DICTIONARY[1](d)), f"SELECT line FROM (SELECT {DICTIONARY[0]} AS line FROM lines) WHERE {S.match('line', _ends)}")
add("visarga_headword_count", "native", lambda d: V.visarga_headwords(DICTIONARY[1](d)).agg(F.count(F.lit(1)).alias("n")), f"SELECT count(*) AS n FROM (SELECT {DICTIONARY[0]} AS line FROM lines) WHERE {S.match('line', _ends)}")
add("headwords_with_visarga", "native", lambda d: V.headwords_with_visarga(DICTIONARY[1](d)), f"SELECT * FROM (SELECT {S.strip(f'split_part({DICTIONARY[0]}, chr(9), 1)')} AS headword FROM lines) WHERE contains(headword, {q(P.VISARGA)})")

# ---- Scans and sinks: what is written is read again ----


def stored(name: str, source: str, write: Callable[[DataFrame, str], None], read: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = scratch(spark, name)
        write(INPUTS[source](spark, sf_dir), at)
        return read(spark, at)

    QUERIES[name] = query
    SQL[name] = with_input(source, sql)


stored("stored_lines", "noisy", lambda d, at: X.write_lines(D.lines_of(d), at), X.read_lines, "SELECT line FROM lines")
stored(
    "stored_numbered_lines", "noisy", lambda d, at: X.write_sorted_lines(D.lines_of(d), at),
    lambda spark, at: X.read_numbered_lines(spark, at, across=True).select("line_no", "line"), "SELECT row_number() OVER (ORDER BY doc_id, line_no) AS line_no, line FROM lines",
)
stored("stored_line_count", "noisy", lambda d, at: X.write_lines(D.lines_of(d), at), lambda spark, at: spark.createDataFrame([(X.count_lines(spark, at),)], "lines long"), "SELECT count(*) AS lines FROM lines")
stored("stored_escaped_documents", "noisy", X.write_escaped_documents, X.read_escaped_documents, f"SELECT {S.unescape(S.strip('replace(text, chr(10), chr(92) || chr(110))'))} AS text FROM input")
stored("stored_documents", "noisy", X.write_documents, X.read_documents, f"SELECT text FROM (SELECT unnest(string_split(text, chr(10) || chr(10))) AS text FROM input) WHERE {S.strip('text')} <> ''")
stored("stored_table", "docs", lambda d, at: d.withColumn("text", F.when(F.col("doc_id") % 7 > 0, F.col("text"))).write.parquet(at), X.read_table, "SELECT doc_id, lang, CASE WHEN doc_id % 7 > 0 THEN text ELSE '' END AS text FROM input")
stored("stored_words", "native", lambda d, at: X.write_sorted_words(V.chillu_words(d), at), X.read_vocabulary, f"{S.words_cte()} SELECT word FROM words")
stored("stored_mapping", "native", lambda d, at: X.write_mapping(V.chillu_pairs(V.chillu_words(d)), at), X.read_mapping, f"{S.pairs_cte()} SELECT word, atomic FROM pairs")
_field = f"string_split({DICTIONARY[0]}, chr(9))"
stored("stored_dictionary", "native", lambda d, at: X.write_lines(DICTIONARY[1](d), at), X.read_dictionary, f"SELECT {_field}[1] AS headword, {_field}[2] AS pos, {_field}[3] AS gloss FROM lines")


def _write_both(d: DataFrame, at: str) -> None:
    X.write_split(D.labelled_lines(d), f"{at}/kept", f"{at}/log")


def _read_both(spark: SparkSession, at: str) -> DataFrame:
    return X.read_lines(spark, f"{at}/kept").select(F.lit("kept").alias("part"), "line").unionByName(X.read_lines(spark, f"{at}/log").select(F.lit("log").alias("part"), "line"))


stored(
    "stored_split", "noisy", _write_both, _read_both,
    f"{TRIMMED}, l AS (SELECT *, {S.label('x')} AS label FROM t) SELECT 'kept' AS part, line FROM l WHERE label = 'keep' UNION ALL SELECT 'log', '[' || label || '] L' || line_no || ': ' || x FROM l WHERE label <> 'keep'",
)
_zero_width = ", ".join(f"sum(length(text) - length(replace(text, {q(c)}, '')))::BIGINT AS {n}" for n, c in (("zwj", P.ZWJ), ("zwnj", P.ZWNJ), ("bom", P.BOM)))
stored(
    "stored_report", "noisy", lambda d, at: X.write_report(M.zero_width_counts(d), at), X.read_lines,
    f", z AS (SELECT {_zero_width} FROM input), u AS (SELECT name, value::VARCHAR AS value FROM (UNPIVOT z ON zwj, zwnj, bom)) SELECT rpad(name, 24, ' ') || value AS line FROM u",
)
_sample = f", s AS (SELECT doc_id, line_no, line FROM lines ORDER BY md5('audit:' || doc_id || ':' || line_no) LIMIT 100), t AS (SELECT doc_id, line_no, {S.strip('line')} AS line FROM s) "
stored(
    "stored_sample_report", "noisy", lambda d, at: X.write_sample_report(M.audit_sample(D.lines_of(d)), at), lambda spark, at: X.read_lines(spark, at).where("line != ''"),
    f"{_sample}, n AS (SELECT row_number() OVER (ORDER BY doc_id, line_no) AS k, line FROM t WHERE line <> '') SELECT 'SAMPLE #' || k || ':' AS line FROM n UNION ALL SELECT line FROM n",
)

# ---- Metrics ----
_words = f",\nw AS (SELECT unnest({S.tokens('line')}) AS word FROM lines), counts AS (SELECT word, count(*) AS n FROM w GROUP BY word)\n"
add(
    "line_metrics", "noisy", lambda d: M.line_metrics(D.lines_of(d)),
    f"{TRIMMED}SELECT count(*) AS total_lines, count(*) FILTER (x = '') AS blank_lines, count(*) FILTER (x <> '') AS non_blank_lines, max(length(line)) AS longest_line, "
    f"min(length(line)) FILTER (x <> '') AS shortest_line, round(sum(len({S.tokens('line')})) / count(*), 6) AS words_per_line FROM t",
)
add(
    "char_metrics", "noisy", lambda d: M.char_metrics(D.lines_of(d)),
    "SELECT sum(length(line))::BIGINT AS total_chars, " + ", ".join(f"sum({S.count_of('line', c)})::BIGINT AS {n}" for n, c in M.CLASSES.items()) + f", sum(length({S.sub('line', portable('[' + chr(92) + 'w' + chr(92) + 's]+'))}))::BIGINT AS punctuation FROM lines",
)
add(
    "word_metrics", "noisy", lambda d: M.word_metrics(M.word_counts(D.lines_of(d))),
    _words + f"""SELECT sum(n)::BIGINT AS total_words, count(*) AS unique_words, sum(CASE WHEN {S.match('word', '[' + P.NATIVE + ']')} THEN n ELSE 0 END)::BIGINT AS native_words,
(SELECT word FROM counts ORDER BY length(word) DESC, word LIMIT 1) AS longest_word, round(count(*) / sum(n), 6) AS type_token_ratio,
round(100.0 * sum(CASE WHEN {S.match('word', '[' + P.NATIVE + ']')} THEN n ELSE 0 END) / sum(n), 6) AS native_percent, round(sum(length(word) * n) / sum(n), 6) AS average_length FROM counts""",
)
add("word_counts", "noisy", lambda d: M.word_counts(D.lines_of(d)), _words + "SELECT word, n FROM counts")
add("word_top20", "noisy", lambda d: M.top_words(M.word_counts(D.lines_of(d))), _words + "SELECT row_number() OVER (ORDER BY n DESC, word) AS rank, word, n FROM counts ORDER BY n DESC, word LIMIT 20")
add(
    "word_length_histogram", "noisy", lambda d: M.length_histogram(M.word_counts(D.lines_of(d))),
    _words + "SELECT length(word) AS length, sum(n)::BIGINT AS n, round(100.0 * sum(n) / sum(sum(n)) OVER (), 6) AS percent, floor(sum(n) / max(sum(n)) OVER () * 30)::BIGINT AS bar FROM counts GROUP BY 1 ORDER BY 1 LIMIT 25",
)
add(
    "zero_width_counts", "noisy", M.zero_width_counts,
    "SELECT " + ", ".join(f"sum(length(text) - length(replace(text, {q(c)}, '')))::BIGINT AS {n}" for n, c in (("zwj", P.ZWJ), ("zwnj", P.ZWNJ), ("bom", P.BOM))) + " FROM input",
)
add("noise_counts", "noisy", lambda d: M.noise_counts(D.lines_of(d)), "SELECT " + ", ".join(f"sum(len(regexp_extract_all(line, {q(p)})))::BIGINT AS {n}" for n, p in P.NOISE_COUNTS.items()) + " FROM lines")
for _name, _most in (("noise_lines", 1_000_002), ("noise_lines_of_head", 4000)):
    add(
        _name, "noisy", lambda d, n=_most: M.noise_lines(D.lines_of(d), n),
        f", head AS (SELECT * FROM lines ORDER BY doc_id, line_no LIMIT {_most}) SELECT doc_id, line_no, line FROM head WHERE {S.match('line', re2('|'.join(P.NOISE_SCAN)))}",
    )
add("head_lines", "noisy", lambda d: M.head_lines(D.lines_of(d)), "SELECT doc_id, line_no, line FROM lines ORDER BY doc_id, line_no LIMIT 1000")
add("line_count", "noisy", lambda d: D.lines_of(d).agg(F.count(F.lit(1)).alias("lines")), "SELECT count(*) AS lines FROM lines")
add(
    "audit_sample", "noisy", lambda d: M.audit_sample(D.lines_of(d)),
    f", s AS (SELECT doc_id, line_no, line FROM lines ORDER BY md5('audit:' || doc_id || ':' || line_no) LIMIT 100), t AS (SELECT doc_id, line_no, {S.strip('line')} AS line FROM s) "
    "SELECT row_number() OVER (ORDER BY doc_id, line_no) AS sample_no, doc_id, line_no, line FROM t WHERE line <> ''",
)
