"""Inputs of the registered queries, derived from `documents` alike in Spark and in SQL.

The test tables hold no native script and no wiki markup, so letters are mapped to native ones, and a
line chosen by the document's id is appended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.functions.profile import CHILLU_ZWJ, VIRAMA

LETTERS = "abcdefghijklmnopqrstuvwxyz"
NATIVE_LETTERS = "".join(map(chr, [0x0D3E, 0x0D15, 0x0D17, 0x0D23, 0x0D3F, 0x0D1A, 0x0D24, 0x0D28, 0x0D41, 0x0D26, 0x0D2A, 0x0D33, 0x0D30, 0x0D32, 0x0D4D, 0x0D2E, 0x0D2C, 0x0D03, 0x0D38, 0x0D1F, 0x0D4A, 0x0D35, 0x200D, 0x0D2F, 0x0D37, 0x0D7B]))
#: Appended lines; a document gets that of its id modulo their number.
NOISE = [
    "[[വർഗ്ഗം:ചരിത്രം]]",
    "{| class=wikitable | a | b |",
    "| row | of | a | table |",
    "ഈ ലേഖനം അപൂർണ്ണമാണ് എന്ന് കാണാം",
    "this stub is short but long enough",
    "10° 31' 12\" N, 76° 12' 33\" E",
    "12 January 2019",
    "\\displaystyle x = \\frac{a}{b} some math",
    "upright=1.13|thumb|a picture of it",
    "C:\\Users\\someone and %windir%\\debug\\x",
    "/ai/ /t~t/, /d~d/ ",
    "plain prose <ref name=x>note</ref> goes on here",
    "see https://example.org/a/b for more of this",
    "Read More about all of it here",
    "call +91 98765 43210 today please",
    "(Malayalam)",
    " (). () ' '' , !  ",
    "* * * **",
    "first\n\n\nsecond after two blank lines",
    "first\n \nsecond after one blank line",
    "a literal \\n newline in here somewhere",
    "\ufeffa mark in front\u00a0and a no-break space",
    "cafe\u0301 noe\u0308l and \u212a kelvin, nai\u0308ve",
    "== Section heading that is long ==",
    "== Short ==",
    "# * list item that is long enough",
    "[[link|shown text]] and [[plain]] {{template|x}} left over []",
    "wait.... what?!?! really , . ; yes ---- ok ***",
    "© Some Company 2019 - All rights reserved",
    "- News and more things of the day",
    "\ttabs\t\tand   spaces   kept  apart \u200c\u200d ",
    "word [p] with /ai/ inline and [c] marks \u2603 \u263a",
]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))


def native_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.translate("text", LETTERS, NATIVE_LETTERS)
    atomic = reduce(lambda t, kv: F.replace(t, F.lit(kv[0] + VIRAMA), F.lit(kv[1])), CHILLU_ZWJ.items(), text)
    return documents(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 2 == 0, atomic).otherwise(text))


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.element_at(F.array(*map(F.lit, NOISE)), (F.pmod("doc_id", F.lit(len(NOISE))) + 1).cast("int"))
    return native_documents(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n"), line))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("doc_id"), F.coalesce("html", F.lit("")).alias("text"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_native() -> str:
    mapped = f"translate(coalesce(text, ''), {quoted(LETTERS)}, {quoted(NATIVE_LETTERS)})"
    atomic = reduce(lambda t, kv: f"replace({t}, {quoted(kv[0] + VIRAMA)}, {quoted(kv[1])})", CHILLU_ZWJ.items(), mapped)
    return f"SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN {atomic} ELSE {mapped} END AS text FROM documents"


SQL_INPUTS = {
    "docs": "SELECT doc_id, lang, coalesce(text, '') AS text FROM documents",
    "native": _sql_native(),
    "noisy": f"SELECT doc_id, lang, text || chr(10) || ([{', '.join(map(quoted, NOISE))}])[doc_id % {len(NOISE)} + 1] AS text FROM ({_sql_native()})",
    "html": "SELECT page_id AS doc_id, coalesce(html, '') AS text FROM pages",
}


def with_input(name: str, query: str) -> str:
    """query over the view input(doc_id, text) and lines(doc_id, line_no, line)."""
    return f"""WITH input AS ({SQL_INPUTS[name]}),
lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM input)){query if query.startswith(',') else chr(10) + query}"""
