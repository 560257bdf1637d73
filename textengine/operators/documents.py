"""Operators on documents and their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import rewrite as R
from textengine.functions.profile import MASTER, STANDALONE, WIKIPEDIA, Profile, WikiProfile


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, line_no from 1, line)."""
    return docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("at", "line")).select("doc_id", (F.col("at") + 1).alias("line_no"), "line")


def clean_text(raw: Column, profile: Profile = MASTER) -> Column:
    """The document cleaner up to its last check: unescape, chillus, structure, boilerplate lines, trim."""
    text = R.structural_master(R.zwj_to_chillu(R.unescape_newlines(R.strip(raw))), profile)
    kept = F.filter(F.split(text, "\n"), lambda line: ~T.boilerplate_trimmed(line, profile))  # the lines are trimmed there
    return R.strip(F.array_join(kept, "\n"))


def long_enough(text: Column, least: int) -> Column:
    """The text where it has that length, else no row: a generator, so that text is not computed again for the test."""
    return F.explode(F.filter(F.array(text), lambda t: F.length(t) >= least))


def clean_documents(docs: DataFrame, profile: Profile = MASTER) -> DataFrame:
    """docs with text cleaned; documents under the least length go. One narrow stage, no shuffle."""
    return docs.withColumn("text", long_enough(clean_text(F.col("text"), profile), profile.least_document))


def clean_counts(docs: DataFrame, profile: Profile = MASTER) -> DataFrame:
    """total, kept, dropped, keep_rate (per cent)."""
    kept = F.count_if(F.col("length") >= profile.least_document)
    out = docs.select(F.explode(F.array(F.length(clean_text(F.col("text"), profile)))).alias("length")).agg(F.count(F.lit(1)).alias("total"), kept.alias("kept"))
    return out.select("total", "kept", (F.col("total") - F.col("kept")).alias("dropped"), F.when(F.col("total") > 0, 100.0 * F.col("kept") / F.col("total")).otherwise(0.0).alias("keep_rate"))


def labelled_lines(docs: DataFrame, profile: Profile = STANDALONE) -> DataFrame:
    return lines_of(docs).withColumn("label", F.explode(F.array(T.line_label(F.col("line"), profile))))  # computed once, whatever reads it


def label_counts(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("lines"))
    share = 100.0 * F.col("lines") / F.sum("lines").over(Window.partitionBy())
    return counts.select("label", "lines", F.round(share, 6).alias("percent"))


def removal_log(labelled: DataFrame) -> DataFrame:
    """(doc_id, line_no, entry): what the removal log says of each removed line."""
    entry = F.format_string("[%s] L%d: %s", "label", "line_no", R.strip(F.col("line")))
    return labelled.where("label != 'keep'").select("doc_id", "line_no", entry.alias("entry"))


def wiki_lines(docs: DataFrame, profile: WikiProfile = WIKIPEDIA) -> DataFrame:
    """lines with cleaned (null where the line goes) and reason."""
    return wiki_cleaned(lines_of(docs), profile)


def wiki_cleaned(lines: DataFrame, profile: WikiProfile = WIKIPEDIA) -> DataFrame:
    def both(line: Column) -> Column:
        cleaned = R.wiki_line(line, lambda x: T.wiki_removed(x, profile), profile)
        return R.once(cleaned, lambda c: F.struct(c.alias("cleaned"), T.wiki_reason(line, c, profile).alias("reason")))

    return lines.select("*", F.inline(F.array(both(F.col("line")))))  # computed once, whatever reads it


def wiki_output(lines: DataFrame, profile: WikiProfile = WIKIPEDIA) -> DataFrame:
    """Of (doc_id, line_no, line) what the wiki cleaner writes: cleaned lines, and one empty line for each run of blank lines.

    A blank line is a run's first if the line before it is not blank: each tells its own number and the next,
    and these meet by number, so that a file of any length is many tasks' work.
    """
    blank = lines.where(R.strip(F.col("line")) == "")
    told = F.inline(F.array(F.struct(F.col("line_no").alias("line_no"), F.lit(True).alias("own")), F.struct((F.col("line_no") + 1).alias("line_no"), F.lit(False).alias("own"))))
    seen = blank.select("doc_id", told).where("own OR line_no IS NOT NULL").groupBy("doc_id", "line_no").agg(F.count_if("own").alias("own"), F.count_if(~F.col("own")).alias("before"))
    first = seen.where("before = 0").select("doc_id", "line_no", F.explode(F.array_repeat(F.lit(""), F.col("own").cast("int"))).alias("output"))
    kept = wiki_cleaned(lines, profile).where("reason = 'keep'").select("doc_id", "line_no", F.col("cleaned").alias("output"))
    return kept.unionByName(first)


def wiki_reasons(lines: DataFrame) -> DataFrame:
    return lines.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def wiki_markup(lines: DataFrame, profile: WikiProfile = WIKIPEDIA) -> DataFrame:
    """How many kept lines lost each kind of markup."""
    p = profile.patterns
    line, cleaned, x = F.col("line"), F.col("cleaned"), R.strip(F.col("line"))
    has = lambda c, name: c.rlike(T.java(p[name]))
    gone = {
        "links": line.contains("[[") & ~cleaned.contains("[["),
        "templates": line.contains("{{") & ~cleaned.contains("{{"),
        "bullets": has(x, "bullet") & ~has(cleaned, "bullet"),
        "refs": (F.lower(line).contains("<ref") | F.lower(line).contains("</ref")) & ~F.lower(cleaned).contains("<ref"),
        "urls": line.contains("http") & ~cleaned.contains("http"),
        "brackets": has(line, "inline_brackets") & ~has(cleaned, "inline_brackets"),
        "phonetic": has(line, "inline_phonetic") & ~has(cleaned, "inline_phonetic"),
    }
    return lines.where("reason = 'keep'").agg(*[F.count_if(c).alias(n) for n, c in gone.items()])


def wiki_documents(docs: DataFrame, profile: WikiProfile = WIKIPEDIA) -> DataFrame:
    """Whole documents through the wiki line cleaner; short ones and those without a line of prose go."""
    cleaned = F.transform(F.split("text", "\n"), lambda line: R.wiki_line(line, lambda x: T.wiki_removed(x, profile), profile))
    prose = lambda lines: F.when(F.exists(lines, lambda line: F.length(line) >= profile.least_prose), R.strip(F.array_join(lines, "\n")))
    text = R.once(F.filter(cleaned, lambda line: line.isNotNull()), prose)
    return docs.withColumn("text", long_enough(text, profile.least_document))


def structural_stats(docs: DataFrame, profile: Profile = MASTER) -> DataFrame:
    """What the stand-alone structural cleanup removes, summed over all documents."""
    count = lambda x, pattern: F.length(x) - F.length(F.regexp_replace(x, pattern, ""))
    control = r"(?![\p{L}\p{M}\p{N}\p{P}\p{S}\p{Z}])[\x{0}-\x{10FFFF}]"
    c = F.col
    steps = [
        {"unescaped": R.unescape_newlines(c("first"))},
        {"opened": R.drop_bom(c("unescaped"))},
        {"removed": F.regexp_replace("opened", f"[{profile.allowed}]+", ""), "allowed": R.allow_characters(c("opened"), profile)},
        {"steady": R.drop_stray_signs(c("allowed"), profile)},
        {"spaced": R.collapse_spaces(R.collapse_repeated(R.collapse_ellipsis(c("steady"))))},
        {"after": R.tidy_lines(c("spaced")), "control": count(c("removed"), control), "signs": count(c("removed"), r"[\p{So}\p{Sk}]")},
    ]
    work = docs.select("text", R.nfc(c("text")).alias("first"))
    for step in steps:  # behind a generator each, so that none is computed again for each sum
        work = work.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in step.items()]))))
    work = work.select(
        F.length("text").alias("chars_before"),
        (F.length("first") - F.length("unescaped")).alias("literal_newlines"),
        (F.length("unescaped") - F.length("opened") + c("control")).alias("control_chars"),
        c("signs").alias("decorative"),
        (F.length("removed") - c("control") - c("signs")).alias("foreign"),
        (F.length("allowed") - F.length("steady")).alias("stray_signs"),
        F.size(F.split("spaced", "\n")).alias("lines_before"),
        F.when(c("after") == "", 0).otherwise(F.size(F.split("after", "\n"))).alias("lines_after"),
        F.length("after").alias("chars_after"),
        F.octet_length("after").alias("bytes_after"),
    )
    return work.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in work.columns])


def split_on_blank_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text): documents apart by two blank lines or more; all but the last lose their single blank lines."""
    flat = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.when(R.strip(x) == "", "").otherwise(x)), "\n")
    flat = F.regexp_replace(flat, r"^\n+|\n+\z", "")
    parts = docs.select("doc_id", F.split(flat, r"\n{3,}").alias("parts"))
    exploded = parts.select("doc_id", F.size("parts").alias("n"), F.posexplode("parts").alias("part", "text"))
    text = R.strip(F.when(F.col("part") + 1 < F.col("n"), F.regexp_replace("text", r"\n{2,}", "\n")).otherwise(F.col("text")))
    return exploded.select("doc_id", F.col("part").cast("long").alias("part"), text.alias("text")).where("text != ''")


def count_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n): neighbouring pairs of blank lines, and one."""
    blank = R.strip(F.col("line")) == ""
    before = F.lag(blank, 1, False).over(Window.partitionBy("doc_id").orderBy("line_no"))
    pairs = lines_of(docs).select("doc_id", (blank & before).alias("pair"))
    return pairs.groupBy("doc_id").agg((F.count_if("pair") + 1).alias("n"))
