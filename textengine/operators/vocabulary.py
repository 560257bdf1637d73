"""Words, word pairs and the dictionary rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textengine.functions import predicate as T
from textengine.functions import rewrite as R
from textengine.functions.profile import MASTER, Profile
from textengine.operators.documents import lines_of
from textengine.storage import cut


def chillu_words(docs: DataFrame, profile: Profile = MASTER) -> DataFrame:
    """(word): the distinct native words that hold a chillu form. Lines without one are dropped before words are made."""
    lines = lines_of(docs).where(T.may_have_chillu(F.col("line")))
    runs = lines.select(F.explode(F.regexp_extract_all("line", F.lit(f"[{profile.native}]+"), F.lit(0))).alias("word"))
    return runs.where(T.has_chillu(F.col("word"))).distinct()


def chillu_pairs(words: DataFrame) -> DataFrame:
    """(word, atomic): words whose single-letter form is a word too. Spark sizes both sides and picks the join.

    The words are written first, as both sides read them and the corpus behind them is read once.
    """
    words = cut(words, "words")
    candidates = words.where(T.convertible(F.col("word"))).select("word", R.atomic_form(F.col("word")).alias("atomic"))
    return candidates.where("word != atomic").join(words.select(F.col("word").alias("atomic")), "atomic", "left_semi").select("word", "atomic")


def rewrite_tokens(lines: DataFrame, pairs: DataFrame, keep_blank: bool = False, line: str = "line") -> DataFrame:
    """(doc_id, line_no, line): tokens whose core is in pairs replaced, tokens apart by one space.

    Only tokens that hold a convertible sequence can be in pairs, so only these are looked up, and only
    lines with one are shuffled, whole and once; the others are put together again where they are. Lines
    are written first, as they are read three times. keep_blank leaves blank lines as they are, and all lines if pairs is empty, as the last step of the
    large-crawl flow does.
    """
    lines = cut(lines.select("doc_id", "line_no", line), "lines")
    joined = F.array_join(R.tokens(F.col(line)), " ")
    blank = R.strip(F.col(line)) == ""
    asis = F.when(blank, F.col(line) if keep_blank else F.lit("")).otherwise(joined)
    plain = lines.where(~T.convertible(F.col(line)) | F.col(line).isNull()).select("doc_id", "line_no", asis.alias("line"))
    taken = lines.where(T.convertible(F.col(line))).select("doc_id", "line_no", F.col(line).alias("line"), F.xxhash64(line).alias("hash"))
    each = F.filter(F.transform(R.tokens(F.col("line")), lambda t, i: F.struct(i.alias("at"), t.alias("token"))), lambda x: T.convertible(x["token"]))
    looked_up = taken.select("doc_id", "line_no", "hash", F.inline(each)).withColumn("core", R.token_core(F.col("token")))
    found = looked_up.join(pairs.where("word != ''").select(F.col("word").alias("core"), "atomic"), "core")
    before = F.length("token") - F.length(F.ltrim("token", F.lit(R.P.TOKEN_PUNCTUATION)))
    around = F.concat(F.substring(F.col("token"), F.lit(1), before), F.col("atomic"), F.substring(F.col("token"), before + F.length("core") + 1, F.length("token")))
    new = found.groupBy(F.col("doc_id").alias("d"), F.col("line_no").alias("l"), F.col("hash").alias("h")).agg(F.array_sort(F.collect_set(F.struct("at", around.alias("token")))).alias("new"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("line_no").eqNullSafe(F.col("l")) & (F.col("hash") == F.col("h"))
    again = taken.join(new, same, "left").select("doc_id", "line_no", F.array_join(_with(R.tokens(F.col("line")), F.col("new")), " ").alias("line"))
    return plain.unionByName(again)


def _with(tokens: Column, new: Column) -> Column:
    """tokens with those of new, structs (at from 0, token) by place, in theirs; tokens if new is null."""

    def put(tokens: Column) -> Column:
        def stretch(x: Column, i: Column) -> Column:
            start = F.when(i > 0, F.get(new, i - 1)["at"] + 1).otherwise(0)
            return F.concat(F.slice(tokens, start + 1, x["at"] - start), F.array(x["token"]))

        rest = F.get(new, F.size(new) - 1)["at"] + 1
        return F.when(new.isNull(), tokens).otherwise(F.concat(F.flatten(F.transform(new, stretch)), F.slice(tokens, rest + 1, F.size(tokens) - rest)))

    return R.once(tokens, put)


def clean_crawl_lines(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The large-crawl step: line ends off, visarga to colon, dictionary rewrite."""
    ready = lines.withColumn("line", R.visarga_to_colon(R.rstrip_newlines(F.col("line"))))
    return ready if pairs.isEmpty() else rewrite_tokens(ready, pairs, keep_blank=True)


def visarga_headwords(dictionary: DataFrame) -> DataFrame:
    """(line): dictionary lines (tab-separated) whose headword ends in a visarga."""
    return dictionary.where(T.visarga_headword(F.col("line")))


def headwords_with_visarga(dictionary: DataFrame) -> DataFrame:
    """(headword): trimmed first fields that hold a visarga."""
    word = R.strip(F.get(F.split("line", "\t"), F.lit(0)))
    return dictionary.select(word.alias("headword")).where(F.col("headword").contains(R.P.VISARGA))
