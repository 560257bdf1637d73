"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textengine.llm.common import table
from textengine.llm.sql import OP6_SQL, OP9_SQL, PII_BASE_SQL, TARGETS_SQL, op3_sql


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.exact_dedup import exact_dedup

    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS kept,
       text_sha256
FROM d
"""


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.chat_format import END, expand, format_conversations, read_back, unescape

    both = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -1L conv_id, * FROM VALUES (0L, 'user', '{both}'), (1L, 'assistant', '{both}') AS t(turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    of_conversation = {"n_turns": F.size("turns").cast("long"), "turns_sha256": F.sha2(said, 256), "formatted_chars": F.length("formatted").cast("long")}
    rows = expand(read_back(format_conversations(turns)).withColumns(of_conversation), keep=tuple(of_conversation), outer=True)
    # What is read off an example goes on, not its text: the aggregate may sort its rows.
    chars = F.length(F.concat("prefix", "target", F.lit(END))).cast("long")
    rows = rows.select("conv_id", *of_conversation, "turn_no", "example_no", unescape(F.col("target")).alias("loss"), chars.alias("chars"))
    loss = F.when(F.col("turn_no").isNotNull(), F.struct("example_no", "loss"))
    grouped = rows.groupBy("conv_id", *of_conversation).agg(F.sort_array(F.collect_list(loss)).alias("losses"), F.coalesce(F.sum("chars"), F.lit(0)).alias("example_chars"))
    text = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return grouped.select(
        "conv_id",
        *of_conversation,
        F.length(text).cast("long").alias("loss_chars"),
        F.sha2(text, 256).alias("loss_sha256"),
        F.size("losses").cast("long").alias("n_examples"),
        "example_chars",
    )


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'),
              '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>') AS body FROM turns),
sized AS (
  SELECT *, sum(length(role) + length(body) + 13) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
              ROWS UNBOUNDED PRECEDING) AS upto FROM escaped)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(body) + 13)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM sized GROUP BY conv_id
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.quality_rules import apply_rules

    rows = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *QUALITY_COLUMNS)


def quality_rules_at_one_in_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules at a risk of 0.1, for which small tables have labels enough."""
    from textengine.llm.quality_rules import apply_rules

    rows = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.1)
    return rows.select("doc_id", *QUALITY_COLUMNS)


QUALITY_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "passed", "level"]


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.source_mixing import mix

    rows = mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.pii import KINDS, find, written

    def count(i: int):
        return F.size(F.filter("base", lambda s: s["kind_no"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    plain = F.transform("added", lambda s: F.struct(s["kind_no"].alias("kind_no"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.sort_array(F.concat("base", plain))
    rows = find(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *[count(i) for i in range(4)], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op8_pii SQL can express."""
    return op8_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def source_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op5_source_mixing SQL can express."""
    return op5_source_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.ngram_join import ngram_components

    return ngram_components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held).select("doc_id", "toxic")
    machine = fit(docs, "doc_id", "text", "toxic", labels=labels)
    return score(docs, machine).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.token_output import encode_and_read

    return encode_and_read(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textengine.llm.piece_transducer import encode

    rows = encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), keep_text=True, decoded=True)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))
    return rows.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == plain).alias("round_trip"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return SQL


QUERIES = [op1_exact_dedup, op2_token_output, op3_quality_rules, op4_chat_format, op5_source_mixing, op6_substring_dedup, op7_sentencepiece, op8_pii, op9_ngram_join, op10_toxicity, quality_rules_at_one_in_ten, pii_base_spans, source_targets]
SQL = {"op1_exact_dedup": OP1_SQL, "op3_quality_rules": op3_sql(0.01), "quality_rules_at_one_in_ten": op3_sql(0.1), "op4_chat_format": OP4_SQL, "op6_substring_dedup": OP6_SQL, "op9_ngram_join": OP9_SQL, "pii_base_spans": PII_BASE_SQL, "source_targets": TARGETS_SQL}
