r"""Chat formatting with prefix-target expansion, in DataFrame operations only.

A turn becomes ``<|role|>`` newline text ``<|end|>`` newline. Inside roles and texts a backslash goes
before every backslash and into every control string (``<|``, ``</s>``, ``<s>``, ``[INST]``,
``[/INST]``, ``<<SYS>>``), so no text can open or close a turn, here or in a common other template;
taking the first backslash of each pair away gives the text back.

Every assistant turn is an example of its own: all turns before it are its context and only its text
is trainable. As turns are formatted one after another, an example is a prefix of its conversation's
formatted text, so an example row holds where its context, its trainable span and it itself end, and
the text is stored once, in proportion to the input. ``expand`` is the expansion itself: each example
with its prefix (all turns before and the reply's header) and its target (the reply) as texts, made row
by row beside the conversation, without a shuffle or join. All prefixes together grow with the square
of a conversation's turns; ``with_text`` makes the full example of chosen rows.

Defined results: null texts and null roles are empty; turns go by number (null first), equal numbers by
role, then text; null conversation ids are one conversation; a conversation without an assistant has no
example. Other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings and how they look inside a text. The backslash itself comes first.
ESCAPES = [("\\", "\\\\"), ("<|", "<\\|"), ("</s>", "<\\/s>"), ("<s>", "<\\s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]"), ("<<SYS>>", "<\\<SYS>>")]
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def escape_role(role: Column) -> Column:
    """As a text; `|>` cannot close the header either."""
    return F.replace(escape(role), F.lit("|>"), F.lit("|\\>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each conversation: id, formatted, n_turns, targets (array of loss_start, loss_end, end; code points)."""
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(CLOSE))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END))).withColumn("chars", F.length("piece").cast("long"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"no": F.row_number().over(order), "end": F.sum("chars").over(so_far)})
    loss_start = F.col("end") - F.col("chars") + F.length("head")
    target = F.when(F.col("role") == TRAINABLE, F.struct(F.col("no").alias("turn_no"), (F.col("end") - F.col("chars")).alias("context_end"), loss_start.alias("loss_start"), (loss_start + F.length("body")).alias("loss_end"), F.col("end").alias("end")))
    grouped = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("no", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(target)).alias("targets"),
        F.count(F.lit(1)).alias("n_turns"),
    )
    return grouped.select(F.col("conv").alias(conv_col), F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "n_turns", "targets")


def examples(formatted: DataFrame, conv_col: str = "conv_id", keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """A row for each assistant turn: conversation, the columns of keep, example_no, turn_no, context_end, loss_start, loss_end, end.

    Of formatted conversations that were read back, also loss, the trainable text. With outer, a conversation
    without an assistant turn has one row, of nulls.
    """
    read = "losses" in formatted.columns
    each = F.arrays_zip("targets", "losses") if read else F.transform("targets", lambda t: F.struct(t.alias("targets")))
    rows = formatted.select(conv_col, *keep, (F.posexplode_outer if outer else F.posexplode)(each).alias("example_no", "t"))
    return rows.select(conv_col, *keep, "example_no", "t.targets.*", *([F.col("t.losses").alias("loss")] if read else []))


def expand(formatted: DataFrame, conv_col: str = "conv_id", keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """The rows of examples, each with the texts prefix and target; an example is both and END."""
    whole = formatted.drop("losses").withColumn("__te_whole", F.col("formatted"))
    rows = examples(whole, conv_col, (*keep, "__te_whole"), outer)
    prefix = F.substring(F.col("__te_whole"), F.lit(1), F.col("loss_start").cast("int"))
    target = F.substring(F.col("__te_whole"), F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return rows.withColumns({"prefix": prefix, "target": target}).drop("__te_whole")


def with_text(formatted: DataFrame, chosen: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The chosen examples with their whole text: context, then the reply."""
    other = formatted.select(F.col(conv_col).alias("__te_conv"), "formatted")
    joined = chosen.join(other, F.col(conv_col).eqNullSafe(F.col("__te_conv")))
    return joined.select(*chosen.columns, F.substring(F.col("formatted"), F.lit(1), F.col("end").cast("int")).alias("example"))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with what a reader of it finds: turns (array of role, text) and losses (the unescaped trainable texts)."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda p: p != "")

    def turn(p: Column) -> Column:
        cut = F.instr(p, CLOSE)
        return F.struct(unescape(F.substring(p, F.lit(3), cut - 3)).alias("role"), unescape(F.substring(p, cut + F.lit(len(CLOSE)), F.length(p))).alias("text"))

    loss = F.transform("targets", lambda t: unescape(F.substring(F.col("formatted"), t["loss_start"].cast("int") + 1, (t["loss_end"] - t["loss_start"]).cast("int"))))
    return formatted.withColumns({"turns": F.transform(pieces, turn), "losses": loss})
