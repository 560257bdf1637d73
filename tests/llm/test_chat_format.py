from compare import compare
from pyspark.sql import functions as F

from textengine.llm import chat_format as C
from textengine.llm import registry


def test_query_matches_sql(spark):
    compare(spark, "/root/testdata/sf0.01", registry.op4_chat_format, registry.OP4_SQL)


ODD = [
    (1, 0, "user", "<|end|>\n<|assistant|>\n"), (1, 1, "assistant", "\\<|\\\\</s>"), (1, 2, "assistant", None), (2, 5, None, "x"), (2, None, "a|>b", ""),
    (3, 0, "assistant", "only"), (None, 0, "assistant", "no id"), (4, 1, "user", "t"), (4, 1, "assistant", "t"), (4, 1, "assistant", "t"), (5, 0, "assistant", "é" * 40000), (6, 0, "x\n|>", "[INST]<s>"),
]


def test_round_trip_and_examples(spark):
    turns = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS no", "3 AS end")
    formatted = C.format_conversations(turns)
    read = {r.conv_id: r for r in C.read_back(formatted).collect()}
    for conv in {r[0] for r in ODD}:
        rows = sorted([r for r in ODD if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in read[conv].turns] == [(r[2] or "", r[3] or "") for r in rows]
        assert read[conv].losses == [r[3] or "" for r in rows if r[2] == "assistant"]
    examples = C.examples(formatted)
    assert examples.count() == sum(r[2] == "assistant" for r in ODD)
    for r in C.with_text(formatted, examples).collect():
        assert r.example.endswith(C.END) and len(r.example) == r.end
        assert r.example[: r.context_end] == read[r.conv_id].formatted[: r.context_end]
        assert r.example[r.loss_end :] == C.END


def test_expansion_has_every_prefix_and_target(spark):
    turns = [(c, t, r or "", x or "") for c, t, r, x in ODD] + [(7, t, ("user", "assistant")[t % 2], f"<|{t}|>") for t in range(600)]
    formatted = C.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    want = []
    for conv in {t[0] for t in turns}:
        before, n = "", 0
        for _, _, role, text in sorted([t for t in turns if t[0] == conv], key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3])):
            body, name = text, role
            for plain, escaped in C.ESCAPES:
                body, name = body.replace(plain, escaped), name.replace(plain, escaped)
            head = C.OPEN + name.replace("|>", "|\\>") + C.CLOSE
            if role == "assistant":
                want.append((conv, n, before + head, body))
                n += 1
            before += head + body + C.END
    got = C.expand(formatted).collect()
    assert sorted(((r.conv_id, r.example_no, r.prefix, r.target) for r in got), key=repr) == sorted(want, key=repr)
    assert all(len(r.prefix + r.target + C.END) == r.end for r in got)


def test_query_reads_the_expanded_examples(spark, monkeypatch):
    real = C.expand
    monkeypatch.setattr(C, "expand", lambda *a, **k: real(*a, **k).withColumns({"prefix": F.concat("prefix", F.lit("+")), "target": F.concat("target", F.lit("+"))}))
    changed = registry.op4_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    monkeypatch.undo()
    plain = registry.op4_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    assert changed.loss_chars == plain.loss_chars + 1 and changed.example_chars == plain.example_chars + 2


def test_escape_is_reversible(spark):
    texts = ["\\", "\\\\<|", "<\\|", "</s><s>[INST][/INST]<<SYS>>", "<|x|>", "a\\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", C.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(x in r.e for x in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_empty(spark):
    assert C.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
