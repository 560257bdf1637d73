import re
from collections import defaultdict

import sentencepiece
from test_ngram_join import brute
from test_quality_rules import brute as metrics
from test_source_mixing import brute_targets

import corpus_pipeline as C
from textengine.llm.common import table
from textengine.llm.registry import tokenizer_path

SF = "/root/testdata/sf0.01"
W = re.compile(r"[^\x20\x09-\x0D]+")


def test_each_stage_matches_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    outputs = []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outputs.append([tuple(r) for r in docs.collect()])
        if k < len(C.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [tuple(r) for r in table(spark, SF, "documents").collect()]
    # Too few labels here to certify a cutoff: the base rule alone decides.
    good = [r for r in rows if not metrics(r[1])[5]]
    assert sorted(outputs[0]) == sorted(good)
    groups = defaultdict(list)
    for r in good:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1])].append(r)
    single = [min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values()]
    assert sorted(outputs[1]) == sorted(single)
    found = near_brute([(r[0], r[1]) for r in single])
    kept = [r for r in single if found[r[0]] == r[0]]
    assert sorted(outputs[2]) == sorted(kept)
    times, size, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in outputs[3]:
        times[r] += 1
        taken[r[3]] += len(W.findall(r[1]))
    for r in kept:
        size[r[3]] += len(W.findall(r[1]))
    assert set(times) <= set(kept) and max(times.values()) <= 2
    for s, want in brute_targets(size).items():
        assert abs(taken[s] - want) <= 0.02 * want + 120
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in kept}
    assert len(outputs[4]) == len(outputs[3])
    for doc_id, _, n, ids, same in outputs[4]:
        want = library.encode(texts[doc_id])
        assert same and n == len(want) and memoryview(ids).cast("I").tolist() == want


def near_brute(rows):
    return {i: c for i, (_, c) in brute(rows, 80, 5).items()}


def test_run_is_the_stages_in_order(spark):
    assert C.run(spark, "/root/testdata/sf0.001").where("NOT round_trip").count() == 0
