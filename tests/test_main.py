import json

from textengine.__main__ import FLOWS, main
from textengine.functions import profile as P


def read(path):
    return [line for f in sorted(path.glob("part-*")) for line in f.read_text().splitlines()]


def test_flows_on_paths(spark, tmp_path, capsys):
    legacy, atomic = "അവന" + P.VIRAMA, "അവൻ"
    lines = [f"{legacy} ({atomic}) ഒരു നല്ല വരിയാണ് എന്ന് ഞാൻ കരുതുന്നു", "", " ", "Read More here", f"[] അന്തഃ {legacy} ഇത് ഒരു നല്ല വരിയാണ് x", "abc"]
    source = tmp_path / "in.txt"
    source.write_text("\n".join(lines) + "\n")
    run = lambda flow, *rest: main([flow, str(source), *map(str, rest)], spark)
    out = lambda name: tmp_path / name
    run("words", out("words"))
    assert legacy in read(out("words")) and atomic in read(out("words"))
    main(["pairs", str(out("words")), str(out("pairs"))], spark)
    assert json.loads("".join(read(out("pairs")))) == {legacy: atomic}
    run("replace", out("pairs"), out("replaced"))
    assert read(out("replaced")) == [lines[0].replace(legacy, atomic), "", "", lines[3], lines[4].replace(legacy, atomic), "abc"]
    run("crawl", out("pairs"), out("crawled"))
    assert read(out("crawled")) == [lines[0].replace(legacy, atomic), "", " ", lines[3], lines[4].replace(legacy, atomic).replace("അന്തഃ", "അന്ത:"), "abc"]
    run("clean-wiki", out("wiki"))
    assert read(out("wiki")) == [lines[0], "", lines[3], lines[4][3:]]
    run("split-boilerplate", out("kept"), out("log"))
    assert read(out("kept")) == [lines[0], lines[4]]
    assert read(out("log")) == ["[remove_empty] L2: ", "[remove_empty] L3: ", "[remove_keyword] L4: Read More here", "[remove_heuristic] L6: abc"]
    run("clean-documents", out("cleaned"))
    assert [x for x in read(out("cleaned")) if x] == [lines[0], lines[4].replace("[] ", "[] ")]
    for flow in ("structure", "zwj", "visarga", "chillu-rules", "headwords", "sample"):
        run(flow, out(flow))
        assert (out(flow) / "_SUCCESS").exists()
    assert read(out("zwj")) == lines
    capsys.readouterr()
    for flow in ("metrics", "count", "noise"):
        run(flow)
    said = capsys.readouterr().out
    assert "total_lines\t6" in said and "brackets\t1" in said and f"5\t{lines[4]}" in said
    assert set(FLOWS) >= {"metrics", "crawl"}
