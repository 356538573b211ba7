"""Corpus files, pages, conversion and the commands, on fixtures written for them."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom import cli, schema
from corpusloom.convert import convert_bytes, converted, eqedit_script, equation_to_latex, infer_extension, mime_type, raw_hints, readable_score, with_equations
from corpusloom.functions import pages
from corpusloom.functions.html import page_to_markdown
from corpusloom.operators import ordered
from corpusloom.plans import pipeline
from corpusloom.sources.corpus import load_documents, parse_documents, parse_front_matter, write_documents


def hwpx(*sections):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for i, xml in enumerate(sections):
            archive.writestr(f"Contents/section{i}.xml", xml)
    return data.getvalue()


SECTION = '<s xmlns:hp="u"><hp:p>첫 문단</hp:p><hp:tbl><hp:tr><hp:tc><hp:p>이름</hp:p></hp:tc><hp:tc><hp:p>값</hp:p></hp:tc></hp:tr><hp:tr><hp:tc>하나뿐</hp:tc></hp:tr></hp:tbl><hp:equation script="A=B+1"/></s>'
BUNDLE = '---\nid: "d1"\ntitle: "규정 하나"\nsource_url: "http://x"\ndocument_type: rule\nlanguage: en_US\ncollected_at: "2026-01-01T00:00:00Z"\ncontent_hash: "ab"\nattachments:\n  - id: "a1"\n    title: "서식: 하나"\n    status: "converted"\n    size: 12\n  - id: "a2"\n    title: "개정이유"\n---\n\n본문\n\n---\n끝\n'


def test_front_matter():
    fields, listed = parse_front_matter("a: \"x\\ny\"\nb: 'it''s'\nc: 007\nd: []\nattachments:\n  - id: 1\n    title: t: u\ne: z")
    assert fields == {"a": "x\ny", "b": "it's", "c": "7", "d": "", "e": "z"} and listed == [{"id": "1", "title": "t: u"}]


def test_parse_and_refuse(spark):
    files = spark.createDataFrame([("p", BUNDLE.replace("\n", "\r\n"))], "path string, text string")
    row = parse_documents(files).first()
    assert (row["id"], row["language"], row["body"]) == ("d1", "en", "본문\n\n---\n끝")
    assert [(a["id"], a["status"], a["size"]) for a in row["attachments"]] == [("a1", "converted", 12), ("a2", "pending", 0)]
    bad = spark.createDataFrame([("p", "no front matter"), ("q", '---\nid: "x"\n---\n')], "path string, text string")
    assert parse_documents(bad, permissive=True).where("malformed is not null").count() == 2
    with pytest.raises(Exception, match="front matter|required"):
        parse_documents(bad).collect()


def test_round_trip(spark, tmp_path):
    root = str(tmp_path / "a b+c")
    docs = parse_documents(spark.createDataFrame([("p", BUNDLE)], "path string, text string"))
    os.makedirs(f"{root}/en/rules")
    open(f"{root}/en/rules/규정-하나.md", "w").write(BUNDLE)
    assert write_documents(docs, root) == 1
    assert not os.path.exists(f"{root}/en/rules/규정-하나.md")
    os.makedirs(f"{root}/en/rules/규정-하나/attachments")
    open(f"{root}/en/rules/규정-하나/attachments/x.md", "w").write("no document")
    again = load_documents(spark, root).collect()
    assert [r["path"] for r in again] == ["en/rules/규정-하나/index.md"]
    assert again[0].asDict() | {"path": ""} == docs.first().asDict() | {"path": ""}
    assert load_documents(spark, str(tmp_path / "none")).count() == 0


def test_html():
    assert page_to_markdown("<p>하나 <b>둘</b></p><ul><li>셋</li></ul><br>넷 &amp; 다섯") == "하나**둘**\n\n- 셋\n넷 & 다섯"
    assert page_to_markdown(None) == "" and page_to_markdown("<p>x</p><a href=") == "x"


def test_arguments():
    cases = {"f('a'+'b','c', \"d\")": ["ab", "c", "d"], "go(1, g(2,3), 'x')": ["1", "g(2,3)", "x"], "'a' 'b'": ["a", "b"], "": [], None: [], "f('a'": ["a"]}
    assert {k: pages.call_arguments(k) for k in cases} == cases


HOME = """<div class="boardA"><strong>최근 규정</strong><ul><li><p title="규정 A" onclick="view('11','Y')">규정 A</p><span>2026. 1. 5.</span></li><li><p>빈</p></li></ul></div>
<div class='x boardA'><strong>제정 예고</strong><ul><li><p onclick="v('21','M1')">예고 &amp; B</p><span>2026.02.03</span></li></ul></div>"""
RULE = """<p class="title">규정 A</p><p class="jang">[시행일: 2026. 3. 1.] 2026.2.1</p><div id="innerbody"><p>제1조</p></div>
<script>obj.put('statehistoryid', 'H9');</script>
<a onclick="downFile('서식.hwpx','s1.hwpx','f1')">서식</a><a onclick="downFileView('a','b','c')">보기</a><span onclick="downFile('x.hwp','x_rea.hwp','f')">개정이유</span>
<li class="filename" onclick="down('서식.hwpx','s1.hwpx','f1')">서식</li><li class="filename" onclick="down('둘.pdf','s2.pdf','f1')">둘</li>"""
NOTICE = """<div class="popTT">제목 <a>닫기</a></div><table><tr><th>내용</th><td><p>예고 본문</p></td></tr></table><ul><li class="filename" onclick="d('신구조문.hwp','n1.hwp','BBS')">신구조문</li></ul>"""


def test_pages(spark):
    frame = lambda html: spark.createDataFrame([("11", "", "11", "", "", "", "", html)], "id string, title string, book_id string, category string, effective_date string, published_date string, state_history_id string, html string")
    found = [(r["id"], r["title"], r["document_type"], r["menu_id"], r["effective_date"], r["published_date"]) for r in pages.recent_items(frame(HOME)).orderBy("ord").collect()]
    assert found == [("11", "규정 A", "rule", "", "2026-01-05", ""), ("21", "예고 & B", "notice", "M1", "", "2026-02-03")]
    rule = pages.rule_documents(frame(RULE), "http://h").first()
    assert (rule["title"], rule["body"], rule["effective_date"], rule["published_date"], rule["state_history_id"]) == ("규정 A", "제1조", "2026-03-01", "2026-03-01", "H9")
    assert [(r["server_file"], r["id"]) for r in pages.rule_attachments(frame(RULE), "id").orderBy("pos").collect()] == [("s1.hwpx", "11-s1-hwpx"), ("s2.pdf", "11-s2-pdf")]
    notice = pages.notice_documents(frame(NOTICE), "http://h").first()
    assert (notice["title"], notice["body"]) == ("제목 닫기", "예고 본문")
    assert [r["file_name"] for r in pages.notice_attachments(frame(NOTICE), "id").collect()] == ["신구조문.hwp"]
    checks = spark.createDataFrame([("a.pdf", b"%PDF-1"), ("a.pdf", b"PK"), ("a.hwp", b" <html>"), ("a.hwp", b"x alert('no')"), ("a.hwp", b"\x00")], "n string, c binary")
    assert [r[0] is None for r in checks.select(pages.download_error(F.col("n"), F.col("c"))).collect()] == [True, False, False, False, True]


def test_hwpx():
    text = convert_bytes(".hwpx", hwpx(SECTION, SECTION))
    assert text.split("\n\n")[0].split("\n") == ["| 이름 | 값 |", "첫 문단", "수식: A=B+1"]
    assert raw_hints(".hwpx", hwpx(SECTION))[0] > 0 and raw_hints(".hwpx", b"broken") == (0, 0) and raw_hints(".pdf", b"x") == (0, 0)


def test_formats(spark):
    rows = [("a-hwp/x", b""), ("x", b"%PDF-1"), ("x", b"PK\x03\x04"), ("x.HTML", b""), ("x", b"?"), ("d.hwpx", hwpx(SECTION)), ("e.txt", "가".encode()), ("f.txt", b"  "), ("g.pdf", b"no"), ("h.txt", None)]
    files = spark.createDataFrame(rows, "path string, content binary")
    assert [r[0] for r in files.select(infer_extension(F.col("path"), F.col("content"))).collect()] == [".hwp", ".pdf", ".hwpx", ".html", "", ".hwpx", ".txt", ".txt", ".pdf", ".txt"]
    done = {r["path"]: r for r in converted(files.where("path rlike '^[d-h]'")).collect()}
    assert [done[p]["status"] for p in ("d.hwpx", "e.txt", "f.txt", "g.pdf", "h.txt")] == ["converted", "converted", "failed", "failed", "failed"]
    assert done["e.txt"]["text"] == "가\n" and done["f.txt"]["error"] and done["d.hwpx"]["raw_tables"] > 0
    scores = spark.createDataFrame([("가a",), ("��a",), ("",), ("--",)], "t string").select(readable_score(F.col("t"))).collect()
    assert [round(r[0], 3) for r in scores] == [1.0, 0.333, 0.0, 0.0]
    assert spark.range(1).select(mime_type(F.lit("a/b.PDF")), mime_type(F.lit("x"))).first()[:] == ("application/pdf", "")


def test_equations():
    cases = {
        "{보유일수} over {기준일수} GEQ 이행률": r"\frac{\text{보유일수}}{\text{기준일수}} \ge \text{이행률}", "hat{beta _{j}}": r"\hat{\beta_{j}}", "AB_{T-1D": "AB_{T - 1D}", "matrix{a & b # c & d}": r"\begin{matrix}a & b \\ c & d\end{matrix}",
        "sum _{i=1} ^{m} x _{i}": r"\sum_{i = 1}^{m} x_{i}", "LEFT ( a over b RIGHT )": r"\left( \frac{a}{b} \right)", "": "", 'x = "평균 값"': r"x = \text{평균 값}", "sqrt {a}": r"\sqrt{a}", "1+f TIMES {t} over {365}": r"1 + \frac{f \times {t}}{365}",
    }
    assert {k: equation_to_latex(k) for k in cases} == cases
    for script in ["{{{", "}}}", "a over", "over b", "_", "^{", 'LEFT {', '"', "a/b/c", "x_{1}_{2}", "# & #", None]:
        latex = equation_to_latex(script)
        bare = latex.replace(r"\{", "").replace(r"\}", "")
        assert bare.count("{") == bare.count("}")
    script = "a over b"
    payload = b"\0" * 4 + len(script).to_bytes(2, "little") + script.encode("utf-16le") + "HYhwpEQ".encode("utf-16le")
    assert eqedit_script(payload) == script and eqedit_script(b"") == "" and eqedit_script(None) == ""
    assert "```math" in with_equations("본문", [script, " "]) and with_equations("본문", []) == "본문"


def test_unique_names(spark):
    names = ["a.md", "a.md", "a-2.md", "a.md", None, "", "b", "b"] + ["가" * 60 + ".md"] * 3
    rows = [("p", i, n) for i, n in enumerate(names)] + [("q", 0, "a.md"), (None, 0, "a.md"), (None, 1, "a.md")]
    found = ordered.unique_names(spark.createDataFrame(rows, "parent string, ord int, name string"), "parent", "ord", "name").collect()
    own = [r["unique_name"] for r in sorted((r for r in found if r["parent"] == "p"), key=lambda r: r["ord"])]
    assert own == ordered.fold_unique([n or "" for n in names], 160)
    assert own[:4] == ["a.md", "a-2.md", "a-2-2.md", "a-3.md"] and len(set(own)) == len(own) and all(len(n.encode()) <= 186 for n in own)
    assert [r["unique_name"] for r in found if r["parent"] == "q"] == ["a.md"] and len(found) == len(rows)


@pytest.fixture
def replay(tmp_path):
    folder = tmp_path / "replay"
    for name in ("tree", "rules", "notices", "files"):
        (folder / name).mkdir(parents=True)
    leaf = lambda i, day: {"leaf": True, "bookid": i, "title": f"규정 {i}", "startdt": day}
    (folder / "tree/0.json").write_text(json.dumps([{"id": "7", "title": "업무"}, leaf(12, "2026.1.1"), leaf(13, "2026.5.1")]))
    (folder / "tree/7.json").write_text(json.dumps([leaf(11, "2025-01-01"), leaf(11, "2025-01-01")]))
    (folder / "home.html").write_text(HOME)
    (folder / "rules/11.html").write_text(RULE)
    (folder / "rules/12.html").write_text(RULE.replace("규정 A", "규정 C"))
    (folder / "notices/21.html").write_text(NOTICE)
    (folder / "files/s1.hwpx").write_bytes(hwpx(SECTION))
    (folder / "files/s2.pdf").write_bytes(b"<html>error")
    return str(folder)


def test_items(spark, replay):
    ids = lambda **c: [r["id"] for r in pipeline.items(spark, replay, **c).orderBy("ord").collect()]
    assert ids() == ["13", "12", "11", "21"] and ids(language="en") == ["13", "12", "11"] and ids(limit=2) == ["11"]
    assert ids(recent_only=True) == ["11", "21"] and ids(rule_id="5") == ["5"]
    with pytest.raises(ValueError, match="language"):
        ids(language="fr")


def test_commands(spark, replay, tmp_path, capsys):
    root = str(tmp_path / "data")
    run = lambda *a: cli.main([*a, "--data-dir", root], spark)
    assert run("sync", "--replay-dir", replay, "--all") == 0
    docs = {r["id"]: r for r in load_documents(spark, root).collect()}
    assert docs.keys() == {"11", "12", "21"}
    first = docs["11"]["attachments"]
    assert [a["status"] for a in first] == ["converted", "failed"] and first[1]["error"]
    assert os.path.exists(os.path.join(root, first[0]["text_path"])) and os.path.exists(os.path.join(root, "manifest.json"))
    assert run("validate") == 0
    assert run("quality", "--update-metadata", "--output", os.path.join(root, "report.json"), "--fail-on", "error") == 0
    assert run("quality", "--fail-on", "warn") == 1
    report = json.load(open(os.path.join(root, "report.json")))
    assert report["summary"]["quality_status"]["fail"] >= 1 and report["generated_at"]
    assert report["issues"][0].keys() == {f.name for f in schema.ISSUE.fields} and all(i["document_title"] for i in report["issues"])
    assert json.load(open(os.path.join(root, "manifest.json")))["generated_at"] and os.path.exists(os.path.join(root, "reports", "data-quality.json"))
    again = {r["id"]: r for r in load_documents(spark, root).collect()}["11"]["attachments"][0]
    assert again["quality_status"] == "warn" and again["quality_flags"] == "very_short_text" and again["table_row_count"] == 1
    orphan = os.path.join(root, os.path.dirname(first[0]["raw_path"]), "orphan.hwp")
    open(orphan, "wb").write(b"x")
    assert run("clean") == 2
    assert run("clean", "--prune-unreferenced-attachments", "--dry-run") == 0 and os.path.exists(orphan)
    assert run("clean", "--prune-unreferenced-attachments") == 0 and not os.path.exists(orphan)
    assert run("clean", "--drop-past-rule-attachments", "--drop-professional-attachments") == 0
    os.remove(os.path.join(root, first[0]["text_path"]))
    assert run("validate") == 1 and "missing converted attachment" in capsys.readouterr().err


def test_english_twins(spark, replay, tmp_path):
    root = str(tmp_path / "data")
    for book, name, content in (("11", "Rule A.txt", b"Article 1 Purpose"), ("12", "broken.pdf", b"no pdf"), ("99", "other.txt", b"x")):
        os.makedirs(f"{replay}/english/{book}")
        open(f"{replay}/english/{book}/{name}", "wb").write(content)
    assert cli.main(["sync", "--replay-dir", replay, "--language", "en", "--data-dir", root], spark) == 0
    [twin] = load_documents(spark, root).collect()
    assert (twin["id"], twin["source_id"], twin["language"], twin["title"], twin["body"], twin["file_name"], twin["path"]) == ("11-en", "11", "en", "Rule A", "Article 1 Purpose", "Rule A.txt", "en/rules/rule-a/index.md")
    assert os.path.exists(os.path.join(root, twin["raw_path"])) and twin["text_path"] == "en/rules/rule-a/attachments/english-full-text.md"
    assert cli.main(["sync", "--replay-dir", replay, "--language", "ko", "--data-dir", str(tmp_path / "ko")], spark) == 0
    assert {r["language"] for r in load_documents(spark, str(tmp_path / "ko")).collect()} == {"ko"}


def test_one_folder_for_two_documents(spark, tmp_path):
    twice = [BUNDLE, BUNDLE.replace('"d1"', '"d0"')]
    docs = parse_documents(spark.createDataFrame([(str(i), b) for i, b in enumerate(twice)], "path string, text string"))
    with pytest.warns(UserWarning, match="1 documents share"):
        assert write_documents(docs, str(tmp_path)) == 1
    assert [r["id"] for r in load_documents(spark, str(tmp_path)).collect()] == ["d0"]


def test_stream(spark, tmp_path):
    from corpusloom.streaming.bundles import document_stream, graded

    folder = tmp_path / "ko/rules/x"
    folder.mkdir(parents=True)
    (folder / "index.md").write_text(BUNDLE)
    query = graded(document_stream(spark, str(tmp_path))).writeStream.format("memory").queryName("graded").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    assert [(r["id"], r["status"]) for r in spark.table("graded").collect()] == [("d1", "warn")]


def test_sql_functions(spark):
    from corpusloom.functions.registry import register

    assert "equation_to_latex" in register(spark)
    assert spark.sql("select equation_to_latex('a over b') l, html_to_markdown('<b>x</b>') m, js_arguments('f(1)') a").first()[:] == (r"\frac{a}{b}", "**x**", ["1"])
