"""Operators on pages and files that no test table holds: queries over written-out inputs, with their results.

The inputs are literal rows, whole as they stand here; the oracle of each query lists what must come
out, by the rules of the data model and not by the engine.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.convert import eqedit_script, equation_to_latex, infer_extension, mime_type, with_equations
from corpusloom.convert.formats import converted, readable_score
from corpusloom.convert.hwp import hwp_parts
from corpusloom.functions import html, pages, policy, quality, text
from corpusloom.operators import integrity, ordered
from corpusloom.sources.corpus import parse_documents

_ITEM = "id string, title string, book_id string, category string, effective_date string, published_date string, state_history_id string, html string"


def _strings(values: list[str | None]) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: spark.createDataFrame([(i, v) for i, v in enumerate(values)], "no int, value string")


def _page(spark: SparkSession, body: str, **item: str) -> DataFrame:
    names = [f.split()[0] for f in _ITEM.split(", ")]
    return spark.createDataFrame([tuple(body if n == "html" else item.get(n, "") for n in names)], _ITEM)


# Equations: scripts, and what their LaTeX must hold.
EQUATIONS = [
    ("{충족일수} over {조성일수} GEQ 이행률", [r"\frac{\text{충족일수}}{\text{조성일수}} \ge \text{이행률}"]),
    ("RATE_{T-1D", ["RATE_{T - 1D}"]),
    ("sum _{i=1} ^{m} 선형화된`증거금 _{i} `/ {dmatrix{sum _{i=1} ^{m} 계약수량 _{i}}}", [r"\frac", r"\sum_{i = 1}^{m}", r"\text{선형화된 증거금}_{i}", r"\displaystyle \sum_{i = 1}^{m}", r"\text{계약수량}_{i}"]),
    ("C=Min LEFT { sum _{i=1} ^{m} |`k _{i}`| RIGHT }", [r"C = \min \left\{", r"\sum_{i = 1}^{m}", "| k_{i} |", r"\right\}"]),
    ('D _{i} = {"Div " _{i}} over {MC} TIMES 100 TIMES (1+f _{i} TIMES {t _{i}} over {365} )', [r"D_{i} = \frac{\operatorname{Div}_{i}}{MC}", r"\times 100 \times", r"\frac{f_{i} \times {t_{i}}}{365}"]),
    ("hat{beta _{j}}", [r"\hat{\beta_{j}}"]),
    ("a LEQ b NEQ c", [r"\le", r"\ne"]),
    ("sqrt {x}", [r"\sqrt{x}"]),
    ("matrix{a & b # c & d}", [r"\begin{matrix}", "&", r"\\", r"\end{matrix}"]),
]


def equation_cases(spark, sf_dir):
    """EQ-01..28: LaTeX of written-out scripts holds the parts that it must."""
    rows = [(i, j, script, part) for i, (script, parts) in enumerate(EQUATIONS) for j, part in enumerate(parts)]
    run = F.pandas_udf(lambda s: s.map(equation_to_latex), "string")
    return spark.createDataFrame(rows, "no int, part int, script string, wanted string").select("no", "part", "wanted", F.contains(run("script"), F.col("wanted")).alias("held"))


def equation_balance(spark, sf_dir):
    """EQ-05, EQ-24: broken scripts give LaTeX whose braces balance."""
    run = F.pandas_udf(lambda s: s.map(equation_to_latex), "string")
    bare = F.regexp_replace(run("value"), r"\\[{}]", "")
    return _strings(BROKEN)(spark).select("no", (F.regexp_count(bare, F.lit(r"\{")) == F.regexp_count(bare, F.lit(r"\}"))).alias("balanced"))


BROKEN = ["{{{", "}}}", "a over", "over b", "_", "^{", "LEFT {", '"', "a/b/c", "x_{1}_{2}", "# & #", "", None]


def equation_section(spark, sf_dir):
    """EQ-01: the section of equations that is put behind a text: its heading, and a block for each script and its LaTeX."""
    run = F.pandas_udf(lambda s: s.map(lambda t: with_equations(t, ["hat{beta _{j}}", " "])), "string")
    return spark.createDataFrame([("본문",)], "t string").select(F.posexplode(F.split(run("t"), "\n")).alias("no", "line")).where("line <> ''").where(F.col("line").startswith("#") | F.col("line").startswith("`") | F.col("line").contains("beta") | (F.col("line") == "본문"))


_SCRIPT = "WC=Min LEFT { sum _{i=1} ^{m} |`k _{i}`| RIGHT }"


def eqedit_decode(spark, sf_dir):
    """CNV-09, SCL-09: the script in an equation record."""
    record = b"\0" * 4 + len(_SCRIPT).to_bytes(2, "little") + _SCRIPT.encode("utf-16le") + (19).to_bytes(2, "little") + "Equation Version 60".encode("utf-16le") + (7).to_bytes(2, "little") + "HYhwpEQ".encode("utf-16le")
    run = F.pandas_udf(lambda s: s.map(lambda b: eqedit_script(bytes(b))), "string")
    return spark.createDataFrame([(0, record), (1, b"")], "no int, data binary").select("no", run("data").alias("script"))


def _record(kind: int, payload: bytes, long: bool = False) -> bytes:
    """A record of a body stream; ``long`` writes its length on its own."""
    return ((0xFFF if long else len(payload)) << 20 | kind).to_bytes(4, "little") + (len(payload).to_bytes(4, "little") if long else b"") + payload


def hwp_streams(spark, sf_dir):
    """CNV-08, CNV-09, AGG-11: paragraphs of body streams, their equations, and the preview where there is no body."""
    units = lambda t: t.encode("utf-16le")
    table = (11).to_bytes(2, "little") + b"\1" * 14  # a control of eight places
    equation = b"\0" * 4 + len(_SCRIPT).to_bytes(2, "little") + units(_SCRIPT)
    body = _record(66, b"head") + _record(67, units("첫 문단") + table + units(" 끝\r")) + _record(67, units("\r")) + _record(67, units("둘째" * 3_000), long=True) + _record(88, equation) + _record(67, b"cut")[:-1]
    files = [(0, [body, _record(67, units("다음 구역"))], b""), (1, [], units("미리 보기"))]

    def run(streams, previews):
        import pandas as pd

        parts = [hwp_parts([bytes(b) for b in s], bytes(p)) for s, p in zip(streams, previews, strict=True)]
        return pd.DataFrame({"lines": [[line[:20] for line in t.split("\n") if line] for t, _ in parts], "scripts": [[eqedit_script(p) for p in e] for _, e in parts]})

    read = F.pandas_udf(run, "lines array<string>, scripts array<string>")("streams", "preview")
    done = spark.createDataFrame(files, "no int, streams array<binary>, preview binary").select("no", read.alias("r"))
    return done.select("no", F.array_join("r.lines", "|").alias("lines"), F.array_join("r.scripts", "|").alias("scripts"))


def _archive(**parts: str) -> bytes:
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as out:
        for name, xml in parts.items():
            out.writestr(f"Contents/{name}.xml", xml)
    return data.getvalue()


_CELLS = lambda *texts: "<hp:tr>" + "".join(f"<hp:tc><hp:p><hp:run><hp:t>{t}</hp:t></hp:run></hp:p></hp:tc>" for t in texts) + "</hp:tr>"
_BODY = f'<?xml version="1.0" encoding="UTF-8"?><hp:body xmlns:hp="u"><hp:p><hp:run><hp:t>본문 문단</hp:t></hp:run></hp:p><hp:tbl>{_CELLS("구분", "산식")}{_CELLS("A", "B+1")}{_CELLS("하나뿐", "")}</hp:tbl><hp:equation script="A=B+1" /></hp:body>'


def hwpx_convert(spark, sf_dir):
    """CNV-04..06, CNV-01, AGG-10: lines of an archive's sections, whether its raw parts hint at tables and formulas, and errors."""
    files = [("a/one.hwpx", _archive(section0=_BODY)), ("a/two.hwpx", _archive(section0=_BODY, header="<x/>", section1="<hp:p>broken")), ("a/none.hwpx", _archive(header="<x/>")), ("a/bad.hwpx", b"no archive")]
    done = converted(spark.createDataFrame(files, "path string, content binary"))
    lines = F.explode_outer(F.when(F.col("status") == "converted", F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))))
    return done.select("path", "status", "error", (F.col("raw_tables") > 0).alias("tables"), (F.col("raw_formulas") > 0).alias("formulas"), lines.alias("l")).select("path", "status", "error", "tables", "formulas", F.coalesce("l.no", F.lit(-1)).alias("no"), F.coalesce("l.line", F.lit("")).alias("line")).where("no = -1 or line <> ''")


def file_kinds(spark, sf_dir):
    """CNV-11, CNV-13, CNV-14: extension and media type by name, folder or first bytes."""
    rows = [("/tmp/att-1-hwp/download", b""), ("/tmp/download", b"%PDF-1.7"), ("a/b.PDF", b""), ("c.md", b"x"), ("d", b"?"), ("e.txt", b"")]
    files = spark.createDataFrame(rows, "path string, content binary").withColumn("extension", infer_extension(F.col("path"), F.col("content")))
    return files.select("path", "extension", mime_type(F.concat(F.lit("x"), "extension")).alias("mime"))


def converted_files(spark, sf_dir):
    """CNV-02, CNV-03, CNV-10: text files and pages are converted; empty and unknown ones fail with the reason."""
    rows = [("a.txt", "가 나".encode()), ("b.md", b"# x"), ("c.html", b"<p>x</p>"), ("d.txt", b"  "), ("e.xyz", b"1")]
    return converted(spark.createDataFrame(rows, "path string, content binary")).select("path", "status", F.trim("text", F.lit("\n")).alias("text"), "error", "size")


def readable_scores(spark, sf_dir):
    """CNV-12: the share of what can be read."""
    return _strings(["가a", "��a", "", "--"])(spark).select("no", F.round(readable_score(F.col("value")), 3).alias("score"))


_HOME = """<div class="boardA"><strong>최근개정 규정</strong><ul>
<li><p title="시장 상장규정" onclick="goView('210207961','N')">시장 상장규정</p><span>2026. 7. 1</span></li><li><p>빈 줄</p></li></ul></div>
<div class="boardA"><strong>규정 제·개정예고</strong><ul>
<li><p title="업무규정 시행세칙 개정 예고" onclick="goViewpds('210217910','10000016')">예고</p><span>2026. 6. 16.</span></li></ul></div>"""


def page_recent_items(spark, sf_dir):
    """SRC-15, PRS-01: the items on a home page."""
    return pages.recent_items(_page(spark, _HOME)).select("id", "title", "document_type", "book_id", "noformyn", "menu_id", "effective_date", "published_date")


def page_call_arguments(spark, sf_dir):
    """PRS-08, PRS-09: the arguments of calls in scripts, joined literals as one."""
    values = ["downFile('규정'+'_'+'별표.hwp','server.hwp','ATTACH');", "f(1, g(2,3), 'x')", "'a' 'b'", "", 'h("q", \'r\')']
    return _strings(values)(spark).select("no", F.array_join(pages.js_arguments("value"), "|").alias("arguments"))


_RULE = """<script>obj.put("statehistoryid","210016751");</script><p class="title">시장 업무규정</p><p class="jang">[시행일: 2026. 3. 1.] 2026.2.1</p><div id="innerbody"><p>제1조 목적</p></div>
<p class="byulText"><span onclick="downFile('세칙'+'_'+'172차'+'_'+'기준.hwp','210032775.hwp','ATTACH');">[별표 1] 산출기준</span></p>
<p class="byulText"><span onclick="downFile('세칙'+'_'+'신청서.hwp','210032776.hwp','ATTACH');">[별지 제1호 서식] 신청서</span></p>
<p class="byulText"><span onclick="downFile('세칙_개정이유.hwp','210032777.hwp','ATTACH');">개정이유</span></p>
<p class="byulText"><span onclick="downFile('세칙_신구조문.hwp','210032778.hwp','ATTACH');">신구조문</span></p>
<p class="byulText"><span onclick="downFile('세칙_전문.hwp','210032779-jun.hwp','ATTACH');">전문</span></p>
<a onclick="downFileView('a','b','c')">보기</a>"""
_NOTICE = """<div class="popTT">시행세칙 개정 예고 <button>닫기</button></div><table><tr><th>내용</th><td>미래 개정 예고 내용</td></tr></table>
<li class="filename" onclick="downFile('(붙임2) 일부개정세칙안.pdf','210217917.pdf','BBS');">일부개정세칙안</li>
<li class="filename" onclick="downFile('(붙임1) 신구조문 대비표.pdf','210217916.pdf','BBS');">신구조문 대비표</li>"""


def page_rule(spark, sf_dir):
    """PRS-02, PRS-04, PRS-10, PRS-11: a rule's page."""
    return pages.rule_documents(_page(spark, _RULE, id="7", book_id="210203562"), "http://portal").select("id", "title", "source_url", "document_type", "body", "effective_date", "published_date", "state_history_id")


def page_rule_attachments(spark, sf_dir):
    """PRS-05, PRS-06, PRS-07, FLT-06, SET-02, DED-02: a rule's current attachments."""
    return pages.rule_attachments(_page(spark, _RULE, id="210203562"), "id").select("id", "title", "file_name", "server_file", "folder", "source_url", "status")


def page_notice(spark, sf_dir):
    """PRS-03, PRS-12: a notice's page; the listed title is preferred."""
    return pages.notice_documents(_page(spark, _NOTICE, id="210217910", title="시행세칙 개정 예고", published_date="2026-06-16"), "http://portal").select("id", "title", "document_type", "body", "published_date")


def page_notice_attachments(spark, sf_dir):
    """PRS-07: a notice's files, none left out."""
    return pages.notice_attachments(_page(spark, _NOTICE, id="210217910"), "id").select("title", "file_name", "server_file", "folder")


def page_state_ids(spark, sf_dir):
    """PRS-11, SRC-14: the three ways in which a page names its version, in their order."""
    values = ["obj.put('statehistoryid', 'H1');", 'name: "statehistoryid", value: "H2"', "statehistoryid: 'H3'", "statehistoryid: 'H3' obj.put(\"statehistoryid\",\"H1\")", "none"]
    return _strings(values)(spark).select("no", pages.state_history_id(F.col("value")).alias("id"))


def page_title(spark, sf_dir):
    """HTM-04, HTM-05, HTM-06: the first title on a page, without tags and with its entities decoded."""
    values = ["<html><title> A &amp; <b>B</b> </title><title>C</title>", "<p>no title</p>", "<TITLE>규정&nbsp;하나</TITLE>", None]
    return _strings(values)(spark).select("no", html.strip_tags(html.first_match(r"<title\b[^>]*>(.*?)</title>", F.col("value"))).alias("title"))


def download_errors(spark, sf_dir):
    """PRS-12, SRC-16: why downloads are refused."""
    rows = [("a.pdf", b"%PDF-1"), ("b.pdf", b"PK"), ("c.hwp", b" <html>"), ("d.hwp", b"x alert('no')"), ("e.hwp", b"\0")]
    return spark.createDataFrame(rows, "file_name string, content binary").select("file_name", pages.download_error(F.col("file_name"), F.col("content")).alias("error"))


_ATTACHMENTS = [("rule", "r-jun", "전문", "jun.hwp"), ("rule", "r-rea", "개정이유", "rea.hwp"), ("rule", "r-sin", "신구조문", "sin.hwp"), ("rule", "r-byl", "[별표 1] 산식", "byl.hwp"), ("notice", "n-sin", "신구조문 대비표", "future.pdf"), ("notice", "n-jun", "전문", "x.hwp"), ("rule", "r-area", "지역", "area.hwp"), ("rule", "r-q", "a", "view?filecd=gae")]


def _policed(spark):
    return spark.createDataFrame([(k, i, t, f, "", i[0]) for k, i, t, f in _ATTACHMENTS], "document_type string, id string, title string, file_name string, server_file string, document_id string")


def policy_cases(spark, sf_dir):
    """FLT-01..05, JOI-08: which attachments are full texts, belong to past versions, or either."""
    of = [F.col(c) for c in ("title", "file_name", "server_file", "id")]
    return _policed(spark).select("id", policy.is_full_text(*of).alias("full_text"), policy.is_past_rule(*of).alias("past"), policy.is_excluded(*of).alias("excluded"))


def drop_cases(spark, sf_dir):
    """FLT-11: what goes when past versions' attachments are dropped: of rules only."""
    return integrity.excluded_children(_policed(spark), past_rule=True).select("id")


def drop_case_counts(spark, sf_dir):
    """AGG-12: how many attachments go under both policies, and from how many documents."""
    return integrity.child_drop_counts(integrity.excluded_children(_policed(spark), full_text=True, past_rule=True))


def drop_nested_cases(spark, sf_dir):
    """FLT-11, SNK-08: what stays in nested documents under both policies."""
    docs = ordered.nested(_policed(spark), "document_type", "id", ["id", "title", "file_name", "server_file"]).withColumnRenamed("children", "attachments")
    return integrity.drop_attachments(docs, full_text=True, past_rule=True).select("document_type", "removed", F.array_join(F.transform("attachments", lambda a: a["id"]), ",").alias("kept"))


def sync_languages(spark, sf_dir):
    """FLT-08, FLT-09: the items that each language collects."""
    rules, notices = (spark.createDataFrame([(i, k, 0)], "id string, document_type string, ord long") for i, k in (("rule-1", "rule"), ("notice-1", "notice")))
    parts = [ordered.collected_items(rules, notices, language).select(F.lit(language).alias("language"), "id") for language in ("all", "ko", "en")]
    return parts[0].union(parts[1]).union(parts[2])


_BUNDLE = """---
id: "210207961"
title: 시장 상장규정
source_url: https://example.test/rule
collected_at: 2026-06-16T14:33:12Z
content_hash: hash
attachments:
  - id: att-1
    title: 전문
    file_name: source.hwp
    status: failed
    error: stored rule attachment not available
document_type: rule
---

본문
"""


def bundle_fields(spark, sf_dir):
    """SRC-02..07: the fields of a document file, with a language that is not given."""
    docs = parse_documents(spark.createDataFrame([("rules/legacy.md", _BUNDLE)], "path string, text string"))
    a = F.col("attachments")[0]
    return docs.select("id", "title", "source_url", "collected_at", "document_type", "language", "body", "path", F.size("attachments").alias("n"), a["id"].alias("attachment_id"), a["status"].alias("status"), a["error"].alias("error"))


def bundle_refusals(spark, sf_dir):
    """SRC-08, SRC-09: files that are refused: without front matter, or without what is required."""
    rows = [("a.md", "no front matter"), ("b.md", '---\nid: "x"\n---\n'), ("c.md", _BUNDLE)]
    return parse_documents(spark.createDataFrame(rows, "path string, text string"), permissive=True).select("path", F.col("malformed").isNotNull().alias("refused"))


def file_names(spark, sf_dir):
    """SCL-11..16: names of raw and converted files of attachments."""
    rows = [("a", "[별표 1] 산출기준", "210032775.hwp"), ("b", "download", "신청서 서식.pdf"), ("c", "", "12345678.hwp"), ("", "--", ""), ("e", "가" * 60, "x.hwp"), ("f", "x", "가." + "y" * 60)]
    stem = text.slug(text.attachment_stem(F.col("title"), F.col("file_name"), F.col("id")))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "no int, id string, title string, file_name string")
    return frame.select("no", text.truncate_bytes(F.concat(stem, text.suffix(F.col("file_name"))), 40).alias("raw"), text.truncate_bytes(F.concat(stem, F.lit(".md")), 40).alias("converted"), text.truncate_bytes(F.col("file_name"), 40).alias("short"))


def unique_name_cases(spark, sf_dir):
    """DED-04, JOI-09: names that are taken get the least free number."""
    names = ["a.md", "a.md", "a-2.md", "a.md", "b", "b"]
    frame = spark.createDataFrame([("p", i, n) for i, n in enumerate(names)] + [("q", 0, "a.md")], "parent string, ord int, name string")
    return ordered.unique_names(frame, "parent", "ord", "name").select("parent", "ord", "unique_name")


def validate_files(spark, sf_dir):
    """JOI-03, SNK-10: paths of documents and attachments that lead to no file."""
    docs = spark.createDataFrame([("ko/rules/x/index.md", "d", "t", "u", "c", "h", "rule", "ko", "raw/a", "text/b")], "path string, id string, title string, source_url string, collected_at string, content_hash string, document_type string, language string, raw_path string, text_path string")
    children = spark.createDataFrame([("ko/rules/x/index.md", "1", "converted", "raw/c", "text/d"), ("ko/rules/x/index.md", "2", "failed", "raw/a", "")], "document_path string, id string, status string, raw_path string, text_path string")
    return integrity.validate(docs, children, spark.createDataFrame([("./raw//a",)], "rel_path string"))


def raw_hint_flags(spark, sf_dir):
    """AGG-07: the two flags of raw files whose tables or formulas the text lost."""
    rows = [(0, "본문 " * 30, 3, 0), (1, "본문 " * 30, 0, 2), (2, "| a | b |\n" + "본문 " * 30, 3, 0), (3, "x = 1 " + "본문 " * 30, 3, 2)]
    measured = spark.createDataFrame(rows, "no int, t string, tables int, formulas int").select("no", "tables", "formulas", *[c.alias(n) for n, c in quality.metrics(F.col("t")).items()])
    flagged = measured.withColumn("flags", quality.flags(F.col("tables"), F.col("formulas")))
    return flagged.select("no", F.array_join("flags", ",").alias("flags"), quality.score(F.col("flags")).alias("score"), quality.status(F.col("flags")).alias("status"))


_M = "ko/rules/x/index.md: missing "
#: What must come out: columns, and rows.
EXPECTED: dict[str, tuple[str, list[tuple]]] = {
    "equation_cases": ("no part wanted held", [(i, j, part, True) for i, (_, parts) in enumerate(EQUATIONS) for j, part in enumerate(parts)]),
    "equation_balance": ("no balanced", [(i, True) for i in range(len(BROKEN))]),
    "equation_section": ("no line", [(0, "본문"), (2, "## HWP 수식"), (5, "```hwp-equation"), (6, "hat{beta _{j}}"), (7, "```"), (10, "```math"), (11, r"\hat{\beta_{j}}"), (12, "```")]),
    "eqedit_decode": ("no script", [(0, _SCRIPT), (1, "")]),
    "hwp_streams": ("no lines scripts", [(0, "첫 문단 끝|" + "둘째" * 10 + "|다음 구역", _SCRIPT), (1, "미리 보기", "")]),
    "hwpx_convert": (
        "path status error tables formulas no line",
        [("a/one.hwpx", "converted", "", True, True, i, line) for i, line in enumerate(("| 구분 | 산식 |", "| A | B+1 |", "본문 문단", "수식: A=B+1"))]
        + [("a/two.hwpx", "converted", "", True, True, i, line) for i, line in ((0, "| 구분 | 산식 |"), (1, "| A | B+1 |"), (2, "본문 문단"), (3, "수식: A=B+1"), (5, "broken"))]
        + [("a/none.hwpx", "failed", "no readable HWPX body XML found", False, False, -1, ""), ("a/bad.hwpx", "failed", "not a readable HWPX archive", False, False, -1, "")],
    ),
    "file_kinds": ("path extension mime", [("/tmp/att-1-hwp/download", ".hwp", "application/x-hwp"), ("/tmp/download", ".pdf", "application/pdf"), ("a/b.PDF", ".pdf", "application/pdf"), ("c.md", ".md", "text/markdown"), ("d", "", ""), ("e.txt", ".txt", "text/plain")]),
    "converted_files": ("path status text error size", [("a.txt", "converted", "가 나", "", 7), ("b.md", "converted", "# x", "", 3), ("c.html", "converted", "x", "", 8), ("d.txt", "failed", "", "converted text is empty", 2), ("e.xyz", "failed", "", "unsupported attachment format: .xyz", 1)]),
    "readable_scores": ("no score", [(0, 1.0), (1, 0.333), (2, 0.0), (3, 0.0)]),
    "page_recent_items": ("id title document_type book_id noformyn menu_id effective_date published_date", [("210207961", "시장 상장규정", "rule", "210207961", "N", "", "2026-07-01", ""), ("210217910", "업무규정 시행세칙 개정 예고", "notice", "", "", "10000016", "", "2026-06-16")]),
    "page_call_arguments": ("no arguments", [(0, "규정_별표.hwp|server.hwp|ATTACH"), (1, "1|g(2,3)|x"), (2, "a|b"), (3, ""), (4, "q|r")]),
    "page_rule": ("id title source_url document_type body effective_date published_date state_history_id", [("210203562", "시장 업무규정", "http://portal/out/regulation/regulationViewPop.do", "rule", "제1조 목적", "2026-03-01", "2026-03-01", "210016751")]),
    "page_rule_attachments": (
        "id title file_name server_file folder source_url status",
        [("210203562-210032775-hwp", "[별표 1] 산출기준", "세칙_172차_기준.hwp", "210032775.hwp", "ATTACH", "/Download.do", "pending"), ("210203562-210032776-hwp", "[별지 제1호 서식] 신청서", "세칙_신청서.hwp", "210032776.hwp", "ATTACH", "/Download.do", "pending")],
    ),
    "page_notice": ("id title document_type body published_date", [("210217910", "시행세칙 개정 예고", "notice", "미래 개정 예고 내용", "2026-06-16")]),
    "page_notice_attachments": ("title file_name server_file folder", [("일부개정세칙안", "(붙임2) 일부개정세칙안.pdf", "210217917.pdf", "BBS"), ("신구조문 대비표", "(붙임1) 신구조문 대비표.pdf", "210217916.pdf", "BBS")]),
    "page_state_ids": ("no id", [(0, "H1"), (1, "H2"), (2, "H3"), (3, "H1"), (4, "")]),
    "page_title": ("no title", [(0, "A & B"), (1, ""), (2, "규정 하나"), (3, "")]),
    "download_errors": ("file_name error", [("a.pdf", None), ("b.pdf", "downloaded file is not a PDF"), ("c.hwp", "download returned HTML error response"), ("d.hwp", "download returned HTML error response"), ("e.hwp", None)]),
    "policy_cases": (
        "id full_text past excluded",
        [("r-jun", True, False, True), ("r-rea", False, True, True), ("r-sin", False, True, True), ("r-byl", False, False, False), ("n-sin", False, True, True), ("n-jun", True, False, True), ("r-area", False, False, False), ("r-q", False, True, True)],
    ),
    "drop_cases": ("id", [("r-rea",), ("r-sin",), ("r-q",)]),
    "drop_case_counts": ("removed changed", [(5, 2)]),
    "drop_nested_cases": ("document_type removed kept", [("rule", 4, "r-area,r-byl"), ("notice", 1, "n-sin")]),
    "sync_languages": ("language id", [("all", "rule-1"), ("all", "notice-1"), ("ko", "rule-1"), ("ko", "notice-1"), ("en", "rule-1")]),
    "bundle_fields": (
        "id title source_url collected_at document_type language body path n attachment_id status error",
        [("210207961", "시장 상장규정", "https://example.test/rule", "2026-06-16T14:33:12Z", "rule", "ko", "본문", "rules/legacy.md", 1, "att-1", "failed", "stored rule attachment not available")],
    ),
    "bundle_refusals": ("path refused", [("a.md", True), ("b.md", True), ("c.md", False)]),
    "file_names": (
        "no raw converted short",
        [(0, "별표-1-산출기준.hwp", "별표-1-산출기준.md", "210032775.hwp"), (1, "신청서-서식.pdf", "신청서-서식.md", "신청서 서식.pdf"), (2, "c.hwp", "c.md", "12345678.hwp"), (3, "attachment", "attachment.md", "")]
        + [(4, "가" * 12 + ".hwp", "가" * 12 + ".md", "x.hwp"), (5, "x." + "y" * 60, "x.md", "attachment." + "y" * 60)],
    ),
    "unique_name_cases": ("parent ord unique_name", [("p", 0, "a.md"), ("p", 1, "a-2.md"), ("p", 2, "a-2-2.md"), ("p", 3, "a-3.md"), ("p", 4, "b"), ("p", 5, "b-2"), ("q", 0, "a.md")]),
    "validate_files": ("message", [(_M + "converted document file text/b",), (_M + "raw attachment raw/c",), (_M + "converted attachment text/d",)]),
    "raw_hint_flags": ("no flags score status", [(0, "raw_table_hints_without_table_text", 75, "warn"), (1, "raw_formula_hints_without_formula_text", 75, "warn"), (2, "", 100, "ok"), (3, "raw_table_hints_without_table_text", 75, "warn")]),
}


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return f"CAST({value!r} AS DOUBLE)" if isinstance(value, float) else str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


QUERIES = {name: globals()[name] for name in EXPECTED}
ORACLES = {name: f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_literal, row)) + ')' for row in rows)}) t({', '.join(columns.split())})" for name, (columns, rows) in EXPECTED.items()}
