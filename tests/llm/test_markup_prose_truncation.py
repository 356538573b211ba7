"""Markup, prose and truncation on texts with known answers."""

import random

import pytest

from corpusloom.llm import queries
from corpusloom.llm.markup import KINDS, analysed, best_region, clean, content_region, fit, kinds, label_lines, learn, records, tokens
from corpusloom.llm.prose import is_sentence, not_prose, sentence_share, text_statistics
from corpusloom.llm.truncation import threshold, truncated, truncation_rates, without_mark

CONTENT = [
    "① 제1항 <개정 2020. 1. 2.> [별표 3] (단위: $, A < B)", "(경로: C:\\규정\\item_18.hwp)", "[Form 3] Fee <Deleted>", "(가 == 나, {예비} 항목 #25)", "성명: ____________", "| a | b |", "- 항목", "* 항목", "1. 하나",
    "R&D, M&A, file no_12_b", "fee of $ 203 * 2, if A < B", "__홍길동____", "a  b  c", "x\ty", "* * *", "(주*4: 수량 12 * 단가 $ 672)", "", "가" * 100_000,
]
MARKED = {
    "<p class='a'>본문</p>": ["html"], "줄&nbsp;하나": ["html"], "줄&lt;br&gt;": ["html"], "&amp;nbsp;": ["html"], "<!-- x -->": ["html"], "## 제목": ["markdown"], "가 **나** 다": ["markdown"], "| a | b |\n|---|---|\n| 1 | 2 |": ["markdown"],
    "[이름](http://a.b/c)": ["markdown"], "- [x] 일": ["markdown"], "제목\n=====": ["markdown"], "== 제목 ==": ["wiki"], "[[분류:가]]": ["wiki"], "{{틀|가}}": ["wiki"], "'''굵게'''": ["wiki"], "{| border=1\n|-\n| a\n|}": ["wiki"],
    "\\section{가}": ["latex"], "$$ x $$": ["latex"], "값 $x_{1} = 2$ 이다": ["latex"], "\\begin{itemize}\n\\item 가\n\\end{itemize}": ["latex"], "<b>가</b> **나**": ["html", "markdown"],
}


@pytest.mark.parametrize("text", CONTENT)
def test_content_is_no_markup(text):
    assert kinds(text) == []


@pytest.mark.parametrize("text", MARKED)
def test_kinds(text):
    assert kinds(text) == MARKED[text]


def test_clean_keeps_structure():
    assert clean("<h2>제목</h2><p>본문&nbsp;하나</p><ul><li>가</li><li>나</li></ul>") == "## 제목\n\n본문 하나\n\n- 가\n- 나"
    assert clean("<table><tr><td>a</td><td>1</td></tr></table>") == "| a | 1 |"
    assert clean("== 제목 ==\n[[가|나]] '''다'''") == "## 제목\n나 다"
    assert clean("\\section{제목}\n\\begin{itemize}\n\\item 가\n\\end{itemize}\n식 $x_{1} = 2$") == "# 제목\n\n- 가\n\n식 $x_{1} = 2$"
    assert clean("```\n**code** <b>\n```") == "```\n**code** <b>\n```"
    assert clean("가 **나** [다](http://a) ~~라~~") == "가 나 다 라"


def test_region_is_the_best_subsequence():
    rng = random.Random(1)
    weights = {"word": 1.0, "html": -1.5}
    for _ in range(200):
        found = [(rng.choice(["word", "html"]), i, i + 1) for i in range(rng.randint(0, 15))]
        sums = [sum(weights[f] for f, _, _ in found[a:b]) for a in range(len(found)) for b in range(a + 1, len(found) + 1)]
        start, end = best_region(found, weights)
        assert sum(weights[f] for f, s, e in found if start <= s and e <= end) == max([0, *sums])


def test_region_leaves_out_scripts_but_no_sentence():
    page = "<script>go('1');</script>\n첫째 문장이 여기에 있다.\n둘째 문장이 '''여기에''' 있다.\n<style>\n.c { margin: 3px; }\n</style>"
    weights = learn([(page, label_lines(page))] * 3)
    start, end = content_region(page, weights)
    assert page[start:end] == "첫째 문장이 여기에 있다.\n둘째 문장이 '''여기에''' 있다."


def test_weights_have_their_signs():
    weights = learn([("<p>하나 둘 셋</p>\n<script>", [True, False])])
    assert weights["word"] > 0 and all(w < 0 for f, w in weights.items() if f != "word")
    assert tokens("") == []


def test_analysed(spark):
    rows = [(str(i), t, "x") for i, t in enumerate([*CONTENT, *MARKED, None])] + [("0", CONTENT[0], "x")]
    texts = records(spark.createDataFrame(rows, "id string, text string, markup string"), "id", "text", "document")
    found = analysed(texts, fit(texts)).collect()
    assert len(found) == len(rows)
    assert {r["record_key"]: r["markup"] for r in found} == {i: kinds(t or "") for i, t, _ in rows}
    assert all(set(r["markup"]) <= set(KINDS) and r["clean_text"] is not None for r in found)
    none = texts.limit(0)
    assert analysed(none, fit(none)).count() == 0


def test_p6_found_comes_from_the_fitted_scan(spark, sf_dir, monkeypatch):
    runs = []

    def spy(texts, weights, **options):
        runs.append((weights, analysed(texts, weights, **options)))
        return runs[-1][1]

    monkeypatch.setattr(queries, "analysed", spy)
    found = {tuple(r) for r in queries.p6_found(spark, sf_dir).collect()}
    [(weights, scanned)] = runs
    assert weights["word"] > 0 and {"region_start", "region_end", "clean_text"} <= set(scanned.columns)
    every = queries._marked_records(spark, sf_dir).collect()
    assert found == {(r["record_kind"], r["record_key"], k) for r in every for k in kinds(r["text"] or "")}


PROSE = ["위원회는 보고서를 제출하여야 한다.", "① 위원회는 보고서를 제출하여야 한다", "The board shall send the report to the client.", "위원회는 보고서를 제출하여야 � 한다."]
JUNK = ["• 보고서 사본 1부\n• 증명서", "| a | b |\n| 1 | 2 |", "성명: ____", "∑ m(i) ≤ 86 × X", "", None, "   ", "À§Å¹ ÀÎµµ¹°ÀÇ ±â·Ï¿¡ µå´Â ºñ¿ëÀº", "제1조 목적 ········ 1"]


def test_sentences():
    assert all(is_sentence(p) and sentence_share(p) > 0.5 for p in PROSE)
    assert all(sentence_share(j) == 0 for j in JUNK)
    assert 0.3 < sentence_share(PROSE[0] + "\n" + "• 보고서 사본 1부\n" * 3) < 0.7
    assert sentence_share("위원회는 보고서를 작성하여 지체 없이\n거래소에 제출하여야 한다.") == 1.0


def test_not_prose(spark):
    rows = [(str(i), t, 1) for i, t in enumerate(PROSE + JUNK)] + [("junk", "x" * 200_000, 1)]
    texts = spark.createDataFrame(rows, "text_path string, text string, words int")
    assert {r[0] for r in not_prose(texts).collect()} == {str(i) for i in range(len(PROSE), len(PROSE) + len(JUNK))} | {"junk"}
    stats = {r["text_path"]: r for r in text_statistics(texts).collect()}
    assert stats["0"]["words"] == 4 and stats["0"]["punctuated_line_share"] == 1.0 and "too_few_words" in stats["0"]["failures"]
    assert text_statistics(texts.limit(0)).count() == 0


def test_marks():
    assert [without_mark(t) for t in ["가나 …", "가 [cut]", "가... ", "가 (이하 생략)", "가. [별표 1] 나", "…", "끝."]] == ["가나", "가", "가", "가", "가. [별표 1] 나", "", "끝."]


def test_thresholds_follow_the_share_of_cut_texts():
    whole, cut = {8.0: 900, 3.0: 60, 0.0: 40}, {-12.0: 50, -7.0: 10}
    usual = threshold(whole | cut)
    assert -5 < usual < -1 and usual < threshold(whole | {k: 10 * n for k, n in cut.items()}) and threshold(whole) < usual
    assert threshold({9.0: 1}) < 0 and threshold({}) == 0.0


def test_truncated(spark):
    rng = random.Random(3)
    subject, things, verbs = ["위원회는", "회원은", "거래소가"], ["보고서를", "증명서를", "명부를", "자료를"], ["제출하여야 한다.", "보관할 수 있다.", "정정한다."]
    sentence = lambda: f"{rng.choice(subject)} {rng.choice(things)} {rng.choice(['지체 없이', '매월', '서면으로'])} {rng.choice(verbs)}"
    rows, cut = [], set()
    for i in range(600):
        body = " ".join(sentence() for _ in range(rng.randint(2, 6)))
        if i % 12 == 0:
            body = body[: len(body) - rng.randint(4, 12)].rstrip() + rng.choice(["", "…", " [cut]"])
            cut.add(i)
        elif i % 5 == 0:
            body += "\n\n" + rng.choice(["[별표 3] 보고서", "담당부서: 시장팀", "붙임  자료 1부"])
        rows.append((i, body, f"s{i % 3}", 0.0))
    rows += [(1000, None, None, 0.0), (1001, "", "s0", 0.0), (1002, "  ", "s0", 0.0), (1003, "…", "s0", 0.0), (1004, rows[0][1], "s0", 0.0), (1005, rows[1][1] * 400, "s1", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, log_odds double")
    found = {r["doc_id"] for r in truncated(docs).where("truncated").collect()}
    expected = cut | {1003, 1004}
    assert len(found & expected) >= 0.9 * len(expected) and len(found & expected) >= 0.95 * len(found)
    assert not found & {1000, 1001, 1002, 1005} and {1003, 1004} <= found
    rates = {r["source"]: r for r in truncation_rates(docs).collect()}
    assert rates[None]["documents"] == 1 and sum(r["cut"] for r in rates.values()) == len(found)
    assert truncated(docs.limit(0)).count() == 0
