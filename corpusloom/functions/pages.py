"""Items, documents and attachments on the portal's pages."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions.html import attribute, elements_by_class, first_match, html_to_markdown, strip_tags, unescape
from corpusloom.functions.policy import is_excluded
from corpusloom.functions.text import first_non_empty, hash_text, normalize_date, slug, strip, text_or_empty

#: Labels on the pages, the portal's paths, the category of notices.
NOTICE_HEADING, CONTENT_LABEL, EFFECTIVE_LABEL = "예고", "내용", "시행일"
NOTICE_CATEGORY = "규정 제·개정예고"
RULE_PATH, NOTICE_PATH, DOWNLOAD_PATH = "/out/regulation/regulationViewPop.do", "/out/pds/pdsViewPop.do", "/Download.do"
#: The three ways in which the page's scripts write a version's id.
STATE_PATTERNS = (
    r"""obj\.put\(["']statehistoryid["']\s*,\s*["']([^"']+)["']""",
    r"""name\s*:\s*["']statehistoryid["']\s*,\s*value\s*:\s*["']([^"']+)["']""",
    r"""statehistoryid\s*:\s*["']([^"']+)["']""",
)
#: The tags that carry direct downloads, in the order in which they count, and those that list files.
DIRECT_TAGS, LISTED_TAGS = ("span", "a", "li", "p"), ("li", "span")
_DATE = r"([0-9]{4}\s*[.\-/]\s*[0-9]{1,2}\s*[.\-/]\s*[0-9]{1,2})"


def call_arguments(call: str | None) -> list[str]:
    """The arguments of the first call in a script; quoted parts of one are joined. Without parentheses,
    all single-quoted literals."""
    text = call or ""
    begin = text.find("(")
    if begin < 0:
        return re.findall(r"'([^']*)'", text)
    depth, quote, parts, start = 0, "", [], begin + 1
    end = len(text)
    for at in range(begin, len(text)):
        char = text[at]
        if quote:
            quote = "" if char == quote else quote
        elif char in "'\"":
            quote = char
        elif char == "(":
            depth += 1
        elif char == ")":
            depth -= 1
            if not depth:
                end = at
                break
        elif char == "," and depth == 1:
            parts.append(text[start:at])
            start = at + 1
    if text[start:end]:
        parts.append(text[start:end])
    joined = lambda part: "".join(a or b for a, b in re.findall(r"""'([^']*)'|"([^"]*)\"""", part))
    return [joined(p) if re.search(r"""'[^']*'|"[^"]*\"""", p) else p.strip() for p in parts]


@F.pandas_udf(ArrayType(StringType()))
def js_arguments(calls: pd.Series) -> pd.Series:
    return calls.map(call_arguments)


def recent_items(pages: DataFrame, body: str = "html") -> DataFrame:
    """Items of the boards on a home page, in order: the columns of a crawl item, and ``ord``."""
    boards = pages.select(F.posexplode(elements_by_class(F.col(body), "div", "boardA")).alias("b", "board"))
    kind = F.when(F.contains(strip_tags(first_match(r"<strong\b[^>]*>(.*?)</strong>", F.col("board"))), F.lit(NOTICE_HEADING)), "notice").otherwise("rule")
    rows = boards.select("b", kind.alias("document_type"), F.posexplode(F.regexp_extract_all("board", F.lit(r"(?is)<li\b[^>]*>.*?</li>"), F.lit(0))).alias("l", "li"))
    tagged = rows.withColumn("p", F.regexp_extract("li", r"(?is)(<p\b[^>]*>.*?</p>)", 1))
    parts = tagged.select(
        "b",
        "l",
        "document_type",
        first_non_empty(unescape(attribute(F.col("p"), "title")), strip_tags(F.col("p"))).alias("title"),
        js_arguments(unescape(attribute(F.col("p"), "onclick"))).alias("args"),
        normalize_date(strip_tags(first_match(r"<span\b[^>]*>(.*?)</span>", F.col("li")))).alias("date"),
    ).where((F.col("title") != "") & (F.size("args") >= 2))
    rule = F.col("document_type") == "rule"
    only = lambda c, when: F.when(when, c).otherwise("")
    return parts.select(
        F.col("args")[0].alias("id"),
        "title",
        "document_type",
        F.lit("").alias("category"),
        only(F.col("args")[0], rule).alias("book_id"),
        only(F.col("args")[1], rule).alias("noformyn"),
        only(F.col("args")[1], ~rule).alias("menu_id"),
        only(F.col("date"), ~rule).alias("published_date"),
        only(F.col("date"), rule).alias("effective_date"),
        F.lit("").alias("state_history_id"),
        (F.col("b") * 1_000_000 + F.col("l")).cast("long").alias("ord"),
    )


def state_history_id(body: Column) -> Column:
    """The id of a rule's version in a page's scripts: the first of three ways of writing it."""
    return first_non_empty(*[first_match(p, body) for p in STATE_PATTERNS])


def _tags(body: Column) -> Column:
    """The page's download tags in order: direct downloads by kind of tag, then listed files."""
    direct = [
        F.transform(
            F.filter(F.regexp_extract_all(body, F.lit(rf"""(?is)<{tag}\b[^>]*onclick=["'][^"']*\bdownFile\s*\([^>]*>.*?</{tag}>"""), F.lit(0)), lambda t: ~F.contains(t, F.lit("downFileView"))),
            lambda t: F.struct(F.lit(True).alias("direct"), t.alias("tag")),
        )
        for tag in DIRECT_TAGS
    ]
    listed = [F.transform(elements_by_class(body, tag, "filename"), lambda t: F.struct(F.lit(False).alias("direct"), t.alias("tag"))) for tag in LISTED_TAGS]
    return F.concat(*direct, *listed)


def rule_attachments(pages: DataFrame, key: str, body: str = "html") -> DataFrame:
    """The current attachments on rule pages, first occurrence of each server file and folder, in order."""
    tags = pages.select(F.col(key).alias("document_id"), F.posexplode(_tags(text_or_empty(F.col(body)))).alias("pos", "t"))
    parts = tags.select("document_id", "pos", strip_tags(F.col("t.tag")).alias("title"), js_arguments(unescape(attribute(F.col("t.tag"), "onclick"))).alias("args")).where(F.size("args") >= 3)
    arg = lambda i: F.col("args")[i]
    kept = parts.where(~is_excluded(F.col("title"), arg(0), arg(1), F.lit("")))
    first = kept.groupBy("document_id", arg(1).alias("server_file"), arg(2).alias("folder")).agg(F.min(F.struct("pos", "title", arg(0).alias("file_name"))).alias("f"))
    return first.select("document_id", "f.pos", slug(F.concat_ws("-", "document_id", "server_file")).alias("id"), "f.title", "f.file_name", "server_file", "folder", F.lit(DOWNLOAD_PATH).alias("source_url"), F.lit("pending").alias("status"))


def notice_attachments(pages: DataFrame, key: str, body: str = "html") -> DataFrame:
    """All listed files on notice pages, in order; nothing is left out."""
    tags = pages.select(F.col(key).alias("document_id"), F.posexplode(elements_by_class(F.col(body), "li", "filename")).alias("pos", "tag"))
    parts = tags.select("document_id", "pos", strip_tags(F.col("tag")).alias("title"), js_arguments(unescape(attribute(F.col("tag"), "onclick"))).alias("args")).where(F.size("args") >= 3)
    names = {"file_name": 0, "server_file": 1, "folder": 2}
    return parts.select("document_id", "pos", slug(F.concat_ws("-", "document_id", F.col("args")[1])).alias("id"), "title", *[F.col("args")[i].alias(n) for n, i in names.items()], F.lit(NOTICE_PATH).alias("source_url"), F.lit("pending").alias("status"))


def _by_class(tag: str, name: str) -> str:
    return rf"""<{tag}\b[^>]*class=["'][^"']*\b{name}\b[^"']*["'][^>]*>(.*?)</{tag}>"""


def rule_documents(pages: DataFrame, base_url: str, body: str = "html") -> DataFrame:
    """Documents on rule pages. ``pages`` has a crawl item's columns and the page."""
    page = F.col(body)
    inner = first_match(r"""<div\b[^>]*id=["']innerbody["'][^>]*>(.*?)</div>""", page)
    head = strip_tags(first_match(_by_class("p", "jang"), page))
    out = pages.select(
        first_non_empty(F.col("book_id"), F.col("id")).alias("id"),
        first_non_empty(strip_tags(first_match(_by_class("p", "title"), page)), F.col("title")).alias("title"),
        F.lit(base_url + RULE_PATH).alias("source_url"),
        F.lit("rule").alias("document_type"),
        html_to_markdown(F.when(inner == "", page).otherwise(inner)).alias("body"),
        text_or_empty(F.col("category")).alias("category"),
        first_non_empty(normalize_date(F.regexp_extract(head, rf"{EFFECTIVE_LABEL}\s*:\s*{_DATE}", 1)), F.col("effective_date")).alias("effective_date"),
        first_non_empty(normalize_date(F.regexp_extract(head, _DATE, 1)), F.col("published_date")).alias("published_date"),
        first_non_empty(state_history_id(page), F.col("state_history_id")).alias("state_history_id"),
    )
    return out.withColumn("content_hash", hash_text(F.concat("title", F.lit("\n"), "body")))


def notice_documents(pages: DataFrame, base_url: str, body: str = "html") -> DataFrame:
    """Documents on notice pages. An item's own title is preferred; the content is the row labelled so."""
    page = F.col(body)
    pop = first_match(r"""<[^>]*class=["'][^"']*\bpopTT\b[^"']*["'][^>]*>(.*?)</[^>]+>""", page)
    rows = F.regexp_extract_all(text_or_empty(page), F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), F.lit(0))
    label = lambda r: F.regexp_replace(F.regexp_extract(r, r"(?is)<th\b[^>]*>(.*?)</th>", 1), r"(?s)<[^>]+>", " ")
    row = F.get(F.filter(rows, lambda r: F.contains(label(r), F.lit(CONTENT_LABEL))), F.lit(0))
    content = F.coalesce(F.nullif(first_match(r"<td\b[^>]*>(.*?)</td>", row), F.lit("")), row, F.lit(""))
    title = strip_tags(F.regexp_replace(pop, r"(?is)<a\b[^>]*>.*?</a>", " "))
    out = pages.select(
        F.col("id"),
        F.when(text_or_empty(F.col("title")) != "", F.col("title")).otherwise(title).alias("title"),
        F.lit(base_url + NOTICE_PATH).alias("source_url"),
        F.lit("notice").alias("document_type"),
        html_to_markdown(content).alias("body"),
        F.lit(NOTICE_CATEGORY).alias("category"),
        text_or_empty(F.col("published_date")).alias("published_date"),
    )
    return out.withColumn("content_hash", hash_text(F.concat("title", F.lit("\n"), "body")))


def download_error(file_name: Column, content: Column) -> Column:
    """Why a download cannot be the file, or null."""
    text = F.lower(strip(F.decode(F.substring(content, 1, 256), "ISO-8859-1")))
    start = F.substring(text, 1, 128)
    page = start.startswith("<script") | start.startswith("<html") | F.contains(start, F.lit("alert("))
    return F.when(page, "download returned HTML error response").when(F.lower(file_name).endswith(".pdf") & ~text.startswith("%pdf-"), "downloaded file is not a PDF")



