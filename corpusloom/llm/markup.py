"""Remains of markup in text: which kinds there are, and clean text that keeps the structure."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("html", "markdown", "wiki", "latex")

#: The names of HTML elements.
_ELEMENTS = (
    "a abbr address area article aside audio b base big blockquote body br button canvas caption center cite code col colgroup dd del details dfn div dl dt em embed "
    "fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu "
    "meta nav noscript object ol optgroup option p param picture pre q rp rt ruby s samp script section select small source span strike strong style sub summary sup svg "
    "table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr"
)
_NAME = "(?:" + "|".join(sorted(_ELEMENTS.split(), key=len, reverse=True)) + ")"
_ATTRIBUTE = r"""\s+[A-Za-z:_-][\w:.-]*(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=]+))?"""
_LT, _GT, _AMP = r"(?:<|&(?:amp;)*lt;)", r"(?:>|&(?:amp;)*gt;)", r"&(?:amp;)*"
_QUOTED = r"(?:&(?:amp;)*(?:quot|#0?39|apos);)"
_ESCAPED = rf"""(?:{_ATTRIBUTE}|\s+[A-Za-z:_-][\w:.-]*\s*=\s*{_QUOTED}[^<>\n]*?{_QUOTED}|\s+[A-Za-z:_-][\w:.-]*\s*=\s*[^\s"'<>&=]+)"""

#: What is markup, by kind. Provision numbers, bullets, tags of annexes and amendments, amounts,
#: comparisons, paths, placeholders and fill-in lines are content and match none of these.
PATTERNS = {
    "html": rf"""{_LT}/?{_NAME}(?:{_ESCAPED})*\s*/?{_GT}|{_LT}!--|--{_GT}|{_LT}!doctype\b[^<>\n]*{_GT}|{_AMP}(?:nbsp|lt|gt|quot|apos|copy|reg|middot|hellip|mdash|ndash|bull|ensp|emsp|thinsp|laquo|raquo|times|divide|[lr][sd]quo|amp|\#[0-9]{{1,6}}|\#x[0-9a-fA-F]{{1,5}});""",
    "markdown": (
        r"^[ ]{0,3}\#{1,6}[ ]+\S|\*\*(?=\S)[^*\n]+?(?<=\S)\*\*|(?<![_\w])__(?=[^\s_])[^_\n]+?(?<=[^\s_])__(?![_\w])|~~(?=\S)[^~\n]+?~~|!?\[[^\[\]\n]*\]\([^()\s]+(?:[ ]+\"[^\"\n]*\")?\)|\[\^[\w-]+\]"
        r"|^[ ]*[-*+][ ]+\[[ xX]\][ ]|^[ ]*(?:```|~~~)[\w-]*[ ]*$|(?<![`\w])`[^`\n]+`(?!`)|^[ ]*\|?(?:[ ]*:?-{3,}:?[ ]*\|)+(?:[ ]*:?-{3,}:?[ ]*)?$|^>[ ]+\S|(?<=\S)\n(?:={4,}|-{4,})[ ]*$|(?<![\w*])\*(?=[^\s*])[^*\n]{1,80}?(?<=[^\s*])\*(?![\w*])(?!\))"
    ),
    "wiki": r"^\{\||^\|\}|^\|-+[^|\n]*$|\[\[[^\[\]\n]+\]\]|\{\{[^{}\n]+\}\}|^={2,6}[ ]*[^=\s][^=\n]*?[ ]*={2,6}[ ]*$|'{2,5}(?=[^\s'])[^'\n]+?'{2,5}|\[https?://[^\s\]]+[ ][^\]\n]+\]",
    "latex": (
        r"\\(?:begin|end)\{[A-Za-z]+\*?\}|\\(?:part|chapter|(?:sub)*section|paragraph)\*?\{|\\item(?=[ \t\[])|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{[^}\n]*\}|\$\$|\\\(|\\\)|(?<!\\)\\\[|\\\]"
        r"|(?<![\\$\w])\$(?=[^\s$])[^$\n]*[\\_^=][^$\n]*?(?<=[^\s$])\$(?![\w$])|\\(?:frac|sqrt|sum|prod|int|alpha|beta|gamma|sigma|leq?|geq?|times|cdot|infty|ldots|dots|quad|text|mathrm|hline|maketitle|label|ref|cite|noindent|textbf|textit)(?![A-Za-z])|(?<=\S)[ ]\\\\[ ]*$"
    ),
}
_KIND = {k: re.compile(p, re.M | re.I if k == "html" else re.M) for k, p in PATTERNS.items()}
_TOKEN = re.compile("|".join(f"(?P<{k}>{p if k != 'html' else '(?i:' + p + ')'})" for k, p in PATTERNS.items()) + r"|(?P<word>[^\s<>&]+|[<>&])", re.M)
_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
#: Texts without any of these are not looked at closer; the exact patterns all need one.
CANDIDATE = r"<[A-Za-z/!]|&[A-Za-z#]|--[>&]|\*|~~|`|__[^\s_]|(?m:^\s*#)|\]\(|\[\^|\[[ xX]\]|-{3,}|={2,}|\{[|{]|(?m:^\|[-}])|\[\[|\[http|''|\\|\$|(?m:^>)"


def kinds(text: str) -> list[str]:
    """The kinds of markup in a text, in the order of ``KINDS``."""
    return [k for k in KINDS if _KIND[k].search(text)]


def _feature(kind: str, token: str) -> str:
    """The class of a token that a weight is learned for: its kind, of HTML also the element."""
    if kind == "html" and (name := re.search(r"(?:<|lt;)(/?)(\w+|!--)", token)):
        return f"html:{name.group(2).lower()}"
    return kind


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(feature, start, end) of words and marks, in order. The words that a mark of another kind than HTML
    wraps follow it; the last ends where the mark does."""
    out = []
    hidden = [m.span() for m in _HIDDEN.finditer(text)]
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        if m.lastgroup == "word" and any(a < start < b for a, b in hidden):
            continue  # what is never shown is part of its tags
        words = [] if m.lastgroup in ("word", "html") else [(start + w.start(), start + w.end()) for w in re.finditer(r"\w+", m.group())]
        out.append((_feature(m.lastgroup, m.group()), start, words[0][0] if words else end))
        out += [("word", a, b) for a, b in words[:-1]] + [("word", a, end) for a, _ in words[-1:]]
    return out


def feature_counts(text: str, labels: list[bool]) -> Counter:
    """How often each (label, feature) occurs in the lines of a page."""
    return Counter((label, f) for line, label in zip(text.split("\n"), labels, strict=True) for f, _, _ in tokens(line))


def feature_weights(counts: dict[tuple[bool, str], int]) -> dict[str, float]:
    """Weights of the features: their log-odds on lines of content, with words held positive and marks negative."""
    totals = {label: sum(n for (own, _), n in counts.items() if own == label) + 1 for label in (True, False)}
    weights = {}
    for feature in sorted({f for _, f in counts}):
        odds = math.log((counts.get((True, feature), 0) + 1) / totals[True]) - math.log((counts.get((False, feature), 0) + 1) / totals[False])
        # Wrappers of words are marks, but no sign of noise.
        least = -8.0 if feature.startswith("html") else -1.0
        weights[feature] = max(0.2, odds) if feature == "word" else max(least, min(-0.2, odds))
    return weights


def learn(pages: Iterable[tuple[str, list[bool]]]) -> dict[str, float]:
    """Weights of the features from pages whose lines are labelled as content or not."""
    return feature_weights(sum((feature_counts(text, labels) for text, labels in pages), Counter()))


def label_lines(text: str) -> list[bool]:
    """Labels of a page's lines for training: content has at least three words outside of its marks, or
    is a heading, item, row or formula; scripts, styles, comments and lone tags are not."""
    labels, inside = [], False
    for line in text.split("\n"):
        opens = re.search(r"(?i)(?:<|&lt;)(?:script|style|!--)", line)
        words = [f for f, _, _ in tokens(re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ", line)) if f == "word"]
        labels.append(not inside and len(words) >= 2)
        if opens:
            inside = not re.search(r"(?i)(?:</|&lt;/)(?:script|style)|--(?:>|&gt;)", line)
        elif re.search(r"(?i)(?:</|&lt;/)(?:script|style)|--(?:>|&gt;)", line):
            inside = False
    return labels


def best_region(found: list[tuple[str, int, int]], weights: dict[str, float], default: float = -1.0) -> tuple[int, int]:
    """Start and end of the contiguous region with the highest sum of weights, by one linear scan."""
    best, best_at, total, since = 0.0, (0, 0), 0.0, None
    for feature, start, end in found:
        if since is None or total <= 0:
            total, since = 0.0, start
        total += weights.get(feature, 0.2 if feature == "word" else default)
        if total > best:
            best, best_at = total, (since, end)
    return best_at


def content_region(text: str, weights: dict[str, float]) -> tuple[int, int]:
    """The best region of a text, out to the ends of the lines that it begins and ends in."""
    start, end = best_region(tokens(text), weights)
    if start == end:
        return 0, 0
    after = text.find("\n", end)
    return text.rfind("\n", 0, start) + 1, len(text) if after < 0 else after


def clean(text: str) -> str:
    """The text without marks. Headings become ``#`` lines, items ``- ``, tables rows of ``| a | b |``; code
    fences and formulas stay as they are."""
    kept: list[str] = []

    def keep(part: str) -> str:
        kept.append(part)
        return f"\x00{len(kept) - 1}\x00"

    out = text.replace("\x00", " ")
    while re.search(r"&amp;(?:[a-z]+|#x?[0-9a-fA-F]+);", out):
        out = re.sub(r"&amp;(?=[a-z]+;|#x?[0-9a-fA-F]+;)", "&", out)
    if _KIND["html"].search(out):
        out = html.unescape(out).replace("\xa0", " ")
        out = re.sub(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", "", out)
    out = re.sub(r"(?ms)^[ ]*```.*?^[ ]*```[ ]*$", lambda m: keep(m.group()), out)
    out = re.sub(r"(?is)<(?:pre|code)\b[^>]*>(.*?)</(?:pre|code)\s*>", lambda m: keep(f"```\n{m.group(1).strip()}\n```") if "\n" in m.group(1) else keep(m.group(1)), out)
    out = re.sub(r"(?s)\$\$.+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)|\\begin\{(?:equation|align|aligned|gather|math)\*?\}.*?\\end\{(?:equation|align|aligned|gather|math)\*?\}", lambda m: keep(m.group()), out)
    out = re.sub(r"(?<![\\$\w])\$(?=[^\s$])[^$\n]*[\\_^=][^$\n]*?(?<=[^\s$])\$(?![\w$])", lambda m: keep(m.group()), out)
    out = _clean_html(out)
    out = _clean_wiki(out)
    out = _clean_latex(out)
    out = _clean_markdown(out)
    for _ in range(3):
        out = re.sub("\x00(\\d+)\x00", lambda m: kept[int(m.group(1))], out)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+(?=\n|\Z)", "", out)).strip()


def _clean_html(out: str) -> str:
    row = lambda m: "\n| " + " | ".join(re.sub(r"<[^>]*>", "", c).strip() for c in re.findall(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]|<t[dh]\b|\Z)", m.group())) + " |"
    out = re.sub(r"(?is)<tr\b[^>]*>.*?(?=</tr|<tr\b|</table|\Z)", row, out)
    out = re.sub(r"(?i)<h([1-6])\b[^>]*>", lambda m: "\n" + "#" * int(m.group(1)) + " ", out)
    out = re.sub(r"(?i)<li\b[^>]*>", "\n- ", out)
    out = re.sub(r"""(?i)<img\b[^>]*?\balt\s*=\s*["']([^"']*)["'][^>]*>""", r"\1 ", out)
    out = re.sub(r"(?i)<br\s*/?>|</?(?:p|div|ul|ol|table|section|article|blockquote|h[1-6]|dl|dt|dd)\b(?:\s[^>]*)?>", "\n", out)
    return re.sub(rf"(?i)</?{_NAME}(?:{_ATTRIBUTE})*\s*/?>", "", out)


def _clean_wiki(out: str) -> str:
    def table(m: re.Match) -> str:
        rows = []
        for part in re.split(r"(?m)^\|-.*$", m.group(1)):
            cells = [c.split("|")[-1].strip() for c in re.split(r"(?m)^[|!]|\|\||!!", part)[1:]]
            if any(cells):
                rows.append("| " + " | ".join(cells) + " |")
        return "\n".join(rows)

    out = re.sub(r"(?ms)^\{\|[^\n]*\n(.*?)^\|\}", table, out)
    out = re.sub(r"(?m)^(?:\{\||\|\}|\|-+)[^|\n]*$\n?", "", out)
    out = re.sub(r"(?m)^(={2,6})[ ]*([^=\n]+?)[ ]*\1[ ]*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), out)
    out = re.sub(r"(?i)\[\[(?:분류|category|file|파일|image|그림):[^\[\]\n]*\]\]", "", out)
    out = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]", r"\1", out)
    out = re.sub(r"\{\{[^{}\n]*\}\}", "", out)
    out = re.sub(r"\[https?://[^\s\]]+[ ]([^\]\n]+)\]", r"\1", out)
    return re.sub(r"'{2,5}(?=[^\s'])([^'\n]+?)'{2,5}", r"\1", out)


def _clean_latex(out: str) -> str:
    levels = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
    out = re.sub(r"\\(part|chapter|(?:sub)*section|paragraph)\*?\{([^}\n]*)\}", lambda m: "#" * levels[m.group(1)] + " " + m.group(2), out)

    def tabular(m: re.Match) -> str:
        rows = [re.sub(r"\\hline", "", r).strip() for r in re.split(r"\\\\", m.group(1))]
        return "\n".join("| " + " | ".join(c.strip() for c in r.split("&")) + " |" for r in rows if r)

    out = re.sub(r"(?s)\\begin\{tabular\*?\}(?:\{[^}]*\})?(.*?)\\end\{tabular\*?\}", tabular, out)
    out = re.sub(r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?", "", out)
    out = re.sub(r"(?m)\\item(?:\[[^\]\n]*\])?[ \t]+", "- ", out)
    out = re.sub(r"\\(?:label|ref|cite|vspace|hspace|index)\{[^}\n]*\}", "", out)
    out = re.sub(r"\\footnote\{([^}\n]*)\}", r" (\1)", out)
    for _ in range(4):
        new = re.sub(r"\\(?:emph|text[a-z]{2}|textbf|textit|underline|mbox|text|mathrm|href\{[^}\n]*\}|url|title|author|caption)\*?\{([^{}\n]*)\}", r"\1", out)
        if new == out:
            break
        out = new
    return re.sub(r"\\(?:maketitle|noindent|hline|centering|newpage|clearpage)\b", "", out)


def _clean_markdown(out: str) -> str:
    out = re.sub(r"(?m)^[ ]*\|?(?:[ ]*:?-{3,}:?[ ]*\|)+(?:[ ]*:?-{3,}:?[ ]*)?$\n?", "", out)
    out = re.sub(r"(?m)^(\S.*)\n={4,}[ ]*$", r"# \1", out)
    out = re.sub(r"(?m)^(\S.*)\n-{4,}[ ]*$", r"## \1", out)
    out = re.sub(r"!?\[([^\[\]\n]*)\]\([^()\s]+(?:[ ]+\"[^\"\n]*\")?\)", r"\1", out)
    out = re.sub(r"(?m)^\[\^[\w-]+\]:[ ]*", "", out)
    out = re.sub(r"\[\^[\w-]+\]", "", out)
    out = re.sub(r"(?m)^([ ]*)[-*+][ ]+\[[ xX]\][ ]", r"\1- ", out)
    out = re.sub(r"\*\*(?=\S)([^*\n]+?)(?<=\S)\*\*", r"\1", out)
    out = re.sub(r"__(?=[^\s_])([^_\n]+?)(?<=[^\s_])__", r"\1", out)
    out = re.sub(r"~~(?=\S)([^~\n]+?)~~", r"\1", out)
    out = re.sub(r"(?<![\w*])\*(?=[^\s*])([^*\n]{1,80}?)(?<=[^\s*])\*(?![\w*])(?!\))", r"\1", out)
    out = re.sub(r"(?<![`\w])`([^`\n]+)`(?!`)", r"\1", out)
    return re.sub(r"(?m)^>[ ]+", "", out)


def records(docs: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """(``record_kind``, ``record_key``, ``text``) of the rows of one table."""
    return docs.select(F.lit(kind).alias("record_kind"), F.col(key).cast("string").alias("record_key"), F.col(text).alias("text"))


def fit(texts: DataFrame, sample: int = 2_000) -> dict[str, float]:
    """Weights from the ``sample`` different marked texts with the least digests: the same for the same texts, and
    bounded whatever their number. They only place the content region; kinds are found in all texts.

    To the driver come digests, then counts of features (some hundred), but no text.
    """
    marked = texts.where(F.col("text").rlike(CANDIDATE)).select("text", F.xxhash64("text").alias("digest"))
    least = marked.select("digest").distinct().orderBy("digest").limit(sample).agg(F.max("digest")).first()[0]
    if least is None:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sum((feature_counts(t, label_lines(t)) for t in batch.column(0).to_pylist()), Counter())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.bool_()), pa.array([f for _, f in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["label", "feature", "n"])

    chosen = marked.where(F.col("digest") <= least).dropDuplicates(["digest"]).select("text")
    counted = chosen.mapInArrow(count, "label boolean, feature string, n long").groupBy("label", "feature").agg(F.sum("n").alias("n")).collect()
    return feature_weights({(r["label"], r["feature"]): r["n"] for r in counted})


def analysed(texts: DataFrame, weights: dict[str, float], with_text: bool = True) -> DataFrame:
    """One row a row of ``records``: kind, key, ``markup`` (kinds found) and, if wanted, ``region_start``,
    ``region_end`` (characters of the original) and ``clean_text`` of the region.

    Null texts count as empty: no markup, an empty region. Texts without words have an empty region.
    Texts without any mark are their own content and never reach a Python worker.
    """
    known = texts.select("record_kind", "record_key", F.coalesce("text", F.lit("")).alias("text"))
    candidate = F.col("text").rlike(CANDIDATE)
    fields = "record_kind string, record_key string, markup array<string>" + (", region_start int, region_end int, clean_text string" if with_text else "")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).to_pylist()
            columns = [batch.column(0), batch.column(1), pa.array([kinds(t) for t in values], pa.list_(pa.string()))]
            names = ["record_kind", "record_key", "markup"]
            if with_text:
                at = [content_region(t, weights) for t in values]
                columns += [pa.array([a for a, _ in at], pa.int32()), pa.array([b for _, b in at], pa.int32()), pa.array([clean(t[a:b]) for t, (a, b) in zip(values, at, strict=True)], pa.string())]
                names += ["region_start", "region_end", "clean_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    marked = known.where(candidate).mapInArrow(look, fields)
    whole: list[Column] = [F.lit(0).alias("region_start"), F.length("text").alias("region_end"), F.col("text").alias("clean_text")] if with_text else []
    plain = known.where(~candidate).select("record_kind", "record_key", F.array().cast("array<string>").alias("markup"), *whole)
    return marked.unionByName(plain) if with_text else marked
