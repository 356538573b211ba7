"""Reading HTML pages: extraction inside the JVM, and conversion to Markdown by Arrow UDFs."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions.text import collapse_space, strip, text_or_empty


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return texts.map(lambda t: html.unescape(t) if t and "&" in t else t)


def without_tags(value: Column) -> Column:
    """Text without scripts, styles and tags, its entities still escaped; white space is collapsed."""
    bare = F.regexp_replace(text_or_empty(value), r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]+>", " ")


def strip_tags(value: Column) -> Column:
    """Plain text of HTML: scripts and styles dropped, tags as spaces, entities decoded, spaces collapsed."""
    return collapse_space(unescape(without_tags(value)))


def first_match(pattern: str, value: Column) -> Column:
    """The first group of the first match, in any case and across lines; ``''`` if there is none."""
    return strip(unescape(F.regexp_extract(text_or_empty(value), f"(?is){pattern}", 1)))


def elements_by_class(value: Column, tag: str, name: str) -> Column:
    """All elements of a tag with a class, as they stand; elements within each other are not told apart."""
    pattern = rf"""(?is)<{tag}\b[^>]*class\s*=\s*["'][^"']*\b{name}\b[^"']*["'][^>]*>.*?</{tag}>"""
    return F.regexp_extract_all(text_or_empty(value), F.lit(pattern), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in double quotes or else in single ones; ``''`` without it."""
    double = F.regexp_extract(text_or_empty(tag), rf'(?is)\b{name}\s*=\s*"([^"]*)"', 1)
    single = F.regexp_extract(text_or_empty(tag), rf"(?is)\b{name}\s*=\s*'([^']*)'", 1)
    return F.coalesce(F.nullif(double, F.lit("")), single)


class _Markdown(HTMLParser):
    """Paragraph breaks, items and bold text; text runs are joined without a space, as in the data model."""

    BREAKS = {"p": 2, "div": 2, "tr": 2, "br": 1}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out = ""

    def _break(self, lines: int) -> None:
        have = len(self.out) - len(self.out.rstrip("\n"))
        if self.out and have < lines:
            self.out += "\n" * (lines - have)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.BREAKS:
            self._break(self.BREAKS[tag])
        elif tag == "li":
            self._break(1)
            self.out += "- "
        elif tag in ("strong", "b"):
            self.out += "**"

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "div", "tr"):
            self._break(2)
        elif tag == "li":
            self._break(1)
        elif tag in ("strong", "b"):
            self.out += "**"

    def handle_data(self, data: str) -> None:
        self.out += " ".join(data.split())


def page_to_markdown(page: str | None) -> str:
    """Markdown of a page. Scripts' text is text; what is left open at the end is lost."""
    parser = _Markdown()
    parser.feed(page or "")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", parser.out)).strip()


@F.pandas_udf(StringType())
def html_to_markdown(pages: pd.Series) -> pd.Series:
    return pages.map(page_to_markdown)
