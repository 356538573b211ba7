"""Which attachments of a current rule are kept out of the corpus."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip, text_or_empty

#: File codes and title words of attachments that belong to past versions, and full texts.
PAST_CODES = ("rea", "gae", "sin")
FULL_TEXT_CODES = ("jun",)
FULL_TEXT_TITLE = "전문"
PAST_WORDS = ("개정이유", "개정문", "개정조문", "개정지시문", "신구조문", "신ㆍ구조문", "신·구조문", "신・구조문", "신구 조문", "대비표")


def joined_text(*parts: Column) -> Column:
    """The non-empty parts with spaces between, stripped, in lower case."""
    return F.lower(strip(F.concat_ws(" ", *[F.nullif(text_or_empty(p), F.lit("")) for p in parts])))


def has_code(text: Column, codes: tuple[str, ...]) -> Column:
    """Whether a code stands in ``text`` as the value of ``filecd`` or on its own between separators."""
    either = "|".join(codes)
    return text.rlike(rf"filecd=(?:{either})|(?:^|[-_/])(?:{either})(?:$|[-_.?/=&\s])")


def is_full_text(title: Column, file_name: Column, server_file: Column, attachment_id: Column) -> Column:
    return (strip(text_or_empty(title)) == FULL_TEXT_TITLE) | has_code(joined_text(title, file_name, server_file, attachment_id), FULL_TEXT_CODES)


def is_past_rule(title: Column, file_name: Column, server_file: Column, attachment_id: Column) -> Column:
    text = joined_text(title, file_name, server_file, attachment_id)
    return has_code(text, PAST_CODES) | text.rlike("|".join(PAST_WORDS))


def is_excluded(title: Column, file_name: Column, server_file: Column, attachment_id: Column) -> Column:
    return is_full_text(title, file_name, server_file, attachment_id) | is_past_rule(title, file_name, server_file, attachment_id)
