"""Explicit schemas of the data model. Missing text is ``''`` and a missing count 0."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType


def _fields(names: str, kind=StringType) -> list[StructField]:
    return [StructField(n, kind()) for n in names.split()]


ATTACHMENT = StructType(
    _fields("id title file_name mime_type source_url server_file folder raw_path text_path content_hash status error")
    + _fields("size", LongType)
    + _fields("quality_status")
    + _fields("quality_score", IntegerType)
    + _fields("quality_flags")
    + _fields("converted_text_chars converted_non_space_chars table_row_count formula_hint_count replacement_char_count", LongType)
)
DOCUMENT = StructType(
    _fields("id title source_url document_type body category effective_date published_date collected_at content_hash language source_id file_name raw_path text_path file_content_hash")
    + [StructField("attachments", ArrayType(ATTACHMENT))]
    + _fields("path")
)
ITEM = StructType(_fields("id title document_type category book_id noformyn menu_id published_date effective_date state_history_id") + _fields("ord", LongType))
ISSUE = StructType(_fields("severity code document_id document_title attachment_id attachment_title file_name message"))
