"""Formats: telling them apart, and one conversion for all."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.convert.equation import clean_script, with_equations
from corpusloom.convert.hwp import body_streams, hwp_parts
from corpusloom.convert.hwpx import ConversionError, hwpx_text, raw_hints
from corpusloom.functions.html import page_to_markdown
from corpusloom.functions.text import suffix

#: First bytes of files, and media types by extension.
MAGIC = {"255044462D": ".pdf", "504B0304": ".hwpx", "D0CF11E0A1B11AE1": ".hwp"}
FOLDERS = ("hwpx", "hwp", "pdf", "html", "htm", "txt")
MIME = {".pdf": "application/pdf", ".html": "text/html", ".htm": "text/html", ".txt": "text/plain", ".md": "text/markdown", ".zip": "application/zip", ".hwp": "application/x-hwp", ".hwpx": "application/hwp+zip", ".json": "application/json", ".xml": "text/xml", ".png": "image/png", ".jpg": "image/jpeg"}


def infer_extension(path: Column, content: Column) -> Column:
    """A file's extension in lower case: by its name, its folder's name or its first bytes; ``''`` if unknown."""
    own = F.lower(suffix(path))
    folder = F.regexp_extract(F.lower(path), rf"-({'|'.join(FOLDERS)})/[^/]*$", 1)
    out = F.lit("")
    for magic, extension in MAGIC.items():
        out = F.when(F.hex(F.substring(content, 1, len(magic) // 2)) == magic, extension).otherwise(out)
    return F.when(own != "", own).when(folder != "", F.concat(F.lit("."), folder)).otherwise(out)


def mime_type(path: Column) -> Column:
    """The media type of a file name's extension; ``''`` if unknown."""
    out = F.lit("")
    for extension, kind in MIME.items():
        out = F.when(F.lower(suffix(path)) == extension, kind).otherwise(out)
    return out


def readable_score(text: Column) -> Column:
    """The share of letters and digits among these and lost characters; 0 without either."""
    useful = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]"))
    bad = F.regexp_count(text, F.lit(r"[�\x00]"))
    return F.when(F.length(text) > 0, useful / F.greatest(F.lit(1), useful + bad)).otherwise(0.0)


def eqedit_script(payload: bytes | None) -> str:
    """The script of an equation record: its length stands before it; else all text but known markers."""
    data = payload or b""
    if len(data) < 6:
        return ""
    end = 6 + 2 * int.from_bytes(data[4:6], "little")
    if 6 < end <= len(data) and (script := clean_script(data[6:end].decode("utf-16le", "replace"))):
        return script
    return clean_script(re.sub(r"Equation Version \d+|HYhwpEQ", " ", data.decode("utf-16le", "ignore")))


def _pdf_text(data: bytes) -> str:
    try:
        from pypdf import PdfReader
    except ImportError as error:
        raise ConversionError("no PDF library is installed") from error
    return "\n\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages)


def _hwp_text(data: bytes) -> str:
    text, payloads = hwp_parts(*body_streams(data))
    if not text.strip():
        raise ConversionError("no readable HWP body text found")
    return with_equations(text, [eqedit_script(p) for p in payloads])


def file_hints(extension: str, data: bytes | None) -> tuple[int, int]:
    """How many hints of tables and formulas a raw file holds; of HWP files the equations. (0, 0) for what cannot be read."""
    if extension != ".hwp" or not data:
        return raw_hints(extension, data)
    try:
        return 0, len(hwp_parts(*body_streams(data))[1])
    except Exception:  # whatever a library raises on a broken file
        return 0, 0


def convert_bytes(extension: str, data: bytes) -> str:
    """Markdown text of a file; ``ConversionError`` if its format is unknown or it cannot be read."""
    decoded = lambda: data.decode("utf-8", "replace")
    readers = {".md": decoded, ".txt": decoded, ".html": lambda: page_to_markdown(decoded()), ".htm": lambda: page_to_markdown(decoded()), ".hwpx": lambda: hwpx_text(data), ".pdf": lambda: _pdf_text(data), ".hwp": lambda: _hwp_text(data)}
    if extension not in readers:
        raise ConversionError(f"unsupported attachment format: {extension or '(none)'}")
    return readers[extension]()


def converted(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``files`` with ``extension``, ``size``, ``content_hash``, ``text``, ``status``, ``error`` and raw hints.

    A file that cannot be converted, or has no text, is a ``failed`` row with its reason; it never fails
    the job. Null content counts as empty.
    """

    @F.pandas_udf("text string, error string, raw_tables int, raw_formulas int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for extensions, contents in batches:
            rows = []
            for extension, data in zip(extensions, contents, strict=True):
                hints = file_hints(extension, data)
                try:
                    text = convert_bytes(extension, bytes(data or b"")).strip()
                    rows.append((text + "\n", "", *hints) if text else ("", "converted text is empty", *hints))
                except Exception as error:  # whatever a library raises on a broken file is the row's error
                    rows.append(("", str(error) or type(error).__name__, *hints))
            yield pd.DataFrame(rows, columns=["text", "error", "raw_tables", "raw_formulas"])

    extension = infer_extension(F.col(path), F.col(content))
    known = files.withColumns({"extension": extension, "size": F.coalesce(F.octet_length(content), F.lit(0)).cast("long"), "content_hash": F.sha2(F.coalesce(F.col(content), F.lit(b"")), 256)})
    done = known.withColumn("__r", run("extension", content))
    return done.select(*[F.col(c) for c in known.columns], F.col("__r.text").alias("text"), F.when(F.col("__r.error") == "", "converted").otherwise("failed").alias("status"), F.col("__r.error").alias("error"), F.col("__r.raw_tables").alias("raw_tables"), F.col("__r.raw_formulas").alias("raw_formulas"))
