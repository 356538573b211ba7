"""Conversion of binary and page formats to Markdown text; every converter reports errors as a column."""

from corpusloom.convert.equation import equation_to_latex, with_equations
from corpusloom.convert.formats import ConversionError, convert_bytes, converted, eqedit_script, file_hints, infer_extension, mime_type, readable_score
from corpusloom.convert.hwpx import hwpx_text, raw_hints, section_text

__all__ = [
    "ConversionError",
    "convert_bytes",
    "converted",
    "eqedit_script",
    "file_hints",
    "equation_to_latex",
    "hwpx_text",
    "infer_extension",
    "mime_type",
    "raw_hints",
    "readable_score",
    "section_text",
    "with_equations",
]
