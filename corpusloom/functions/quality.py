"""The rule-based audit of converted texts, as Column expressions without a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import WS, non_space_length, strip, text_lines, text_or_empty

#: What counts as a hint of a formula, signs and phrases. No phrase holds a sign.
FORMULA_SIGNS = "≤≥≠±×÷√∑∫∞∂→←"
FORMULA_PHRASES = (
    r"\b[A-Za-z]\s*[=<>]\s*[-+0-9A-Za-z(]|[0-9]\s*[+\-*/]\s*[0-9]|"
    r"\b(?:hat|sum|Isum|LEFT|RIGHT|over|sqrt|root|matrix|dmatrix)\b|"
    r"수식\s+\d+:|```hwp-equation"
)
#: Penalties of the flags, in the order in which flags are listed.
SHORT, LONG_LINE = 40, 1200
PENALTIES = {
    "empty_text": 100,
    "very_short_text": 45,
    "replacement_characters": None,  # 3 a character, 30 at most
    "very_long_lines": 15,
    "raw_table_hints_without_table_text": 25,
    "raw_formula_hints_without_formula_text": 25,
}


def is_table_line(line: Column) -> Column:
    """Whether a line looks like a table's row: by pipes, else by tabs, else by wide gaps."""
    bare = strip(line)
    filled = lambda cells: F.filter(cells, lambda c: F.regexp_replace(c, f"{WS}+", "") != "")
    wide = filled(F.split(bare, f"{WS}{{2,}}"))
    return (
        F.when(F.regexp_count(bare, F.lit(r"\|")) >= 2, F.size(filled(F.split(bare, r"\|"))) >= 2)
        .when(F.contains(bare, F.lit("\t")), F.size(filled(F.split(bare, "\t"))) >= 2)
        .otherwise((F.size(wide) >= 3) & (F.size(F.filter(wide, lambda c: c.rlike("[0-9A-Za-z가-힣]"))) >= 2))
    )


#: What parts cells; the range tells letters of most scripts apart first.
_SEPARATOR = rf"(?=[\x00-\u3000])(?:[|\t]|{WS}{{2}})"


def table_row_count(lines: Column) -> Column:
    # Lines without any separator cannot be rows; the cheap test comes first.
    return F.size(F.filter(lines, lambda line: line.rlike(_SEPARATOR) & is_table_line(line))).cast("long")


def formula_hint_count(text: Column) -> Column:
    # What either begins with is tested first; it tells most characters apart.
    signs = F.regexp_count(text, F.lit(rf"(?=[±×÷\u2190-\u2265])[{FORMULA_SIGNS}]"))
    phrases = F.regexp_count(text, F.lit(rf"(?U)(?=[A-Za-z0-9`수])(?:{FORMULA_PHRASES})"))
    return (signs + phrases).cast("long")


def replacement_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))).cast("long")


def metrics(text: Column, lines: Column | None = None) -> dict[str, Column]:
    """The counters of a text; null is the empty text. ``lines`` may name a column of its lines, so they are cut once."""
    value = text_or_empty(text)
    lines = text_lines(value) if lines is None else lines
    return {
        "text_chars": F.length(value).cast("long"),
        "non_space_chars": non_space_length(value),
        "line_count": F.size(lines).cast("long"),
        "table_row_count": table_row_count(lines),
        "formula_hint_count": formula_hint_count(value),
        "replacement_char_count": replacement_count(value),
        "longest_line": F.coalesce(F.array_max(F.transform(lines, lambda line: F.length(line))), F.lit(0)).cast("long"),
    }


def flags(raw_tables: Column | None = None, raw_formulas: Column | None = None) -> Column:
    """The flags of a row that has the columns of ``metrics``, in their fixed order."""
    hits = {
        "empty_text": F.col("text_chars") == 0,
        "very_short_text": (F.col("non_space_chars") > 0) & (F.col("non_space_chars") < SHORT),
        "replacement_characters": F.col("replacement_char_count") > 0,
        "very_long_lines": F.col("longest_line") > LONG_LINE,
        "raw_table_hints_without_table_text": (raw_tables if raw_tables is not None else F.lit(0)) > 0,
        "raw_formula_hints_without_formula_text": (raw_formulas if raw_formulas is not None else F.lit(0)) > 0,
    }
    hits["raw_table_hints_without_table_text"] &= F.col("table_row_count") == 0
    hits["raw_formula_hints_without_formula_text"] &= F.col("formula_hint_count") == 0
    return F.filter(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items()]), lambda f: f.isNotNull())


def score(found: Column) -> Column:
    """100 less the penalties of the flags, within 0 and 100; needs ``replacement_char_count``."""
    broken = F.least(F.lit(30), 3 * F.col("replacement_char_count")).cast("int")
    cost = sum((F.when(F.array_contains(found, name), F.lit(p) if p is not None else broken).otherwise(F.lit(0)) for name, p in PENALTIES.items()), F.lit(0))
    return F.greatest(F.lit(0), 100 - cost).cast("int")


def status(found: Column) -> Column:
    return F.when(F.array_contains(found, "empty_text"), "fail").when(F.size(found) > 0, "warn").otherwise("ok")


#: What the flags and routes mean; the counts stand where %d does.
MESSAGES = {
    "empty_text": "converted text is empty",
    "very_short_text": "converted text is very short (%d non-space chars)",
    "replacement_characters": "converted text contains %d replacement character(s)",
    "very_long_lines": "converted text contains very long lines; table or paragraph boundaries may be lost",
    "raw_table_hints_without_table_text": "raw HWPX has table tags but converted text has no table-like rows",
    "raw_formula_hints_without_formula_text": "raw attachment has formula hints but converted text has no formula-like text",
}


def message(flag: Column, non_space: Column, broken: Column) -> Column:
    """What a flag means; unknown flags speak for themselves."""
    counts = {"very_short_text": non_space, "replacement_characters": broken}
    out = flag
    for name, words in MESSAGES.items():
        out = F.when(flag == name, F.format_string(words, counts[name]) if name in counts else F.lit(words)).otherwise(out)
    return out
