"""String functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the data model (Unicode white space with the file, group, record and unit separators).
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: The same characters as a string, to trim by: ends are looked at only, and no pattern runs over the rest.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Line boundaries of the data model.
NL = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def text_or_empty(value: Column) -> Column:
    """Missing text is ``''`` in the data model, never null."""
    return F.coalesce(value, F.lit(""))


def strip(value: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(value, F.lit(WS_CHARS))


def strip_chars(value: Column, chars: str) -> Column:
    """Without any of ``chars`` at either end."""
    return F.btrim(value, F.lit(chars))


def collapse_space(value: Column) -> Column:
    """Single spaces in place of white space, and none at the ends."""
    return F.btrim(F.regexp_replace(value, f"{WS}+", " "), F.lit(" "))


def non_space_length(value: Column) -> Column:
    return F.length(F.regexp_replace(value, f"{WS}+", "")).cast("long")


def text_lines(value: Column) -> Column:
    """The non-blank lines, without white space at their ends."""
    return F.filter(F.transform(F.split(value, NL), lambda line: F.rtrim(line, F.lit(WS_CHARS))), lambda line: line != "")


def slug(value: Column) -> Column:
    """A name for paths: lower-case words of digits, Latin letters and Hangul, joined by single hyphens."""
    mapped = F.translate(F.lower(strip(text_or_empty(value))), "/\\ _.:", "------")
    kept = F.regexp_replace(F.regexp_replace(mapped, "[^0-9a-z가-힣-]", ""), "-+", "-")
    return F.coalesce(F.nullif(strip_chars(kept, "-"), F.lit("")), F.lit("untitled"))


def first_non_empty(*values: Column) -> Column:
    """The first value that is not blank, stripped; ``''`` if all are."""
    return F.coalesce(*[F.nullif(strip(v), F.lit("")) for v in values], F.lit(""))


def normalize_language(value: Column) -> Column:
    """``en`` for its usual names and regions, ``ko`` for everything else."""
    return F.when(F.replace(F.lower(strip(text_or_empty(value))), F.lit("_"), F.lit("-")).isin("en", "eng", "english", "en-us", "en-gb"), "en").otherwise("ko")


def normalize_date(value: Column) -> Column:
    """The first year-month-day in a text, written with hyphens and two digits; ``''`` without one."""
    pattern = r"([0-9]{4})\s*[./-]\s*([0-9]{1,2})\s*[./-]\s*([0-9]{1,2})"
    year, month, day = (F.regexp_extract(text_or_empty(value), pattern, i) for i in (1, 2, 3))
    return F.when(year == "", "").otherwise(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))


def hash_text(value: Column) -> Column:
    """SHA-256 of the stripped text, in hex."""
    return F.sha2(strip(text_or_empty(value)), 256)


def suffix(name: Column) -> Column:
    """The last extension of a file name with its point, as written; ``''`` if there is none."""
    base = F.element_at(F.split(F.regexp_replace(text_or_empty(name), "/+$", ""), "/"), -1)
    return F.regexp_extract(base, r"[^.](\.[^.]+)$", 1)


def clean_title(value: Column) -> Column:
    return strip_chars(collapse_space(text_or_empty(value)), " ._-")


def is_generic_name(value: Column) -> Column:
    """Whether a server's file name says nothing about the file."""
    bare = F.regexp_replace(F.lower(text_or_empty(value)), "[^0-9a-z가-힣]", "")
    return (bare == "") | bare.isin("download", "attachment", "file") | bare.rlike("^[0-9]{8,}[0-9a-z]*$")


def attachment_stem(title: Column, file_name: Column, attachment_id: Column) -> Column:
    """What a converted attachment is named after: its title, else its file's name, unless these say nothing;
    else its id, else ``attachment``."""
    base = F.element_at(F.split(F.regexp_replace(text_or_empty(file_name), "/+$", ""), "/"), -1)
    own = clean_title(F.left(base, F.length(base) - F.length(suffix(file_name))))
    named = clean_title(title)
    useful = lambda c: F.when((c != "") & ~is_generic_name(c), c)
    return F.coalesce(useful(named), useful(own), F.nullif(text_or_empty(attachment_id), F.lit("")), F.lit("attachment"))


def truncate_bytes(name: Column, limit: int) -> Column:
    """A file name of at most ``limit`` UTF-8 bytes: the stem gives way, at a character's boundary.

    Of the stem at least one byte may stay, however long the suffix; where nothing of it does, it
    is ``attachment``.
    """
    end = suffix(name)
    stem = F.left(name, F.length(name) - F.length(end))
    room = F.greatest(F.lit(1), F.lit(limit) - F.octet_length(end))
    # The longest prefix that fits: of the first characters, no more than bytes there are.
    fits = F.filter(F.sequence(F.lit(0), F.least(F.length(stem), room)), lambda n: F.octet_length(F.left(stem, n)) <= room)
    kept = F.rtrim(F.left(stem, F.array_max(fits)), F.lit(" ._-"))
    return F.when(F.octet_length(name) <= limit, name).otherwise(F.concat(F.coalesce(F.nullif(kept, F.lit("")), F.lit("attachment")), end))


def tokens(value: Column) -> Column:
    """Distinct search tokens in the order they first occur: words, and the 2- and 3-grams of Hangul words.

    Single characters beyond ASCII are no tokens.
    """

    def expand(word: Column) -> Column:
        grams: Callable[[int], Column] = lambda n: F.when(
            F.length(word) > n - 1, F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, F.lit(n)))
        ).otherwise(F.array().cast("array<string>"))
        return F.when(word.rlike("^[가-힣]+$"), F.concat(F.array(word), grams(2), grams(3))).otherwise(F.array(word))

    words = F.regexp_extract_all(F.lower(text_or_empty(value)), F.lit("[0-9A-Za-z가-힣]+"), F.lit(0))
    every = F.flatten(F.transform(words, expand))
    return F.array_distinct(F.filter(every, lambda t: (F.length(t) > 1) | t.rlike(r"^[\x00-\x7f]$")))


def chunks(value: Column, max_chars: int = 1600) -> Column:
    """Paragraphs, packed in order into chunks of at most ``max_chars``; longer paragraphs are cut.

    Two characters join paragraphs within a chunk. Slices of a cut paragraph are stripped and may be empty.
    """
    size = max_chars if max_chars > 0 else 1600
    paragraphs = F.filter(F.transform(F.split(strip(text_or_empty(value)), r"\n{2,}"), strip), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(acc: Column, p: Column) -> Column:
        closed = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        slices = F.transform(F.sequence(F.lit(0), F.floor((F.length(p) - 1) / size).cast("int")), lambda i: strip(F.substring(p, i * size + 1, F.lit(size))))
        return (
            F.when(F.length(p) > size, F.struct(F.concat(closed, slices).alias("done"), F.lit("").alias("open")))
            .when(acc["open"] == "", F.struct(acc["done"].alias("done"), p.alias("open")))
            .when(F.length(acc["open"]) + F.length(p) + 2 > size, F.struct(closed.alias("done"), p.alias("open")))
            .otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit("\n\n"), p).alias("open")))
        )

    return F.aggregate(paragraphs, start, add, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def drop_adjacent_repeats(values: Column) -> Column:
    """An array without elements that equal the one before."""
    return F.filter(values, lambda x, i: (i == 0) | (x != F.get(values, i - 1)))


def json_scalar(value: Column) -> Column:
    """Text as a JSON string."""
    escaped = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")], text_or_empty(value))
    return F.concat(F.lit('"'), escaped, F.lit('"'))
