"""How many tokens each slice of a corpus provides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import TOKENIZERS, VOCABULARY, token_count


def normal_language(value: Column) -> Column:
    """``ko`` or ``en`` for the ways these are written, else the lower-case primary subtag, ``und`` if missing."""
    tag = F.regexp_extract(F.lower(F.trim(F.coalesce(value, F.lit("")))), r"^([a-z]+)", 1)
    return (
        F.when(tag.isin("ko", "kor", "korean", "kr"), "ko").when(tag.isin("en", "eng", "english"), "en").when(tag == "", "und").otherwise(tag)
    )


def normal_label(value: Column) -> Column:
    """A label path with ``' / '`` between its parts, single spaces and no outer ones; missing is ``''``."""
    text = F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " "))
    return F.regexp_replace(text, r" ?/ ?", " / ")


def token_budget(docs: DataFrame, slices: dict[str, Column], key: str = "id", text: str = "body", order: str = "loaded_at", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents``, ``characters`` and ``tokens`` for every combination of the ``slices`` columns.

    Every key counts once: of its rows the one loaded last (null is earliest), of several loaded at once
    the greatest by slices and text digest. Rows with a null key are documents of their own if they differ
    in slices or text; others are one. Null texts have no tokens. Columns other than those named are
    not read, so clashing names do no harm. No rows: no slices.

    Texts move once, to be deduplicated by a 128-bit digest before they are tokenized, and equal texts
    collapse before they are moved. What is joined back is one row per digest and slice with its number
    of documents, so a text with very many copies is no hot key.
    """
    names = list(slices)
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(7), body, F.length(body)).alias("b"))
    rows = docs.select(F.col(key).alias("key"), F.col(order).alias("at"), *[slices[n].alias(n) for n in names], digest.alias("digest"), body.alias("text"))
    # Null keys are told apart by what they hold.
    own = F.when(F.col("key").isNull(), F.struct(*names, "digest"))
    once = rows.groupBy("key", own.alias("own")).agg(F.max(F.struct("at", *names, "digest")).alias("r"))
    members = once.groupBy(*[F.col(f"r.{n}").alias(n) for n in names], F.col("r.digest.a").alias("a"), F.col("r.digest.b").alias("b")).agg(F.count("*").alias("n"))
    texts = rows.select(F.col("digest.a").alias("a"), F.col("digest.b").alias("b"), "text").dropDuplicates(["a", "b"])
    counts = texts.select("a", "b", F.length("text").alias("characters"), token_count(F.col("text"), folder, vocabulary).alias("tokens"))
    return (
        members.join(counts, ["a", "b"])
        .groupBy(*names)
        .agg(F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("characters")).alias("characters"), F.sum(F.col("n") * F.col("tokens")).alias("tokens"))
    )
