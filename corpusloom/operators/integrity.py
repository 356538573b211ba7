"""References between documents and files: orphans, dangling references, validation, removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.policy import is_full_text, is_past_rule
from corpusloom.functions.text import text_or_empty


def normal_path(path: Column) -> Column:
    """A relative path without ``./`` and doubled slashes; ``..`` stays."""
    return F.regexp_replace(F.regexp_replace(text_or_empty(path), "/+", "/"), r"^(?:\./)+|(?<=/)(?:\./)+", "")


def referenced_paths(*references: tuple[DataFrame, str]) -> DataFrame:
    """The distinct non-empty paths (``rel_path``) of columns of several tables."""
    parts = [df.select(normal_path(F.col(c)).alias("rel_path")) for df, c in references]
    return reduce(DataFrame.union, parts).where("rel_path <> ''").distinct()


def orphans(files: DataFrame, referenced: DataFrame) -> DataFrame:
    """Files that nothing refers to."""
    keyed = files.withColumn("__p", normal_path(F.col("rel_path")))
    return keyed.join(referenced.select(F.col("rel_path").alias("__p")), "__p", "left_anti").drop("__p")


def dangling(references: DataFrame, path: str, files: DataFrame) -> DataFrame:
    """Rows whose non-empty path leads to no file."""
    known = references.where(text_or_empty(F.col(path)) != "").withColumn("__p", normal_path(F.col(path)))
    return known.join(files.select(normal_path(F.col("rel_path")).alias("__p")).distinct(), "__p", "left_anti").drop("__p")


def _messages(rows: DataFrame, owner: Column, checks: list[tuple[Column, Column]]) -> DataFrame:
    found = F.filter(F.array(*[F.when(bad, F.concat(owner, F.lit(": "), words)) for bad, words in checks]), lambda m: m.isNotNull())
    return rows.select(F.explode(found).alias("message"))


def validate(documents: DataFrame, attachments: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Every violated constraint of documents and attachments as a ``message`` that begins with a path.

    ``attachments`` has ``document_path``. Without ``files``, existence is not checked.
    """
    empty = lambda c: text_or_empty(F.col(c)) == ""
    required = [(empty(c), F.lit(f"{c} is required")) for c in ("id", "title", "source_url", "collected_at", "content_hash")]
    kinds = [
        (~text_or_empty(F.col("document_type")).isin("rule", "notice"), F.lit("document_type must be rule or notice")),
        (~text_or_empty(F.col("language")).isin("ko", "en"), F.lit("language must be ko or en")),
    ]
    status = text_or_empty(F.col("status"))
    states = [
        ((status == "converted") & empty("text_path"), F.concat(F.lit("converted attachment "), F.col("id"), F.lit(" has no text_path"))),
        ((status == "failed") & ~empty("text_path"), F.concat(F.lit("failed attachment "), F.col("id"), F.lit(" must not expose text_path"))),
    ]
    parts = [_messages(documents, F.col("path"), required + kinds), _messages(attachments, F.col("document_path"), states)]
    if files is not None:
        for rows, owner, column, words in ((documents, "path", "raw_path", "missing raw document file "), (documents, "path", "text_path", "missing converted document file "), (attachments, "document_path", "raw_path", "missing raw attachment "), (attachments, "document_path", "text_path", "missing converted attachment ")):
            parts.append(dangling(rows, column, files).select(F.concat(F.col(owner), F.lit(": " + words), F.col(column)).alias("message")))
    return reduce(DataFrame.union, parts)


def drop_attachments(documents: DataFrame, full_text: bool = False, past_rule: bool = False) -> DataFrame:
    """``documents`` without the attachments that a policy excludes, with ``removed``, how many went.

    Full texts go from all documents, past versions' attachments from rules only.
    """
    of = lambda a: (a["title"], a["file_name"], a["server_file"], a["id"])
    rule = F.col("document_type") == "rule"

    def keep(a: Column) -> Column:
        out = F.lit(True)
        if full_text:
            out = out & ~is_full_text(*of(a))
        if past_rule:
            out = out & ~(rule & is_past_rule(*of(a)))
        return out

    kept = F.filter("attachments", keep)
    return documents.withColumn("__kept", kept).withColumn("removed", F.size("attachments") - F.size("__kept")).withColumn("attachments", F.col("__kept")).drop("__kept")


def excluded_children(children: DataFrame, full_text: bool = False, past_rule: bool = False) -> DataFrame:
    """The attachments, a row each with their ``document_type``, that ``drop_attachments`` would take out."""
    of = [F.col(c) for c in ("title", "file_name", "server_file", "id")]
    out = F.lit(False)
    if full_text:
        out = out | is_full_text(*of)
    if past_rule:
        out = out | ((F.col("document_type") == "rule") & is_past_rule(*of))
    return children.where(out)


def child_drop_counts(excluded: DataFrame) -> DataFrame:
    """``removed`` attachments and ``changed`` documents, of rows with ``document_id``: partial sums, no nesting."""
    return excluded.groupBy("document_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("removed"), F.count("*").alias("changed"))


def drop_counts(dropped: DataFrame) -> DataFrame:
    """``removed`` attachments and ``changed`` documents of a ``drop_attachments``."""
    return dropped.agg(F.coalesce(F.sum("removed"), F.lit(0)).alias("removed"), F.count_if(F.col("removed") > 0).alias("changed"))
