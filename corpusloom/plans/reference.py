"""Queries of the document-corpus operators on the test tables, with their DuckDB oracles.

``documents.text`` and ``attachment_texts.text`` stand for converted texts, ``rule_docs`` for documents,
``attachments`` for their children and ``crawl_items`` for items in order of arrival.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.cluster import checkpoint, table
from corpusloom.convert import converted, equation_to_latex
from corpusloom.functions import html, policy, quality, text
from corpusloom.operators import audit, integrity, ordered
from corpusloom.sources.corpus import bundle_dir, render_markdown

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_NL = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"
#: The formula pattern, for an engine whose word boundary knows ASCII only.
_FORMULA = (
    r"≤|≥|≠|±|×|÷|√|∑|∫|∞|∂|→|←|\b[A-Za-z]\s*[=<>]\s*[-+0-9A-Za-z(]|[0-9]\s*[+\-*/]\s*[0-9]|"
    r"\b(?:hat|sum|Isum|LEFT|RIGHT|over|sqrt|root|matrix|dmatrix)\b|수식\s+\d+:|```hwp-equation"
)


def sql_metrics(source: str, key: str, body: str) -> str:
    """CTEs ``base`` (lines) and ``m`` (the counters of a text) over a table."""
    blank = f"regexp_replace(c, '{_WS}+', '', 'g') <> ''"
    bare = _STRIP("l")
    row = (
        f"CASE WHEN length({bare}) - length(replace({bare}, '|', '')) >= 2 THEN len(list_filter(string_split({bare}, '|'), lambda c: {blank})) >= 2 "
        f"WHEN contains({bare}, chr(9)) THEN len(list_filter(string_split({bare}, chr(9)), lambda c: {blank})) >= 2 "
        f"ELSE len(list_filter(regexp_split_to_array({bare}, '{_WS}{{2,}}'), lambda c: {blank})) >= 3 "
        f"AND len(list_filter(regexp_split_to_array({bare}, '{_WS}{{2,}}'), lambda c: regexp_matches(c, '[0-9A-Za-z가-힣]'))) >= 2 END"
    )
    return f"""
base AS (SELECT {key} AS k, coalesce({body}, '') AS t,
  list_filter(list_transform(regexp_split_to_array(coalesce({body}, ''), '{_NL}'), lambda l: regexp_replace(l, '{_WS}+$', '')), lambda l: l <> '') AS lines FROM {source}),
m AS (SELECT k, t, lines, length(t) AS text_chars, length(regexp_replace(t, '{_WS}+', '', 'g')) AS non_space_chars, len(lines) AS line_count,
  len(list_filter(lines, lambda l: {row})) AS table_row_count, len(regexp_extract_all(t, '{_FORMULA}')) AS formula_hint_count,
  length(t) - length(replace(t, chr(65533), '')) AS replacement_char_count, coalesce(list_max(list_transform(lines, lambda l: length(l))), 0) AS longest_line FROM base)"""


_SQL_GRADED = """
g AS (SELECT m.*, list_filter([CASE WHEN text_chars = 0 THEN 'empty_text' END, CASE WHEN non_space_chars BETWEEN 1 AND 39 THEN 'very_short_text' END,
  CASE WHEN replacement_char_count > 0 THEN 'replacement_characters' END, CASE WHEN longest_line > 1200 THEN 'very_long_lines' END], lambda f: f IS NOT NULL) AS flags,
  greatest(0, 100 - (CASE WHEN text_chars = 0 THEN 100 ELSE 0 END) - (CASE WHEN non_space_chars BETWEEN 1 AND 39 THEN 45 ELSE 0 END)
  - least(30, 3 * replacement_char_count) - (CASE WHEN longest_line > 1200 THEN 15 ELSE 0 END)) AS score FROM m),
s AS (SELECT g.*, CASE WHEN list_contains(flags, 'empty_text') THEN 'fail' WHEN len(flags) > 0 THEN 'warn' ELSE 'ok' END AS status FROM g)"""
_SQL_TEXTS = f"WITH {sql_metrics('attachment_texts', 'text_path', 'text')}, {_SQL_GRADED}"
_SQL_MESSAGE = """CASE code WHEN 'empty_text' THEN 'converted text is empty'
  WHEN 'very_short_text' THEN 'converted text is very short (' || non_space_chars || ' non-space chars)'
  WHEN 'replacement_characters' THEN 'converted text contains ' || replacement_char_count || ' replacement character(s)'
  WHEN 'very_long_lines' THEN 'converted text contains very long lines; table or paragraph boundaries may be lost' ELSE code END"""


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "attachment_texts")
    measured = texts.select("text_path", *[c.alias(n) for n, c in quality.metrics(F.col("text")).items()]).withColumn("flags", quality.flags())
    return measured.withColumns({"score": quality.score(F.col("flags")), "status": quality.status(F.col("flags"))})


def quality_metrics(spark, sf_dir):
    """AGG-07..09: the counters of every converted text."""
    return _graded(spark, sf_dir).drop("flags", "score", "status")


def quality_status(spark, sf_dir):
    """AGG-07: flags, score and status of every converted text."""
    return _graded(spark, sf_dir).select("text_path", F.array_join("flags", ",").alias("flags"), "score", "status")


def _issues(spark, sf_dir):
    rows = _graded(spark, sf_dir).select("*", F.posexplode("flags").alias("flag_pos", "code"))
    return rows.withColumn("severity", F.when(F.col("status") == "fail", "error").otherwise("warn")).withColumn("message", quality.message(F.col("code"), F.col("non_space_chars"), F.col("replacement_char_count")))


def quality_issues(spark, sf_dir):
    """SNK-09, SCL-28: one row a flag."""
    return _issues(spark, sf_dir).select("text_path", "flag_pos", "code", "severity", "message")


def quality_status_counts(spark, sf_dir):
    """AGG-04: texts by status."""
    return _graded(spark, sf_dir).groupBy("status").agg(F.count("*").alias("many"))


def length_summary(spark, sf_dir):
    """AGG-05: count, least, median and greatest length."""
    return audit.length_summary(table(spark, sf_dir, "documents"), F.length(F.coalesce("text", F.lit(""))))


def length_summary_by_lang(spark, sf_dir):
    """AGG-05 by language."""
    docs = table(spark, sf_dir, "documents").withColumn("language", text.normalize_language(F.col("lang")))
    return audit.length_summary(docs, F.length(F.coalesce("text", F.lit(""))), "language")


def table_like_lines(spark, sf_dir):
    """FLT-07, AGG-08: the lines of attachment texts that look like rows of tables."""
    lines = table(spark, sf_dir, "attachment_texts").select("text_path", F.posexplode(text.text_lines(text.text_or_empty(F.col("text")))).alias("line_no", "line"))
    return lines.where(quality.is_table_line(F.col("line"))).select("text_path", "line_no", F.sha2("line", 256).alias("line_hash"))


def formula_hints(spark, sf_dir):
    """AGG-09: hints of formulas in attachment texts."""
    return table(spark, sf_dir, "attachment_texts").select("text_path", quality.formula_hint_count(text.text_or_empty(F.col("text"))).alias("hints")).where("hints > 0")


def _audited(spark, sf_dir):
    return audit.audited(table(spark, sf_dir, "attachments"), table(spark, sf_dir, "attachment_texts"))


def _titled(spark, sf_dir):
    """The issues of all attachments, with their documents' titles."""
    titles = table(spark, sf_dir, "rule_docs").groupBy(F.col("id").alias("document_id")).agg(F.min("title").alias("document_title"))
    return audit.issues(_audited(spark, sf_dir)).join(titles, "document_id", "left")


def fail_on_warn(spark, sf_dir):
    """FLT-10: the issues that reach the threshold ``warn``, as lines."""
    return audit.failures(audit.issues(_audited(spark, sf_dir)), "warn").select("ord", "flag_pos", "line")


def fail_on_error(spark, sf_dir):
    """FLT-10: the issues that reach the threshold ``error``, as lines."""
    return audit.failures(audit.issues(_audited(spark, sf_dir)), "error").select("ord", "flag_pos", "line")


def issue_rows(spark, sf_dir):
    """SNK-09: the issues with all fields of a recorded one."""
    return audit.issue_rows(_titled(spark, sf_dir))


def report_summary(spark, sf_dir):
    """AGG-01, SNK-05, SRT-03: the numbers of the report, a row each, and how many issues it lists."""
    done = _audited(spark, sf_dir)
    one = checkpoint(audit.report(table(spark, sf_dir, "rule_docs"), done, _titled(spark, sf_dir), F.lit("")))
    rows = [one.select(F.lit(m).alias("section"), F.explode(f"summary.{m}").alias("name", "many")) for m in ("attachment_status", "attachment_extensions", "quality_status")]
    single = [("converted_text_chars", n, F.col(f"summary.converted_text_chars.{n}")) for n in ("count", "min", "median", "max")]
    single += [("totals", n, F.col(f"summary.{n}")) for n in ("documents", "attachments")] + [("totals", "issues", F.size("issues"))]
    rows += [one.select(F.lit(section).alias("section"), F.lit(name).alias("name"), value.cast("long").alias("many")) for section, name, value in single]
    return functools.reduce(DataFrame.union, rows)


def audit_issues(spark, sf_dir):
    """AGG-01, JOI-04: the issues of all attachments against the texts at their paths."""
    done = audit.audited(table(spark, sf_dir, "attachments"), table(spark, sf_dir, "attachment_texts"))
    return audit.issues(done).select("document_id", "id", "ord", "flag_pos", "severity", "code", "message")


def audit_counts(spark, sf_dir):
    """AGG-02..04: attachments by status, extension and quality, in one pass."""
    return audit.counts(audit.audited(table(spark, sf_dir, "attachments"), table(spark, sf_dir, "attachment_texts")))


def report_json(spark, sf_dir):
    """AGG-01, SNK-05: the report as one JSON row."""
    one = audit.report(table(spark, sf_dir, "rule_docs"), _audited(spark, sf_dir), _titled(spark, sf_dir), F.lit("2026-01-01T00:00:00Z"))
    return one.select(F.to_json(F.struct("*")).alias("report"))


def content_hash(spark, sf_dir):
    """SCL-06: the digest of stripped bodies."""
    return table(spark, sf_dir, "rule_docs").select("id", text.hash_text(F.col("body")).alias("hash"), (text.hash_text(F.col("body")) == F.col("content_hash")).alias("recorded")).distinct()


def duplicate_hash_first_wins(spark, sf_dir):
    """DED-01: the first document of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.hash_text(F.col("text")).alias("hash"))
    return ordered.first_wins(docs, ["hash"], ["doc_id"]).select("doc_id", "hash")


def slug_names(spark, sf_dir):
    """SCL-01, SCL-02, SCL-18: names and folders made of titles."""
    docs = table(spark, sf_dir, "rule_docs")
    return docs.select("id", text.slug(F.col("title")).alias("slug"), bundle_dir(F.col("language"), F.lower("document_type"), F.col("title")).alias("folder")).distinct()


def language_normalized(spark, sf_dir):
    """SCL-04: documents by normal language."""
    return table(spark, sf_dir, "rule_docs").groupBy(text.normalize_language(F.col("language")).alias("language")).agg(F.count("*").alias("many"))


def tokens(spark, sf_dir):
    """SCL-23: the search tokens of evaluation items."""
    return table(spark, sf_dir, "eval_items").select("item_id", F.explode(text.tokens(F.col("text"))).alias("token"))


def token_counts(spark, sf_dir):
    """SCL-23: in how many titles each token occurs."""
    return table(spark, sf_dir, "attachments").select(F.explode(text.tokens(F.col("title"))).alias("token")).groupBy("token").agg(F.count("*").alias("many"))


def chunks(spark, sf_dir):
    """SCL-25: chunks of documents, packed by paragraphs."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk_no", "chunk"))
    return rows.select("doc_id", "chunk_no", F.length("chunk").alias("chars"), F.sha2("chunk", 256).alias("hash"))


def chunk_stats(spark, sf_dir):
    """SCL-25: how many chunks and characters each document gives at 400 characters a chunk."""
    parts = text.chunks(F.col("text"), 400)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(parts).alias("chunks"), F.aggregate(F.transform(parts, lambda c: F.length(c)), F.lit(0), lambda a, b: a + b).alias("chars"))


def strip_tags(spark, sf_dir):
    """HTM-04: bodies without tags, their entities as they are."""
    return table(spark, sf_dir, "rule_docs").select("id", F.sha2(text.collapse_space(html.without_tags(F.col("body"))), 256).alias("hash")).distinct()


def page_links(spark, sf_dir):
    """HTM-06, HTM-07: the links in attachment texts."""
    tags = F.regexp_extract_all(F.col("text"), F.lit(r"(?is)<a\b[^>]*>"), F.lit(0))
    return table(spark, sf_dir, "attachment_texts").select("text_path", F.posexplode(tags).alias("pos", "tag")).select("text_path", "pos", html.attribute(F.col("tag"), "href").alias("href"))


def html_to_markdown(spark, sf_dir):
    """HTM-01, HTM-02: Markdown of all bodies."""
    return table(spark, sf_dir, "rule_docs").select("id", html.html_to_markdown("body").alias("markdown")).distinct()


def orphan_texts(spark, sf_dir):
    """JOI-01: texts at paths that no attachment or document names."""
    files = table(spark, sf_dir, "attachment_texts").select(F.col("text_path").alias("rel_path"))
    named = integrity.referenced_paths((table(spark, sf_dir, "attachments"), "text_path"), (table(spark, sf_dir, "rule_docs"), "text_path"))
    return integrity.orphans(files, named)


def dangling_texts(spark, sf_dir):
    """JOI-03: attachments whose text path leads to no text."""
    files = table(spark, sf_dir, "attachment_texts").select(F.col("text_path").alias("rel_path"))
    return integrity.dangling(table(spark, sf_dir, "attachments"), "text_path", files).select("id", "ord", "text_path")


def referenced_union(spark, sf_dir):
    """JOI-02, SET-03: all paths that documents and attachments name."""
    docs, children = table(spark, sf_dir, "rule_docs"), table(spark, sf_dir, "attachments")
    return integrity.referenced_paths((docs, "raw_path"), (docs, "text_path"), (children, "raw_path"), (children, "text_path"))


def validate_rows(spark, sf_dir):
    """SNK-10: violated constraints of documents and attachments."""
    docs = table(spark, sf_dir, "rule_docs")
    paths = docs.select(F.col("id").alias("document_id"), F.col("path").alias("document_path")).distinct()
    children = table(spark, sf_dir, "attachments").join(paths, "document_id")
    return integrity.validate(docs, children).groupBy("message").agg(F.count("*").alias("many"))


def left_join_metadata(spark, sf_dir):
    """JOI-04, AGG-02: attachments by status and by whether there is a text."""
    done = audit.audited(table(spark, sf_dir, "attachments"), table(spark, sf_dir, "attachment_texts"))
    return done.groupBy(audit.state(F.col("status")).alias("status"), "route").agg(F.count("*").alias("many"))


def nest_unnest(spark, sf_dir):
    """JOI-06, SNK-08: attachments nested into documents in order, and taken out again."""
    children = table(spark, sf_dir, "attachments")
    back = ordered.nested(children, "document_id", "ord", ["id", "title"]).select("document_id", F.posexplode("children").alias("pos", "c"))
    return back.select("document_id", "pos", F.col("c.id").alias("id"), F.col("c.title").alias("title"))


def drop_excluded(spark, sf_dir):
    """FLT-11, AGG-12: how many attachments the policy removes, and from how many documents."""
    children = table(spark, sf_dir, "attachments")
    docs = table(spark, sf_dir, "rule_docs").groupBy(F.col("id").alias("document_id")).agg(F.min(F.lower("document_type")).alias("document_type"))
    return integrity.child_drop_counts(integrity.excluded_children(children.join(docs, "document_id"), full_text=True, past_rule=True))


def policy_exclusion(spark, sf_dir):
    """FLT-01..05: attachments that the policy excludes."""
    children = table(spark, sf_dir, "attachments")
    return children.where(policy.is_excluded(F.col("title"), F.col("file_name"), F.col("server_file"), F.col("id"))).select("id", "ord", "title")


def items_sorted_limited(spark, sf_dir):
    """SRT-01, LIM-01: the first hundred items, latest effective date first."""
    first = ordered.by_effective_date(ordered.limited(table(spark, sf_dir, "crawl_items"), 100))
    # The rows in their order, numbered as they come: what is numbered is the limit's hundred.
    return first.coalesce(1).select("id", "ord", "effective_date", F.monotonically_increasing_id().alias("place"))


def union_rules_notices(spark, sf_dir):
    """SET-01, FLT-09: rules and then notices."""
    items = table(spark, sf_dir, "crawl_items")
    both = ordered.collected_items(items.where("document_type = 'rule'"), items.where("document_type = 'notice'"))
    return both.select("id", "document_type", "ord")


def dedupe_items(spark, sf_dir):
    """DED-01: the first item of every type and id."""
    items = table(spark, sf_dir, "crawl_items")
    return ordered.first_wins(items, ["document_type", "id"], ["ord"]).select("document_type", "id", "ord", "title")


def dedupe_adjacent(spark, sf_dir):
    """SCL-27: lines that differ from the one before."""
    kept = text.drop_adjacent_repeats(F.split(F.coalesce("text", F.lit("")), "\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(kept).alias("lines"))


def unique_names(spark, sf_dir):
    """DED-04: file names made unique within a document, in order."""
    children = table(spark, sf_dir, "attachments").withColumn("name", F.concat(text.slug(F.col("title")), F.lit(".md")))
    return ordered.unique_names(children, "document_id", "ord", "name")


def normalize_date(spark, sf_dir):
    """SCL-05: dates written in one way."""
    return table(spark, sf_dir, "manifest_docs").select("effective_date", text.normalize_date(F.col("effective_date")).alias("date")).distinct()


def truncate_bytes(spark, sf_dir):
    """SCL-11, SCL-12: file names of at most 40 bytes."""
    return table(spark, sf_dir, "attachments").select("file_name", text.truncate_bytes(F.col("file_name"), 40).alias("short")).distinct()


def converted_stems(spark, sf_dir):
    """SCL-13..15: what converted attachments are named after."""
    return table(spark, sf_dir, "attachments").select("id", text.attachment_stem(F.col("title"), F.col("file_name"), F.col("id")).alias("stem")).distinct()


def extension_counts(spark, sf_dir):
    """AGG-03, SCL-17: attachments by extension."""
    return table(spark, sf_dir, "attachments").groupBy(audit.extension(F.col("file_name"), F.col("raw_path")).alias("extension")).agg(F.count("*").alias("many"))


def render(spark, sf_dir):
    """SNK-02, SCL-26: documents as files, by digest."""
    docs = table(spark, sf_dir, "rule_docs")
    return docs.select("id", F.sha2(render_markdown(docs), 256).alias("hash")).distinct()


def english_twins(spark, sf_dir):
    """JOI-07: Korean documents with their English twins."""
    docs = table(spark, sf_dir, "rule_docs")
    korean = docs.where(~F.col("id").endswith("-en")).select(F.col("id").alias("ko_id"), F.col("title").alias("ko_title")).distinct()
    english = docs.where(F.col("id").endswith("-en")).select(F.col("id").alias("en_id"), F.col("title").alias("en_title")).distinct()
    return korean.withColumn("en_id", ordered.exists_twin(F.col("ko_id"))).join(english, "en_id")


def latex(spark, sf_dir):
    """EQ-01..28: the equation scripts in attachment texts as LaTeX."""
    scripts = F.regexp_extract_all("text", F.lit(r"(?s)```hwp-equation\n(.*?)\n```"), F.lit(1))
    run = F.pandas_udf(lambda s: s.map(equation_to_latex), "string")
    return table(spark, sf_dir, "attachment_texts").select("text_path", F.posexplode(scripts).alias("pos", "script")).withColumn("latex", run("script"))


def convert_texts(spark, sf_dir):
    """CNV-01..03: texts taken as files and converted by their extension."""
    files = table(spark, sf_dir, "attachment_texts").select(F.col("text_path").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return converted(files).select("path", "extension", "size", "content_hash", "status", "error")


QUERIES = {
    f.__name__: f
    for f in (
        quality_metrics, quality_status, quality_issues, quality_status_counts, length_summary, length_summary_by_lang, table_like_lines, formula_hints, fail_on_warn, fail_on_error, issue_rows, report_summary, audit_issues, audit_counts, report_json,
        content_hash, duplicate_hash_first_wins, slug_names, language_normalized, tokens, token_counts, chunks, chunk_stats, strip_tags, page_links, html_to_markdown, orphan_texts, dangling_texts,
        referenced_union, validate_rows, left_join_metadata, nest_unnest, drop_excluded, policy_exclusion, items_sorted_limited, union_rules_notices, dedupe_items, dedupe_adjacent, unique_names,
        normalize_date, truncate_bytes, converted_stems, extension_counts, render, english_twins, latex, convert_texts,
    )
}

_SLUG = lambda c: f"coalesce(nullif(trim(regexp_replace(regexp_replace(translate(lower({_STRIP(c)}), '/\\ _.:', '------'), '[^0-9a-z가-힣-]', '', 'g'), '-+', '-', 'g'), '-'), ''), 'untitled')"
_LANG = lambda c: f"CASE WHEN replace(lower({_STRIP(f'coalesce({c}, {chr(39) * 2})')}), '_', '-') IN ('en', 'eng', 'english', 'en-us', 'en-gb') THEN 'en' ELSE 'ko' END"
_SUFFIX = lambda c: f"regexp_extract(regexp_extract({c}, '[^/]*$'), '[^.](\\.[^.]+)$', 1)"
_STATE = "coalesce(nullif(a.status, ''), 'pending')"
_ROUTE = f"""CASE WHEN {_STATE} = 'converted' AND coalesce(a.text_path, '') = '' THEN 'missing_text_path' WHEN {_STATE} = 'converted' AND s.k IS NULL THEN 'missing_converted_file'
  WHEN {_STATE} = 'converted' THEN 'inspected' WHEN {_STATE} = 'failed' THEN 'conversion_failed' ELSE 'conversion_pending' END"""
_SQL_AUDIT = f"""WITH {sql_metrics('attachment_texts', 'text_path', 'text')}, {_SQL_GRADED},
r AS (SELECT a.document_id, a.id, a.ord, a.text_path, a.error, a.title, {_STATE} AS state, a.file_name, a.raw_path, {_ROUTE} AS route, s.text_chars, s.flags, s.status AS st, s.non_space_chars, s.replacement_char_count
  FROM attachments a LEFT JOIN s ON s.k = nullif(a.text_path, '')),
q AS (SELECT r.*, CASE route WHEN 'inspected' THEN st WHEN 'conversion_pending' THEN 'pending' ELSE 'fail' END AS quality,
  coalesce(nullif(lower({_SUFFIX("coalesce(nullif(file_name, ''), raw_path, '')")}), ''), '(none)') AS extension FROM r)"""
_SQL_ISSUES = f"""{_SQL_AUDIT}, i AS (SELECT *, pos - 1 AS flag_pos, CASE WHEN route LIKE 'missing%' OR (route = 'inspected' AND quality = 'fail') THEN 'error' ELSE 'warn' END AS severity,
  CASE code WHEN 'missing_text_path' THEN 'converted attachment has no text_path' WHEN 'missing_converted_file' THEN 'missing converted text file ' || text_path WHEN 'conversion_failed' THEN coalesce(nullif(error, ''), 'attachment conversion failed')
  WHEN 'conversion_pending' THEN 'attachment has not been converted' ELSE {_SQL_MESSAGE} END AS message
  FROM (SELECT *, unnest(f) AS code, unnest(range(1, len(f) + 1)) AS pos FROM (SELECT *, CASE WHEN route = 'inspected' THEN flags ELSE [route] END AS f FROM q)))"""
_SQL_LINE = "severity || ': ' || code || ' ' || coalesce(document_id, '') || '/' || coalesce(id, '') || ': ' || message"
_CLEAN = lambda c: f"trim(trim(regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g'), ' '), ' ._-')"
_GENERIC = lambda c: f"(regexp_full_match(regexp_replace(lower({c}), '[^0-9a-z가-힣]', '', 'g'), '|download|attachment|file|[0-9]{{8,}}[0-9a-z]*'))"
_EXCLUDED = """(regexp_matches(x, 'filecd=(rea|gae|sin|jun)|(^|[-_/])(rea|gae|sin|jun)($|[-_.?/=&\\s])') OR trim(coalesce(title, '')) = '전문'
  OR regexp_matches(x, '개정이유|개정문|개정조문|개정지시문|신구조문|신ㆍ구조문|신·구조문|신・구조문|신구 조문|대비표'))"""
_EXCLUDED_TEXT = "lower(trim(concat_ws(' ', nullif(title, ''), nullif(file_name, ''), nullif(server_file, ''), nullif(id, ''))))"
_JSON = lambda c: f"""'"' || replace(replace(replace(coalesce({c}, ''), chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n') || '"'"""
_FRONT = " || chr(10) || ".join([f"'{c}: ' || {_JSON(c)}" for c in ("id", "title", "source_url", "document_type", "language", "collected_at", "content_hash")])
_FRONT += "".join(f" || CASE WHEN coalesce({c}, '') <> '' THEN chr(10) || '{c}: ' || {_JSON(c)} ELSE '' END" for c in ("category", "effective_date", "published_date", "source_id", "file_name", "raw_path", "text_path", "file_content_hash"))
_TOKENS = lambda key, body, source: f"""words AS (SELECT {key} AS k, unnest(regexp_extract_all(lower(coalesce({body}, '')), '[0-9a-z가-힣]+')) AS w, row_number() OVER () AS r FROM {source}),
grams AS (SELECT r, k, w AS token FROM words UNION ALL
  SELECT r, k, substr(w, i, n) FROM (SELECT r, k, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM words, (VALUES (2), (3)) v(n) WHERE regexp_matches(w, '^[가-힣]+$') AND length(w) >= n))"""  # noqa: E731
_PATH = lambda c: f"regexp_replace(regexp_replace(coalesce({c}, ''), '/+', '/', 'g'), '^(\\./)+', '')"

ORACLES = {
    "quality_metrics": f"{_SQL_TEXTS} SELECT k AS text_path, text_chars, non_space_chars, line_count, table_row_count, formula_hint_count, replacement_char_count, longest_line FROM s",
    "quality_status": f"{_SQL_TEXTS} SELECT k AS text_path, array_to_string(flags, ',') AS flags, score, status FROM s",
    "quality_issues": f"{_SQL_TEXTS} SELECT k AS text_path, pos - 1 AS flag_pos, code, CASE WHEN status = 'fail' THEN 'error' ELSE 'warn' END AS severity, {_SQL_MESSAGE} AS message FROM (SELECT *, unnest(flags) AS code, unnest(range(1, len(flags) + 1)) AS pos FROM s)",
    "quality_status_counts": f"{_SQL_TEXTS} SELECT status, count(*) AS many FROM s GROUP BY status",
    "length_summary": "SELECT count(*) AS count, coalesce(min(n), 0) AS min, coalesce(CAST(trunc(median(n)) AS BIGINT), 0) AS median, coalesce(max(n), 0) AS max FROM (SELECT length(coalesce(text, '')) AS n FROM documents)",
    "length_summary_by_lang": f"SELECT {_LANG('lang')} AS language, count(*) AS count, min(length(coalesce(text, ''))) AS min, CAST(trunc(median(length(coalesce(text, '')))) AS BIGINT) AS median, max(length(coalesce(text, ''))) AS max FROM documents GROUP BY 1",
    "formula_hints": f"{_SQL_TEXTS} SELECT k AS text_path, formula_hint_count AS hints FROM s WHERE formula_hint_count > 0",
    "fail_on_warn": f"{_SQL_ISSUES} SELECT ord, flag_pos, {_SQL_LINE} AS line FROM i",
    "fail_on_error": f"{_SQL_ISSUES} SELECT ord, flag_pos, {_SQL_LINE} AS line FROM i WHERE severity = 'error'",
    "issue_rows": f"{_SQL_ISSUES} SELECT severity, code, coalesce(document_id, '') AS document_id, coalesce(t, '') AS document_title, coalesce(i.id, '') AS attachment_id, coalesce(title, '') AS attachment_title, coalesce(file_name, '') AS file_name, coalesce(message, '') AS message FROM i LEFT JOIN (SELECT id AS did, min(title) AS t FROM rule_docs GROUP BY id) d ON d.did = i.document_id",
    "report_summary": f"""{_SQL_ISSUES}, n AS (SELECT text_chars FROM q WHERE route = 'inspected')
SELECT 'attachment_status' AS section, state AS name, count(*) AS many FROM q GROUP BY state UNION ALL SELECT 'attachment_extensions', extension, count(*) FROM q GROUP BY extension UNION ALL SELECT 'quality_status', quality, count(*) FROM q GROUP BY quality
UNION ALL SELECT 'totals', 'documents', count(*) FROM rule_docs UNION ALL SELECT 'totals', 'attachments', count(*) FROM attachments UNION ALL SELECT 'totals', 'issues', count(*) FROM i
UNION ALL SELECT 'converted_text_chars', 'count', count(*) FROM n UNION ALL SELECT 'converted_text_chars', 'min', coalesce(min(text_chars), 0) FROM n
UNION ALL SELECT 'converted_text_chars', 'median', coalesce(CAST(trunc(median(text_chars)) AS BIGINT), 0) FROM n UNION ALL SELECT 'converted_text_chars', 'max', coalesce(max(text_chars), 0) FROM n""",
    "converted_stems": f"SELECT DISTINCT id, CASE WHEN title <> '' AND NOT {_GENERIC('title')} THEN title WHEN own <> '' AND NOT {_GENERIC('own')} THEN own WHEN coalesce(id, '') <> '' THEN id ELSE 'attachment' END AS stem FROM (SELECT id, {_CLEAN('title')} AS title, {_CLEAN('left(base, length(base) - length(coalesce(ending, ' + chr(39) * 2 + ')))')} AS own FROM (SELECT id, title, regexp_extract(coalesce(file_name, ''), '[^/]*$') AS base, {_SUFFIX('file_name')} AS ending FROM attachments))",
    "truncate_bytes": f"SELECT DISTINCT file_name, CASE WHEN strlen(file_name) <= 40 THEN file_name ELSE coalesce(nullif(rtrim(left(stem, list_max(list_filter(range(0, length(stem) + 1), lambda n: strlen(left(stem, n)) <= greatest(1, 40 - strlen(ending))))), ' ._-'), ''), 'attachment') || ending END AS short FROM (SELECT file_name, ending, left(file_name, length(file_name) - length(ending)) AS stem FROM (SELECT file_name, coalesce({_SUFFIX('file_name')}, '') AS ending FROM attachments))",
    "table_like_lines": f"WITH {sql_metrics('attachment_texts', 'text_path', 'text')}, l AS (SELECT k AS text_path, unnest(lines) AS line, unnest(range(0, len(lines))) AS line_no FROM base) SELECT text_path, line_no, sha256(line) AS line_hash FROM l WHERE (SELECT table_row_count FROM (WITH {sql_metrics('(SELECT 1 AS one)', 'one', 'l.line')} SELECT table_row_count FROM m)) > 0",
    "audit_issues": f"{_SQL_ISSUES} SELECT document_id, id, ord, flag_pos, severity, code, message FROM i",
    "audit_counts": f"{_SQL_AUDIT} SELECT 'status' AS kind, state AS name, count(*) AS many FROM q GROUP BY state UNION ALL SELECT 'extension', extension, count(*) FROM q GROUP BY extension UNION ALL SELECT 'quality', quality, count(*) FROM q GROUP BY quality",
    "left_join_metadata": f"{_SQL_AUDIT} SELECT state AS status, route, count(*) AS many FROM q GROUP BY state, route",
    "content_hash": f"SELECT DISTINCT id, sha256({_STRIP('body')}) AS hash, sha256({_STRIP('body')}) = content_hash AS recorded FROM rule_docs",
    "duplicate_hash_first_wins": f"SELECT min(doc_id) AS doc_id, sha256({_STRIP('text')}) AS hash FROM documents GROUP BY 2",
    "slug_names": f"SELECT DISTINCT id, {_SLUG('title')} AS slug, {_LANG('language')} || CASE WHEN lower(document_type) = 'notice' THEN '/notices/' ELSE '/rules/' END || {_SLUG('title')} AS folder FROM rule_docs",
    "language_normalized": f"SELECT {_LANG('language')} AS language, count(*) AS many FROM rule_docs GROUP BY 1",
    "tokens": f"WITH {_TOKENS('item_id', 'text', 'eval_items')} SELECT DISTINCT k AS item_id, token FROM grams WHERE length(token) > 1 OR regexp_matches(token, '^[0-9a-z]$')",
    "token_counts": f"WITH numbered AS (SELECT row_number() OVER () AS n, title FROM attachments), {_TOKENS('n', 'title', 'numbered')} SELECT token, count(DISTINCT k) AS many FROM grams WHERE length(token) > 1 OR regexp_matches(token, '^[0-9a-z]$') GROUP BY token",
    "strip_tags": f"SELECT DISTINCT id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(body, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '{_WS}+', ' ', 'g'), ' ')) AS hash FROM rule_docs",
    "page_links": "SELECT text_path, pos - 1 AS pos, coalesce(nullif(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*\"([^\"]*)\"', 1), ''), regexp_extract(tag, '(?is)\\bhref\\s*=\\s*''([^'']*)''', 1)) AS href FROM (SELECT text_path, unnest(t) AS tag, unnest(range(1, len(t) + 1)) AS pos FROM (SELECT text_path, regexp_extract_all(text, '(?is)<a\\b[^>]*>') AS t FROM attachment_texts))",
    "orphan_texts": "SELECT text_path AS rel_path FROM attachment_texts WHERE text_path NOT IN (SELECT text_path FROM attachments WHERE text_path IS NOT NULL UNION SELECT text_path FROM rule_docs WHERE text_path IS NOT NULL)",
    "dangling_texts": "SELECT id, ord, text_path FROM attachments WHERE coalesce(text_path, '') <> '' AND text_path NOT IN (SELECT text_path FROM attachment_texts)",
    "referenced_union": " UNION ".join(f"SELECT {_PATH(c)} AS rel_path FROM {t} WHERE coalesce({c}, '') <> ''" for t in ("rule_docs", "attachments") for c in ("raw_path", "text_path")),
    "validate_rows": "SELECT message, count(*) AS many FROM ("
    + " UNION ALL ".join(f"SELECT path || ': {c} is required' AS message FROM rule_docs WHERE coalesce({c}, '') = ''" for c in ("id", "title", "source_url", "collected_at", "content_hash"))
    + " UNION ALL SELECT path || ': document_type must be rule or notice' FROM rule_docs WHERE coalesce(document_type, '') NOT IN ('rule', 'notice')"
    + " UNION ALL SELECT path || ': language must be ko or en' FROM rule_docs WHERE coalesce(language, '') NOT IN ('ko', 'en')"
    + " UNION ALL SELECT p.path || ': converted attachment ' || a.id || ' has no text_path' FROM attachments a JOIN (SELECT DISTINCT id, path FROM rule_docs) p ON a.document_id = p.id WHERE a.status = 'converted' AND coalesce(a.text_path, '') = ''"
    + " UNION ALL SELECT p.path || ': failed attachment ' || a.id || ' must not expose text_path' FROM attachments a JOIN (SELECT DISTINCT id, path FROM rule_docs) p ON a.document_id = p.id WHERE a.status = 'failed' AND coalesce(a.text_path, '') <> '') GROUP BY message",
    "nest_unnest": "SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY ord NULLS FIRST, id NULLS FIRST, title NULLS FIRST) - 1 AS pos, id, title FROM attachments",
    "drop_excluded": f"""SELECT CAST(coalesce(sum(gone), 0) AS BIGINT) AS removed, CAST(count_if(gone > 0) AS BIGINT) AS changed FROM (SELECT d.document_id, d.document_type, count_if(CASE WHEN d.document_type = 'rule' THEN {_EXCLUDED}
  ELSE regexp_matches(x, 'filecd=jun|(^|[-_/])jun($|[-_.?/=&\\s])') OR trim(coalesce(title, '')) = '전문' END) AS gone
  FROM (SELECT *, {_EXCLUDED_TEXT} AS x FROM attachments) a JOIN (SELECT DISTINCT id AS document_id, lower(document_type) AS document_type FROM rule_docs) d ON a.document_id = d.document_id GROUP BY 1, 2)""",
    "policy_exclusion": f"SELECT id, ord, title FROM (SELECT *, {_EXCLUDED_TEXT} AS x FROM attachments) WHERE {_EXCLUDED}",
    "items_sorted_limited": "SELECT id, ord, effective_date, row_number() OVER (ORDER BY coalesce(effective_date, '') DESC, ord) - 1 AS place FROM (SELECT * FROM crawl_items ORDER BY ord LIMIT 100)",
    "union_rules_notices": "SELECT id, document_type, ord + CASE WHEN document_type = 'notice' THEN 1099511627776 ELSE 0 END AS ord FROM crawl_items WHERE document_type IN ('rule', 'notice')",
    "dedupe_items": "SELECT document_type, id, ord, title FROM crawl_items QUALIFY row_number() OVER (PARTITION BY document_type, id ORDER BY ord) = 1",
    "dedupe_adjacent": "SELECT doc_id, len(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1])) AS lines FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)",
    "normalize_date": "SELECT DISTINCT effective_date, CASE WHEN y = '' THEN '' ELSE y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') END AS date FROM (SELECT effective_date, "
    + ", ".join(f"coalesce(regexp_extract(effective_date, '([0-9]{{4}})\\s*[./-]\\s*([0-9]{{1,2}})\\s*[./-]\\s*([0-9]{{1,2}})', {i}), '') AS {c}" for i, c in ((1, "y"), (2, "m"), (3, "d")))
    + " FROM manifest_docs)",
    "extension_counts": f"SELECT coalesce(nullif(lower({_SUFFIX(chr(99) + 'oalesce(nullif(file_name, ' + chr(39) * 2 + '), raw_path, ' + chr(39) * 2 + ')')}), ''), '(none)') AS extension, count(*) AS many FROM attachments GROUP BY 1",
    "render": f"SELECT DISTINCT id, sha256('---' || chr(10) || {_FRONT} || chr(10) || '---' || chr(10) || chr(10) || {_STRIP('body')} || chr(10)) AS hash FROM rule_docs",
    "english_twins": "SELECT DISTINCT k.id AS ko_id, k.title AS ko_title, e.id AS en_id, e.title AS en_title FROM rule_docs k JOIN rule_docs e ON e.id = k.id || '-en'",
}
