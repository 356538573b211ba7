"""Queries of the training-text operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.cluster import table
from corpusloom.llm.alignment import align, sentence_pairs, twin_sentences
from corpusloom.llm.budget import normal_label, normal_language, token_budget
from corpusloom.llm.leakage import leaks
from corpusloom.llm.markup import analysed, fit, records
from corpusloom.llm.mojibake import garbled, restored
from corpusloom.llm.neardup import expand_pairs, near_duplicate_classes, near_duplicates
from corpusloom.llm.packing import pack
from corpusloom.llm.prose import COMMON_EN, COMMON_KO, not_prose, text_statistics
from corpusloom.llm.truncation import truncated, truncation_rates
from corpusloom.plans.reference import sql_metrics


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sentences that say the same in a Korean document and its English twin."""
    return sentence_pairs(align(twin_sentences(table(spark, sf_dir, "doc_sentences"))))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachment texts of which at least a passage was decoded with the wrong encoding."""
    return garbled(table(spark, sf_dir, "attachment_texts")).select("text_path").distinct()


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected attachment texts, restored as far as the corpus knows their words."""
    return restored(table(spark, sf_dir, "attachment_texts"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents whose bodies agree by at least 0.6 in three-word sequences."""
    links, members = near_duplicates(table(spark, sf_dir, "rule_docs"), "id", "body", shingle=3, threshold=0.6)
    return expand_pairs(links, members)


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class and the number of links of every document, at the same similarity."""
    return near_duplicate_classes(table(spark, sf_dir, "rule_docs"), "id", text="body", shingle=3, threshold=0.6)


def p4_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of ``rule_docs.body`` by board, language, document type and category."""
    slices = {
        "source_url": F.trim(F.coalesce("source_url", F.lit(""))),
        "language": normal_language(F.col("language")),
        "document_type": F.lower(F.trim(F.coalesce("document_type", F.lit("")))),
        "category": normal_label(F.col("category")),
    }
    return token_budget(table(spark, sf_dir, "rule_docs"), slices)


def p4_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents and characters of ``p4_token_budget``: all but the tokens, for a comparison in SQL."""
    return p4_token_budget(spark, sf_dir).drop("tokens")


def _marked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = records(table(spark, sf_dir, "rule_docs"), "id", "body", "document")
    return documents.unionByName(records(table(spark, sf_dir, "attachment_texts"), "text_path", "text", "attachment"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of markup in documents and attachment texts, of the operator that also scans and cleans them."""
    texts = _marked_records(spark, sf_dir)
    return analysed(texts, fit(texts)).select("record_kind", "record_key", F.explode("markup").alias("markup")).distinct()


def p6_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean text of every document and attachment text, with the kinds of markup found."""
    texts = _marked_records(spark, sf_dir)
    return analysed(texts, fit(texts)).withColumn("markup", F.array_join("markup", ","))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachment texts that are not natural prose."""
    return not_prose(table(spark, sf_dir, "attachment_texts")).select("text_path").distinct()


def p7_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters, statistics and failed rules of every attachment text."""
    stats = text_statistics(table(spark, sf_dir, "attachment_texts"))
    return stats.withColumn("failures", F.array_join("failures", ","))


def p7_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of ``p7_statistics`` that SQL can express, shares to six places."""
    stats = text_statistics(table(spark, sf_dir, "attachment_texts"))
    shares = ("mean_word_length", "hangul_share", "symbol_ratio", "bullet_line_share", "ellipsis_line_share", "punctuated_line_share", "letter_word_share")
    return stats.select("text_path", "non_space_chars", "table_row_count", "formula_hint_count", "words", "common_words", *[F.round(c, 6).alias(c) for c in shares])


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of 2,048 tokens at most for every document or piece of one."""
    return pack(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat at least half of an evaluation item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose last sentence is broken off."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return truncated(docs).where("truncated").select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source of ``documents`` cuts its texts off."""
    return truncation_rates(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_restored": p2_restored,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p4_token_budget": p4_token_budget,
    "p4_documents": p4_documents,
    "p6_found": p6_found,
    "p6_clean_text": p6_clean_text,
    "p7_found": p7_found,
    "p7_statistics": p7_statistics,
    "p7_counters": p7_counters,
    "p8_containers": p8_containers,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}

_WORDS = "list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '')"
_SHARE = lambda part, whole: f"round(CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0.0 END, 6)"
_LINES = lambda pattern: _SHARE(f"len(list_filter(lines, lambda l: regexp_matches(l, '{pattern}')))", "line_count")
_COMMON = ", ".join(f"'{w}'" for w in dict.fromkeys(COMMON_EN + COMMON_KO))
_MATCHES = lambda pattern: f"len(regexp_extract_all(t, '{pattern}'))"
_LETTERS = "len(list_filter(words, lambda w: regexp_matches(w, '\\p{L}')))"

ORACLES: dict[str, str] = {
    "p3_found": """WITH d AS (SELECT row_number() OVER () AS n, id, regexp_extract_all(lower(body), '[0-9a-z가-힣]+') AS w FROM (SELECT DISTINCT id, body FROM rule_docs WHERE id IS NOT NULL AND body IS NOT NULL)),
s AS (SELECT DISTINCT n, id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT n, id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
c AS (SELECT n, count(*) AS many FROM s GROUP BY n),
p AS (SELECT a.n AS na, b.n AS nb, a.id AS id_a, b.id AS id_b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.id < b.id GROUP BY ALL)
SELECT DISTINCT id_a, id_b FROM p JOIN c x ON x.n = na JOIN c y ON y.n = nb WHERE shared / (x.many + y.many - shared) >= 0.6""",
    "p4_documents": """SELECT source_url, language, document_type, category, count(*) AS documents, CAST(sum(length(body)) AS BIGINT) AS characters FROM (
  SELECT id, loaded_at, trim(coalesce(source_url, '')) AS source_url, CASE WHEN tag IN ('ko', 'kor', 'korean', 'kr') THEN 'ko' WHEN tag IN ('en', 'eng', 'english') THEN 'en' WHEN tag = '' THEN 'und' ELSE tag END AS language,
    lower(trim(coalesce(document_type, ''))) AS document_type, regexp_replace(trim(regexp_replace(coalesce(category, ''), '\\s+', ' ', 'g')), ' ?/ ?', ' / ', 'g') AS category, coalesce(body, '') AS body
  FROM (SELECT *, regexp_extract(lower(trim(coalesce(language, ''))), '^([a-z]+)', 1) AS tag FROM rule_docs)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, source_url DESC, language DESC, document_type DESC, category DESC) = 1) GROUP BY ALL""",
    "p7_counters": f"""WITH {sql_metrics('attachment_texts', 'text_path', 'text')}
SELECT k AS text_path, non_space_chars, table_row_count, formula_hint_count, len(words) AS words, len(list_filter(words, lambda w: trim(lower(w), '.,;:()“”"''') IN ({_COMMON}))) AS common_words,
  {_SHARE('non_space_chars', 'len(words)')} AS mean_word_length, {_SHARE(_MATCHES('[가-힣]'), 'non_space_chars')} AS hangul_share, {_SHARE(_MATCHES('#|[.][.][.]|…'), 'len(words)')} AS symbol_ratio,
  {_LINES('^[ \\t]*(?:[-*•●○■□▪※◦]|[①-⓿])')} AS bullet_line_share, {_LINES('(?:[.][.][.]|…)$')} AS ellipsis_line_share, {_LINES("[.!?。][\"''”’)\\]]*$")} AS punctuated_line_share,
  {_SHARE(_LETTERS, 'len(words)')} AS letter_word_share
FROM (SELECT m.*, {_WORDS} AS words FROM m)""",
}
