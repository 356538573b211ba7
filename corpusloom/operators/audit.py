"""The audit of a corpus: routes, metrics, issues, counts, report, and its write-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import schema
from corpusloom.functions import quality
from corpusloom.functions.text import suffix, text_lines, text_or_empty

REPORT_VERSION = "0.1.0"


def state(value: Column) -> Column:
    """An attachment's status; empty and missing are ``pending``."""
    return F.coalesce(F.nullif(text_or_empty(value), F.lit("")), F.lit("pending"))


def extension(file_name: Column, raw_path: Column) -> Column:
    """The extension an attachment is counted under: of its file name, else of its raw path, else ``(none)``."""
    own = F.coalesce(F.nullif(text_or_empty(file_name), F.lit("")), text_or_empty(raw_path))
    return F.coalesce(F.nullif(F.lower(suffix(own)), F.lit("")), F.lit("(none)"))


def audited(attachments: DataFrame, texts: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """``attachments`` with ``route``, the counters of their present text, ``flags``, ``score`` and ``quality``.

    ``texts`` has unique ``text_path`` and ``text``; ``hints`` unique ``raw_path``, ``raw_tables`` and
    ``raw_formulas``. Every text is measured once, before it is joined, and only its counters move.
    Converted attachments are inspected; those without a path or text fail; failed and other ones are
    not inspected and have zero counters.
    """
    cut = texts.where(F.col("text_path").isNotNull()).select("text_path", "text", text_lines(text_or_empty(F.col("text"))).alias("__lines"))
    measured = cut.select("text_path", F.lit(True).alias("__found"), *[c.alias(n) for n, c in quality.metrics(F.col("text"), F.col("__lines")).items()])
    names = [c for c in measured.columns if not c.startswith("__") and c != "text_path"]
    clean = attachments.drop(*[c for c in attachments.columns if c in (*names, "flags", "score", "quality", "route")])
    joined = clean.withColumn("__path", F.nullif(text_or_empty(F.col("text_path")), F.lit(""))).join(measured.withColumnRenamed("text_path", "__path"), "__path", "left")
    if hints is not None:
        own = hints.select(F.col("raw_path").alias("__raw"), "raw_tables", "raw_formulas")
        joined = joined.join(own, joined["raw_path"] == F.col("__raw"), "left").drop("__raw")
        raw = (F.coalesce("raw_tables", F.lit(0)), F.coalesce("raw_formulas", F.lit(0)))
    else:
        raw = (F.lit(0), F.lit(0))
    status = state(F.col("status"))
    route = (
        F.when((status == "converted") & F.col("__path").isNull(), "missing_text_path")
        .when((status == "converted") & F.col("__found").isNull(), "missing_converted_file")
        .when(status == "converted", "inspected")
        .when(status == "failed", "conversion_failed")
        .otherwise("conversion_pending")
    )
    routed = joined.withColumn("route", route)
    inspected = F.col("route") == "inspected"
    counted = routed.withColumns({n: F.when(inspected, F.col(n)).otherwise(F.lit(0)).cast("long") for n in names})
    flagged = counted.withColumn("flags", F.when(inspected, quality.flags(*raw)).otherwise(F.array("route")))
    graded = F.when(inspected, quality.status(F.col("flags"))).when(F.col("route") == "conversion_pending", "pending").otherwise("fail")
    return flagged.withColumn("score", F.when(inspected, quality.score(F.col("flags"))).otherwise(0)).withColumn("quality", graded).drop("__path", "__found")


def issues(audit: DataFrame) -> DataFrame:
    """One row a flag of each audited attachment: severity, code, message, with the attachment's columns.

    Inspected texts are errors only if they are empty; missing paths and texts are errors; conversions
    that failed or are pending are warnings.
    """
    route = F.col("route")
    rows = audit.select("*", F.posexplode("flags").alias("flag_pos", "code"))
    severity = F.when(route.isin("missing_text_path", "missing_converted_file") | ((route == "inspected") & (F.col("quality") == "fail")), "error").otherwise("warn")
    message = (
        F.when(F.col("code") == "missing_text_path", "converted attachment has no text_path")
        .when(F.col("code") == "missing_converted_file", F.concat(F.lit("missing converted text file "), F.col("text_path")))
        .when(F.col("code") == "conversion_failed", F.coalesce(F.nullif(text_or_empty(F.col("error")), F.lit("")), F.lit("attachment conversion failed")))
        .when(F.col("code") == "conversion_pending", "attachment has not been converted")
        .otherwise(quality.message(F.col("code"), F.col("non_space_chars"), F.col("replacement_char_count")))
    )
    return rows.withColumn("severity", severity).withColumn("message", message)


def issue_rows(found: DataFrame) -> DataFrame:
    """Issues as they are listed, with the fields of ``schema.ISSUE``; ``found`` has ``document_title`` and an attachment's columns."""
    given = {"attachment_id": F.col("id"), "attachment_title": F.col("title")}
    return found.select(*[text_or_empty(given.get(f.name, F.col(f.name))).alias(f.name) for f in schema.ISSUE.fields])


def failures(found: DataFrame, fail_on: str) -> DataFrame:
    """Issues that reach a threshold (``none``, ``error``, ``warn``), each with a ``line`` to show.

    ``found`` has ``document_id`` and an attachment's ``id``.
    """
    severities = {"none": [], "error": ["error"], "warn": ["error", "warn"]}[fail_on]
    line = F.format_string("%s: %s %s/%s: %s", "severity", "code", text_or_empty(F.col("document_id")), text_or_empty(F.col("id")), "message")
    return found.where(F.col("severity").isin(severities) if severities else F.lit(False)).withColumn("line", line)


def counts(audit: DataFrame) -> DataFrame:
    """(``kind``, ``name``, ``many``): attachments by status, extension and quality, in one pass."""
    rows = audit.select(state(F.col("status")).alias("status"), extension(F.col("file_name"), F.col("raw_path")).alias("extension"), F.col("quality"))
    grouped = rows.groupingSets([["status"], ["extension"], ["quality"]], "status", "extension", "quality").agg(F.grouping_id().alias("g"), F.count("*").alias("many"))
    kind = F.when(F.col("g") == 3, "status").when(F.col("g") == 5, "extension").otherwise("quality")
    return grouped.select(kind.alias("kind"), F.coalesce("status", "extension", "quality").alias("name"), "many")


def length_summary(rows: DataFrame, length: Column, *by: str) -> DataFrame:
    """``count``, ``min``, ``median`` (cut to a whole number) and ``max`` of lengths, zeros if there are none."""
    value = rows.select(*by, length.alias("__n"))
    whole = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    return value.groupBy(*by).agg(F.count("__n").alias("count"), whole(F.min("__n")).alias("min"), whole(F.percentile("__n", F.lit(0.5))).alias("median"), whole(F.max("__n")).alias("max"))


def report(documents: DataFrame, audit: DataFrame, found: DataFrame, generated_at: Column | None = None, max_issues: int = 1_000_000) -> DataFrame:
    """The report as one row: counts as maps, the length summary, and the issues as one array.

    One row is the report's form, so its issues are refused beyond ``max_issues``; ``issue_rows`` has them
    all, a row each. ``found`` has ``document_title``.
    """
    fields = [f.name for f in schema.ISSUE.fields]
    by_kind = counts(audit).groupBy("kind").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "many")))).alias("m"))
    maps = by_kind.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("kind", "m"))).alias("maps"))
    lengths = length_summary(audit.where("route = 'inspected'"), F.col("text_chars")).select(F.struct("count", "min", "median", "max").alias("converted_text_chars"))
    rows = found.select(F.struct(F.col("document_id"), F.col("id").alias("attachment_id"), F.col("flag_pos")).alias("o"), F.struct(*[text_or_empty({"attachment_id": F.col("id"), "attachment_title": F.col("title")}.get(n, F.col(n))).alias(n) for n in fields]).alias("i"))
    number = rows.limit(max_issues + 1).groupBy().agg(F.count("*").alias("n_issues"))
    listed = rows.limit(max_issues).groupBy().agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "i"))), lambda x: x["i"]).alias("issues"))
    totals = documents.groupBy().agg(F.count("*").alias("documents")).crossJoin(audit.groupBy().agg(F.count("*").alias("attachments")))
    one = totals.crossJoin(maps).crossJoin(lengths).crossJoin(number).crossJoin(listed)
    checked = F.when(F.col("n_issues") > max_issues, F.raise_error(F.lit("too many issues for one report")).cast("string")).otherwise(F.lit(REPORT_VERSION))
    part = lambda kind, name: F.coalesce(F.try_element_at("maps", F.lit(kind)), F.create_map().cast("map<string,bigint>")).alias(name)
    summary = F.struct("documents", "attachments", part("status", "attachment_status"), part("extension", "attachment_extensions"), part("quality", "quality_status"), "converted_text_chars")
    return one.select(checked.alias("version"), (now() if generated_at is None else generated_at).alias("generated_at"), summary.alias("summary"), "issues")


def now() -> Column:
    """The time of the query, as it is written in reports and documents."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def written_back(documents: DataFrame, audit: DataFrame) -> DataFrame:
    """``documents`` with their attachments' quality columns set from an audit that has ``document_id`` and
    ``pos``; attachments keep their order."""
    values = {
        "quality_status": F.col("quality"), "quality_score": F.col("score").cast("int"), "quality_flags": F.array_join("flags", ","), "converted_text_chars": F.col("text_chars"),
        "converted_non_space_chars": F.col("non_space_chars"), "table_row_count": F.col("table_row_count"), "formula_hint_count": F.col("formula_hint_count"), "replacement_char_count": F.col("replacement_char_count"),
    }
    fields = [f.name for f in documents.schema["attachments"].dataType.elementType.fields]
    nested = audit.select("document_id", F.struct("pos", F.struct(*[(values.get(n, F.col(n))).alias(n) for n in fields]).alias("a")).alias("p")).groupBy("document_id").agg(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["a"]).alias("__new"))
    joined = documents.join(nested, documents["id"] == nested["document_id"], "left").drop("document_id")
    return joined.withColumn("attachments", F.coalesce("__new", "attachments")).drop("__new")
