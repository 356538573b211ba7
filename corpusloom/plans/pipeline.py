"""The commands' pipelines: ingest, audit with write-back, cleaning, manifests."""

from __future__ import annotations

import datetime
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schema
from corpusloom.cluster import checkpoint
from corpusloom.convert import converted
from corpusloom.functions import pages
from corpusloom.functions.text import attachment_stem, hash_text, slug, strip, suffix, truncate_bytes
from corpusloom.operators import audit, integrity, ordered
from corpusloom.sources.corpus import bundle_dir, load_documents, load_files, write_documents
from corpusloom.sources.portal import PortalReplay

VERSION = "0.1.0"
#: How many bytes a raw and a converted name may have.
RAW_BYTES, TEXT_BYTES = 180, 160


def items(spark: SparkSession, replay: str, limit: int = 0, rule_id: str = "", recent_only: bool = False, language: str = "all") -> DataFrame:
    """What to collect, in order: one rule, the recent items, or all rules and then recent notices."""
    spark.dataSource.register(PortalReplay)
    if rule_id:
        one = [(rule_id, rule_id, "rule", "", rule_id, "N", "", "", "", "", 0)]
        return spark.createDataFrame(one, schema.ITEM)
    load = lambda what: spark.read.format("portal_replay").option("what", what).option("limit", str(limit)).load(replay)
    recent = pages.recent_items(load("pages").where("document_type = 'home'"))
    rules = load("items")
    # The tree's limit comes before the order by date, the limit of all items after both.
    # Latest first, then in the tree's order: one number a rule, without a window over all.
    part = lambda i: F.coalesce(F.try_element_at(F.split("effective_date", "-"), F.lit(i)).try_cast("int"), F.lit(0))
    day = F.greatest(F.lit(0), F.least(F.lit((1 << 16) - 1), (part(1) - 1900) * 372 + part(2) * 31 + part(3)))
    ranked = rules.withColumn("ord", ((1 << 16) - 1 - day).cast("long") * (1 << 24) + F.col("ord"))
    chosen = ordered.collected_items(ranked, recent.where("document_type = 'notice'") if language in ("all", "ko") else recent.limit(0), language, recent if recent_only else None)
    return ordered.first_wins(ordered.limited(chosen, limit), ["document_type", "id"], ["ord"])


def sync(spark: SparkSession, replay: str, root: str, base_url: str = "", download: bool = False, **choice) -> dict[str, int]:
    """Documents of the chosen items from their saved pages, written as bundles, with their attachments.

    A page that is not there leaves its item out; a file that is not there, is no file or cannot be
    converted is a failed attachment with its reason. Rules whose English text is there and can be
    converted get an English twin, unless only Korean is wanted; with only English, nothing else is written.
    """
    language = choice.get("language", "all") or "all"
    chosen = checkpoint(items(spark, replay, **choice))
    saved = spark.read.format("portal_replay").option("what", "pages").load(replay)
    found = chosen.join(saved.select("document_type", "id", "html"), ["document_type", "id"])
    rules, notices = found.where("document_type = 'rule'"), found.where("document_type = 'notice'")
    documents = pages.rule_documents(rules, base_url).unionByName(pages.notice_documents(notices, base_url), allowMissingColumns=True)
    attachments = pages.rule_attachments(rules, "id").unionByName(pages.notice_attachments(notices, "id"))
    named = attachments.join(documents.select(F.col("id").alias("document_id"), bundle_dir(F.lit("ko"), F.col("document_type"), F.col("title")).alias("folder_path")), "document_id")
    kept = _download(spark, replay, root, named) if download else named
    fields = [F.col(f.name) if f.name in kept.columns else F.lit("" if f.dataType.simpleString() == "string" else 0).cast(f.dataType).alias(f.name) for f in schema.ATTACHMENT.fields]
    listed = kept.select("document_id", "pos", F.struct(*fields).alias("a")).groupBy("document_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "a"))), lambda p: p["a"]).alias("attachments"))
    stamped = documents.withColumn("collected_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).withColumn("language", F.lit("ko"))
    joined = stamped.join(listed.withColumnRenamed("document_id", "id"), "id", "left").withColumn("attachments", F.coalesce("attachments", F.array().cast(schema.DOCUMENT["attachments"].dataType)))
    for field in schema.DOCUMENT.fields:
        if field.name not in joined.columns:
            joined = joined.withColumn(field.name, F.lit(""))
    whole = checkpoint(joined.select(*[f.name for f in schema.DOCUMENT.fields]))
    written = 0 if language == "en" else write_documents(whole, root)
    if language != "ko":
        written += write_documents(_english(spark, replay, root, whole.where("document_type = 'rule'")), root)
    return {"items": chosen.count(), "documents": written}


def _english(spark: SparkSession, replay: str, root: str, rules: DataFrame) -> DataFrame:
    """English twins of rules, of saved English files that can be converted; their files are written."""
    files = spark.read.format("portal_replay").option("what", "english").load(replay).withColumnRenamed("id", "source_id").withColumnRenamed("file_name", "english_name")
    own = strip(F.left("english_name", F.length("english_name") - F.length(suffix(F.col("english_name")))))
    twins = rules.drop("file_name", "raw_path", "text_path", "content_hash", "attachments", "body", "source_id", "path").withColumnRenamed("id", "source_id").join(files, "source_id")
    titled = twins.withColumns({"id": ordered.exists_twin(F.col("source_id")), "title": F.coalesce(F.nullif(own, F.lit("")), F.concat("title", F.lit(" (English)"))), "language": F.lit("en"), "document_type": F.lit("rule"), "file_name": F.col("english_name")})
    # The file is an attachment titled so; its name follows the rule of attachments.
    stem = slug(attachment_stem(F.lit("English full text"), F.col("english_name"), F.col("id")))
    folder = bundle_dir(F.lit("en"), F.lit("rule"), F.col("title"))
    placed = titled.withColumns({
        "raw_path": F.concat_ws("/", folder, F.lit("raw"), truncate_bytes(F.concat(stem, F.coalesce(F.nullif(suffix(F.col("english_name")), F.lit("")), F.lit(".bin"))), RAW_BYTES)),
        "text_path": F.concat_ws("/", folder, F.lit("attachments"), truncate_bytes(F.concat(stem, F.lit(".md")), TEXT_BYTES)),
    })
    done = checkpoint(converted(placed, path="raw_path").where("status = 'converted'"))
    _write_files(done.select(F.col("raw_path").alias("path"), "content"), root)
    _write_files(done.select(F.col("text_path").alias("path"), F.encode("text", "UTF-8").alias("content")), root)
    filled = done.withColumns({"body": strip(F.col("text")), "file_content_hash": F.col("content_hash"), "attachments": F.array().cast(schema.DOCUMENT["attachments"].dataType), "path": F.lit("")})
    return filled.withColumn("content_hash", hash_text(F.concat("title", F.lit("\n"), "body"))).select(*[f.name for f in schema.DOCUMENT.fields])


def _download(spark: SparkSession, replay: str, root: str, named: DataFrame) -> DataFrame:
    """Attachments with their files written and converted: names are unique within a document."""
    stem = attachment_stem(F.col("title"), F.col("file_name"), F.col("id"))
    ending = F.coalesce(F.nullif(suffix(F.col("file_name")), F.lit("")), F.nullif(suffix(F.col("server_file")), F.lit("")), F.lit(".bin"))
    proposed = named.withColumn("raw_name", truncate_bytes(F.concat(slug(stem), ending), RAW_BYTES)).withColumn("text_name", truncate_bytes(F.concat(slug(stem), F.lit(".md")), TEXT_BYTES))
    raw = ordered.unique_names(proposed, "document_id", "pos", "raw_name", RAW_BYTES).select("document_id", "pos", F.col("unique_name").alias("raw_unique"))
    text = ordered.unique_names(proposed, "document_id", "pos", "text_name", TEXT_BYTES).select("document_id", "pos", F.col("unique_name").alias("text_unique"))
    paths = proposed.join(raw, ["document_id", "pos"]).join(text, ["document_id", "pos"])
    placed = paths.withColumn("raw_path", F.concat_ws("/", "folder_path", F.lit("raw"), "raw_unique")).withColumn("text_path", F.concat_ws("/", "folder_path", F.lit("attachments"), "text_unique"))
    files = spark.read.format("portal_replay").option("what", "files").load(replay)
    with_file = placed.drop("status").join(files, "server_file", "left")
    refused = F.when(F.col("content").isNull(), "the file was not found").otherwise(pages.download_error(F.col("file_name"), F.col("content")))
    done = converted(with_file.withColumn("refused", refused), path="raw_path").withColumn("status", F.when(F.col("refused").isNotNull(), "failed").otherwise(F.col("status"))).withColumn("error", F.coalesce("refused", "error"))
    written = checkpoint(done)
    _write_files(written.where("status = 'converted'").select(F.col("raw_path").alias("path"), "content"), root)
    _write_files(written.where("status = 'converted'").select(F.col("text_path").alias("path"), F.encode("text", "UTF-8").alias("content")), root)
    return written.withColumn("text_path", F.when(F.col("status") == "converted", F.col("text_path")).otherwise("")).withColumn("raw_path", F.when(F.col("refused").isNull(), F.col("raw_path")).otherwise("")).drop("content", "text")


def _write_files(files: DataFrame, root: str) -> None:
    """Write files below a folder that all executors share; a repeated task leaves the same files."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                target = os.path.join(root, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(f"{target}.{os.getpid()}", "wb") as file:
                    file.write(content)
                os.replace(f"{target}.{os.getpid()}", target)
            yield pd.DataFrame({"n": [len(batch)]})

    files.mapInPandas(write, "n long").count()


def children(documents: DataFrame) -> DataFrame:
    """The attachments of documents, with ``document_id``, ``document_path`` and ``pos``."""
    rows = documents.select(F.col("id").alias("document_id"), F.col("title").alias("document_title"), F.col("path").alias("document_path"), F.posexplode("attachments").alias("pos", "a"))
    return rows.select("document_id", "document_title", "document_path", "pos", "a.*")


def corpus_audit(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(documents, audit) of a corpus on disk, with the hints of its raw files."""
    from corpusloom.convert import file_hints

    documents = load_documents(spark, root)
    files = load_files(spark, root, content=True)
    texts = files.where(F.col("rel_path").rlike("(^|/)attachments/")).select(F.col("rel_path").alias("text_path"), F.decode("content", "UTF-8").alias("text"))
    hint = F.pandas_udf(lambda path, data: pd.DataFrame([file_hints(os.path.splitext(p)[1].lower(), d) for p, d in zip(path, data, strict=True)], columns=["t", "f"]), "t int, f int")
    hints = files.where(F.col("rel_path").rlike("(?i)/raw/.*\\.hwpx?$")).select(F.col("rel_path").alias("raw_path"), hint("rel_path", "content").alias("h")).select("raw_path", F.col("h.t").alias("raw_tables"), F.col("h.f").alias("raw_formulas"))
    return documents, audit.audited(children(documents), texts, hints)


def write_manifest(documents: DataFrame, root: str, source: str | None = None) -> None:
    """The manifest of a corpus as one JSON file; version and source of an older one stay.

    The file is the interface of a corpus of documents, whose rows come to the driver one at a time.
    """
    path, old = os.path.join(root, "manifest.json"), {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as file:
            old = json.load(file)
    now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = {"version": old.get("version", VERSION), "generated_at": now, "source": source if source is not None else old.get("source", "")}
    body = documents.drop("body").select(F.to_json(F.struct("*")).alias("d"), F.col("attachments"))
    log = documents.select(F.explode("attachments").alias("a")).select(F.to_json("a").alias("a"))
    with open(path + ".new", "w", encoding="utf-8") as out:
        out.write(json.dumps(head, ensure_ascii=False)[:-1] + ', "documents": [\n')
        for i, row in enumerate(body.select("d").toLocalIterator()):
            out.write((",\n" if i else "") + row["d"])
        out.write('\n], "attachment_log": [\n')
        for i, row in enumerate(log.toLocalIterator()):
            out.write((",\n" if i else "") + row["a"])
        out.write("\n]}\n")
    os.replace(path + ".new", path)


def prune(spark: SparkSession, root: str, dry_run: bool = False) -> dict[str, int]:
    """Files that no document refers to are deleted, and folders that this empties; or only counted."""
    documents = load_documents(spark, root)
    attachments = children(documents)
    named = integrity.referenced_paths((documents, "raw_path"), (documents, "text_path"), (attachments, "raw_path"), (attachments, "text_path"))
    files = load_files(spark, root)
    lost = checkpoint(integrity.orphans(files, named).select("rel_path"))
    counted = {"scanned": files.count(), "removed": lost.count()}
    if not dry_run:
        for row in lost.orderBy(F.desc("rel_path")).toLocalIterator():
            target = os.path.join(root, row["rel_path"])
            os.remove(target)
            folder = os.path.dirname(target)
            if not os.listdir(folder):
                os.rmdir(folder)
    return counted


def drop(spark: SparkSession, root: str, dry_run: bool = False, **policy: bool) -> dict[str, int]:
    """Excluded attachments are taken out of their documents, which are rewritten; or only counted."""
    documents = checkpoint(integrity.drop_attachments(load_documents(spark, root), **policy))
    counted = integrity.drop_counts(documents).first()
    if counted["changed"] and not dry_run:
        write_documents(documents.where("removed > 0").drop("removed"), root)
        write_manifest(documents.drop("removed"), root)
    return {"removed": counted["removed"], "changed": counted["changed"]}


