"""The command line: ``sync``, ``validate``, ``quality``, ``clean``. Exit codes: 0 fine, 1 violations or a
threshold reached, 2 nothing to clean."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.cluster import checkpoint, ship
from corpusloom.operators import audit, integrity
from corpusloom.plans import pipeline
from corpusloom.sources.corpus import load_documents, load_files, write_documents


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusloom")
    commands = parser.add_subparsers(dest="command", required=True)
    # The names of commands, options and choices are the interface.
    data = os.getenv("CORPUS_DATA_DIR", "data")
    sync = commands.add_parser("sync", help="collect documents from the saved answers of a portal")
    sync.add_argument("--replay-dir", default=os.getenv("CORPUS_REPLAY_DIR", "replay"))
    sync.add_argument("--base-url", default="")
    sync.add_argument("--limit", type=int, default=0)
    sync.add_argument("--rule-id", default="")
    sync.add_argument("--recent-only", action="store_true")
    sync.add_argument("--download-attachments", action="store_true")
    sync.add_argument("--language", choices=("all", "ko", "en"), default=os.getenv("CORPUS_LANGUAGE", "all"))
    sync.add_argument("--all", action="store_true")
    validate = commands.add_parser("validate", help="check documents, attachments and their files")
    validate.add_argument("--quality", action="store_true")
    quality = commands.add_parser("quality", help="audit converted texts")
    quality.add_argument("--output", default=os.getenv("CORPUS_REPORT", ""), help="where the report goes; reports/data-quality.json below the data unless given, - to show it")
    quality.add_argument("--update-metadata", action="store_true")
    quality.add_argument("--fail-on", choices=("none", "error", "warn"), default="none")
    clean = commands.add_parser("clean", help="remove attachments and files that are not wanted")
    clean.add_argument("--drop-professional-attachments", action="store_true")
    clean.add_argument("--drop-past-rule-attachments", action="store_true")
    clean.add_argument("--prune-unreferenced-attachments", action="store_true")
    clean.add_argument("--dry-run", action="store_true")
    for command in (sync, validate, quality, clean):
        command.add_argument("--data-dir", default=data)
    return parser


def _show(lines: DataFrame, column: str) -> int:
    many = 0
    for row in lines.select(column).toLocalIterator():
        print(row[column], file=sys.stderr)
        many += 1
    return many


def _quality_lines(spark: SparkSession, root: str, fail_on: str) -> DataFrame:
    _, done = pipeline.corpus_audit(spark, root)
    return audit.failures(audit.issues(done), fail_on)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusloom").getOrCreate()
    ship(spark)
    root = os.path.abspath(args.data_dir)
    if args.command == "sync":
        done = pipeline.sync(
            spark, os.path.abspath(args.replay_dir), root, args.base_url, args.download_attachments or args.all,
            limit=0 if args.all else args.limit, rule_id=args.rule_id, recent_only=args.recent_only, language=args.language,
        )
        pipeline.write_manifest(load_documents(spark, root), root, args.base_url)
        print(f"{done['documents']} of {done['items']} items collected")
        return 0
    if args.command == "validate":
        documents = load_documents(spark, root)
        errors = _show(integrity.validate(documents, pipeline.children(documents), load_files(spark, root)), "message")
        if args.quality:
            errors += _show(_quality_lines(spark, root, "error"), "line")
        print(f"{errors} errors")
        return int(errors > 0)
    if args.command == "quality":
        documents, done = pipeline.corpus_audit(spark, root)
        done = checkpoint(done)
        found = audit.issues(done)
        text = audit.report(documents, done, found).select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("r")).first()["r"]
        output = args.output or os.path.join(root, "reports", "data-quality.json")
        if output != "-":
            os.makedirs(os.path.dirname(os.path.abspath(output)), exist_ok=True)
            with open(output, "w", encoding="utf-8") as file:
                file.write(text + "\n")
        else:
            print(text)
        if args.update_metadata:
            updated = checkpoint(audit.written_back(documents, done))
            write_documents(updated, root)
            pipeline.write_manifest(updated, root)
        return int(_show(audit.failures(found, args.fail_on), "line") > 0)
    actions = 0
    for wanted, run in (
        (args.drop_professional_attachments, lambda: pipeline.drop(spark, root, args.dry_run, full_text=True)),
        (args.drop_past_rule_attachments, lambda: pipeline.drop(spark, root, args.dry_run, past_rule=True)),
        (args.prune_unreferenced_attachments, lambda: pipeline.prune(spark, root, args.dry_run)),
    ):
        if wanted:
            actions += 1
            print(", ".join(f"{k} {v}" for k, v in run().items()))
    return 0 if actions else 2
