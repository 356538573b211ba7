"""Bundles as a stream: documents are audited as their files arrive (an extension, no part of the model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import quality
from corpusloom.sources.corpus import parse_documents


def document_stream(spark: SparkSession, root: str, files_per_batch: int = 1_000) -> DataFrame:
    """Documents of bundles below ``root`` as they arrive, malformed ones with their reason."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "index.md").option("recursiveFileLookup", True).load(root)
    return parse_documents(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")), permissive=True)


def graded(documents: DataFrame) -> DataFrame:
    """The counters, flags, score and status of every document's body; needs no state."""
    measured = documents.select("id", "path", "malformed", *[c.alias(n) for n, c in quality.metrics(F.col("body")).items()]).withColumn("flags", quality.flags())
    return measured.withColumns({"score": quality.score(F.col("flags")), "status": quality.status(F.col("flags"))})
