"""Session plumbing shared by all operators: tables, shared checkpoints, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` in the folder that all executors share.

    The cluster names it in ``spark.checkpoint.dir``; a folder of our own is set only where that is
    unset and all runs in one process, as in tests; on a cluster that is an error. The data is written to files, so it survives the loss of an executor.
    """
    spark = df.sparkSession
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix=f"checkpoint-{os.getpid()}-"))
    return df.checkpoint(eager)


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = 1 << 28) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if it is proven to hold at most ``max_rows`` rows and ``max_bytes``, and whether it does.

    The proof looks at no more than ``max_rows + 1`` rows, so it costs little on a large table. Numbers
    count 8 bytes, texts their own.
    """
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in df.dtypes]
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0))).first()
    small = rows <= max_rows and size <= max_bytes
    return (F.broadcast(df) if small else df), small


@contextmanager
def with_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run within; the one before is restored. It may steer plans only, not results."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once an application, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}-{os.getpid()}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
