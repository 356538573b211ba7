"""Queries of the general data-processing operators (those that are not specific to training text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.cluster import table
from corpusloom.operators.snapshots import canonical_date, canonical_hash, snapshot_changes


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids added, removed or changed from each snapshot of ``manifest_docs`` to the next."""
    rows = table(spark, sf_dir, "manifest_docs")
    return snapshot_changes(rows, {"content_hash": canonical_hash, "effective_date": canonical_date})


QUERIES = {"p5_found": p5_found}

ORACLES = {
    "p5_found": r"""
WITH clean AS (
  SELECT snapshot_no, id, delivered_at,
         regexp_replace(lower(trim(coalesce(content_hash, ''))), '^[a-z0-9-]+:\s*', '') AS h,
         regexp_replace(trim(coalesce(effective_date, '')), '[-./]', '', 'g') AS e
  FROM manifest_docs WHERE id IS NOT NULL AND snapshot_no IS NOT NULL),
latest AS (
  SELECT snapshot_no, id, h, e FROM clean
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, id ORDER BY delivered_at DESC NULLS LAST, h DESC, e DESC) = 1),
steps AS (SELECT s AS prev, lead(s) OVER (ORDER BY s) AS next FROM (SELECT DISTINCT snapshot_no AS s FROM latest)),
old AS (SELECT t.next AS snapshot_no, l.id, l.h, l.e FROM latest l JOIN steps t ON l.snapshot_no = t.prev WHERE t.next IS NOT NULL),
new AS (SELECT l.* FROM latest l JOIN steps t ON l.snapshot_no = t.next)
SELECT coalesce(o.snapshot_no, n.snapshot_no) AS snapshot_no, coalesce(o.id, n.id) AS id,
       CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM old o FULL JOIN new n ON o.snapshot_no = n.snapshot_no AND o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL OR o.h <> n.h OR o.e <> n.e
""",
}
