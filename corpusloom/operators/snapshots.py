"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_hash(value: Column) -> Column:
    """One way of writing a hex digest: trimmed, lower case, without an algorithm prefix; null is ``''``."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), r"^[a-z0-9-]+:\s*", "")


def canonical_date(value: Column) -> Column:
    """``YYYYMMDD`` of a date in any of the usual orders year-month-day; other text trimmed, null is ``''``."""
    text = F.trim(F.coalesce(value, F.lit("")))
    pattern = r"^(\d{4})\s*[-./]\s*(\d{1,2})\s*[-./]\s*(\d{1,2})"
    parts = [F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]
    split = F.concat(parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return F.when(text.rlike(pattern), split).otherwise(text)


def _merge(key: str, order: dict[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The merge of one key range; its rows come sorted by key and snapshot.

    A row's partner in the next snapshot can only be the row after it, so both pointers advance together.
    The last row of a batch waits for the first of the next one: one row is all the state there is.
    """
    last = max(order.values(), default=0)
    schema = pa.schema([("snapshot_no", pa.int32()), (key, pa.string()), ("change_kind", pa.string())])
    numbers = np.array(sorted(order), dtype=np.int64)

    def emit(rows: pa.Table, first: bool, final: bool) -> pa.RecordBatch | None:
        """Changes seen at rows 1.. (all rows if ``first``) and removals after rows ..-2 (all if ``final``)."""
        ids = rows.column(0).combine_chunks()
        step = np.searchsorted(numbers, rows.column(1).to_numpy())
        n = len(ids)
        same = np.zeros(n + 1, dtype=bool)  # same[i]: row i continues row i - 1 in the next snapshot
        differs = np.zeros(n, dtype=bool)
        if n > 1:
            before, after = rows.slice(0, n - 1), rows.slice(1)
            same[1:n] = pc.equal(ids.slice(0, n - 1), ids.slice(1)).to_numpy(zero_copy_only=False) & (step[1:] == step[:-1] + 1)
            for c in range(2, rows.num_columns):
                differs[1:] |= pc.not_equal(before.column(c), after.column(c)).to_numpy()
        fresh, ends = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        fresh[0], ends[-1] = first, final
        added = np.flatnonzero(fresh & ~same[:n] & (step > 0))
        changed = np.flatnonzero(same[:n] & differs)
        removed = np.flatnonzero(ends & ~same[1:] & (step < last))
        where = np.concatenate([added, changed, removed])
        if not len(where):
            return None
        at = np.concatenate([step[added], step[changed], step[removed] + 1])
        kinds = ["added"] * len(added) + ["changed"] * len(changed) + ["removed"] * len(removed)
        return pa.RecordBatch.from_arrays([pa.array(numbers[at].astype(np.int32)), pc.cast(ids.take(pa.array(where)), pa.string()), pa.array(kinds, pa.string())], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            joined = rows if held is None else pa.concat_tables([held, rows])
            if (out := emit(joined, held is None, False)) is not None:
                yield out
            held = joined.slice(joined.num_rows - 1)
        if held is not None and (out := emit(held, False, True)) is not None:
            yield out

    return merge


def snapshot_changes(
    rows: DataFrame,
    compare: dict[str, Callable[[Column], Column]],
    key: str = "id",
    snapshot: str = "snapshot_no",
    delivered: str = "delivered_at",
    max_snapshots: int = 10_000,
) -> DataFrame:
    """Typed changes (``snapshot_no``, key, ``change_kind``) from each snapshot to the next one.

    ``compare`` names the columns that matter, each with the expression that reduces it to one way of
    writing. The rows are reduced to one per snapshot and key before they are moved (the one delivered
    last; of several delivered at once the one with the greatest values), so a key delivered many times
    cannot fill a range. They are then range-partitioned and sorted by key and snapshot, and every range
    is merged in one streaming pass that holds a single row.

    Snapshots follow each other by number; the one before is the nearest smaller number that occurs.
    Rows with a null key or snapshot number name no record and are left out. A null delivery time counts
    as earliest. Other columns, whatever their names, are not read. No rows: no changes.
    ``max_snapshots`` bounds the list of snapshot numbers that is sent to the tasks; more is an error.
    """
    known = rows.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
    found = known.select(F.col(snapshot).cast("int").alias("s")).distinct().limit(max_snapshots + 1).collect()
    if len(found) > max_snapshots:
        raise ValueError(f"more than {max_snapshots} snapshots")
    order = {s: i for i, s in enumerate(sorted(r.s for r in found))}
    values = [f(F.col(c)).alias(f"v{i}") for i, (c, f) in enumerate(compare.items())]
    latest = (
        known.select(F.col(key).cast("string").alias("k"), F.col(snapshot).cast("int").alias("s"), F.struct(F.col(delivered).alias("d"), *values).alias("row"))
        .groupBy("k", "s")
        .agg(F.max("row").alias("row"))
        .select("k", "s", *[F.coalesce(F.col(f"row.v{i}"), F.lit("")).alias(f"v{i}") for i in range(len(values))])
    )
    ranged = latest.repartitionByRange("k").sortWithinPartitions("k", "s")
    return ranged.mapInArrow(_merge(key, order), f"snapshot_no int, {key} string, change_kind string")
