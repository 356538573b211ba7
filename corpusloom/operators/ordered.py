"""Operators whose result follows an order: first occurrences, unique names, limits, nesting."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import text_or_empty


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by an order. Nulls are a key of their own.

    The minimum is partial before rows are moved, so a key with very many rows is no hot one.
    """
    rest = [c for c in rows.columns if c not in keys]
    first = F.min(F.struct(*order, F.struct(*rest).alias("__row"))).alias("__first")
    return rows.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"__first.__row.{c}").alias(c) for c in rows.columns])


def collected_items(rules: DataFrame, notices: DataFrame, language: str = "all", recent: DataFrame | None = None) -> DataFrame:
    """Rules and then notices in their order; English exists for rules only; recent items stand in for both."""
    if language not in ("", "all", "ko", "en"):
        raise ValueError("language must be all, ko or en")
    if recent is not None:
        both = recent
    else:
        both = rules.withColumn("__part", F.lit(0)).unionByName(notices.withColumn("__part", F.lit(1)))
        both = both.withColumn("ord", F.col("__part").cast("long") * (1 << 40) + F.col("ord")).drop("__part")
    return both.where(F.col("document_type") == "rule") if language == "en" else both


def limited(items: DataFrame, limit: int) -> DataFrame:
    """The first items by ``ord``; all with 0."""
    return items.orderBy("ord").limit(limit) if limit > 0 else items


def by_effective_date(items: DataFrame) -> DataFrame:
    """Latest effective date first, dates that are missing last, then in the order of arrival."""
    return items.orderBy(F.desc(text_or_empty(F.col("effective_date"))), "ord")


def _numbered(name: str, number: int, limit: int) -> str:
    """A name with a number after its stem, which gives way so that the number always stays."""
    stem, end = _split(name)
    tail = f"-{number}{end}"
    room = max(1, limit - len(tail.encode()))
    if len(stem.encode()) > room:
        stem = stem.encode()[:room].decode("utf-8", "ignore").rstrip(" ._-") or "attachment"
    return stem + tail


def _split(name: str) -> tuple[str, str]:
    at = name.rfind(".")
    return (name[:at], name[at:]) if 0 < at < len(name) - 1 else (name, "")


class _Names:
    """Names that are taken within a parent, and from which number on a name is tried again."""

    def __init__(self) -> None:
        self.used: set[str] = set()
        self.next: dict[str, int] = {}

    def take(self, name: str, limit: int) -> str:
        candidate, number = name, self.next.get(name, 2)
        while candidate in self.used:
            candidate = _numbered(name, number, limit)
            number += 1
        self.next[name] = number
        self.used.add(candidate)
        return candidate


def fold_unique(names: list[str], limit: int) -> list[str]:
    """Each name, or its stem with the least number from 2 on that is free, in order."""
    taken = _Names()
    return [taken.take(name, limit) for name in names]


def unique_names(rows: DataFrame, parent: str, order: str, name: str, limit: int = 160) -> DataFrame:
    """(``parent``, ``order``, ``name``, ``unique_name``): names made unique within a parent, in order.

    The fold is sequential by nature, so a parent's rows meet in one task, sorted on the way and read as
    a stream: what is held is the set of the parent's names, not its rows. Null names count as empty.
    """
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, taken = object(), _Names()
        for batch in batches:
            out = []
            for owner, value in zip(batch[parent], batch[name], strict=True):
                if owner != current:
                    current, taken = owner, _Names()
                out.append(taken.take(value, limit))
            yield batch.assign(unique_name=out)

    sorted_rows = rows.select(parent, order, text_or_empty(F.col(name)).alias(name)).repartition(parent).sortWithinPartitions(parent, order, name)
    return sorted_rows.mapInPandas(run, f"{parent} {kinds[parent]}, {order} {kinds[order]}, {name} string, unique_name string")


def nested(children: DataFrame, parent: str, order: str, fields: list[str]) -> DataFrame:
    """One row a parent with its children as an array in their order."""
    return children.groupBy(parent).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("c")))), lambda x: x["c"]).alias("children"))


def exists_twin(ids: Column) -> Column:
    """The id that the English twin of a document has."""
    return F.concat(ids, F.lit("-en"))
