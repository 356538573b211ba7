"""Snapshot changes against a brute-force comparison."""

import datetime as dt
import random

import pytest

from corpusloom.operators.snapshots import canonical_date, canonical_hash, snapshot_changes

SCHEMA = "snapshot_no int, id string, delivered_at timestamp, content_hash string, effective_date string, v0 string, row string, change_kind string"
COMPARE = {"content_hash": canonical_hash, "effective_date": canonical_date}


def brute(rows):
    import re

    def hash_of(h):
        return re.sub(r"^[a-z0-9-]+:\s*", "", (h or "").strip().lower())

    def date_of(d):
        d = (d or "").strip()
        return "".join(p.zfill(2) for p in re.match(r"(\d{4})\s*[-./]\s*(\d+)\s*[-./]\s*(\d+)", d).groups()) if re.match(r"\d{4}\s*[-./]", d) else d

    last = {}
    for s, i, at, h, e, *_ in rows:
        if s is None or i is None:
            continue
        row = (at or dt.datetime.min, hash_of(h), date_of(e))
        last[s, i] = max(last.get((s, i), row), row)
    numbers = sorted({s for s, _ in last})
    out = set()
    for before, after in zip(numbers, numbers[1:], strict=False):
        for i in {i for _, i in last}:
            a, b = last.get((before, i)), last.get((after, i))
            if a and b and a[1:] != b[1:]:
                out.add((after, i, "changed"))
            elif a and not b:
                out.add((after, i, "removed"))
            elif b and not a:
                out.add((after, i, "added"))
    return out


def run(spark, rows):
    found = snapshot_changes(spark.createDataFrame(rows, SCHEMA), COMPARE).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_random_rows(spark):
    rng = random.Random(5)
    at = [None] + [dt.datetime(2026, 1, d) for d in range(1, 6)]
    hashes = ["ab", "AB ", "sha256:ab", "cd", None, ""]
    dates = ["2020-01-02", "2020.1.2", " 20200102", "2020/01/03", "", None]
    rows = [(rng.choice([1, 2, 3, 5, 6, None]), rng.choice(["a", "b", "c", "hot", None] + ["hot"] * 3 + [f"k{i}" for i in range(40)]), rng.choice(at), rng.choice(hashes), rng.choice(dates), "x", None, "y") for _ in range(600)]
    assert run(spark, rows) == brute(rows)


def test_ways_of_writing_are_no_change(spark):
    rows = [(1, "a", None, "AB", "2020-01-02"), (2, "a", None, " sha256:ab", "2020. 1. 2"), (3, "a", None, "ab", "20200102")]
    assert run(spark, [(*r, None, None, None) for r in rows]) == set()


def test_gone_and_back(spark):
    rows = [(1, "a"), (2, "b"), (3, "a")]
    assert run(spark, [(s, i, None, None, None, None, None, None) for s, i in rows]) == {(2, "a", "removed"), (2, "b", "added"), (3, "a", "added"), (3, "b", "removed")}


def test_empty_and_bound(spark):
    assert run(spark, []) == set()
    with pytest.raises(ValueError, match="snapshots"):
        snapshot_changes(spark.createDataFrame([(s, "a", None, "", "", "", "", "") for s in range(4)], SCHEMA), COMPARE, max_snapshots=3)


def test_long_keys_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = [(s, f"{'k' * 5000}{i}", None, str(i * s % 3), "", "", "", "") for i in range(20) for s in range(1, 6) if (i + s) % 4]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
