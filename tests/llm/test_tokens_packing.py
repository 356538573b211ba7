"""Token counts, budgets and packing against the tokenizer itself and plain Python."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm.budget import normal_label, normal_language, token_budget
from corpusloom.llm.packing import pack, plan
from corpusloom.llm.tokens import TOKENIZERS, VOCABULARY, encoding, token_count

TEXTS = ["", None, "a", "제1조(목적) 이 규정은", "word " * 50, "<|endoftext|>", "가나다" * 3000]


def count(text):
    return len(encoding(TOKENIZERS, VOCABULARY).encode_ordinary(text)) if text else 0


def test_token_count(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", token_count(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in rows] == [count(t) for t in TEXTS]


def test_labels(spark):
    rows = spark.createDataFrame([("KO ", "a/b"), ("en-US", " a / b "), ("", ""), (None, None), ("fr", "x  y")], "l string, c string")
    assert [tuple(r) for r in rows.select(normal_language(F.col("l")), normal_label(F.col("c"))).collect()] == [("ko", "a / b"), ("en", "a / b"), ("und", ""), ("und", ""), ("fr", "x y")]


def test_budget_counts_every_id_once(spark):
    rows = [("1", 1, "s", "same text"), ("1", 2, "s", "same text"), ("2", 1, "s", "same text"), ("3", 1, "t", None), ("4", None, None, ""), ("5", 1, "t", "가" * 9000), ("1", 2, "s", "same text")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "id string, loaded_at int, src string, body string, n string, tokens int")
    found = {r["src"]: (r["documents"], r["tokens"]) for r in token_budget(docs, {"src": F.coalesce("src", F.lit(""))}).collect()}
    assert found == {"s": (2, 2 * count("same text")), "t": (2, count("가" * 9000)), "": (1, 0)}
    assert token_budget(docs.limit(0), {"src": F.col("src")}).count() == 0


def test_budget_counts_null_ids_apart(spark):
    rows = [(None, 1, "s", "a text"), (None, 2, "s", "a text"), (None, 1, "s", "another text here"), (None, 1, "t", "a text"), (None, None, "t", None), ("1", 1, "s", "a text")]
    docs = spark.createDataFrame(rows, "id string, loaded_at int, src string, body string")
    found = {r["src"]: (r["documents"], r["characters"], r["tokens"]) for r in token_budget(docs, {"src": F.col("src")}).collect()}
    assert found == {"s": (3, 29, 2 * count("a text") + count("another text here")), "t": (2, 6, count("a text"))}


def check_plan(histogram, capacities):
    slots, containers = plan(histogram, capacities)
    fill, placed = {}, {}
    for size, rank, items, each, first in slots:
        assert placed.get(size, 0) == rank
        placed[size] = rank + items
        for i in range(items):
            fill[first + i // each] = fill.get(first + i // each, 0) + size
    assert placed == {s: n for s, n in histogram.items() if s > 0 and n > 0}
    sizes = {first + i: c for first, many, c in containers for i in range(many)}
    assert fill.keys() == sizes.keys()
    for c, used in fill.items():
        assert used <= sizes[c] and all(used > smaller for smaller in capacities if smaller < sizes[c])
    return fill, sizes


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 64), st.integers(0, 40), max_size=30))
def test_plan_places_everything(histogram):
    check_plan(histogram, [8, 16, 32, 64])


def test_plan_leaves_little_space():
    rng = random.Random(1)
    histogram = {}
    for _ in range(20_000):
        size = min(2048, max(1, int(rng.lognormvariate(5, 1))))
        histogram[size] = histogram.get(size, 0) + 1
    fill, sizes = check_plan(histogram, [256, 512, 1024, 2048])
    assert sum(fill.values()) / sum(sizes.values()) > 0.99


@pytest.mark.parametrize("rows", [[], TEXTS, ["same text"] * 300 + TEXTS * 3])
def test_pack(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(rows)], "doc_id long, text string, tokens string, container_no int")
    found = pack(docs, capacities=(16, 32, 64), buckets=4).toPandas()
    totals = found.groupby("doc_id")["tokens"].sum()
    assert {i: count(t) for i, t in enumerate(rows)} == totals.to_dict()
    filled = found[found["tokens"] > 0]
    assert found[found["tokens"] == 0]["container_no"].isna().all() and filled["container_no"].notna().all()
    if len(filled):
        groups = filled.groupby("container_no")
        assert (groups["tokens"].sum() <= groups["container_size"].first()).all() and (groups["container_size"].nunique() == 1).all()
        long = filled[filled["doc_id"].map(totals) > 64]
        assert (long[long["piece_no"] < long.groupby("doc_id")["piece_no"].transform("max")]["tokens"] == 64).all()
        assert (filled[filled["doc_id"].map(totals) <= 64]["piece_no"] == 0).all()
