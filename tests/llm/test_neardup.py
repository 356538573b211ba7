"""Near-duplicates against all pairs by brute force."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.neardup import WORD, components, expand_pairs, near_duplicate_classes, near_duplicates, shape

SCHEMA = "id string, body string, member string, s long, u string"


def shingles(text, k):
    words = WORD.findall((text or "").lower())
    return set(zip(*[words[i:] for i in range(k)], strict=False))


def brute(rows, k, threshold):
    sets = {}
    for i, body in rows:
        if i is not None and body is not None:
            sets.setdefault(i, []).append(shingles(body, k))
    out = set()
    for a in sets:
        for b in sets:
            if a < b and any(x and y and len(x & y) >= threshold * len(x | y) for x in sets[a] for y in sets[b]):
                out.add((a, b))
    return out


def corpus(seed, groups=12, hot=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["가나", "다라", "마바"]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(30, 160))]
        for v in range(hot if g == 0 else rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 14)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [rng.choice(words)], [copy[at], rng.choice(words)]])
            rows.append((f"{g:02}-{v:02}", " ".join(copy)))
    rows += [("dup1", rows[0][1]), ("dup2", rows[0][1]), ("dup2", rows[0][1]), ("empty1", ""), ("empty2", ""), ("none", None), ("short1", "a b"), ("short2", "a b"), (None, rows[0][1])]
    return rows + [("long1", " ".join(words * 30)), ("long2", " ".join(words * 30) + " extra")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("k, threshold", [(3, 0.6), (5, 0.8)])
def test_pairs_are_those_of_brute_force(spark, k, threshold):
    rows = corpus(k)
    links, members = near_duplicates(frame(spark, rows), shingle=k, threshold=threshold)
    assert {tuple(r) for r in expand_pairs(links, members).collect()} == brute(rows, k, threshold)


def test_without_broadcast(spark):
    rows = corpus(9, groups=5, hot=8)
    links, members = near_duplicates(frame(spark, rows), shingle=3, threshold=0.6, max_broadcast=0)
    assert {tuple(r) for r in expand_pairs(links, members).collect()} == brute(rows, 3, 0.6)


def test_misses_at_the_threshold_are_rare():
    segments, width = shape(0.6)
    assert (1 - 0.6**width - width * 0.4 * 0.6 ** (width - 1)) ** segments <= 2e-4


def test_different_texts_with_one_stand_in(spark):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(5000))
    other = text + " extra"
    number = lambda key, body: F.xxhash64(key, F.xxhash64(F.lit(body))).bitwiseAND(F.lit(0xFFFF))
    wanted = spark.range(1).select(number(F.lit("a"), text).alias("n")).first()["n"]
    keys = spark.range(1_000_000).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("key"))
    key = keys.where(number(F.col("key"), other) == wanted).first()["key"]
    links, _ = near_duplicates(frame(spark, [("a", text), (key, other), ("c", "x y z")]), shingle=3, threshold=0.6)
    assert [(r["a"], r["b"]) for r in links.collect()] == [("a", key)]


def test_empty(spark):
    links, members = near_duplicates(frame(spark, []))
    assert links.count() == 0 and expand_pairs(links, members).count() == 0


def test_classes(spark):
    rows = corpus(4, groups=6, hot=10)
    found = {r["id"]: r for r in near_duplicate_classes(frame(spark, rows), shingle=3, threshold=0.6).collect()}
    assert found.keys() == {i for i, b in rows if i is not None and b is not None}
    root = {i: i for i in found}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in brute(rows, 3, 0.6):
        root[max(find(a), find(b))] = min(find(a), find(b))
    # Equal texts without shingles are no pairs, but one class.
    assert {i: r["class_id"] for i, r in found.items() if not i.startswith(("empty", "short"))} == {i: find(i) for i in found if not i.startswith(("empty", "short"))}
    assert found["empty1"]["links"] == 0


@pytest.mark.parametrize("max_broadcast", [1_000_000, 0])
def test_repeated_rows_add_no_links(spark, max_broadcast):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    a, b, c = " ".join(words), " ".join([*words, "b"]), " ".join([*words, "c"])
    rows = [("a", a)] * 7 + [("b", b)] * 3 + [("c", c), ("copy", a), ("copy", a), ("other", "x y z")]
    links, _ = near_duplicates(frame(spark, rows), shingle=3, threshold=0.6, max_broadcast=max_broadcast)
    assert sorted((r["a"], r["b"]) for r in links.collect()) == [("a", "b"), ("a", "c"), ("b", "c")]
    found = near_duplicate_classes(frame(spark, rows), shingle=3, threshold=0.6, max_broadcast=max_broadcast).collect()
    assert {r["id"]: (r["class_id"], r["links"]) for r in found} == {"a": ("a", 2), "b": ("a", 2), "c": ("a", 2), "copy": ("a", 2), "other": ("other", 0)}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("x", "y")], "a string, b string")
    labels = {r["node"]: r["class_id"] for r in components(links).collect()}
    assert set(labels.values()) == {"000", "x"} and labels["y"] == "x"
