"""Leaks against a brute-force search by definition."""

import random

import numpy as np

from corpusloom.llm.filters import hash_filter
from corpusloom.llm.leakage import RUNS, item_shingles, leaks, prefixes, signs


def brute(docs, items):
    out = set()
    for key, text in docs:
        doc = signs(text)
        for item_id, body, lang in items:
            item, run = signs(body), RUNS.get(lang, 44)
            if key is None or item_id is None or len(item) < run:
                continue
            pairs = [(q, p) for p in range(len(item) - run + 1) for q in range(len(doc) - run + 1) if doc[q : q + run] == item[p : p + run]]
            for start, _ in pairs:
                seen = {x for q, p in pairs if q >= start and q + run <= start + 3 * len(item) for x in range(p, p + run)}
                if 2 * len(seen) >= len(item):
                    out.add((key, item_id))
                    break
    return out


def sample(seed):
    rng = random.Random(seed)
    letters = "가나다라마바사아자차카타파하abcdefgh123"
    make = lambda n: "".join(rng.choice(letters) + (" " if rng.random() < 0.2 else "") for _ in range(n))
    stock = make(30)
    items = [(i, (stock if i % 3 == 0 else "") + make(rng.randint(80, 200)), "ko" if i % 2 else "en") for i in range(12)]
    items += [(90, None, "ko"), (91, "", "en"), (92, "short", "ko"), (None, make(100), "ko"), (5, items[5][1], items[5][2]), (93, make(150), None)]
    docs = []
    for i in range(40):
        _, text, _ = items[i % 12]
        cut = rng.randrange(len(text) // 2 + 1)
        piece = text[cut : cut + rng.randint(len(text) // 4, len(text))]
        halves = [piece[: len(piece) // 2], make(rng.choice([0, 30, 900])), piece[len(piece) // 2 :]]
        rng.shuffle(halves)
        docs.append((i, make(rng.randint(0, 200)).upper() + "".join(halves).upper() + make(50)))
    return docs + [(100, None), (101, ""), (None, items[0][1]), (102, make(20000) + items[1][1] + make(20000)), (3, docs[3][1]), (103, items[2][1]), (104, items[2][1])], items


def run(spark, docs, items, **options):
    left = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string")
    right = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, lang string, doc_id string")
    found = leaks(left, right, **options).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_found_pairs(spark):
    docs, items = sample(1)
    expected = brute(docs, [i for i in items if i[0] != 93])
    assert expected
    assert {f for f in run(spark, docs, items) if f[1] != 93} == expected


def test_joins_instead_of_broadcasts(spark):
    docs, items = sample(2)
    assert run(spark, docs, items, max_broadcast=0) == run(spark, docs, items)


def test_odd_runs_and_languages_given_twice(spark):
    body = "abcdefghij klmnopqrst uvwxyz 0123456789 " * 2 + "the quick brown fox jumps over a lazy dog again"
    docs, items = [(1, "x " * 50 + body + " y" * 50)], [(7, body, "en"), (7, body, None)]
    for length in (43, 44, 45):
        assert run(spark, docs, items, runs={"ko": 26, "en": length}) == {(1, 7)}


def test_filter_is_bounded_and_misses_nothing(spark):
    hashes = [h * 0x9E3779B97F4A7C15 % 2**64 - 2**63 for h in range(1, 3_000)]
    frame = spark.createDataFrame([(h,) for h in hashes], "hash long")
    values = np.array(hashes, dtype=np.int64).view(np.uint64)
    small, usual = hash_filter(frame, most=12), hash_filter(frame)
    assert small.map.nbytes == 512 and len(small.holds(values)) == len(usual.holds(values)) == len(hashes)
    others = np.random.default_rng(1).integers(0, 2**63, 10_000).astype(np.uint64)
    assert len(usual.holds(others)) < 100


def test_empty(spark):
    docs, items = sample(3)
    assert run(spark, [], items) == set() and run(spark, docs, []) == set()


def test_prefix_leaves_out_the_commonest(spark):
    frame = spark.createDataFrame([(1, "가" * 26 + "나" * 26 + "다" * 100, "ko")], "item_id long, text string, lang string")
    row = item_shingles(frame, RUNS).first()
    assert row["needed"] == 3 and len(row["hashes"]) == 11
    rows = [(1, 13, 3, 11, at, h) for at, h in enumerate(range(11))]
    shingles = spark.createDataFrame(rows, "item long, width int, needed int, shingles int, start int, hash long")
    frequency = spark.createDataFrame([(13, h, h + 1) for h in range(1, 11)], "width int, hash long, many long")
    assert {r["hash"] for r in prefixes(shingles, frequency).collect()} == set(range(9))
