"""Sentence alignment on an invented language pair with known partners."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm.alignment import JOINT, Concepts, Counter, _vector_rows, align, english_terms, korean_terms, sentence_pairs, twin_sentences

SCHEMA = "id string, sentence_no int, sentence string, pair string, w double"


def test_terms_of_numbers_agree():
    cases = [
        ("32억 5,500만원을 넘지 않는", "KRW 3.255 billion"), ("4,400만원", "44 million won"), ("2019년 9월 15일에", "September 15, 2019"), ("2019년 9월 15일", "15 September 2019"),
        ("100분의 46", "46 percent"), ("4.4퍼센트", "4.4 percent"), ("41부", "forty-one (41) copies"), ("16시", "16:00"), ("제51조제6항", "Article 51 (6)"),
    ]
    for ko, en in cases:
        assert {t for t in korean_terms(ko) if t[0] == "#"} == {t for t in english_terms(en) if t[0] == "#"}, (ko, en)


def test_stems():
    assert korean_terms("위험관리위원회는 보고서를 제출하여야 한다")[:3] == ["위험관리위원회", "보고서", "제출"]
    assert english_terms("The boards restricted") == english_terms("board restrict")


def corpus(seed, documents=60):
    rng = random.Random(seed)
    syllables = "강남동서북산천초목화수금토일월성운하"
    nouns = [("".join(rng.sample(syllables, 3)), "".join(rng.sample("bcdfghklmnprstvz", 3)) + rng.choice("aeiou") + "rk") for _ in range(70)]
    nouns = list({k: (k, e) for k, e in nouns}.values())
    rows, truth = [], set()
    for d in range(documents):
        said = [(rng.sample(nouns, 4), rng.randint(1, 500)) for _ in range(8)]
        ko = lambda s: f"{s[0][0][0]}은 {s[0][1][0]}을 {s[0][2][0]}와 {s[0][3][0]}에게 {s[1]}건 보낸다."
        en = lambda s: f"The {s[0][0][1]} sends {s[0][1][1]} and {s[0][2][1]} to the {s[0][3][1]} {s[1]} times."
        order = list(range(8))
        rng.shuffle(order)
        dropped = order.pop()
        merge = rng.random() < 0.4
        units = [[order[0], order[1]]] + [[i] for i in order[2:]] if merge else [[i] for i in order]
        for i in range(8):
            rows.append((f"d{d}", i + 1, ko(said[i])))
        for j, unit in enumerate(units, 1):
            rows.append((f"d{d}-en", j, " ".join(en(said[i]) for i in unit)))
            truth |= {(f"d{d}", i + 1, f"d{d}-en", j) for i in unit}
        assert dropped is not None
    return rows, truth


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA)
    return {tuple(r) for r in sentence_pairs(align(twin_sentences(frame), **options)).collect()}


def test_known_partners(spark):
    rows, truth = corpus(1)
    rows += [rows[0], (None, 1, "x"), ("d1", None, "x"), ("d1", 99, None), ("d2", 50, ""), ("alone", 1, "강남은"), ("d3", 60, "긴 " * 5000)]
    found = run(spark, rows)
    assert len(found & truth) >= 0.95 * len(truth) and len(found & truth) >= 0.97 * len(found)


def test_terms_of_every_pair_are_learned(spark):
    # Words that only the documents with the greatest digests hold, and no numbers to align by.
    names = [r["d"] for r in spark.range(1060).select(F.concat(F.lit("d"), "id").alias("d")).orderBy(F.xxhash64("d"), "d").collect()]
    rows, truth = corpus(2)
    as_last = lambda d: names[1000 + int(re.sub(r"\D", "", d))] + ("-en" if d.endswith("-en") else "")
    rows = [(as_last(d), no, re.sub(r" ?[0-9]+(?:건| times)", "", text)) for d, no, text in rows]
    truth = {(as_last(k), i, as_last(e), j) for k, i, e, j in truth}
    rows += [row for d in names[:1000] for row in ((d, 1, "회원은 자료를 낸다."), (f"{d}-en", 1, "The member files records."))]
    found = {r for r in run(spark, rows) if r[0] in names[1000:]}
    assert len(found & truth) >= 0.9 * len(truth) and len(found & truth) >= 0.9 * len(found)


def test_hot_pairs_and_large_vocabularies_give_the_same(spark):
    rows, _ = corpus(3, documents=25)
    usual = run(spark, rows)
    assert usual and run(spark, rows, whole=3) == usual and run(spark, rows, max_broadcast=0) == usual


def test_three_sentences_in_one(spark):
    rows, _ = corpus(4)
    said = {d: [t for i, n, t in rows if i == f"{d}-en" and n in (1, 2, 3)] for d in ("d1", "d2", "d3")}
    kept = [r for r in rows if r[0].removesuffix("-en") not in said]
    ko = [r for r in rows if r[0] in said]
    _, truth = corpus(4)
    truth = {t for t in truth if t[0] in said}
    wide = [(f"{d}-en", 1, " ".join(texts)) for d, texts in said.items()] + [(i, n, t) for i, n, t in rows if i.removesuffix("-en") in said and i.endswith("-en") and n > 3]
    expected = {(k, i, e, 1 if j <= 3 else j) for k, i, e, j in truth}
    # Merged neighbours must be neighbours in the other language, too.
    order = {d: sorted((j, i) for k, i, _, j in truth if k == d and j <= 3) for d in said}
    renumber = {}
    for d, pairs in order.items():
        first = [i for _, i in pairs]
        renumber |= {(d, i): at for at, i in enumerate(first + [i for i in range(1, 9) if i not in first], 1)}
    ko = [(d, renumber[d, i], t) for d, i, t in ko]
    expected = {(k, renumber[k, i], e, j) for k, i, e, j in expected}
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in kept + ko + wide], SCHEMA)
    spans = align(twin_sentences(frame))
    found = {tuple(r) for r in sentence_pairs(spans).collect() if r["ko_id"] in said}
    of_three = {r for r in expected if r[3] == 1}
    assert len(of_three & found) >= 0.85 * len(of_three)
    assert spans.where("i1 - i0 = 2 and j0 = j1").where(F.col("pair").isin(*said)).count() >= 2


def test_counts_of_both_ways_agree():
    rng = np.random.default_rng(1)
    for words, most in ((12, 40), (4_000, 60)):
        units = [[np.unique(rng.integers(0, words, 20) * 2).astype(np.int32) for _ in range(2)] for _ in range(most)]
        counter = Counter()
        for ko, en in units:
            counter.add(ko, en)
        found = {(k, e): n for kind, k, e, n in zip(*(c.to_pylist() for c in counter.rows().columns), strict=True) if kind == JOINT}
        expected = {}
        for ko, en in units:
            for pair in ((int(k), int(e)) for k in ko for e in en):
                expected[pair] = expected.get(pair, 0) + 1
        assert found == expected


def test_vectors_across_batches():
    terms = [[2, 4], [4, 6], [2], [8], [6, 4]]
    concepts = Concepts(np.array([2, 4, 6, 6]), np.array([10, 12, 14, 12]), np.array([1.0, 2.0, 3.0, 0.5]))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 1, 2]), pa.array([True] * 5), pa.array([1, 2, 3, 5, 6], pa.int32()), pa.array(terms, pa.list_(pa.int32()))], names=["p", "en", "no", "terms"])
    alone = [{}, {}, {}, {}, {}]
    for vector, own in zip(alone, terms, strict=True):
        for t, d, v in zip((2, 4, 6, 6), (10, 12, 14, 12), (1.0, 2.0, 3.0, 0.5), strict=True):
            if t in own:
                vector[d] = vector.get(d, 0) + v
    merged = lambda *vs: sum(sum(v.get(d, 0) for v in vs) ** 2 for d in (10, 12, 14))
    for cuts in ([5], [2, 3], [1, 1, 1, 1, 1]):
        parts, at = [], 0
        for n in cuts:
            parts.append(rows.slice(at, n))
            at += n
        found = [r for b in _vector_rows({False: concepts, True: concepts}, 3, pairs=False)(iter(parts)) for r in b.to_pylist()]
        assert [dict(zip(r["dims"], r["weights"], strict=True)) for r in found] == alone
        assert [r["norms"] for r in found] == [[merged(*alone[:1]), merged(*alone[:2]), merged(*alone[:3])], [merged(alone[1]), merged(*alone[1:3]), None], [1, None, None], [0, None, None], [merged(alone[4]), None, None]]


def test_dimensions_that_cannot_meet_are_left_out():
    same = Concepts(np.array([2, 4, 6]), np.array([2, 4, 6]), np.ones(3))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2]), pa.array([False, True, True, False]), pa.array([1, 1, 2, 1], pa.int32()), pa.array([[2, 4], [4], [4, 6], [4]], pa.list_(pa.int32()))], names=["p", "en", "no", "terms"])
    found = [r for b in _vector_rows({False: same, True: same}, 1)(iter([rows.slice(0, 2), rows.slice(2)])) for r in b.to_pylist()]
    assert [r["dims"] for r in found] == [[4], [4], [4], []] and [r["norms"] for r in found] == [[2], [1], [2], [1]]


def test_empty(spark):
    assert run(spark, []) == set() and run(spark, [("a", 1, "강"), ("b-en", 1, "x")]) == set()
