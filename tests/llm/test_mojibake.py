"""Wrong decodings that are made and then found and undone."""

import random

import pytest

from corpusloom.llm.mojibake import garbled, garbled_forms, restored

WORDS = "위원회는 보고서를 제출하여야 한다 거래소가 정한 기준에 따라 심사할 수 있다 회원은 지체 없이 통지한다".split()
LOSSLESS = [("utf-8", "latin-1"), ("cp949", "latin-1"), ("utf-8", "mac_roman"), ("cp949", "gbk"), ("utf-8", "cp949")]


def clean(rng, n=12):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "text_path string, text string, chain string, forms int")


def corpus():
    rng = random.Random(1)
    rows = [(f"clean{i}", clean(rng)) for i in range(30)]
    rows += [("name", "Café Größe, São-Âncora 및 ÄÖÅ로 적는다."), ("sign", "£40 ± 5 °C § 7 – “인용” ½ ㈜"), ("hanja", "증권(證券)"), ("lost", "회원은 � 통지한다"), ("ascii", "plain text"), ("null", None), ("empty", ""), (None, "ì\x88\x98")]
    return rng, rows


@pytest.mark.parametrize("written, read", [*LOSSLESS, ("cp949", "utf-8"), ("utf-8", "cp1252")])
def test_found(spark, written, read):
    rng, rows = corpus()
    broken = clean(rng).encode(written).decode(read, "replace")
    rows += [("whole", broken), ("part", clean(rng) + " " + " ".join(broken.split(" ")[:4])), ("part", clean(rng))]
    assert {r["text_path"] for r in garbled(frame(spark, rows)).collect()} == {"whole", "part"}


@pytest.mark.parametrize("written, read", LOSSLESS[:4])
def test_restored(spark, written, read):
    rng, rows = corpus()
    original = clean(rng)
    found = restored(frame(spark, [*rows, ("whole", original.encode(written).decode(read, "replace"))])).collect()
    assert [(r["text_path"], r["restored"], r["lost_runs"]) for r in found] == [("whole", original, 0)]


def test_twice_and_signs(spark):
    _, rows = corpus()
    once = "“인용” – 5".encode().decode("cp1252", "replace")
    twice = "위원회는 보고서를".encode().decode("latin-1").encode().decode("latin-1")
    assert {r["text_path"] for r in garbled(frame(spark, [*rows, ("signs", once), ("twice", twice)])).collect()} == {"signs", "twice"}


def test_forms_are_no_repairs():
    assert not any(form == "é" for form in garbled_forms("챕"))
    assert all(form and form != "위원회" for form in garbled_forms("위원회"))


def test_empty(spark):
    assert garbled(frame(spark, [])).count() == 0 and restored(frame(spark, [])).count() == 0
