"""Native functions against hand-made expectations and independent Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from corpusloom.functions import policy, quality, text


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def many(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", column.alias("x")).orderBy("i").collect()]


def test_white_space_is_that_of_python(spark):
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    stripped = many(spark, [f"{c}a{c}" for c in points], text.strip(F.col("v")))
    assert [s == "a" for s in stripped] == [c.isspace() for c in points]


def test_slug(spark):
    values = ["  A/B_c.d:e  f ", "제1조 (목적)", "---", "", None, "é!", "A--B"]
    assert many(spark, values, text.slug(F.col("v"))) == ["a-b-c-d-e-f", "제1조-목적", "untitled", "untitled", "untitled", "untitled", "a-b"]


def test_slug_is_idempotent(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice("aB 가/._-é:") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    once = many(spark, values, text.slug(F.col("v")))
    assert many(spark, once, text.slug(F.col("v"))) == once


def test_dates(spark):
    values = ["2024. 3. 5.", "2024/03/05", "2024-13-40", "x 2020.1.2 y", "20240305", "", None]
    assert many(spark, values, text.normalize_date(F.col("v"))) == ["2024-03-05", "2024-03-05", "2024-13-40", "2020-01-02", "", "", ""]


def test_language(spark):
    assert many(spark, ["EN", "en_US", " eng ", "fr", "", None], text.normalize_language(F.col("v"))) == ["en", "en", "en", "ko", "ko", "ko"]


def test_suffix_and_bytes(spark):
    assert many(spark, ["a.b.PDF", ".hidden", "x/y.z/name", "name.", None], text.suffix(F.col("v"))) == [".PDF", "", "", "", ""]
    long = "가" * 30 + ".hwp"
    for value, short in zip([long, "short.txt"], many(spark, [long, "short.txt"], text.truncate_bytes(F.col("v"), 40)), strict=True):
        assert len(short.encode()) <= 40 and short.endswith(value[-4:])


def python_tokens(value):
    out = []
    for word in re.findall("[0-9A-Za-z가-힣]+", value.lower()):
        out.append(word)
        if re.fullmatch("[가-힣]+", word):
            out += [word[i : i + n] for n in (2, 3) for i in range(len(word) - n + 1)]
    return list(dict.fromkeys(t for t in out if len(t) > 1 or t.isascii()))


def test_tokens(spark):
    rng = random.Random(2)
    values = ["", "가", "나다", "가나다라 a 1 é b가", "A a A"] + ["".join(rng.choice("가나다 ab1.é") for _ in range(30)) for _ in range(50)]
    assert many(spark, values, text.tokens(F.col("v"))) == [python_tokens(v) for v in values]


def python_chunks(value, size):
    out, held = [], ""
    for p in [p.strip() for p in re.split(r"\n{2,}", value.strip()) if p.strip()]:
        if held and (len(p) > size or len(held) + len(p) + 2 > size):
            out.append(held)
            held = ""
        if len(p) > size:
            out += [p[i : i + size].strip() for i in range(0, len(p), size)]
        else:
            held = f"{held}\n\n{p}" if held else p
    return out + [held] * bool(held)


def test_chunks(spark):
    rng = random.Random(3)
    values = ["", "a" * 10, "a" * 11, "aaaa\n\nbbbb", "aaaa\n\nbbbbb", "x" * 25 + "\n\ny"] + ["".join(rng.choice("ab \n\n\n") for _ in range(80)) for _ in range(60)]
    assert many(spark, values, text.chunks(F.col("v"), 10)) == [python_chunks(v, 10) for v in values]


def test_adjacent_repeats_and_titles(spark):
    assert many(spark, ["a,a,b,a", "", "x"], text.drop_adjacent_repeats(F.split("v", ","))) == [["a", "b", "a"], [""], ["x"]]
    assert many(spark, [" _a  b.- ", None], text.clean_title(F.col("v"))) == ["a b", ""]
    assert many(spark, ["download", "12345678ab", "서식", "--", None], text.is_generic_name(F.col("v"))) == [True, True, False, True, True]


def test_hash(spark):
    assert one(spark, text.hash_text(F.col("v")), v=" 가\n") == hashlib.sha256("가".encode()).hexdigest()


def grade(spark, value):
    row = spark.createDataFrame([(value,)], "t string").select(*[c.alias(n) for n, c in quality.metrics(F.col("t")).items()]).withColumn("f", quality.flags())
    return row.withColumns({"score": quality.score(F.col("f")), "status": quality.status(F.col("f"))}).first()


def test_quality_boundaries(spark):
    cases = {
        "": (["empty_text"], 0, "fail"), None: (["empty_text"], 0, "fail"), "  \n": ([], 100, "ok"), "a" * 39: (["very_short_text"], 55, "warn"), "a" * 40: ([], 100, "ok"),
        "b " * 45 + "�": (["replacement_characters"], 97, "warn"), "b " * 45 + "�" * 11: (["replacement_characters"], 70, "warn"), "a" * 1200: ([], 100, "ok"), "a" * 1201: (["very_long_lines"], 85, "warn"),
    }
    for value, expected in cases.items():
        row = grade(spark, value)
        assert (row["f"], row["score"], row["status"]) == expected, value


def test_table_lines(spark):
    cases = {"a|b": False, "| a | b |": True, "|  |x|": False, "a\tb": True, "a\t": False, "a  b": False, "a  b  c": True, "-  -  -": False, "a  -  1": True}
    assert dict(zip(cases, many(spark, list(cases), quality.is_table_line(F.col("v"))), strict=True)) == cases


def test_policy(spark):
    cases = {"a_rea.hwp": True, "rea": True, "area.hwp": False, "x filecd=gae": True, "x rea": False, "신구조문대비표": True, "본문": False, "a-jun/b": True}
    columns = (F.lit(""), F.col("v"), F.lit(""), F.lit(""))
    assert dict(zip(cases, many(spark, list(cases), policy.is_excluded(*columns)), strict=True)) == cases
    assert many(spark, [" 전문 ", "전문가"], policy.is_full_text(F.col("v"), F.lit(None).cast("string"), F.lit(""), F.lit(""))) == [True, False]


def test_every_body_becomes_markdown(spark, tmp_path):
    from corpusloom.plans import reference

    bodies = {
        "tags": ("<p>a</p><li>b</li>", "a\n\n- b"), "bold": ("<strong>a</strong> b", "**a**b"), "row": ("<tr>a</tr><tr>b</tr>", "a\n\nb"), "link": ("<a href='x'>a</a>", "a"), "entity": ("R&amp;D &lt;x&gt;", "R&D <x>"),
        "plain": (" a \n\n b ", "a b"), "empty": ("", ""), "null": (None, ""),
    }
    rows = [(i, body) for i, (body, _) in bodies.items()] + [("plain", " a \n\n b ")]
    spark.createDataFrame(rows, "id string, body string").write.parquet(f"{tmp_path}/rule_docs.parquet")
    found = [tuple(r) for r in reference.html_to_markdown(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted((i, markdown) for i, (_, markdown) in bodies.items())
