"""Queries over the smallest tables: against SQL where there is some, else by what must hold of their rows."""

import pytest

from corpusloom.cluster import table
from corpusloom.llm.queries import ORACLES, QUERIES


def normal(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr([None if v is None or v != v else round(v, 6) if isinstance(v, float) else str(v) for v in row]) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    found = normal(QUERIES[name](spark, sf_dir).toPandas())
    assert found[1] and found == normal(duck.sql(ORACLES[name]).df())


def rows(spark, sf_dir, name):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def test_found_columns_and_keys(spark, sf_dir):
    pairs = rows(spark, sf_dir, "p1_found")
    sentences = {(r["id"], r["sentence_no"]) for r in table(spark, sf_dir, "doc_sentences").collect()}
    assert pairs and all(p.keys() == {"ko_id", "ko_sentence_no", "en_id", "en_sentence_no"} and p["en_id"] == p["ko_id"] + "-en" for p in pairs)
    assert {(p["ko_id"], p["ko_sentence_no"]) for p in pairs} | {(p["en_id"], p["en_sentence_no"]) for p in pairs} <= sentences
    docs = {r["doc_id"] for r in table(spark, sf_dir, "documents").select("doc_id").collect()}
    cut, rates = {r["doc_id"] for r in rows(spark, sf_dir, "p10_found")}, rows(spark, sf_dir, "p10_rates")
    assert cut <= docs and sum(r["cut"] for r in rates) == len(cut) and sum(r["documents"] for r in rates) == len(docs)
    assert {r["doc_id"] for r in rows(spark, sf_dir, "p9_found")} <= docs


def test_restored_texts_are_those_found(spark, sf_dir):
    found, restored = {r["text_path"] for r in rows(spark, sf_dir, "p2_found")}, rows(spark, sf_dir, "p2_restored")
    assert found == {r["text_path"] for r in restored} and len(restored) == len(found)
    original = {r["text_path"]: r["text"] for r in table(spark, sf_dir, "attachment_texts").collect()}
    assert all((original[r["text_path"]] != r["restored"]) == (r["replaced_runs"] > 0) for r in restored)


def test_groups_agree_with_pairs(spark, sf_dir):
    pairs, groups = rows(spark, sf_dir, "p3_found"), {r["id"]: r for r in rows(spark, sf_dir, "p3_groups")}
    assert pairs and all(groups[p["id_a"]]["class_id"] == groups[p["id_b"]]["class_id"] for p in pairs)
    assert {r["id"] for r in table(spark, sf_dir, "rule_docs").where("body is not null").select("id").collect()} == groups.keys()


def test_every_record_is_cleaned_and_judged(spark, sf_dir):
    clean = rows(spark, sf_dir, "p6_clean_text")
    kinds = {(r["record_kind"], r["record_key"], k) for r in clean for k in r["markup"].split(",") if k}
    assert kinds == {tuple(r[c] for c in ("record_kind", "record_key", "markup")) for r in rows(spark, sf_dir, "p6_found")}
    assert len(clean) == table(spark, sf_dir, "rule_docs").count() + table(spark, sf_dir, "attachment_texts").count()
    stats = rows(spark, sf_dir, "p7_statistics")
    assert {r["text_path"] for r in stats if "few_sentences" in r["failures"].split(",")} == {r["text_path"] for r in rows(spark, sf_dir, "p7_found")}


def test_containers_hold_their_pieces(spark, sf_dir):
    pieces, filled = rows(spark, sf_dir, "p8_containers"), {}
    for p in pieces:
        if p["container_no"] is not None:
            filled.setdefault((p["container_no"], p["container_size"]), []).append(p["tokens"])
    assert len({no for no, _ in filled}) == len(filled) and all(sum(sizes) <= size <= 2048 for (_, size), sizes in filled.items())
    budget = rows(spark, sf_dir, "p4_token_budget")
    assert all(r["tokens"] <= 4 * r["characters"] for r in budget) and sum(r["documents"] for r in budget) == table(spark, sf_dir, "rule_docs").select("id").distinct().count()
