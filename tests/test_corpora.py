import json

import pytest
from pyspark.sql import functions as F

from termloom.operators import quality
from termloom.sources import adapters, corpora
from test_engine import TEXT


def test_corpus_scores(spark, tmp_path):
    (tmp_path / "a.txt").write_text(TEXT)
    (tmp_path / "b.txt").write_text("x")
    (tmp_path / "orphan.txt").write_text("x")
    truth = {"a": {"expected": {"eligibility[0].counterparty": "wrong", "eligibility[0].haircut_pct": "2", "eligibility[0].valid_to": "not_found"}, "owner_verified": True}, "b": {"expected": {"x": 1, "y": "2"}}, "c": {"expected": {}}}
    (tmp_path / "ground_truth.json").write_text(json.dumps(truth))
    got = {(r.case_id, r.problem) for r in corpora.problems(spark, str(tmp_path)).collect()}
    assert got == {("c", "missing_text"), ("orphan", "orphan_text"), ("c", "empty_expected"), ("b", "value_not_a_string")}
    assert tuple(corpora.shortfall(spark, str(tmp_path)).first()) == (3, 1, 7, 9)
    known = corpora.cases(spark, str(tmp_path)).where("case_id = 'a'")
    assert known.count() == 3 and known.first().owner_verified
    values, _ = corpora.scored(known)
    all_ = quality.rounded(quality.accuracy(values, [])).first()
    assert (all_.n, all_.n_correct, all_.accuracy) == (3, 2, 0.6667)
    (tmp_path / "packaged.json").write_text(json.dumps([{"case_id": "z", "text": TEXT, "owner_verified": False, "expected": {"f": "v"}}]))
    assert corpora.packaged_cases(spark, str(tmp_path / "packaged.json")).first().expected == "v"


def test_packaged_regression(spark):
    gate = corpora.regression(corpora.packaged(spark)).first()
    assert (gate.n_documents, gate.n_verified, gate.accuracy, gate.ready, gate.n_disputed) == (10, 0, 1.0, False, 0)


def test_manifests(spark, tmp_path):
    path = str(tmp_path / "manifest.json")
    corpora.save_manifest(spark, path, {"documents": [{"path": "x"}]})
    told = {"title": "t", "source_url": "u", "profile": "dtc", "expected_records": 3, "synthetic": True, "note": "n"}
    new = corpora.add_document(spark, path, "d.txt", b"abc", **told)
    corpora.add_document(spark, path, "d.txt", b"abc", **told)
    held = corpora.load_manifest(spark, path)["documents"]
    assert [d["path"] for d in held] == ["x", "d.txt"] and held[1] == new and new["expected_minimum_eligibility_records"] == 3 and (tmp_path / "d.txt").read_bytes() == b"abc"
    with pytest.raises(ValueError, match="positive"):
        corpora.entry("p", "t", "u", "s", "dtc")
    assert "expected_minimum_eligibility_records" not in corpora.entry("p", "t", "u", "s", "dtc", route="classification_review")
    (tmp_path / "b.json").write_text(json.dumps({"cases": [{"name": "n", "path": "a.pdf"}, {"name": "m", "path": "/z.pdf", "minimum_table_cells": 2, "expected_locator_count": 9}]}))
    assert [tuple(r) for r in corpora.benchmark_cases(spark, str(tmp_path / "b.json")).collect()] == [("n", str(tmp_path / "a.pdf"), 1, 0, None), ("m", "/z.pdf", 1, 2, 9)]
    (tmp_path / "none.json").write_text("{}")
    with pytest.raises(ValueError, match="cases"):
        corpora.benchmark_cases(spark, str(tmp_path / "none.json"))


def test_corrections_take_the_rows_class(spark):
    silver = spark.createDataFrame([("1", "c")], "extraction_id string, doc_class string")
    records = spark.createDataFrame([("1", "correct"), ("2", "dispute")], "extraction_id string, action string")
    assert {r.extraction_id: r.doc_class for r in corpora.corrections_of(spark, records, silver).collect()} == {"1": "c", "2": "unknown"}


def test_adapters(spark):
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "doc_id string, content binary")
    assert {r.error for r in adapters.pdf_pages(files).collect()} == {"missing tool: pypdf"}

    def words(content):
        if content == b"2":
            raise ValueError("torn")
        return [(1, 9.0, 9.0, "b", 5.0, 1.02, 6.0, 2.0, 1.0, None), (1, 9.0, 9.0, "a", 1.0, 1.04, 2.0, 2.5, 0.5, None), (1, 9.0, 9.0, "c", 1.0, 7.0, 2.0, 8.0, 1.0, None), (1, 9.0, 9.0, "x", 1.0, 7.0, 2.0, 8.0, 1.0, "page=1;table=1;row=1;col=1")]

    got = adapters.pdf_words(files, words)
    assert [r.error for r in got.where("error IS NOT NULL").collect()] == ["unreadable: ValueError"]
    lines = adapters.word_lines(got).orderBy("line").collect()
    assert [(r.line, r.text, r.locator, r.x0, r.y0, r.x1, r.y1, r.n_words) for r in lines] == [(1, "a b", "page=1;line=1", 1.0, 1.02, 6.0, 2.5, 2), (2, "c", "page=1;line=2", 1.0, 7.0, 2.0, 8.0, 1)]
    assert [r.locator for r in adapters.cells(got).collect()] == ["page=1;table=1;row=1;col=1"]
    assert adapters.pdf_pages(files, lambda c: ["p", c.decode()]).where("doc_id = 'b' AND page = 2").first().text == "2"
    assert adapters.layout_adapter("text") is None
    with pytest.raises(ValueError, match="unsupported"):
        adapters.layout_adapter("other")


def test_layout_benchmark(spark):
    rows = [("a", 5, 1, ["x"], ["x"], [], 1, 1, 1), ("b", 0, 0, ["x", "y"], ["x"], ["q"], 1, 1, 1), ("c", 5, 0, ["x"], ["x"], [], 1, 0, None)]
    df = spark.createDataFrame(rows, "name string, n_characters int, n_cells int, locators array<string>, replayed array<string>, quality_issues array<string>, minimum_text_characters int, minimum_table_cells int, expected_locator_count int")
    got = {r.name: (r.status, r.issues) for r in quality.layout_benchmark(df).collect()}
    assert got == {"a": ("passed", ""), "b": ("failed", "q,below_minimum_text_fidelity,below_minimum_table_cells,unexpected_locator_count,non_reproducible_locators"), "c": ("passed", "")}
