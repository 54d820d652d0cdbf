from termloom import cli
from test_engine import TEXT


def test_ddl(capsys):
    assert cli.main(["ddl"]) == 0
    assert capsys.readouterr().out.count("CREATE TABLE") == 10


def test_run(spark, tmp_path):
    land, out = tmp_path / "in", tmp_path / "out"
    land.mkdir()
    (land / "a.txt").write_text(TEXT)
    (land / "b.txt").write_text("a note")
    assert cli.run(spark, str(land), str(out)) == 2
    assert spark.read.json(f"{out}/gold_eligibility").count() == 1
    assert spark.read.json(f"{out}/promotion_errors").count() == 1
    assert spark.read.json(f"{out}/review").count() == 1
    assert spark.read.parquet(f"{out}/silver").count() == 28
    assert spark.read.json(f"{out}/packets").count() == 1 and spark.read.json(f"{out}/audit").count() == 28
    # A PDF without its tool is an error row; the others go on.
    (land / "c.pdf").write_bytes(b"%PDF")
    assert cli.run(spark, str(land), str(tmp_path / "again")) == 3
    assert "missing tool" in spark.read.json(f"{tmp_path}/again/errors").first().error
    review_and_approve(spark, str(out), tmp_path)


def review_and_approve(spark, out, tmp_path):
    said = []
    silver = cli.read_stages(spark, f"{out}/silver", cli.STAGED)
    doc = silver.first().doc_id
    assert cli.main(["review", out, doc, "--list"], say=said.append) == 0 and "<< disputed" in said[-1]
    assert cli.main(["approve", out, doc, "--reviewer", "me"], say=said.append) == 1
    wrong = [r.asDict() for r in silver.where("validator_status != 'confirmed'").orderBy("field_path").collect()]
    answers = iter(["correct", "7", "seen"] + ["c"] * (len(wrong) - 1))
    assert cli.main(["review", out, doc, "--reviewer", "me", "--pending-only"], ask=lambda _: next(answers), say=said.append) == 0
    rows = {r.extraction_id: r for r in cli.rows_under_review(spark, out, doc).collect()}
    assert len(rows) == 28 and rows[wrong[0]["extraction_id"]].corrected_value == "7" and rows[wrong[0]["extraction_id"]].corrected_by == "me"
    assert all(r.validator_status != "disputed" for r in rows.values())
    assert cli.main(["memory", out], say=said.append) == 0 and "corrected_value=7" in said[-1]
    (tmp_path / "c.json").write_text('{"corrections": [{"extraction_id": "%s", "action": "dispute", "note": "why"}], "review_seconds": 1200}' % wrong[0]["extraction_id"])
    assert cli.main(["review", out, doc, "--reviewer", "you", "--file", str(tmp_path / "c.json")], say=said.append) == 0
    assert cli.main(["timings", out], say=said.append) == 0 and "doc_id=" in said[-1]
    assert cli.main(["distill", out], say=said.append) == 0 and "## Open disputes\n- doc-" in said[-1]
    assert cli.main(["approve", out, doc, "--reviewer", "me"], say=said.append) == 1
    (tmp_path / "c.json").write_text('[{"extraction_id": "%s", "action": "confirm"}]' % wrong[0]["extraction_id"])
    assert cli.main(["review", out, doc, "--reviewer", "you", "--file", str(tmp_path / "c.json")], say=said.append) == 0
    assert cli.main(["approve", out, doc, "--reviewer", "me"], say=said.append) == 0 and spark.read.parquet(f"{out}/gold").count() >= 1
    assert cli.main(["dashboard", out], say=said.append) == 0 and "<html" in said[-1]
    assert cli.main(["regression"], say=said.append) == 0 and said[-1] == "ready: False, disputed: 0"
    import pytest

    with pytest.raises(ValueError, match="unknown_extraction"):
        cli.review(spark, out, doc, "me", [{"extraction_id": "none", "action": "confirm", "new_value": None, "note": None}])
