"""The model's contract, the stand-in and the review, against plain code."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from termloom.operators import heuristics, review, semantic
from termloom.schemas import TABLES, split_valid, table_rules
from test_engine import TEXT

DOC = "Counterparty: Bank\nAsset Class: Bonds | Haircut: 2.5% | Rating Floor: n/a | Tenor Cap: 3 years\nAsset Class: Cash | Currency: USD\n"
ROW = {"field_path": "eligibility[0].haircut_pct", "raw_value": "2.5%", "normalized_value": "2.5", "value_type": "percentage", "unit": "percent", "currency": None, "source_clause": "Asset Class: Bonds | Haircut: 2.5%", "source_locator": "line=2", "confidence": 0.9, "ambiguity_flag": False, "ambiguity_note": None}
KINDS = "doc_id string, doc_class string, language string, text string"


def answered(spark, contents, text=DOC, doc_class=semantic.ELIGIBILITY):
    docs = spark.createDataFrame([(d, doc_class, None, text) for d in contents], KINDS)
    answers = spark.createDataFrame([(d, c) for d, c in contents.items()], "doc_id string, content string")
    return docs, semantic.chunks(docs).join(answers, "doc_id")


def test_answers_that_break_the_contract(spark):
    def one(**change):
        return json.dumps({"extractions": [{k: v for k, v in (ROW | change).items() if v != "GONE"}]})

    cases = {
        "null": (None, "no_answer"), "cut": ('{"extractions": [', "invalid_json"), "list": ("[1]", "not_an_object"), "none": ("{}", "no_extractions"), "text": ('{"extractions": "x"}', "no_extractions"), "empty": ('{"extractions": []}', "no_extractions"),
        "number": ('{"extractions": [1]}', "not_an_object"), "key": (one(approved=True), "unsupported_fields"), "path": (one(field_path=" "), "field_path"), "pathtype": (one(field_path=3), "field_path"), "outside": (one(field_path="eligibility[0].price"), "outside_schema"),
        "kind": (one(value_type="money"), "value_type"), "clause": (one(source_clause="Bonds are fine"), "clause_not_verbatim"), "noclause": (one(source_clause=""), "source_clause"), "locator": (one(source_locator="GONE"), "source_locator"), "value": (one(normalized_value=""), "normalized_value"),
        "valuetype": (one(normalized_value=2.5), "normalized_value"), "raw": (one(raw_value=2.5), "raw_value"), "confidence": (one(confidence="0.9"), "confidence"), "bool": (one(confidence=True), "confidence"), "flag": (one(ambiguity_flag="no"), "ambiguity_flag"), "note": (one(ambiguity_note=3), "ambiguity_note"),
        "unit": (one(unit=1), "unit"), "currency": (one(currency=[1]), "currency"), "twice": (json.dumps({"extractions": [ROW, ROW]}), "duplicate_path"), "good": (one(), None), "whole": (one(confidence=1), None), "nounit": (one(unit="GONE", currency="GONE", ambiguity_note="GONE", raw_value=""), None),
        "gap": (one(value_type="not_found", normalized_value="GONE", source_clause="nowhere"), None),
    }
    docs, answers = answered(spark, {k: v[0] for k, v in cases.items()})
    rows, errors = semantic.extractions(answers, docs, "m-1")
    assert {r.doc_id: r.error for r in errors.collect()} == {k: e for k, (_, e) in cases.items() if e}
    got = {r.doc_id: r for r in rows.collect()}
    assert set(got) == {k for k, (_, e) in cases.items() if not e}
    assert got["gap"].normalized_value == "not_found" and got["good"].extractor_version == "m-1-eligibility-1.1.0" and got["whole"].confidence == 1.0 and got["good"].validator_status == "pending"


def test_valuation_chunks_offsets_and_repair(spark):
    text = "Menu\nCollateral Valuation\nLast Updated: 7.3.2026\nSecurities Valuation and Margins Table\nBonds 99 98 97 96 95\nNotes  89 88 87 86 85\nBills 79 78 77 76 75\nLoan Valuation and Margins Tables\nLoans 50 50 50 50 50\n"
    docs = spark.createDataFrame([("v", semantic.VALUATION, "en", text), ("w", semantic.VALUATION, "en", "no table here"), ("x", "other", None, "plain")], KINDS)
    parts = {(r.doc_id, r.chunk_index): r for r in semantic.chunks(docs).collect()}
    assert sorted(parts) == [("v", 0), ("v", 1), ("w", 0), ("x", 0)]
    assert parts["v", 1].field_index_offset == 5 and parts["v", 1].chunk.endswith("\nNotes  89 88 87 86 85") and parts["w", 0].chunk == "no table here" and parts["x", 0].language == "und"
    shown = docs.select("doc_id", semantic.prepared(F.col("doc_class"), F.col("text")).alias("t")).where("doc_id = 'v'").first().t
    assert shown.split("\n")[3:] == ["Last Updated: 7.3.2026", "Bonds 99 98 97 96 95", "Notes  89 88 87 86 85"]
    row = ROW | {"field_path": "valuation_margin[0].collateral_value_pct", "source_clause": "made up", "normalized_value": "89"}
    content = {"by line": row | {"source_locator": "Line: 4"}, "by group": row | {"source_locator": "somewhere", "field_path": "valuation_margin[4].collateral_value_pct"}, "neither": row | {"source_locator": "line 1", "field_path": "valuation_margin[5].collateral_value_pct"}}
    for name, r in content.items():
        answers = semantic.chunks(docs).where("doc_id = 'v' AND chunk_index = 1").withColumn("content", F.lit(json.dumps({"extractions": [r]})))
        rows, errors = semantic.extractions(answers, docs, "m")
        if name == "neither":
            assert rows.count() == 0 and errors.first().error == "clause_not_verbatim"
        else:
            got = rows.first()
            assert got.source_clause == "Notes  89 88 87 86 85" and got.field_path.startswith("valuation_margin[5]" if name == "by line" else "valuation_margin[9]")


def test_judgments_that_break_the_contract(spark):
    docs, answers = answered(spark, {d: json.dumps({"extractions": [ROW, ROW | {"field_path": "eligibility[1].asset_criterion", "value_type": "string"}]}) for d in "abcdefghi"})
    silver, _ = semantic.extractions(answers, docs, "m")
    silver = silver.cache()
    ids = {}
    for r in silver.orderBy("field_path").collect():
        ids.setdefault(r.doc_id, []).append(r.extraction_id)

    def judged(d, *changes):
        base = {"status": "confirmed", "evidence_clause": "Haircut: 2.5%", "evidence_locator": "line=2", "corrected_value": None, "note": None}
        return json.dumps({"judgments": [base | {"extraction_id": i} | c for i, c in zip(ids[d], changes)]})

    contents = {
        "a": judged("a", {}, {"status": "corrected", "corrected_value": "x", "evidence_clause": "[FIELD NOT FOUND]"}), "b": judged("b", {}), "c": judged("c", {}, {"status": "pending"}), "d": judged("d", {}, {"evidence_clause": "nowhere"}), "e": judged("e", {}, {"status": "corrected"}),
        "f": judged("f", {}, {"approve": True}), "g": judged("g", {}, {"extraction_id": ids["g"][0]}), "h": judged("h", {}, {"extraction_id": "other"}), "i": judged("i", {"status": "disputed"}, {"evidence_locator": "x"}),
    }
    told = spark.createDataFrame([(d, c, "p", "m") for d, c in contents.items()], "doc_id string, content string, provider string, model string")
    rows, errors = semantic.judgments(told, docs, silver)
    wrong = {}
    for r in errors.collect():
        wrong.setdefault(r.doc_id, set()).add(r.error)
    assert wrong == {"b": {"not_judged"}, "c": {"pending"}, "d": {"evidence_not_verbatim"}, "e": {"corrected_value"}, "f": {"unsupported_fields"}, "g": {"judged_twice", "not_judged"}, "h": {"not_judged", "unknown_row"}}
    got = {(r.doc_id, r.field_path): (r.validator_status, r.corrected_value, r.corrected_by) for r in rows.collect()}
    assert got == {("a", ROW["field_path"]): ("confirmed", None, None), ("a", "eligibility[1].asset_criterion"): ("corrected", "x", "semantic-validator:p/m"), ("i", ROW["field_path"]): ("disputed", None, None), ("i", "eligibility[1].asset_criterion"): ("confirmed", None, None)}
    with pytest.raises(ValueError, match="separate"):
        semantic.validation_requests(docs, silver, "s", "s")
    asked = semantic.validation_requests(docs, silver, "s2", "s1").where("doc_id = 'a'").first()
    assert len(json.loads(asked.user_payload)["candidate_rows"]) == 2 and asked.role == "validator"


def test_calls_retry_and_are_audited(spark):
    docs = spark.createDataFrame([("d", "collateral_eligibility_schedule", "en", DOC)], KINDS)
    requests = semantic.extraction_requests(semantic.chunks(docs), "s1")
    model = semantic.Model("local", "echo", lambda system, payload, schema: (json.dumps({"n": len(schema["properties"]["extractions"]["items"]["required"])}), "r1", {"input_tokens": 3}))
    got = semantic.called(requests, model).first()
    assert json.loads(got.content)["n"] == 11 and got.response_id == "r1" and got.input_tokens == 3 and got.total_tokens is None and got.call_error is None

    def fails(system, payload, schema):
        raise semantic.Transient("busy", 503)

    got = semantic.called(requests, semantic.Model("local", "echo", fails, retries=1, delay_seconds=0)).first()
    assert got.content is None and "failed closed" in got.call_error
    tries = []

    def second(system, payload, schema):
        tries.append(1)
        if len(tries) < 2:
            raise semantic.Transient("slow")
        return "{}", "x", {}

    assert semantic.Model("p", "m", second, delay_seconds=0).called("", "", {})[0] == "{}" and len(tries) == 2
    tries.clear()

    def refused(system, payload, schema):
        tries.append(1)
        raise semantic.Transient("no", 401)

    with pytest.raises(RuntimeError, match="closed"):
        semantic.Model("p", "m", refused, delay_seconds=0).called("", "", {})
    assert len(tries) == 1
    audit = semantic.audit_records(semantic.called(requests, model), F.lit(dt.datetime(2026, 1, 1))).first().asDict()
    assert len(audit["request_hash"]) == 64 and audit["schema_version"] == "eligibility-1.0.0" and not any("Bank" in str(v) for v in audit.values())
    assert semantic.chat_answer({"id": "i", "choices": [{"message": {"content": "c"}}], "usage": {"prompt_tokens": 2, "total_tokens": True}}) == ("c", "i", {"input_tokens": 2})
    with pytest.raises(ValueError, match="content"):
        semantic.chat_answer({"choices": []})
    for bad in ((None, "k"), ("http://x", None)):
        with pytest.raises(ValueError, match="address"):
            semantic.chat_model("other", "m", *bad)
    semantic.Policy("openai", "zero-data-retention", True).require()
    for p in (semantic.Policy("openai", "zero-data-retention", False), semantic.Policy("x", "zero-data-retention", True), semantic.Policy("openai", "days", True)):
        with pytest.raises(ValueError):
            p.require()


def test_stand_in(spark):
    docs = spark.createDataFrame([("d", "c", None, DOC), ("n", "c", None, "nothing"), ("v", semantic.VALUATION, None, "Collateral Valuation\nFederal Reserve  Bank of X\nSecurities Valuation and Margins Table\nDuration buckets 10 20 30 40 50\n7 Bonds 99 98 97 96 95\n")], KINDS)
    got = {(r.doc_id, r.field_path): (r.normalized_value, r.value_type) for r in heuristics.asset_rows(docs).collect()}
    assert got["d", "eligibility[0].haircut_pct"] == ("2.5", "percentage") and got["d", "eligibility[0].tenor_cap_days"] == ("1095", "integer") and ("d", "eligibility[0].rating_floor") not in got
    assert got["d", "eligibility[1].currency_scope"] == ("USD", "string_array") and got["d", "eligibility[1].counterparty"] == ("Bank", "string") and got["d", "eligibility[1].valid_from"] == ("not_found", "not_found")
    page = {r.field_path: r for r in heuristics.valuation_rows(docs).collect()}
    assert page["document.publisher"].source_clause == "Federal Reserve  Bank of X" and page["valuation_margin[4].implied_haircut_pct"].normalized_value == "5" and page["valuation_margin[0].asset_category"].normalized_value == "7 Bonds"
    assert "valuation_margin[5].asset_category" not in page and "valuation_margin[4].duration_max_years" not in page
    answers = semantic.chunks(docs.withColumn("doc_class", F.lit(semantic.ELIGIBILITY)).where("doc_id != 'v'")).join(heuristics.extraction_answers(docs), "doc_id", "left")
    silver, errors = semantic.extractions(answers, docs, "m")
    assert [r.doc_id for r in errors.collect()] == ["n"]
    rows, errors = semantic.judgments(heuristics.judgment_answers(docs, silver).withColumn("provider", F.lit("local")).withColumn("model", F.lit("m")), docs, silver)
    assert errors.count() == 0 and rows.where("validator_status = 'confirmed'").count() == silver.count() > 10


def silver_of(spark):
    from termloom.operators.extract import validated

    return validated(spark.createDataFrame([("d<1", TEXT)], "doc_id string, text string"))


def test_packets_listing_and_gate(spark):
    silver = silver_of(spark)
    p = review.packets(silver).first()
    rows = json.loads(p.json)
    assert len(rows) == silver.count() and {"doc_id", "corrected_value"} <= set(rows[0]) and "<h1>Review of d&lt;1</h1>" in p.page and p.page.count("<tr>") == len(rows) + 1 and '<td class="disputed">disputed</td>' in p.page
    one = silver.where("validator_status = 'disputed'").first()
    hints = spark.createDataFrame([(one.extraction_id, 3, "fix")], "extraction_id string, n long, suggested_value string")
    text = review.listing(silver, hints).first().listing
    assert "[ 1] " in text and "  << disputed" in text and "↳ memory: previously corrected to 'fix' (3×)" in text
    good, bad = review.decide(silver, "me", True, F.current_timestamp())
    assert good.count() == 0 and bad.first().problem == "pending_or_disputed"
    assert review.decide(silver, "me", False, F.current_timestamp())[0].first().approved is False
    with pytest.raises(ValueError, match="reviewer"):
        review.decide(silver, " ", True, F.current_timestamp())
    assert review.pending(silver).count() == silver.where("validator_status = 'disputed'").count() > 0
    assert review.audit_appendix(silver).columns == review.APPENDIX
    page = review.dashboard(silver.withColumn("doc_id", F.lit("<b>")), "T & Co")
    assert "<title>T &amp; Co</title>" in page and "<td>&lt;b&gt;</td>" in page and page.count('class="tile"') == 6 and "100.000%" not in page


def test_review_loop_and_files(spark):
    rows = [{"extraction_id": str(i), "field_path": f"f{i}", "normalized_value": "v", "corrected_value": None, "validator_status": s, "source_locator": "l", "source_clause": "c"} for i, s in enumerate(["pending", "confirmed", "disputed", "pending", "pending", "pending"])]
    answers = iter(["c", "o", "", "o", "new", "why", "x", "d", "", "d", "bad", "s", "q"])
    said = []
    got = review.review_loop(rows, lambda _: next(answers), said.append)
    assert [(r["extraction_id"], r["action"], r["new_value"], r["note"]) for r in got] == [("0", "confirm", None, None), ("1", "correct", "new", "why"), ("2", "dispute", None, "bad")]
    answers = iter(["correct", "", "", "q"])
    assert review.review_loop(rows[1:4], lambda _: next(answers), said.append, True, {"2": ("mem", 2)})[0]["new_value"] == "mem"
    assert review.requests_of('[{"extraction_id": "1", "action": "confirm"}]') == ([{"extraction_id": "1", "action": "confirm", "new_value": None, "note": None}], None)
    assert review.requests_of('{"corrections": [{"extraction_id": "1", "action": "correct", "corrected_value": "v"}], "review_seconds": 30}')[1] == 30.0
    for bad in ("[]", "{}", '{"corrections": []}'):
        with pytest.raises(ValueError):
            review.requests_of(bad)
    counts = {r.action: r.n for r in review.action_counts(spark.createDataFrame([("1", "correct")], "extraction_id string, action string")).collect()}
    assert counts == {"confirm": 0, "correct": 1, "dispute": 0}
    times = spark.createDataFrame([("a", 100.0), ("b", 1000.0), ("c", 2000.0)], "doc_id string, s double")
    assert [r.doc_id for r in review.over_target(times, "s").collect()] == ["c", "b"]
    told = review.distilled_markdown([{"kind": "normalization", "schema": "e", "suffix": "f", "previous_value": "a", "targets": "b", "n": 2, "reviewers": "r"}], 4, [], 9)
    assert "- **e.f**: normalise `a` to `b`, 2×, by r" in told and told.endswith("_None._\n")


def test_tables_keep_their_rules(spark):
    assert len(TABLES) == 10
    rows = spark.createDataFrame([("a", "landed", dt.datetime(2026, 1, 1), None), ("b", "lost", dt.datetime(2026, 1, 1), None), (None, "landed", dt.datetime(2026, 1, 1), None)], TABLES["workflow_tasks"][0])
    good, bad = split_valid(rows, table_rules("workflow_tasks"))
    assert [r.doc_id for r in good.collect()] == ["a"] and sorted(r.rule for r in bad.collect()) == ["missing:doc_id", "valid_task_status"]


def test_answers_are_parsed_once_for_rows(spark):
    """Silver rows come from one parse of the answers' items; another is only for answers without any."""
    from termloom.plans import queries

    plan = queries.QUERIES["semantic_extractions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode(list") == 1
