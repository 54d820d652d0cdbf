import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from termloom.operators import classify, extract, gold, learning, platinum, quality, recall, review, tables, workflow
from termloom.schemas import TABLES, ddl, silver_rules, split_valid
from termloom.plans import queries
from termloom.sources import bronze
from termloom.sources.store import Conflict, SnapshotTable, append_log, latest_stage, passed_layouts, read_json, read_layouts, read_log, read_stages, write_json, write_once, write_per_document, write_sorted, write_stage

TEXT = """Collateral Eligibility Schedule
Eligible Collateral
Counterparty: First Bank
Agreement ID: A-1
Schedule Version: 2
Margin Type: vm
Valid From: 2026-07-01
Asset: US Treasuries | Eligible: yes | Haircut: 2% | Currencies: usd, eur | Tenor Cap Days: 365
Asset: Equities | Eligible: Y | Haircut: 150%
"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("d1", TEXT), ("d2", "nothing here"), ("d3", TEXT + "Counterparty: Second\n")], "doc_id string, text string")


def test_classify(spark, docs):
    got = {r.doc_id: r for r in classify.classify(docs).collect()}
    assert (got["d1"].doc_class, round(got["d1"].confidence, 6), got["d1"].review_required, got["d1"].profile) == (classify.ELIGIBILITY, 0.8, False, "normalized")
    assert got["d2"].doc_class == "unknown" and got["d2"].review_required
    public = spark.createDataFrame([("CME Group\nAcceptable Performance Bond Collateral\nHaircut Schedule",)], "text string")
    assert classify.classify(public).first().profile == "cme"


def test_extract_and_validate(docs):
    rows = extract.extract(docs)
    assert rows.groupBy("doc_id").count().orderBy("doc_id").collect() == [("d1", 28), ("d3", 28)]
    assert [r.doc_id for r in extract.extract_errors(docs).collect()] == ["d2"]
    v = {(r.doc_id, r.field_path): r for r in extract.validate(docs, rows).collect()}
    assert v["d1", "eligibility[0].currency_scope"].normalized_value == "USD,EUR"
    assert v["d1", "eligibility[0].margin_type"].normalized_value == "VM"
    assert v["d1", "eligibility[0].valid_to"].value_type == "not_found" and v["d1", "eligibility[0].valid_to"].validator_status == "confirmed"
    assert v["d1", "eligibility[1].haircut_pct"].validator_status == "disputed"
    # Two headers: the extractor takes the last, the second derivation the first.
    assert v["d3", "eligibility[0].counterparty"].normalized_value == "Second"
    assert v["d3", "eligibility[0].counterparty"].validator_status == "disputed"


def test_promotion_and_errors(docs):
    v = extract.validate(docs, extract.extract(docs))
    terms = gold.promote_eligibility(v).collect()
    assert [(t.doc_id, t.idx, t.eligible, t.haircut_pct, t.currency_scope) for t in terms] == [("d1", 0, True, 2.0, ["USD", "EUR"])]
    assert len(terms[0].silver_extraction_ids) == 14 and terms[0].silver_extraction_ids == sorted(terms[0].silver_extraction_ids)
    errors = {(r.doc_id, r.idx): r.error for r in gold.eligibility_groups(v).where("error is not null").collect()}
    assert errors == {("d1", 1): "unsettled", ("d3", 0): "unsettled", ("d3", 1): "unsettled"}
    twice = v.where("doc_id = 'd1' and field_path like 'eligibility[0]%'")
    assert gold.eligibility_groups(twice.unionByName(twice.where("field_path like '%asset_criterion'"))).first().error == "duplicate_field"


def test_versions_close_and_as_of(spark):
    ts = lambda d: dt.datetime(2026, 7, d)
    kinds = "n int, k string, j string, knowledge_from timestamp"
    rows = spark.createDataFrame([(1, "a", None, ts(1)), (2, "a", None, ts(5)), (3, "b", "x", ts(2)), (4, "b", "x", ts(2)), (5, "a", None, ts(3)), (6, "a", None, ts(7))], kinds)
    good, bad = gold.close_versions(rows, ["k", "j"], ["n"])
    # Of equal times the first stays open; a backdated version is refused and closes nothing.
    assert sorted((r.n, r.knowledge_to) for r in good.collect()) == [(1, ts(5)), (2, ts(7)), (3, None), (6, None)]
    assert sorted(r.n for r in bad.collect()) == [4, 5]
    assert [r.knowledge_from for r in gold.as_of(good.where("k = 'a'"), F.lit(ts(5))).collect()] == [ts(5)]
    assert sorted(r.n for r in gold.active(good).collect()) == [3, 6]
    # A version that is closed already bars no later one.
    shut = rows.withColumn("knowledge_to", F.when(F.col("n") == 2, F.lit(ts(6))))
    good, bad = gold.close_versions(shut, ["k", "j"], ["n"])
    assert sorted((r.n, r.knowledge_to) for r in good.where("k = 'a'").collect()) == [(1, ts(3)), (2, ts(6)), (5, ts(7)), (6, None)]
    rng = __import__("random").Random(3)
    many = [(n, rng.choice("ab"), None, ts(rng.randint(1, 28))) for n in range(60)]
    kept: dict = {}
    for n, k, _, t in many:
        held = kept.setdefault(k, [])
        if not held or t > held[-1][1]:
            if held:
                held[-1][2] = t
            held.append([n, t, None])
    good, bad = gold.close_versions(spark.createDataFrame(many, kinds), ["k", "j"], ["n"])
    assert sorted((r.n, r.knowledge_to) for r in good.collect()) == sorted((n, to) for v in kept.values() for n, _, to in v)
    assert bad.count() == 60 - good.count()


def test_snapshot_store(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), "k string, knowledge_from timestamp, knowledge_to timestamp")
    assert t.read().count() == 0
    one = spark.createDataFrame([("a", dt.datetime(2026, 7, 1), None)], t.schema)
    t.upsert(one, ["k"], ["knowledge_from"])
    t.upsert(spark.createDataFrame([("a", dt.datetime(2026, 7, 5), None)], t.schema), ["k"], ["knowledge_from"])
    assert t.version() == 1 and t.read(0).count() == 1
    assert sorted(r.knowledge_to is None for r in t.read().collect()) == [False, True]
    for day in (5, 3):
        with pytest.raises(ValueError, match="later"):
            t.upsert(spark.createDataFrame([("a", dt.datetime(2026, 7, day), None)], t.schema), ["k"], ["knowledge_from"])
    # Of two writers that began from one version the second is refused.
    t.commit(one, 1)
    with pytest.raises(Conflict):
        t.commit(one, 1)
    assert t.version() == 2 and t.read().count() == 1


def test_stages_logs_json(spark, tmp_path):
    rows = spark.createDataFrame([("d1", "c", 1), ("d2", "c", 2)], "doc_id string, doc_class string, v int")
    path = str(tmp_path / "s")
    write_stage(rows, path, "validated")
    write_stage(rows.where("doc_id = 'd1'").withColumn("v", F.lit(9)), path, "reviewed")
    kinds = "doc_id string, doc_class string, v int"
    got = {(r.doc_id, r.v) for r in latest_stage(read_stages(spark, path, kinds)).collect()}
    assert got == {("d1", 9), ("d2", 2)}
    # Rows of one document replace its own, and none of another of the class and stage.
    for d in range(3, 90):
        if d < 6:
            write_stage(spark.createDataFrame([(f"d{d}", "c", d), (f"d{d}", "c", d + 1)], kinds), path, "validated")
    write_stage(spark.createDataFrame([(f"d{d}", "c", d) for d in range(6, 200)] + [("d2", "c", 7)], kinds), path, "validated")
    got = sorted((r.doc_id, r.v) for r in read_stages(spark, path, kinds).where("stage = 'validated'").collect())
    assert got == sorted([("d1", 1), ("d2", 7)] + [(f"d{d}", d + k) for d in (3, 4, 5) for k in (0, 1)] + [(f"d{d}", d) for d in range(6, 200)])
    assert read_stages(spark, str(tmp_path / "none"), kinds).count() == 0
    with pytest.raises(ValueError, match="no silver"):
        write_stage(rows.where("false"), path, "validated")
    append_log(rows, str(tmp_path / "log"))
    append_log(rows, str(tmp_path / "log"))
    assert read_log(spark, str(tmp_path / "log"), kinds).count() == 4 and read_log(spark, str(tmp_path / "log"), kinds, "d1").count() == 2
    assert read_log(spark, str(tmp_path / "nolog"), kinds).count() == 0
    write_sorted(rows, str(tmp_path / "m"), ["v"])
    assert [r.v for r in spark.read.parquet(str(tmp_path / "m")).collect()] == [1, 2]
    write_per_document(rows, str(tmp_path / "calls"))
    write_per_document(rows.where("doc_id = 'd1'").withColumn("v", F.lit(5)), str(tmp_path / "calls"))
    assert sorted(r.v for r in spark.read.json(str(tmp_path / "calls")).collect()) == [2, 5]
    assert write_once(spark, str(tmp_path / "w/a.txt"), b"abc") and not write_once(spark, str(tmp_path / "w/a.txt"), b"abc")
    with pytest.raises(ValueError, match="may not change"):
        write_once(spark, str(tmp_path / "w/a.txt"), b"abd")
    write_json(rows, str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j"), "doc_id string, doc_class string, v int").count() == 2


def test_layout_files(spark, tmp_path):
    page = lambda c, *texts: {"page": 1, "width": 1.0, "height": 1.0, "lines": [{"line": i, "text": t, "locator": "x", "confidence": c, "tokens": []} for i, t in enumerate(texts)]}
    for name, adapter, pages, quality in (("a", "text", [page(1.0, "x")], None), ("b", "tesseract-ocr", [page(0.85, "x")], None), ("c", "text", [page(0.85, "x")], None), ("d", "text", [page(1.0)], None), ("e", "text", [page(1.0, "x")], {"status": "failed", "mean_confidence": 0.1, "issues": ["z"]})):
        (tmp_path / f"{name}.json").write_text(__import__("json").dumps({"doc_id": name, "adapter": adapter, "adapter_version": "1", "pages": pages} | ({"quality": quality} if quality else {})))
    good, bad = passed_layouts(read_layouts(spark, str(tmp_path)))
    assert sorted(r.doc_id for r in good.collect()) == ["a", "b"]
    assert sorted((r.doc_id, r.problem) for r in bad.collect()) == [("c", "low_layout_confidence"), ("d", "no_text_coordinates,missing_reading_order,low_layout_confidence"), ("e", "z")]


def test_landing_and_ingest(spark, tmp_path):
    for name, body in (("a.txt", "x"), ("b.md", "x"), ("README.md", "r"), (".hidden.txt", "h"), ("c.csv", "c"), ("d.PDF", "p")):
        (tmp_path / name).write_text(body)
    files = bronze.landing(spark, str(tmp_path))
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == ["a.txt", "b.md", "d.PDF"]
    got = bronze.ingest(files, "content", "received_at").collect()
    assert sorted(r.n_received for r in got) == [1, 2] and all(r.doc_id.startswith("doc-") and len(r.doc_id) == 28 for r in got)


def test_layout(spark):
    d = spark.createDataFrame([("d", "a b\n\nc\f\fz")], "doc_id string, text string")
    got = [(r.page, r.line, r.n_tokens) for r in bronze.layout_lines(d).orderBy("page", "line").collect()]
    assert got == [(1, 1, 2), (1, 2, 0), (1, 3, 1), (3, 1, 1)]
    q = bronze.layout_quality(d).first()
    assert (q.n_pages, q.n_lines, q.status, q.issues) == (3, 4, "failed", "missing_reading_order")


def test_line_clustering_is_a_loop(spark):
    rng = random.Random(1)
    words = [(p, f"w{i}", rng.random() * 50, y := rng.random() * 60, 0.0, y + 4, 0.5) for p in range(6) for i in range(20)]
    df = spark.createDataFrame(words, "page int, text string, x0 double, y0 double, x1 double, y1 double, confidence double")
    got = {(r.page, r.line): r.text for r in bronze.clustered_lines(df, "page").collect()}
    want = {}
    for p in range(6):
        lines, cur = [], []
        for w in sorted((w for w in words if w[0] == p), key=lambda w: ((w[3] + w[5]) / 2, w[2])):
            c = (w[3] + w[5]) / 2
            if cur and abs(c - sum((x[3] + x[5]) / 2 for x in cur) / len(cur)) > 6:
                lines.append(cur)
                cur = []
            cur.append(w)
        lines.append(cur)
        want |= {(p, i + 1): " ".join(w[1] for w in sorted(line, key=lambda w: w[2])) for i, line in enumerate(lines)}
    assert got == want


def test_percent_table(spark):
    text = "Start\nSecurity Type Remaining Maturity Haircut\nTreasury Bills\nwith short terms\n0-1 2%\nzero to 1 year remaining 3%\nrated AA or better 4%\nDebentures 5.5%\nZ 7%\nAgency notes 8%\nend here\n9%"
    d = spark.createDataFrame([("d", text)], "doc_id string, text string")
    got = [(r.entry, r.description, r.haircut) for r in tables.percent_entries(d, tables.section(F.col("text"), "Security", "end here")).orderBy("entry").collect()]
    head = "Treasury Bills with short terms "
    assert got == [(1, head + "0-1", "2"), (2, head + "zero to 1 year remaining", "3"), (3, head + "rated AA or better", "4"), (4, "Debentures", "5.5"), (5, "Debentures Z", "7"), (6, "Debentures Agency notes", "8")]


def test_reindexed(spark):
    d = spark.createDataFrame([("limit[2].x[1]", 5), ("plain", 5)], "p string, n int")
    assert [r[0] for r in d.select(tables.reindexed(F.col("p"), F.col("n"))).collect()] == ["limit[7].x[1]", "plain"]


def test_wildcards_equal_theta_join(spark):
    rng = random.Random(2)
    pick = lambda n: rng.choice([None, *"abcd"[:n]])
    keys = spark.createDataFrame({(pick(4), pick(4)) for _ in range(30)}, "counterparty string, agreement_id string")
    rows = spark.createDataFrame([(pick(4), pick(4), i) for i in range(60)], "counterparty string, agreement_id string, id int")
    r = rows.withColumnsRenamed({"counterparty": "c", "agreement_id": "a"})
    theta = keys.crossJoin(r).where("(c is null or c = counterparty) and (a is null or a = agreement_id)").select("counterparty", "agreement_id", "id")
    got = platinum.wildcard_join(keys, rows.withColumn("exact", F.lit(False)))
    assert sorted(map(str, got.collect())) == sorted(map(str, theta.collect()))


def test_corrections(spark, docs):
    rows = extract.extract(docs).where("doc_id = 'd1'")
    ids = [r.extraction_id for r in rows.orderBy("field_path").limit(3).collect()]
    req = spark.createDataFrame([(ids[0], "correct", "X", "me"), (ids[1], "dispute", None, "me"), ("none", "confirm", None, "me"), (ids[2], "correct", None, "me"), (ids[1], "confirm", None, "me")], "extraction_id string, action string, new_value string, reviewer string")
    codes = {(r.extraction_id, r.code) for r in learning.correction_errors(rows, req).collect()}
    assert codes == {("none", "unknown_extraction"), (ids[1], "duplicate_request"), (ids[2], "missing_value")}
    out = {r.extraction_id: r for r in learning.apply_corrections(rows, req.limit(2)).collect()}
    assert (out[ids[0]].validator_status, out[ids[0]].corrected_value, out[ids[0]].corrected_by) == ("corrected", "X", "me")
    assert out[ids[1]].validator_status == "disputed" and out[ids[2]].validator_status == "pending"


def test_rules_of_silver(docs):
    rows = extract.extract(docs)
    good, bad = split_valid(rows.withColumn("confidence", F.when(F.col("field_path").contains("eligible"), 2.0).otherwise(F.col("confidence"))), silver_rules())
    assert {r.rule for r in bad.collect()} == {"confidence_range"} and good.count() + bad.count() == rows.count()
    assert all(ddl(n).startswith("CREATE TABLE") for n in TABLES)


def test_quality_of_nothing(spark):
    none = spark.createDataFrame([], "case_id string, field_path string, expected string, actual string, locator string")
    r = quality.accuracy(none, []).first()
    assert (r.n, r.accuracy) == (0, 0.0)
    assert quality.release_gate(none, F.lit(True)).first().ready is False
    assert "<ul>" in review.dashboard(extract.extract(spark.createDataFrame([], "doc_id string, text string")))


def test_states_fold_is_a_loop(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.choice(workflow.STATES[:4] + ["failed"])) for k in range(20) for i in range(12)]
    got = {r.k: (r.state, r.refused) for r in workflow.folded_states(spark.createDataFrame(rows, "k int, i int, s string"), "k", "i", "s").collect()}
    for k in range(20):
        state, refused = "", 0
        for _, _, s in [r for r in rows if r[0] == k]:
            if (state, s) in workflow.STEPS or (state, s) == ("", "landed"):
                state = s
            else:
                refused += 1
        assert got[k] == (state, refused)


def test_recall(spark):
    p = spark.createDataFrame([(0.0999,), (0.1,), (0.25,), (0.5,), (1.1,), (None,)], "p double")
    assert [r[0] for r in p.select(recall.band(F.col("p"))).collect()] == ["LOW", "MODERATE", "HIGH", "CRITICAL", None, None]
    loans = spark.createDataFrame([(1,)], "loan int")
    got = recall.predictions(loans, {1: F.lit(0.12), 3: F.lit(0.27), 5: F.lit(0.41), 10: F.lit(0.63)}, F.array(F.lit("A"))).first()
    assert (got.band, got.reasons.split(",")[0], len(got.reasons.split(","))) == ("CRITICAL", "A", 3)
    with pytest.raises(ValueError, match="horizons"):
        recall.predictions(loans, {1: F.lit(0.1)}, F.array())


def test_requests_tasks_and_order(spark):
    asked = spark.createDataFrame([("a", ["1"], [1, 5]), ("b", [], None), ("c", ["1"], [2, 3]), ("d", ["1"], None)], "k string, loan_ids array<string>, horizons array<int>")
    assert {r.k: r.problem for r in recall.request_problems(asked).collect()} == {"a": None, "b": "no_loans", "c": "unsupported horizons: 2", "d": None}
    tasks = spark.createDataFrame([("t", "landed")], "doc_id string, status string")
    assert workflow.task_of(tasks, "doc_id", "t").count() == 1 and workflow.task_of(tasks, "doc_id", "u").count() == 0
    sets = spark.createDataFrame([("b", None), (None, "z"), ("a", "y"), ("a", None)], "counterparty string, agreement_id string")
    assert [tuple(r) for r in platinum.ordered(sets).collect()] == [(None, "z"), ("a", None), ("a", "y"), ("b", None)]
    docs = spark.createDataFrame([("d", "e\nRated A\fx\nEligible assets of the first class, whatever they are and however long", "Eligible assets of the first class, whatever they are and however long"), ("d", "a\fb c", "b  c"), ("d", "a", "zz")], "doc_id string, text string, clause string")
    got = [r.l for r in docs.select(extract.locator(extract.page_index(F.col("text")), F.col("clause")).alias("l")).collect()]
    assert got[0].startswith("page=2;anchor_sha256=") and got[1:] == ["page=2;line=1", "document=all;locator_unresolved"]


def test_locator_index_holds_only_lines_that_can_be_met(spark):
    long = "x" * 49
    doc = spark.createDataFrame([(f"{long}\nasset  one\n\n{'y' * 48}", f"asset one {long}")], "text string, clause string")
    assert [x.t for x in doc.select(extract.page_index(F.col("text")).alias("p")).first().p[0].lines] == ["asset one", "y" * 48]
    told = doc.select(*[extract.locator(extract.page_index(F.col("text")), c).alias(k) for k, c in (("a", F.lit("asset\tone")), ("b", F.lit(long)), ("c", F.col("clause")), ("d", F.lit(None).cast("string")), ("e", F.lit("y" * 48)))]).first()
    assert (told.a, told.c, told.d, told.e) == ("page=1;line=2", "document=all;locator_unresolved", "document=all;locator_unresolved", "page=1;line=4") and told.b.startswith("page=1;anchor_sha256=")


def test_groups_held_makes_no_rows(spark):
    """A text's first path says what all its silver rows say, and no row of them is made or sorted for it."""
    texts = ["Asset: X", "Head: a\r\n  aSSet: X\nASSET: Y", "none: Asset: X", "", "a\u2028Asset: X", "a\x0basset:", "Asset : X", "\tAsset: X", "a\u0085aßet: X", "aẞet: X", "Asset", "a\nb\n", "a\x1cAsset: X\n"]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)] + [("d0", "no line"), ("d3", "Asset: Z"), ("n", None)], "doc_id string, text string")
    want = sorted(map(tuple, gold.groups_held(extract.extract(docs)).collect()))
    assert len(want) == 8
    assert sorted(map(tuple, gold.groups_held(extract.first_paths(docs)).collect())) == want
    plan = queries.QUERIES["groups_held"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "rlike" in plan.lower()


def test_evidence_is_looked_up_once_a_document(spark):
    """Verdicts are those of rows that stand beside their texts, and no row carries a text."""
    text = "Eligible  Things\r\nBonds of the State 5%\nrated AA / Aa2 or\nmore Straße\n"
    docs = spark.createDataFrame([("a", text), ("b", "Nothing here\nBonds 5%"), ("c", None), ("e", "")], "doc_id string, text string")
    fields = ["asset_criterion", "eligible", "haircut_pct", "rating_floor", "concentration_basis", "valid_from", "counterparty"]
    clauses = ["bonds of  the state 5%", "Eligible Things Bonds of", "Bonds 5%", "more STRASSE", "nowhere", "", None]
    raws = [("5%", "5"), ("AA / Aa2", "true"), ("AA / Aa3", "150"), ("", "x"), ("Bonds State", "2024-01-01"), (None, None)]
    rows = [(d, f"eligibility[0].{f}", r, v, k, c, "pending") for d in "abcez" for f in fields for c in clauses for r, v in raws for k in ("string", "not_found")]
    silver = spark.createDataFrame(rows, "doc_id string, field_path string, raw_value string, normalized_value string, value_type string, source_clause string, validator_status string")
    beside = silver.join(extract.folded_texts(docs), F.col("doc_id") == F.col("_d")).withColumn("field", F.substring_index("field_path", ".", -1)).withColumn("value", F.col("normalized_value"))
    ok = (F.col("value_type") == "not_found") | F.col("supported")
    want = extract.evidence_verdict(beside).withColumn("validator_status", F.when(ok, "confirmed").otherwise("disputed")).select(*silver.columns)
    got = extract.evidence_validated(docs, silver)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    found = got.where("value_type = 'string'")
    assert 0 < found.where("validator_status = 'confirmed'").count() < found.count()
    marked = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in marked.splitlines() if "folded" in x and "raw_value" in x]

def test_answers_are_covered_as_rows_are(spark):
    """Answers that hold their rows' judgments tell what the join of all rows and all judgments tells, and move nothing."""
    answers = [(["a", "b"], ["a", "b"]), (["c", "d"], []), (["e", "f"], ["f", "e"]), (["g", "h"], ["h", "h", "h"]), (["i"], ["x", "i", "x", "y"]), ([], ["z", "z"]), ([], []), (["j", "k"], ["j", "k", "j", "k"])]
    df = spark.createDataFrame(answers, "asked array<string>, judged array<string>")
    rows, judged = (df.select(F.explode(c).alias("extraction_id")) for c in ("asked", "judged"))
    want = sorted(map(tuple, workflow.judgment_coverage(rows, judged).collect()))
    assert len(want) == 9
    got = workflow.answer_coverage(df)
    assert sorted(map(tuple, got.collect())) == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_asked_rows_are_those_of_extraction(spark):
    texts = ["Asset: A | Eligible: yes\r\n  aSSet: B\nCounterparty: C\n\nAßet: D\n asset : no\nAsset:\n| Asset: E", "", None, "none", "Asset: Z\n"]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    want = sorted(r[0] for r in extract.extract(docs).select("extraction_id").collect())
    assert len(want) == 14 * 5
    assert sorted(r[0] for r in extract.asked_rows(docs).select(F.explode("asked")).collect()) == want


def test_evidence_of_items_is_that_of_rows(spark):
    """Fields whose clauses are asked for once an asset line have the verdicts of rows that stand beside their texts."""
    text = "Eligible  Things\r\nCounterparty: Straße 5 \nMargin Type: vm\nAsset: Bonds | Eligible: perhaps | Haircut: 150% | Rating Floor: AA\nAsset: Bills | Eligible: yes | Haircut: 5% | Concentration Basis: Market value | Rating Floor: A-\n"
    docs = spark.createDataFrame([("a", text), ("b", "Asset: only | Haircut: x\nnothing else"), ("c", None), ("d", "none")], "doc_id string, text string").withColumn("folded", extract.folded(F.col("text")))
    change = lambda f: F.struct(f["suffix"].alias("suffix"), F.when(f["suffix"] == "asset_criterion", F.concat(f["raw_value"], F.lit(" zz"))).when((f["suffix"] == "rating_floor") & (F.col("idx") == 1), "A- qq").otherwise(f["raw_value"]).alias("raw_value"), f["normalized_value"].alias("normalized_value"), f["value_type"].alias("value_type"), F.when(f["suffix"] == "margin_type", F.concat(f["source_clause"], F.lit(" zz"))).when(f["suffix"] == "counterparty", F.concat(F.lit("  "), F.upper(f["source_clause"]))).otherwise(f["source_clause"]).alias("source_clause"))
    items = extract.items(docs, ("folded",), second=False).withColumn("fields", F.transform("fields", change))
    rows = items.select("doc_id", "idx", F.explode("fields").alias("f")).select("doc_id", "idx", "f.*").where("value_type != 'not_found'").withColumn("field", F.col("suffix")).withColumn("value", F.col("normalized_value"))
    beside = extract.evidence_verdict(rows.join(docs.select("doc_id", "folded"), "doc_id"))
    want = sorted(map(tuple, beside.select("doc_id", "idx", "field", "supported").collect()))
    got = extract.evidence_of_items(items)
    assert sorted(map(tuple, got.collect())) == want
    assert {x[3] for x in want} == {True, False} and len(want) == 15
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
