"""Command line: python -m termloom.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators import learning as L
from termloom.operators import quality as Q
from termloom.operators import review as R
from termloom.operators.classify import ELIGIBILITY, classify
from termloom.operators.extract import evidence_validated, validated
from termloom.operators.gold import eligibility_groups, promote_eligibility
from termloom.operators.profiles import public_silver
from termloom.schemas import SILVER, TABLES, ddl
from termloom.sources import adapters, bronze, corpora
from termloom.sources.store import append_log, latest_stage, read_log, read_stages, write_json, write_sorted, write_stage

STAGED = ", ".join(c for c in SILVER.split(", ") if not c.startswith("created_at"))
LOG = "seq long, doc_id string, doc_class string, extraction_id string, field_path string, action string, previous_status string, previous_value string, corrected_value string, reviewer string, decided_at timestamp, note string"
TIMING = "doc_id string, reviewer string, review_seconds double, action_count int"
MEMORY = "doc_class string, suffix string, original_value string, n long, corrected_value string, reviewer string, decided_at timestamp, note string"


def run(spark: SparkSession, folder: str, out: str, layout: str = "text") -> int:
    """Landing folder to validated silver rows, gold terms and refused groups; returns the number of documents.

    What can't be read or routed is a row of ``review`` or ``errors``; the other documents go on.
    """
    files = bronze.ingest(bronze.landing(spark, folder).withColumn("body", F.col("content")), "content", "received_at").withColumnRenamed("body", "content")
    pdf = F.lower("path").endswith(".pdf")
    texts = files.where(~pdf).select("doc_id", F.decode("content", "UTF-8").alias("text"))
    read = adapters.pdf_pages(files.where(pdf)) if layout == "text" else adapters.word_lines(adapters.pdf_words(files.where(pdf), adapters.layout_adapter(layout))).groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("text")).withColumn("error", F.lit(None).cast("string"))
    pages = read.where("error IS NULL").groupBy("doc_id").agg(bronze.joined(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p["text"])).alias("text"))
    routed = classify(texts.unionByName(pages))
    known = routed.where((F.col("doc_class") == ELIGIBILITY) & ~F.col("review_required"))
    plain, public = known.where("profile = 'normalized'"), known.where("profile != 'normalized'")
    silver = validated(plain).unionByName(evidence_validated(public, public_silver(public)))
    if not silver.isEmpty():
        write_stage(silver, f"{out}/silver", "validated")
    write_json(promote_eligibility(silver), f"{out}/gold_eligibility")
    write_json(eligibility_groups(silver).where("error is not null").select("doc_id", "idx", "error"), f"{out}/promotion_errors")
    write_json(Q.kpis(silver, ["doc_id"]), f"{out}/quality")
    write_json(R.audit_appendix(silver), f"{out}/audit")
    write_json(R.packets(silver), f"{out}/packets")
    write_json(routed.where("review_required").drop("text"), f"{out}/review")
    write_json(read.where("error IS NOT NULL").select("doc_id", "error"), f"{out}/errors")
    return files.count()


def rows_under_review(spark: SparkSession, out: str, doc_id: str) -> DataFrame:
    return latest_stage(read_stages(spark, f"{out}/silver", STAGED)).where(F.col("doc_id") == doc_id).drop("stage")


def review(spark: SparkSession, out: str, doc_id: str, reviewer: str, requests: list[dict], seconds: float | None = None) -> dict[str, int]:
    """Applies requests to a document's rows: the reviewed stage, the log, the memory and the time; returns how many of each action."""
    if not reviewer.strip():
        raise ValueError("a review needs a reviewer")
    silver = rows_under_review(spark, out, doc_id)
    asked = spark.createDataFrame([(r["extraction_id"], r["action"], r["new_value"], reviewer, r["note"]) for r in requests], "extraction_id string, action string, new_value string, reviewer string, note string")
    wrong = L.correction_errors(silver, asked).collect()
    if wrong:
        raise ValueError("; ".join(sorted(f"{w['code']}: {w['extraction_id']}" for w in wrong)))
    log = read_log(spark, f"{out}/corrections", LOG)
    start = log.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
    order = spark.createDataFrame([(r["extraction_id"], start + i) for i, r in enumerate(requests)], "extraction_id string, seq long")
    told = silver.join(asked, "extraction_id").join(order, "extraction_id").select(
        "seq", "doc_id", "doc_class", "extraction_id", "field_path", "action", F.col("validator_status").alias("previous_status"), F.coalesce(F.nullif(F.col("corrected_value"), F.lit("")), F.col("normalized_value")).alias("previous_value"),
        F.when(F.col("action") == "correct", F.col("new_value")).alias("corrected_value"), "reviewer", F.current_timestamp().alias("decided_at"), "note",
    )
    append_log(told, f"{out}/corrections")
    write_stage(L.apply_corrections(silver, asked), f"{out}/silver", "reviewed")
    write_sorted(L.memory(read_log(spark, f"{out}/corrections", LOG)), f"{out}/memory", ["doc_class", "suffix", "original_value"])
    if seconds is not None:
        append_log(spark.createDataFrame([(doc_id, reviewer, seconds, len(requests))], TIMING), f"{out}/timings")
    return {r["action"]: r["n"] for r in R.action_counts(asked).collect()}


def approve(spark: SparkSession, out: str, doc_id: str, reviewer: str, note: str | None = None) -> bool:
    """Approves a document whose rows are all settled, and promotes its terms; False where it may not be."""
    silver = rows_under_review(spark, out, doc_id)
    good, bad = R.decide(silver, reviewer, True, F.current_timestamp(), note)
    if good.isEmpty():
        return False
    append_log(good, f"{out}/decisions")
    append_log(promote_eligibility(silver), f"{out}/gold")
    return True


def _show(df: DataFrame, say: Callable[[str], None]) -> None:
    for r in df.collect():
        say("  ".join(f"{k}={v}" for k, v in r.asDict().items()))


def main(args: list[str] | None = None, ask: Callable[[str], str] = input, say: Callable[[str], None] = print) -> int:
    p = argparse.ArgumentParser(prog="termloom")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("ddl", help="print the tables' DDL")
    c = sub.add_parser("run", help="refine a landing folder")
    c.add_argument("folder")
    c.add_argument("out")
    c.add_argument("--layout", choices=["text", "pdfplumber", "ocr"], default="text")
    c = sub.add_parser("review", help="list a document's rows, or confirm, correct and dispute them")
    c.add_argument("out")
    c.add_argument("doc_id")
    c.add_argument("--list", action="store_true")
    c.add_argument("--file", help="a file of corrections instead of questions")
    c.add_argument("--reviewer", default="")
    c.add_argument("--pending-only", action="store_true")
    c = sub.add_parser("approve", help="approve a document and promote its terms")
    c.add_argument("out")
    c.add_argument("doc_id")
    c.add_argument("--reviewer", required=True)
    c.add_argument("--note")
    for name, told in (("accuracy", "score extraction over a corpus"), ("corpus-check", "check a corpus's files")):
        c = sub.add_parser(name, help=told)
        c.add_argument("corpus")
    sub.add_parser("regression", help="score extraction over the packaged corpus")
    for name, told in (("memory", "list what was corrected before"), ("distill", "propose rules and cases from corrections"), ("timings", "sum up review times"), ("dashboard", "print the quality page")):
        c = sub.add_parser(name, help=told)
        c.add_argument("out")
    a = p.parse_args(args)
    if a.command == "ddl":
        say(";\n\n".join(ddl(n) for n in sorted(TABLES)) + ";")
        return 0
    spark = SparkSession.builder.appName("termloom").getOrCreate()
    if a.command == "run":
        say(f"{run(spark, a.folder, a.out, a.layout)} documents")
    elif a.command == "review":
        rows = rows_under_review(spark, a.out, a.doc_id)
        memory = spark.read.schema(MEMORY).parquet(f"{a.out}/memory") if not read_log(spark, f"{a.out}/corrections", LOG).isEmpty() else spark.createDataFrame([], MEMORY)
        hints = L.suggestions(rows, memory).select("extraction_id", "n", "suggested_value")
        if a.list:
            _ = [say(r["listing"]) for r in R.listing(rows, hints).collect()]
            return 0
        if a.file:
            requests, seconds = R.requests_of(spark.read.text(a.file, wholetext=True).first()[0])
        else:
            told = {h["extraction_id"]: (h["suggested_value"], h["n"]) for h in hints.collect()}
            requests, seconds = R.review_loop([r.asDict() for r in rows.orderBy("field_path").collect()], ask, say, a.pending_only, told), None
        if requests:
            say(json.dumps(review(spark, a.out, a.doc_id, a.reviewer, requests, seconds)))
    elif a.command == "approve":
        ok = approve(spark, a.out, a.doc_id, a.reviewer, a.note)
        say("approved" if ok else "not approved: rows are pending or disputed")
        return 0 if ok else 1
    elif a.command in ("accuracy", "regression"):
        known = corpora.packaged(spark) if a.command == "regression" else corpora.cases(spark, a.corpus)
        values, _ = corpora.scored(known)
        _show(Q.rounded(Q.accuracy(values, [])), say)
        _show(Q.rounded(Q.weakest(values)).select("field", "accuracy"), say)
        _show(Q.first_mismatches(values, ["case_id", "field_path"]).select("case_id", "field_path", "expected", "actual"), say)
        gate = corpora.regression(known).first()
        say(f"ready: {gate['ready']}, disputed: {gate['n_disputed']}")
        return 0 if gate["ready"] or a.command == "regression" else 1
    elif a.command == "corpus-check":
        wrong = corpora.problems(spark, a.corpus)
        _show(corpora.shortfall(spark, a.corpus), say)
        _show(wrong.orderBy("case_id", "problem"), say)
        return 0 if wrong.isEmpty() else 1
    elif a.command == "memory":
        _show(R.memory_list(spark.read.schema(MEMORY).parquet(f"{a.out}/memory")), say)
    elif a.command == "distill":
        log = read_log(spark, f"{a.out}/corrections", LOG)
        rules = [r.asDict() for r in L.mined_rules(log).orderBy("schema", "suffix", "previous_value").collect()]
        say(R.distilled_markdown(rules, L.golden_cases(log).count(), [r.asDict() for r in L.unresolved(log).orderBy("seq").collect()], log.count()))
    elif a.command == "timings":
        times = read_log(spark, f"{a.out}/timings", TIMING)
        _show(Q.review_times(times, "review_seconds", []), say)
        _show(R.over_target(times, "review_seconds"), say)
    elif a.command == "dashboard":
        say(R.dashboard(latest_stage(read_stages(spark, f"{a.out}/silver", STAGED))))
    return 0


if __name__ == "__main__":
    sys.exit(main())
