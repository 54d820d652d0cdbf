"""Human corrections: applying them, remembering them, and mining rules from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from termloom.functions import text as T
from termloom.schemas import effective_value


def correction_errors(silver: DataFrame, requests: DataFrame) -> DataFrame:
    """extraction_id, code of requests that are unknown, given twice, or corrections without a value."""
    unknown = requests.join(silver.select("extraction_id"), "extraction_id", "left_anti").select("extraction_id", F.lit("unknown_extraction").alias("code"))
    twice = requests.groupBy("extraction_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("extraction_id", F.lit("duplicate_request").alias("code"))
    empty = requests.where((F.col("action") == "correct") & (F.coalesce("new_value", F.lit("")) == "")).select("extraction_id", F.lit("missing_value").alias("code"))
    return unknown.unionByName(twice).unionByName(empty)


def apply_corrections(silver: DataFrame, requests: DataFrame) -> DataFrame:
    """Silver rows after requests (extraction_id, action, new_value, reviewer): confirm and dispute clear a correction, correct sets it.

    Requests that ``correction_errors`` names change nothing: of several for one row none counts.
    """
    wrong = correction_errors(silver, requests).select("extraction_id").distinct()
    r = requests.join(wrong, "extraction_id", "left_anti").select(F.col("extraction_id").alias("_e"), "action", "new_value", "reviewer")
    j = silver.join(r, F.col("extraction_id") == F.col("_e"), "left")
    fixed = F.col("action") == "correct"
    return j.withColumns({
        "validator_status": F.when(fixed, "corrected").when(F.col("action") == "confirm", "confirmed").when(F.col("action") == "dispute", "disputed").otherwise(F.col("validator_status")),
        "corrected_value": F.when(fixed, F.col("new_value")).when(F.col("action").isNull(), F.col("corrected_value")),
        "corrected_by": F.when(fixed, F.col("reviewer")).when(F.col("action").isNull(), F.col("corrected_by")),
    }).select(*silver.columns)


def memory(log: DataFrame) -> DataFrame:
    """Per (doc_class, suffix, original value): how often it was corrected or disputed, and the latest record's fix, reviewer, time and note."""
    last = F.struct("seq", "action", "corrected_value", "reviewer", "decided_at", "note")
    keyed = log.where("action != 'confirm'").select(F.coalesce("doc_class", F.lit("unknown")).alias("doc_class"), T.suffix(F.col("field_path")).alias("suffix"), F.col("previous_value").alias("original_value"), last.alias("r"))
    out = keyed.groupBy("doc_class", "suffix", "original_value").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r"))
    return out.select("doc_class", "suffix", "original_value", "n", F.when(F.col("r.action") == "correct", F.col("r.corrected_value")).alias("corrected_value"), F.col("r.reviewer").alias("reviewer"), F.col("r.decided_at").alias("decided_at"), F.col("r.note").alias("note"))


def suggestions(silver: DataFrame, remembered: DataFrame) -> DataFrame:
    """Rows whose value was corrected or disputed before; Spark picks the join by the memory's measured size."""
    m = remembered.select(F.col("doc_class").alias("_c"), F.col("suffix").alias("_s"), F.col("original_value").alias("_v"), "n", F.col("corrected_value").alias("suggested_value"))
    return silver.join(m, (F.col("doc_class") == F.col("_c")) & (T.suffix(F.col("field_path")) == F.col("_s")) & (effective_value() == F.col("_v"))).drop("_c", "_s", "_v")


def mined_rules(log: DataFrame, least: int = 2) -> DataFrame:
    """Rules from the log: several targets of one value ask for review whatever their number, one target seen ``least`` times is a normalisation, disputes ask for review per field."""
    keyed = log.select(T.prefix(F.col("field_path")).alias("schema"), T.suffix(F.col("field_path")).alias("suffix"), "action", "previous_value", "corrected_value", "reviewer", "note")
    fixes = keyed.where("action = 'correct'").groupBy("schema", "suffix", "previous_value").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("corrected_value")).alias("targets"), F.array_sort(F.collect_set("reviewer")).alias("reviewers"))
    kind = F.when(F.size("targets") > 1, "review_flag").when(F.col("n") >= least, "normalization")
    rules = fixes.withColumn("kind", kind).where("kind is not null").select("kind", "schema", "suffix", "previous_value", F.array_join("targets", ",").alias("targets"), "n", F.array_join("reviewers", ",").alias("reviewers"))
    doubts = keyed.where("action = 'dispute'").groupBy("schema", "suffix").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("note")), ",").alias("targets"), F.array_join(F.array_sort(F.collect_set("reviewer")), ",").alias("reviewers"))
    return rules.unionByName(doubts.select(F.lit("dispute_flag").alias("kind"), "schema", "suffix", F.lit(None).cast("string").alias("previous_value"), "targets", "n", "reviewers"))


def golden_cases(log: DataFrame) -> DataFrame:
    """Proposed cases: every correction's value and every confirmed one, with its source and reviewer."""
    fix = F.col("action") == "correct"
    return log.where("action != 'dispute'").select("seq", "doc_id", T.prefix(F.col("field_path")).alias("schema"), "field_path", T.suffix(F.col("field_path")).alias("field"), F.when(fix, F.col("corrected_value")).otherwise(F.col("previous_value")).alias("expected"), F.when(fix, "correction").otherwise("confirmed").alias("source"), "reviewer", "decided_at", "note")


def unresolved(log: DataFrame) -> DataFrame:
    """Disputes of the log, which stay open until their value is settled."""
    return log.where("action = 'dispute'").select("seq", "doc_id", "field_path", "reviewer", "decided_at", "note")


def documents_seen(log: DataFrame) -> DataFrame:
    """doc_id, nth: documents in the order in which the log first names them; only one row a document is ordered."""
    first = log.groupBy("doc_id").agg(F.min("seq").alias("first_seq"))
    return first.withColumn("nth", F.row_number().over(W.orderBy("first_seq", "doc_id"))).select("doc_id", "nth")


def golden_fragment(log: DataFrame) -> DataFrame:
    """doc_id, field_path, expected: the last confirmed or corrected value."""
    value = F.when(F.col("action") == "correct", F.col("corrected_value")).otherwise(F.col("previous_value"))
    return log.where("action != 'dispute'").groupBy("doc_id", "field_path").agg(F.max_by(value, "seq").alias("expected"))
