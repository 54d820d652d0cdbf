"""Corpora with known answers: loading, checking, manifests, and the regression run over one."""

from __future__ import annotations

import json
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators import quality as Q
from termloom.operators.extract import validated

DEFAULT_CLASS = "collateral_eligibility_schedule"
TRUTH = "ground_truth.json"
NEEDED = 10


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """case_id, text of the folder's text files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return files.select(F.regexp_extract("path", "([^/]+)\\.txt$", 1).alias("case_id"), F.decode("content", "UTF-8").alias("text"))


def truths(spark: SparkSession, folder: str) -> DataFrame:
    """case_id, meta (JSON text) of the folder's truth file, one row a case."""
    whole = spark.read.text(f"{folder}/{TRUTH}", wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("case_id", "meta"))


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """case_id, text, doc_class, title, owner_verified, field_path, expected: one row a known value; a case without its text has none."""
    meta = truths(spark, folder)
    told = meta.select(
        "case_id", F.coalesce(F.get_json_object("meta", "$.doc_class"), F.lit(DEFAULT_CLASS)).alias("doc_class"), F.coalesce(F.get_json_object("meta", "$.title"), F.lit("")).alias("title"),
        (F.coalesce(F.get_json_object("meta", "$.owner_verified"), F.lit("false")) == "true").alias("owner_verified"), F.explode(F.from_json(F.get_json_object("meta", "$.expected"), "map<string,string>")).alias("field_path", "expected"),
    )
    return told.join(_texts(spark, folder), "case_id").select("case_id", "text", "doc_class", "title", "owner_verified", "field_path", "expected")


def packaged_cases(spark: SparkSession, path: str) -> DataFrame:
    """The same of one file that lists cases with their texts."""
    rows = spark.read.schema("case_id string, text string, owner_verified boolean, expected map<string,string>").option("multiLine", "true").json(path)
    return rows.select("case_id", "text", F.lit(DEFAULT_CLASS).alias("doc_class"), F.lit("").alias("title"), F.coalesce("owner_verified", F.lit(False)).alias("owner_verified"), F.explode("expected").alias("field_path", "expected"))


def problems(spark: SparkSession, folder: str) -> DataFrame:
    """case_id, problem: texts and truths without each other, truths without values, and values that are no strings."""
    meta, texts = truths(spark, folder), _texts(spark, folder)
    none = meta.join(texts, "case_id", "left_anti").select("case_id", F.lit("missing_text").alias("problem"))
    orphan = texts.join(meta, "case_id", "left_anti").select("case_id", F.lit("orphan_text").alias("problem"))
    held = meta.select("case_id", F.try_variant_get(F.try_parse_json("meta"), "$.expected", "variant").alias("v"), F.json_object_keys(F.get_json_object("meta", "$.expected")).alias("keys"))
    empty = held.where(F.coalesce(F.size("keys"), F.lit(0)) <= 0).select("case_id", F.lit("empty_expected").alias("problem"))
    # An object whose values are all strings says so in its kind.
    fields = F.regexp_extract_all(F.schema_of_variant("v"), F.lit(": ([A-Z]+)"), 1)
    other = held.where(F.size("keys") > 0).where(F.exists(fields, lambda k: k != "STRING")).select("case_id", F.lit("value_not_a_string").alias("problem"))
    return none.unionByName(orphan).unionByName(empty).unionByName(other)


def shortfall(spark: SparkSession, folder: str) -> DataFrame:
    """One row: documents, verified ones, and how many of each the release gate still needs."""
    flag = F.get_json_object("meta", "$.owner_verified") == "true"
    sums = truths(spark, folder).agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(flag).alias("n_verified"))
    return sums.select("*", F.greatest(F.lit(0), NEEDED - F.col("n_documents")).alias("needs_documents"), F.greatest(F.lit(0), NEEDED - F.col("n_verified")).alias("needs_verified"))


def scored(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``known`` (as ``cases`` gives it) with what extraction finds: the values with actual and locator, and the validated rows."""
    docs = known.select(F.col("case_id").alias("doc_id"), "text").distinct()
    rows = validated(docs)
    found = rows.select(F.col("doc_id").alias("_d"), F.col("field_path").alias("_p"), F.col("normalized_value").alias("actual"), F.col("source_locator").alias("locator"))
    return known.drop("text").join(found, (F.col("case_id") == F.col("_d")) & (F.col("field_path") == F.col("_p")), "left").drop("_d", "_p"), rows


def regression(known: DataFrame, least: float = 0.95) -> DataFrame:
    """One row: the release gate over a corpus, and how many rows were disputed."""
    values, rows = scored(known)
    gate = Q.release_gate(values, F.col("owner_verified"), least, NEEDED)
    return gate.crossJoin(rows.agg(F.count_if(F.col("validator_status") == "disputed").alias("n_disputed")))  # one row each


# Manifests: small files that the driver reads


def entry(path: str, title: str, source_url: str, sha256: str, profile: str, route: str = "deterministic", expected_records: int = 0, synthetic: bool = False, note: str | None = None) -> dict:
    """A document's line of a manifest; a deterministic one says how many records it must give."""
    if route == "deterministic" and expected_records <= 0:
        raise ValueError("a deterministic document needs a positive number of records")
    told = {"path": path, "title": title, "source_url": source_url, "sha256": sha256, "profile": profile, "expected_route": route}
    told |= {"expected_minimum_eligibility_records": expected_records} if route == "deterministic" else {}
    return told | ({"synthetic": True} if synthetic else {}) | ({"note": note} if note else {})


def upserted(documents: list[dict], new: dict) -> list[dict]:
    """The documents with ``new`` at the end, in place of the one of its path."""
    return [d for d in documents if d.get("path") != new["path"]] + [new]


def load_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def save_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray((json.dumps(manifest, indent=2, ensure_ascii=False) + "\n").encode()))
    out.close()


def add_document(spark: SparkSession, manifest: str, name: str, content: bytes, **told) -> dict:  # noqa: ANN003
    """Puts a document beside a manifest (its bytes may not change) and its line into it; returns the line."""
    import hashlib

    from termloom.sources.store import write_once

    write_once(spark, f"{PurePosixPath(manifest).parent}/{name}", content)
    held = load_manifest(spark, manifest)
    new = entry(name, sha256=hashlib.sha256(content).hexdigest(), **told)
    held["documents"] = upserted(held["documents"], new)
    save_manifest(spark, manifest, held)
    return new


def observed_route(docs: DataFrame) -> DataFrame:
    """doc_id, route of classified documents: deterministic, or back to a reader."""
    known = (F.col("doc_class") == DEFAULT_CLASS) & ~F.col("review_required")
    return docs.select("doc_id", F.when(known, "deterministic").when(F.col("review_required"), "classification_review").otherwise("unexpected").alias("route"))


def benchmark_cases(spark: SparkSession, path: str) -> DataFrame:
    """name, path, minimum_text_characters, minimum_table_cells, expected_locator_count of a layout benchmark's manifest; paths are taken from its folder."""
    told = load_manifest(spark, path)
    rows = told.get("cases") if isinstance(told, dict) else told
    if not isinstance(rows, list) or not rows:
        raise ValueError("the manifest needs a list of cases")
    base = PurePosixPath(path).parent
    made = [(str(r["name"]), str(base / str(r["path"])), int(r.get("minimum_text_characters", 1)), int(r.get("minimum_table_cells", 0)), None if r.get("expected_locator_count") is None else int(r["expected_locator_count"])) for r in rows]
    return spark.createDataFrame(made, "name string, path string, minimum_text_characters int, minimum_table_cells int, expected_locator_count int")


def corrections_of(spark: SparkSession, rows: DataFrame, silver: DataFrame) -> DataFrame:
    """Correction records (extraction_id, ...) with the class of their silver row; one that is unknown has the class unknown."""
    known = silver.select("extraction_id", F.col("doc_class").alias("_c")).dropDuplicates(["extraction_id"])
    return rows.join(known, "extraction_id", "left").withColumn("doc_class", F.coalesce("_c", F.lit("unknown"))).drop("_c")


def packaged(spark: SparkSession, n: int = NEEDED) -> DataFrame:
    """A corpus of ``n`` small schedules with known values, made by rule; the same at every call."""
    k = F.col("id")
    pct = (k * 3 % 20).cast("string")
    text = F.concat(F.lit("Collateral Eligibility Schedule\nEligible Collateral\nCounterparty: Bank "), k.cast("string"), F.lit("\nAgreement ID: AG-"), k.cast("string"), F.lit("\nSchedule Version: v1\nMargin Type: VM\nValid From: 2026-01-01\nAsset: GOVT_"), k.cast("string"), F.lit(" | Eligible: yes | Haircut: "), pct, F.lit("% | Currencies: usd, eur\n"))
    known = F.create_map(
        F.lit("counterparty"), F.concat(F.lit("Bank "), k.cast("string")), F.lit("agreement_id"), F.concat(F.lit("AG-"), k.cast("string")), F.lit("margin_type"), F.lit("VM"), F.lit("valid_from"), F.lit("2026-01-01"), F.lit("valid_to"), F.lit("not_found"),
        F.lit("asset_criterion"), F.concat(F.lit("GOVT_"), k.cast("string")), F.lit("eligible"), F.lit("true"), F.lit("haircut_pct"), pct, F.lit("currency_scope"), F.lit("USD,EUR"),
    )
    rows = spark.range(n).select(F.concat(F.lit("case-"), k.cast("string")).alias("case_id"), text.alias("text"), F.lit(DEFAULT_CLASS).alias("doc_class"), F.lit("").alias("title"), F.lit(False).alias("owner_verified"), F.explode(known).alias("suffix", "expected"))
    return rows.select("case_id", "text", "doc_class", "title", "owner_verified", F.concat(F.lit("eligibility[0]."), "suffix").alias("field_path"), "expected")


def suffix_of(rows: DataFrame) -> DataFrame:
    return rows.withColumn("field", T.suffix(F.col("field_path")))
