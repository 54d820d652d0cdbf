"""The domain's inputs, derived from the star-schema tables: schedules, silver rows, logs, versions, limits, margins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schedule_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey, idx, p: the parts of each customer that has ordered, each once."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p"))
    # Dealt by customer, pairs are made distinct, numbered and made texts of without another shuffle.
    parts = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select("custkey", "p").repartition("custkey").distinct()
    nth = F.row_number().over(W.partitionBy("custkey").orderBy("p"))
    return parts.withColumn("n", nth).select("custkey", (F.col("n") - 1).alias("idx"), "p")


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey, doc_id, text: one normalised schedule per customer."""
    pct = lambda x: F.concat(x.cast("string"), F.lit("%"))
    p = F.col("p")
    fields = [
        F.concat(F.lit("Asset: PART_"), p.cast("string")),
        F.concat(F.lit("Eligible: "), F.when(p % 3 == 0, "yes").when(p % 3 == 1, "no").otherwise("Y")),
        F.when(p % 11 != 0, F.concat(F.lit("Haircut: "), pct(F.when(p % 17 == 0, F.lit(150)).otherwise((p % 40).cast("int"))))),
        F.when(p % 4 != 0, F.concat(F.lit("Concentration Limit: "), pct(p % 5 * 10), F.lit(" | Concentration Basis: market value"))),
        F.concat(F.lit("Currencies: "), F.when(p % 2 == 0, "usd, eur").otherwise("USD")),
        F.when(p % 3 != 0, F.lit("Rating Floor: A-")),
        F.when(p % 6 != 0, F.concat(F.lit("Tenor Cap Days: "), (p % 6 * 365).cast("string"))),
    ]
    items = schedule_items(spark, sf_dir).select("custkey", "idx", F.concat_ws(" | ", *fields).alias("line"))
    assets = items.groupBy("custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "line"))), lambda x: x["line"]), "\n").alias("assets"))
    since = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("since"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name", "c_mktsegment")
    margin = F.create_map(*[F.lit(x) for kv in {"AUTOMOBILE": "VM", "BUILDING": "im", "FURNITURE": "Repo", "HOUSEHOLD": "vm", "MACHINERY": "Variation Margin"}.items() for x in kv])
    joined = assets.join(c, F.col("custkey") == F.col("k")).join(since, F.col("custkey") == F.col("o_custkey"))
    text = F.concat(
        F.lit("Collateral Eligibility Schedule\nEligible Collateral\nCounterparty: "), F.col("c_name"), F.lit("\nAgreement ID: AG-"), F.col("custkey").cast("string"), F.lit("\nSchedule Version: v"), (F.col("custkey") % 3 + 1).cast("string"),
        F.lit("\nMargin Type: "), margin[F.col("c_mktsegment")], F.lit("\nValid From: "), F.col("since"), F.lit("\n"), F.col("assets"),
        F.when(F.col("custkey") % 10 == 0, F.concat(F.lit("\nCounterparty: DUP "), F.col("c_name"))).otherwise(""),
    )
    return joined.select("custkey", text.alias("text")).select("custkey", F.concat(F.lit("doc-"), F.substring(F.sha2("text", 256), 1, 24)).alias("doc_id"), "text")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold versions from orders: key (custkey, priority), known from the order's date."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("knowledge_from"))


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction log from events, in order of event_id."""
    e = table(spark, sf_dir, "events")
    b = F.floor(F.col("value")).cast("long")
    action = F.when(F.col("event_type") == "purchase", "correct").when(F.col("event_type") == "error", "dispute").otherwise("confirm")
    return e.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("d"), (F.col("user_id") % 50).cast("string")).alias("doc_id"),
        F.concat(F.element_at(F.array(F.lit("eligibility"), F.lit("limit"), F.lit("requirement")), (F.col("event_id") % 3 + 1).cast("int")), F.lit("["), (F.col("event_id") % 4).cast("string"), F.lit("].f"), (F.col("event_id") % 7).cast("string")).alias("field_path"),
        action.alias("action"), (b % 9).cast("string").alias("previous_value"), F.when(action == "correct", (b % 4).cast("string")).alias("corrected_value"),
        F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("reviewer"), F.col("ts").alias("decided_at"), F.when(action == "dispute", F.concat(F.lit("n"), (F.col("event_id") % 3).cast("string"))).alias("note"),
    )


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold limits from suppliers; a null counterparty or agreement stands for any."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("limit_id"), F.when(s % 3 != 0, F.concat(F.lit("C"), (s % 40).cast("string"))).alias("counterparty"), F.when(s % 5 != 0, F.concat(F.lit("A"), (s % 4).cast("string"))).alias("agreement_id"),
        F.element_at(F.array(F.lit("issuer"), F.lit("country"), F.lit("sector")), (s % 3 + 1).cast("int")).alias("dimension"), F.when(s % 4 != 0, F.concat(F.lit("S"), (s % 8).cast("string"))).alias("scope_value"),
        F.when(s % 2 == 0, "percent").otherwise(F.when(s % 9 == 0, "ratio").otherwise("absolute")).alias("limit_unit"), (s * 7 % 130 - 5).cast("double").alias("limit_value"), F.when(s % 7 != 0, "USD").alias("limit_currency"), F.when(s % 6 != 0, "market value").alias("basis"),
        F.concat(F.lit("doc"), (s % 10).cast("string")).alias("doc_id"),
    )


def margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold margin requirements, one of each order."""
    k = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("margin_id"), F.concat(F.lit("C"), (k % 45).cast("string")).alias("counterparty"), F.when(k % 3 != 0, F.concat(F.lit("A"), (k % 5).cast("string"))).alias("agreement_id"), F.col("o_totalprice").alias("required_amount"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold eligibility terms of agreements, from customers."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("term_id"), F.concat(F.lit("C"), (k % 42).cast("string")).alias("counterparty"), F.concat(F.lit("A"), (k % 4).cast("string")).alias("agreement_id"), F.concat(F.lit("asset-"), (k % 13).cast("string")).alias("asset_criterion"), (k % 4 == 0).alias("closed"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls from conversations."""
    n = F.length("text")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.when(F.col("role") == "assistant", "validator").otherwise("extractor").alias("stage"), (n * 3).cast("long").alias("latency_ms"), F.when(F.col("turn") % 4 != 3, (n / 4).cast("long")).alias("input_tokens"), F.when(F.col("turn") % 3 != 2, (n / 8).cast("long")).alias("output_tokens"), F.when(F.col("turn") % 5 == 0, (n / 2).cast("long")).alias("total_tokens"))


def expected_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected and actual values of a rule's fields, case by case."""
    li = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    j = li.join(d, F.col("id") == F.col("doc_id"), "left")
    fields = [
        ("quality", F.col("quality").cast("string"), F.when(F.col("n_chars") > 150, "1").when(F.col("n_chars") > 60, "0")),
        ("toxic", F.col("toxic").cast("string"), F.when(F.col("id") % 13 != 0, "0")),
        ("lang", F.when(F.col("id") % 8 == 0, "not_found").otherwise(F.col("lang")), F.when(F.col("id") % 16 == 0, "not_found").otherwise(F.col("lang"))),
    ]
    rows = F.explode(F.array(*[F.struct(F.lit(f"rule[0].{n}").alias("field_path"), e.alias("expected"), a.alias("actual")) for n, e, a in fields])).alias("r")
    return j.select(F.concat(F.lit("case-"), (F.col("id") % 25).cast("string")).alias("case_id"), "id", rows).select("case_id", "id", "r.*", F.when(F.col("id") % 9 != 0, F.concat(F.lit("page=1;line="), F.col("id").cast("string"))).otherwise("unresolved").alias("locator"))
