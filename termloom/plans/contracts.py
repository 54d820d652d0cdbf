"""Queries on published schedules and on the model's contract, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators import extract as X
from termloom.operators import heuristics as H
from termloom.operators import profiles as PF
from termloom.operators import review as RV
from termloom.operators import semantic as S
from termloom.plans.queries import query
from termloom.sources import fixtures as FX

# Published schedules: haircut tables of parts, the exchange's pages of suppliers, agreements of customers, guidelines of nations


def _table_sql(name: str, profile: str, key: str, first: str) -> str:
    return f"""{name}_t AS (SELECT '{profile}-' || {key} AS doc_id, p_partkey AS k, CASE p_partkey % 7 WHEN 0 THEN 'AA' WHEN 1 THEN 'longer bonds' WHEN 2 THEN 'zero to ' || p_size || ' years' WHEN 3 THEN '1-2' ELSE 'Notes of ' || p_name END AS raw, p_partkey % 7 IN (0, 2, 3) AS bare, (p_size % 30)::VARCHAR AS pct,
CASE WHEN p_partkey % 5 = 0 THEN 'Bonds ' || p_type || ' with maturities' END AS heading, row_number() OVER (PARTITION BY {key} ORDER BY p_partkey) AS seq FROM part),
{name}_c AS (SELECT *, coalesce(last_value(coalesce(CASE WHEN NOT bare THEN raw END, heading) IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '{first}') AS before FROM {name}_t),
{name} AS (SELECT doc_id, '{profile}' AS profile, seq::INTEGER AS seq, raw AS asset_raw, '{name}-' || seq || '-' || CASE WHEN bare THEN concat_ws(' ', coalesce(heading, before), raw) ELSE raw END AS asset, pct || '%' AS haircut_raw, pct AS haircut_pct, NULL AS limit_pct, NULL AS basis, NULL AS rating_floor, raw || ' ' || pct || '%' AS clause FROM {name}_c)"""


_E = "NULL::VARCHAR AS limit_pct, NULL::VARCHAR AS basis, NULL::VARCHAR AS rating_floor"
_ENTRIES = f"""{_table_sql("ficc", "ficc_gsd", "p_brand", "Security Type")},
{_table_sql("dtc", "dtc", "p_type", "Table 2")},
cme AS (SELECT 'cme-' || s_suppkey AS doc_id, 'cme' AS profile, 0 AS seq, 'T-Bills, 0 to 1 year' AS asset_raw, 'cme-T-Bills-0 to 1 year' AS asset, (s_suppkey % 9) || '.5%' AS haircut_raw, (s_suppkey % 9) || '.5' AS haircut_pct, {_E} FROM supplier
UNION ALL SELECT 'cme-' || s_suppkey, 'cme', 20 + i::INTEGER, 'T-Notes, ' || b[i + 1], 'cme-T-Notes-' || b[i + 1], (s_suppkey % 5 + i) || '%', (s_suppkey % 5 + i)::VARCHAR, {_E} FROM supplier, (SELECT ['0 to 1 year', '1 to 3 years', '3 to 5 years', '5 to 10 years', '10 to 30 years'] AS b), range(5) r(i)
UNION ALL SELECT 'cme-' || s_suppkey, 'cme', 100, 'COMEX gold warrants', 'cme-COMEX gold warrants', '15%', '15', {_E} FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'cme-' || s_suppkey, 'cme', 102, 'U.S. equities', 'cme-U.S. equities', '30%', '30', {_E} FROM supplier),
isda AS (SELECT 'isda-' || c_custkey AS doc_id, 'isda_vm' AS profile, 1 AS seq, 'US-CASH: all' AS asset_raw, 'isda-US-CASH-all' AS asset, '100%' AS haircut_raw, '0' AS haircut_pct, {_E} FROM customer
UNION ALL SELECT 'isda-' || c_custkey, 'isda_vm', 2, 'US-TBILL: under 1 year', 'isda-US-TBILL-under 1 year', (90 + c_custkey % 10) || '.5%', (9 - c_custkey % 10) || '.5', NULL, NULL, 'AA / Aa2' FROM customer
UNION ALL SELECT 'isda-' || c_custkey, 'isda_vm', 3, 'US-TBILL: over 1 year', 'isda-US-TBILL-over 1 year', (80 + c_custkey % 7) || '%', (20 - c_custkey % 7)::VARCHAR, NULL, NULL, 'AA / Aa2' FROM customer),
guide AS (SELECT 'guide-' || n_nationkey AS doc_id, 'portfolio_guidelines' AS profile, 0 AS seq, 'Single Issuer Concentration Limit' AS asset_raw, 'Single Issuer Concentration Limit' AS asset, NULL AS haircut_raw, NULL AS haircut_pct, (n_nationkey + 1) || '.5' AS limit_pct, 'aggregate Value of Eligible Assets' AS basis, NULL AS rating_floor FROM nation
UNION ALL SELECT 'guide-' || n_nationkey, 'portfolio_guidelines', 2, 'BICS Industry Group Concentration Limit', 'BICS Industry Group Concentration Limit', NULL, NULL, n_nationkey::VARCHAR, 'Bloomberg BICS industry group', NULL FROM nation
UNION ALL SELECT 'guide-' || n_nationkey, 'portfolio_guidelines', 10 + i::INTEGER, a[i + 1], a[i + 1], h[i + 1] || '%', h[i + 1], {_E} FROM nation, (SELECT ['Equity liquidation under 5 trading days', 'Equity liquidation 5 to 9.9999 trading days', 'Equity liquidation 10 or more trading days'] AS a, ['0', '20', '100'] AS h), range(3) r(i)),
en AS (SELECT doc_id, profile, seq, asset_raw, asset, haircut_raw, haircut_pct, limit_pct, basis, rating_floor FROM ficc UNION ALL SELECT doc_id, profile, seq, asset_raw, asset, haircut_raw, haircut_pct, limit_pct, basis, rating_floor FROM dtc UNION ALL SELECT * FROM cme UNION ALL SELECT * FROM isda UNION ALL SELECT * FROM guide),
ent AS (SELECT *, substr(regexp_replace(regexp_replace(lower(asset), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 160) AS asset_criterion, row_number() OVER (PARTITION BY doc_id ORDER BY seq) - 1 AS idx FROM en)"""


def published(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, text, profile: documents of the five published layouts, made of the star schema's tables."""
    p, k = FX.table(spark, sf, "part"), F.col("p_partkey") % 7
    told = F.when(k == 0, "AA").when(k == 1, "longer bonds").when(k == 2, F.concat(F.lit("zero to "), F.col("p_size").cast("string"), F.lit(" years"))).when(k == 3, "1-2").otherwise(F.concat(F.lit("Notes of "), F.col("p_name")))
    line = F.concat(F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("Bonds "), F.col("p_type"), F.lit("\nwith maturities\n"))).otherwise(""), told, F.lit(" "), (F.col("p_size") % 30).cast("string"), F.lit("%"))

    def table(profile: str, key: str, first: str, last: str) -> DataFrame:
        lines = p.groupBy(F.col(key).alias("k")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", line.alias("l")))), lambda x: x["l"]), "\n").alias("lines"))
        head = f"{said(profile)}\nEFFECTIVE DATE: March 1, 2024\n{first}\n"
        return lines.select(F.concat(F.lit(f"{profile}-"), "k").alias("doc_id"), F.concat(F.lit(head), "lines", F.lit(f"\n{last} 9%")).alias("text"), F.lit(profile).alias("profile"))

    said = lambda profile: "\n".join(PF.HEADERS[profile][i] for i in (0, 2, 5))
    s = F.col("s_suppkey")
    pct = lambda x: F.concat(x.cast("string"), F.lit("%"))
    notes = F.concat_ws(" ", *[pct(s % 5 + i) for i in range(5)], F.lit("99%"))
    page = F.concat(F.lit(f"{said('cme')}\n• T-Bills "), (s % 9).cast("string"), F.lit(".5%\n• T-Notes "), notes, F.when(s % 2 == 0, "\n15%  COMEX gold").otherwise(""), F.lit("\nU.S. Equities\nlisted 7 days\n30% Yes Yes Yes\n"))
    cme = FX.table(spark, sf, "supplier").select(F.concat(F.lit("cme-"), s.cast("string")).alias("doc_id"), page.alias("text"), F.lit("cme").alias("profile"))
    c = F.col("c_custkey")
    rows = F.concat(F.lit(f"{said('isda_vm')} of eligible assets rated AA / Aa2, dated as of August 3, 2017\nISDA COLLATERAL ASSET DEFINITION\nUS-CASH all 100%\nUS-TBILL / under 1 year "), (90 + c % 10).cast("string"), F.lit(".5%\nover 1 year "), (80 + c % 7).cast("string"), F.lit("%\nThe definitions used in this table 5%"))
    isda = FX.table(spark, sf, "customer").select(F.concat(F.lit("isda-"), c.cast("string")).alias("doc_id"), rows.alias("text"), F.lit("isda_vm").alias("profile"))
    n = F.col("n_nationkey")
    rules = F.concat(
        F.lit(f"{said('portfolio_guidelines')}: eligible assets\nAMENDMENT NO. 10 TO CREDIT AGREEMENT, dated as of July 1, 2020\nSingle Issuer Concentration Limit.  No more than "), (n + 1).cast("string"), F.lit(".5% of Value. BICs Industry Group"), F.lit(" Concentration Limit. No more than "), n.cast("string"),
        F.lit("% of it.\nLiquidation Period. Less than 5 trading days\n0% then 5 – 9.9999 trading days 20% then 10 trading days or more 100% then"),
    )
    guide = FX.table(spark, sf, "nation").select(F.concat(F.lit("guide-"), n.cast("string")).alias("doc_id"), rules.alias("text"), F.lit("portfolio_guidelines").alias("profile"))
    out = table("ficc_gsd", "p_brand", "Security Type", "Any deposits of Eligible Clearing Fund").unionByName(table("dtc", "p_type", "Table 2", "Securities are assigned a 100% haircut"))
    return out.unionByName(cme).unionByName(isda).unionByName(guide)


@query(f"WITH {_ENTRIES} SELECT doc_id, seq, asset_raw, asset_criterion, haircut_raw, haircut_pct, limit_pct AS concentration_limit_pct, basis AS concentration_basis, rating_floor FROM ent")
def public_entries(spark: SparkSession, sf: str) -> DataFrame:
    return PF.entries(published(spark, sf)).drop("clause")


@query("""SELECT 'ficc_gsd-' || p_brand AS doc_id, 'FICC GSD' AS counterparty, 'FICC-GSD-CLEARING-FUND' AS agreement_id, 'Clearing Fund' AS margin_type, 'March 1, 2024' AS schedule_version, DATE '2024-03-01' AS valid_from FROM part GROUP BY p_brand UNION ALL SELECT 'dtc-' || p_type, 'DTC', 'DTC-ELIGIBLE-COLLATERAL', 'Clearing Fund', 'March 1, 2024', DATE '2024-03-01' FROM part GROUP BY p_type
UNION ALL SELECT 'cme-' || s_suppkey, 'CME Clearing', 'CME-BASE-GUARANTY-FUND', 'Clearing Fund', 'current', NULL FROM supplier UNION ALL SELECT 'isda-' || c_custkey, 'JPMorgan Chase Bank / Cambridge Master Fund', 'JPM-CAMBRIDGE-ISDA-2017', 'VM', 'August 3, 2017', DATE '2017-08-03' FROM customer
UNION ALL SELECT 'guide-' || n_nationkey, 'Saba Capital Income & Opportunities Fund', 'SABA-TD-CREDIT-AGREEMENT', 'Secured Financing', 'July 1, 2020', DATE '2020-07-01' FROM nation""")
def public_headers(spark: SparkSession, sf: str) -> DataFrame:
    return PF.headers(published(spark, sf)).where("error is null").drop("error")


_PUBLIC = _ENTRIES + """, hd AS (SELECT * FROM (VALUES ('ficc_gsd', 'FICC GSD', 'FICC-GSD-CLEARING-FUND', 'March 1, 2024', 'Clearing Fund', '2024-03-01'), ('dtc', 'DTC', 'DTC-ELIGIBLE-COLLATERAL', 'March 1, 2024', 'Clearing Fund', '2024-03-01'), ('cme', 'CME Clearing', 'CME-BASE-GUARANTY-FUND', 'current', 'Clearing Fund', NULL),
 ('isda_vm', 'JPMorgan Chase Bank / Cambridge Master Fund', 'JPM-CAMBRIDGE-ISDA-2017', 'August 3, 2017', 'VM', '2017-08-03'), ('portfolio_guidelines', 'Saba Capital Income & Opportunities Fund', 'SABA-TD-CREDIT-AGREEMENT', 'July 1, 2020', 'Secured Financing', '2020-07-01')) h(profile, cp, ag, ver, mt, vf)),
f AS (SELECT doc_id, idx, unnest(['counterparty', 'agreement_id', 'schedule_version', 'margin_type', 'asset_criterion', 'eligible', 'haircut_pct', 'concentration_limit_pct', 'concentration_basis', 'currency_scope', 'rating_floor', 'tenor_cap_days', 'valid_from', 'valid_to']) AS suffix, unnest([cp, ag, ver, mt, asset_criterion, 'true', haircut_pct, limit_pct, basis, NULL, rating_floor, NULL, vf, NULL]) AS v,
 unnest(['string', 'string', 'string', 'string', 'string', 'boolean', 'percentage', 'percentage', 'string', 'string_array', 'string', 'integer', 'date', 'date']) AS kind, unnest([NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN mt = 'VM' THEN 'percent_haircut_from_valuation_percentage' ELSE 'percent' END, 'percent', NULL, NULL, NULL, 'days', NULL, NULL]) AS unit FROM ent JOIN hd USING (profile))"""


@query(f"WITH {_PUBLIC} SELECT substr(sha256(doc_id || '|eligibility[' || idx || '].' || suffix || '|{PF.VERSION}'), 1, 32) AS extraction_id, 'eligibility[' || idx || '].' || suffix AS field_path, coalesce(v, 'not_found') AS normalized_value, CASE WHEN v IS NULL THEN 'not_found' ELSE kind END AS value_type, unit, CASE WHEN v IS NULL THEN 0.0::DOUBLE ELSE 0.98::DOUBLE END AS confidence FROM f")
def public_silver(spark: SparkSession, sf: str) -> DataFrame:
    """14 rows an entry."""
    return PF.public_silver(published(spark, sf)).select("extraction_id", "field_path", "normalized_value", "value_type", "unit", "confidence")


@query(f"WITH {_PUBLIC} SELECT 'confirmed' AS validator_status, count(*) AS n FROM f")
def public_validation(spark: SparkSession, sf: str) -> DataFrame:
    """States of all rows after the evidence check: none of them is disputed."""
    docs = published(spark, sf)
    return X.evidence_validated(docs, PF.public_silver(docs)).groupBy("validator_status").agg(F.count(F.lit(1)).alias("n"))


# The model's contract, over a document of each customer, answered by the offline stand-in


def _agreements(spark: SparkSession, sf: str) -> DataFrame:
    """k, doc_id, doc_class, language, text: an agreement of each customer, with one asset."""
    c = F.col("c_custkey")
    text = F.concat(
        F.lit("Collateral Provider: "), F.col("c_name"), F.lit("\nCounterparty: second\nProfile Reference: REF-"), c.cast("string"), F.lit("\nEffective: from 2026-01-"), F.lpad((c % 28 + 1).cast("string"), 2, "0"),
        F.lit(" on\nAsset Class: "), F.col("c_mktsegment"), F.lit(" paper | Valuation Haircut: about "), (c % 30).cast("string"), F.lit(".5% | Maturity Cap: "), (c % 9).cast("string"), F.lit(" years | Rating Floor: "), F.when(c % 2 == 0, "N/A").otherwise("A-"), F.lit(" | Currency: USD\n"),
    )
    return FX.table(spark, sf, "customer").select(c.alias("k"), F.concat(F.lit("agr-"), c.cast("string")).alias("doc_id"), F.lit(S.ELIGIBILITY).alias("doc_class"), F.lit("en").alias("language"), text.alias("text"))


_AGR = """a AS (SELECT c_custkey AS k, 'agr-' || c_custkey AS doc_id, unnest(['asset_criterion', 'eligible', 'haircut_pct', 'rating_floor', 'currency_scope', 'tenor_cap_days', 'counterparty', 'agreement_id', 'valid_from', 'margin_type', 'schedule_version']) AS suffix,
 unnest([lower(c_mktsegment) || '_paper', 'true', (c_custkey % 30) || '.5', CASE WHEN c_custkey % 2 <> 0 THEN 'A-' END, 'USD', ((c_custkey % 9) * 365)::VARCHAR, 'second', 'REF-' || c_custkey, '2026-01-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0'), 'not_found', 'not_found']) AS v,
 unnest(['string', 'boolean', 'percentage', 'string', 'string_array', 'integer', 'string', 'string', 'date', 'not_found', 'not_found']) AS kind FROM customer),
r AS (SELECT *, 'eligibility[0].' || suffix AS field_path, substr(sha256(doc_id || '|eligibility[0].' || suffix || '|model-1-eligibility-1.1.0'), 1, 32) AS extraction_id FROM a WHERE v IS NOT NULL)"""


@query(f"WITH {_AGR} SELECT doc_id, field_path, v AS normalized_value, kind AS value_type, CASE WHEN kind = 'not_found' THEN 0.5::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM r")
def heuristic_assets(spark: SparkSession, sf: str) -> DataFrame:
    return H.asset_rows(_agreements(spark, sf)).select("doc_id", "field_path", "normalized_value", "value_type", "confidence")


@query("""WITH p AS (SELECT 'val-' || p_brand AS doc_id, p_name, p_partkey AS k, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS r FROM part), g AS (SELECT doc_id, p_name, (r * 5 + i)::VARCHAR AS n, i::INTEGER AS i, ([99 - k % 7, 98 - k % 7, 96 - k % 7, 94 - k % 9, 90 - k % 9][i + 1])::INTEGER AS v FROM p, range(5) x(i) WHERE r < 4),
w AS (SELECT doc_id, n, i, unnest(['asset_category', 'duration_bucket', 'duration_min_years', 'collateral_value_pct', 'implied_haircut_pct', 'duration_max_years']) AS f, unnest([p_name, ['0-1', '>1-3', '>3-5', '>5-10', '>10'][i + 1], ['0', '1', '3', '5', '10'][i + 1], v::VARCHAR, (100 - v)::VARCHAR, ['1', '3', '5', '10', 'x'][i + 1]]) AS val FROM g)
SELECT doc_id, 'valuation_margin[' || n || '].' || f AS field_path, val AS normalized_value FROM w WHERE NOT (i = 4 AND f = 'duration_max_years')
UNION ALL SELECT DISTINCT doc_id, 'document.last_updated', '2026-07-03' FROM p""")
def heuristic_valuation(spark: SparkSession, sf: str) -> DataFrame:
    """A valuation page of each brand, a row of each part; the stand-in stops at twenty groups."""
    k = F.col("p_partkey")
    line = F.concat_ws(" ", F.col("p_name"), *[(a - k % m).cast("string") for a, m in ((99, 7), (98, 7), (96, 7), (94, 9), (90, 9))])
    lines = FX.table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("l")))), lambda x: x["l"]), "\n").alias("b"))
    docs = lines.select(F.concat(F.lit("val-"), "p_brand").alias("doc_id"), F.concat(F.lit("Collateral Valuation\nLast Updated: 7.3.2026\nSecurities Valuation and Margins Table\n"), "b", F.lit("\nLoan Valuation and Margins Tables\n")).alias("text"))
    return H.valuation_rows(docs).select("doc_id", "field_path", "normalized_value")


def _answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Agreements, and the stand-in's answers with planted faults: JSON that ends early, a key that is no part of the contract, a clause that no text holds."""
    docs = _agreements(spark, sf)
    content = H.extraction_answers(docs).withColumnRenamed("doc_id", "_d")
    j = S.chunks(docs).join(content, F.col("doc_id") == F.col("_d")).join(docs.select(F.col("doc_id").alias("_k"), "k"), F.col("doc_id") == F.col("_k"))
    c, k = F.col("content"), F.col("k") % 6
    bad = F.when(k == 1, F.substring(c, F.lit(1), F.length(c) - 5)).when(k == 2, F.replace(c, F.lit('"confidence":0.7'), F.lit('"approved":true,"confidence":0.7'))).when(k == 3, F.replace(c, F.lit('"source_clause":"Asset'), F.lit('"source_clause":"Other'))).when(k == 4, F.lit('{"extractions":[]}')).otherwise(c)
    return docs, j.withColumn("content", bad).drop("_d", "_k")


@query(f"WITH {_AGR} SELECT extraction_id, doc_id, field_path, v AS normalized_value, kind AS value_type, CASE WHEN kind = 'not_found' THEN '{H.NOT_STATED}' ELSE NULL END AS not_stated FROM r WHERE k % 6 IN (0, 5)")
def semantic_extractions(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the answers that keep the contract; one bad row keeps a document out."""
    docs, answers = _answers(spark, sf)
    rows, _ = S.extractions(answers, docs, "model-1")
    return rows.select("extraction_id", "doc_id", "field_path", "normalized_value", "value_type", F.when(F.col("value_type") == "not_found", F.col("source_clause")).alias("not_stated"))


@query("SELECT 'agr-' || c_custkey AS doc_id, CASE c_custkey % 6 WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'unsupported_fields' WHEN 3 THEN 'clause_not_verbatim' ELSE 'no_extractions' END AS error FROM customer WHERE c_custkey % 6 IN (1, 2, 3, 4)")
def semantic_errors(spark: SparkSession, sf: str) -> DataFrame:
    docs, answers = _answers(spark, sf)
    return S.extractions(answers, docs, "model-1")[1]


def _judged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Rows after the stand-in's judgments, some of which were changed: a correction, a pending one, one left out, evidence that no text holds."""
    docs = _agreements(spark, sf)
    answers = S.chunks(docs).join(H.extraction_answers(docs), "doc_id")
    silver, _ = S.extractions(answers, docs, "model-1")
    content = H.judgment_answers(docs, silver).join(docs.select(F.col("doc_id").alias("_k"), "k"), F.col("doc_id") == F.col("_k")).drop("_k")
    c, k = F.col("content"), F.col("k") % 7
    one = '"status":"confirmed"'

    def first(new: str) -> Column:
        at = F.instr(c, one)
        return F.concat(F.substring(c, F.lit(1), at - 1), F.lit(new), F.substring(c, at + len(one), F.length(c)))

    changed = F.when(k == 1, first('"corrected_value":"by hand","status":"corrected"')).when(k == 2, first('"status":"pending"')).when(k == 3, F.concat(F.lit('{"judgments":[{'), F.substring_index(c, "},{", -1))).when(k == 4, F.replace(c, F.lit('"evidence_clause":"Asset'), F.lit('"evidence_clause":"Other'))).otherwise(c)
    told = content.select("doc_id", changed.alias("content"), F.lit("local").alias("provider"), F.lit("stand-in").alias("model"))
    return S.judgments(told, docs, silver)


@query(f"WITH {_AGR}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY extraction_id) AS nth FROM r) SELECT extraction_id, CASE WHEN k % 7 = 1 AND nth = 1 THEN 'corrected' ELSE 'confirmed' END AS validator_status, CASE WHEN k % 7 = 1 AND nth = 1 THEN 'by hand' ELSE v END AS effective_value, CASE WHEN k % 7 = 1 AND nth = 1 THEN 'semantic-validator:local/stand-in' END AS corrected_by FROM o WHERE k % 7 IN (0, 1, 5, 6)")
def semantic_judgments(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = _judged(spark, sf)
    return rows.select("extraction_id", "validator_status", F.coalesce("corrected_value", "normalized_value").alias("effective_value"), "corrected_by")


@query("SELECT 'agr-' || c_custkey AS doc_id, CASE c_custkey % 7 WHEN 2 THEN 'pending' WHEN 3 THEN 'not_judged' ELSE 'evidence_not_verbatim' END AS error FROM customer WHERE c_custkey % 7 IN (2, 3, 4)")
def semantic_judgment_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf)[1]


@query(f"WITH {_AGR}, h AS (SELECT doc_id, string_agg('<tr><td>' || field_path || '</td><td>' || v || '</td><td>pending</td><td>' || CASE WHEN kind = 'not_found' THEN 'not_found' WHEN suffix IN ('counterparty', 'agreement_id', 'valid_from') THEN 'header' ELSE 'line=5' END || '</td>', chr(10) ORDER BY field_path) AS head, count(*) AS n_rows FROM r GROUP BY doc_id) SELECT doc_id, head, n_rows FROM h")
def review_packets(spark: SparkSession, sf: str) -> DataFrame:
    """The table rows of each agreement's review page, without their clauses."""
    docs = _agreements(spark, sf)
    silver, _ = S.extractions(S.chunks(docs).join(H.extraction_answers(docs), "doc_id"), docs, "model-1")
    rows = RV.packet_rows(silver).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("field_path", "html"))).alias("r"))
    head = F.array_join(F.transform("r", lambda x: F.concat(F.substring_index(x["html"], "</td>", 4), F.lit("</td>"))), "\n")
    return rows.select("doc_id", head.alias("head"), F.size("r").cast("long").alias("n_rows"))


@query("SELECT 'agr-' || c_custkey AS doc_id, 1 AS chunk_count, 'en' AS language, length(c_name) + length('Collateral Provider: ') AS first_line, 14 AS n_fields FROM customer")
def semantic_requests(spark: SparkSession, sf: str) -> DataFrame:
    """What a model is asked: the payload holds the whole text of a document that isn't cut, and the class's fields are named."""
    r = S.extraction_requests(S.chunks(_agreements(spark, sf)), "session-1")
    shown = F.get_json_object("user_payload", "$.document_text_untrusted")
    names = F.split(F.regexp_extract("system_prompt", "Fields: ([^\n]*)", 1), ", ")
    return r.select("doc_id", "chunk_count", F.get_json_object("user_payload", "$.language").alias("language"), F.length(F.get(T.split_lines(shown), F.lit(0))).alias("first_line"), F.size(names).alias("n_fields"))
