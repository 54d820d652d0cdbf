"""Table schemas, the registry of document classes, and row rules as predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SILVER = (
    "extraction_id string, doc_id string, doc_class string, extractor_version string, constitution_version string, field_path string, raw_value string, "
    "normalized_value string, value_type string, unit string, currency string, source_clause string, source_locator string, confidence double, ambiguity_flag boolean, "
    "ambiguity_note string, validator_status string, corrected_value string, corrected_by string, created_at timestamp"
)
ELIGIBILITY = (
    "counterparty string, agreement_id string, schedule_version string, margin_type string, asset_criterion string, eligible boolean, haircut_pct double, concentration_limit_pct double, "
    "concentration_basis string, currency_scope array<string>, rating_floor string, tenor_cap_days long, valid_from date, valid_to date, knowledge_from timestamp, knowledge_to timestamp, "
    "silver_extraction_ids array<string>, doc_id string"
)
LIMIT = (
    "dimension string, scope_value string, limit_value double, limit_unit string, limit_currency string, basis string, aggregation string, counterparty string, agreement_id string, "
    "schedule_version string, clearing_house string, valid_from date, valid_to date, knowledge_from timestamp, knowledge_to timestamp, silver_extraction_ids array<string>, doc_id string"
)
MARGIN = (
    "counterparty string, agreement_id string, csa_schedule_ref string, netting_set_id string, margin_type string, required_amount double, currency string, risk_class string, model string, "
    "regulatory_regime string, valuation_date date, valid_from date, valid_to date, knowledge_from timestamp, knowledge_to timestamp, silver_extraction_ids array<string>, doc_id string"
)
#: The other tables.
BRONZE = "doc_id string, source string, counterparty string, doc_class_hint string, file_uri string, file_hash string, page_count int, received_at timestamp, text_artifact_uri string, layout_artifact_uri string"
TASK = "doc_id string, status string, updated_at timestamp, error string"
DECISION = "doc_id string, approved boolean, decided_by string, decided_at timestamp, note string"
GOLDEN_RESULT = "run_id string, doc_class string, extractor_version string, constitution_version string, document_count int, owner_verified_document_count int, total_fields int, correct_fields int, field_accuracy double, run_at timestamp, release_blocked boolean"
MODEL_CALL = "doc_id string, role string, provider string, model string, session_id string, response_id string, prompt_version string, schema_version string, constitution_version string, language string, request_hash string, response_hash string, created_at timestamp, latency_ms long, input_tokens long, output_tokens long, total_tokens long"
CORRECTION = "doc_id string, extraction_id string, field_path string, action string, reviewer string, decided_at timestamp, previous_status string, previous_value string, corrected_value string, note string"

#: Tables by name: columns, those that may be null, and what must hold.
TABLES = {
    "bronze_documents": (BRONZE, ["counterparty", "doc_class_hint", "page_count", "text_artifact_uri", "layout_artifact_uri"], {}),
    "silver_extractions": (SILVER, ["raw_value", "unit", "currency", "ambiguity_note", "corrected_value", "corrected_by", "created_at"], {"valid_confidence": "confidence BETWEEN 0.0 AND 1.0", "valid_validator_status": "validator_status IN ('pending', 'confirmed', 'disputed', 'corrected')"}),
    "gold_eligibility_terms": (ELIGIBILITY, ["haircut_pct", "concentration_limit_pct", "concentration_basis", "currency_scope", "rating_floor", "tenor_cap_days", "valid_to", "knowledge_to"], {"valid_haircut": "haircut_pct IS NULL OR haircut_pct BETWEEN 0.0 AND 100.0", "valid_concentration": "concentration_limit_pct IS NULL OR concentration_limit_pct BETWEEN 0.0 AND 100.0", "valid_valid_time": "valid_to IS NULL OR valid_from <= valid_to", "valid_knowledge_time": "knowledge_to IS NULL OR knowledge_from <= knowledge_to"}),
    "workflow_tasks": (TASK, ["error"], {"valid_task_status": "status IN ('landed', 'classified', 'extracted', 'validated', 'gate_a_pending', 'gate_a_approved', 'gold_landed', 'failed')"}),
    "gate_a_decisions": (DECISION, ["note"], {}),
    "golden_set_results": (GOLDEN_RESULT, [], {}),
    "semantic_model_calls": (MODEL_CALL, ["latency_ms", "input_tokens", "output_tokens", "total_tokens"], {"valid_semantic_role": "role IN ('extractor', 'validator')"}),
    "correction_actions": (CORRECTION, ["corrected_value", "note"], {"valid_correction_action": "action IN ('confirm', 'correct', 'dispute')", "valid_previous_status": "previous_status IN ('pending', 'confirmed', 'disputed', 'corrected')"}),
    "gold_collateral_limits": (LIMIT, ["scope_value", "limit_currency", "basis", "aggregation", "counterparty", "agreement_id", "schedule_version", "clearing_house", "valid_from", "valid_to", "knowledge_to"], {"valid_limit_unit": "limit_unit IN ('percent', 'absolute')", "valid_percent_limit": "limit_unit <> 'percent' OR limit_value BETWEEN 0.0 AND 100.0", "valid_absolute_limit": "limit_unit <> 'absolute' OR (limit_value >= 0.0 AND limit_currency IS NOT NULL)", "valid_limit_valid_time": "valid_to IS NULL OR valid_from <= valid_to", "valid_limit_knowledge_time": "knowledge_to IS NULL OR knowledge_from <= knowledge_to"}),
    "gold_margin_requirements": (MARGIN, ["agreement_id", "csa_schedule_ref", "netting_set_id", "risk_class", "model", "regulatory_regime", "valuation_date", "valid_from", "valid_to", "knowledge_to"], {"valid_required_amount": "required_amount >= 0.0", "valid_margin_valid_time": "valid_to IS NULL OR valid_from <= valid_to", "valid_margin_knowledge_time": "knowledge_to IS NULL OR knowledge_from <= knowledge_to"}),
}

#: Keys by which a gold row's versions follow each other.
GOLD_KEYS = {
    "eligibility": ["counterparty", "agreement_id", "margin_type", "asset_criterion", "valid_from"],
    "limit": ["counterparty", "agreement_id", "schedule_version", "dimension", "scope_value", "valid_from"],
    "requirement": ["counterparty", "agreement_id", "netting_set_id", "margin_type", "valuation_date"],
}
#: States, margin types and value types.
STATUSES = ["pending", "confirmed", "disputed", "corrected"]
SETTLED = ["confirmed", "corrected"]
MARGIN_TYPES = ["VM", "IM", "Repo", "Clearing Fund", "Secured Financing"]
VALUE_TYPES = ["string", "boolean", "percentage", "integer", "date", "string_array", "not_found"]
#: Labels of a normalised schedule's header and asset fields, with their types.
HEADER_FIELDS = [("counterparty", "Counterparty", "string"), ("agreement_id", "Agreement ID", "string"), ("schedule_version", "Schedule Version", "string"), ("margin_type", "Margin Type", "string"), ("valid_from", "Valid From", "date"), ("valid_to", "Valid To", "date")]
ITEM_FIELDS = [("asset_criterion", "Asset", "string"), ("eligible", "Eligible", "boolean"), ("haircut_pct", "Haircut", "percentage"), ("concentration_limit_pct", "Concentration Limit", "percentage"), ("concentration_basis", "Concentration Basis", "string"), ("currency_scope", "Currencies", "string_array"), ("rating_floor", "Rating Floor", "string"), ("tenor_cap_days", "Tenor Cap Days", "integer")]
REQUIRED_GOLD = ["counterparty", "agreement_id", "schedule_version", "margin_type", "asset_criterion", "eligible", "valid_from"]


def effective_value() -> Column:
    """The corrected value where there is one that isn't empty, else the normalised one."""
    return F.coalesce(F.nullif(F.col("corrected_value"), F.lit("")), F.col("normalized_value"))


def present(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) != ""


def silver_rules() -> list[tuple[str, Column]]:
    """Made on demand: columns need a running session."""
    lineage = ["extraction_id", "doc_id", "doc_class", "extractor_version", "constitution_version", "field_path", "source_clause", "source_locator"]
    ok = present(lineage[0])
    for name in lineage[1:]:
        ok = ok & present(name)
    return [
        ("blank_lineage", ok),
        ("confidence_range", F.col("confidence").between(0, 1)),
        ("ambiguity_needs_note", ~F.col("ambiguity_flag") | present("ambiguity_note")),
        ("not_found_sentinel", (F.col("value_type") == "not_found") == (F.col("normalized_value") == "not_found")),
        ("corrected_needs_value_and_reviewer", (F.col("validator_status") == "corrected") == ((F.coalesce("corrected_value", F.lit("")) != "") & (F.coalesce("corrected_by", F.lit("")) != ""))),
    ]


def first_broken(rules: list[tuple[str, Column]]) -> Column:
    """The first rule that a row breaks, or null; an unknown outcome is a break."""
    return F.coalesce(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules])


def split_valid(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the rest with the first broken ``rule``."""
    marked = df.withColumn("rule", first_broken(rules))
    return marked.where(F.col("rule").isNull()).drop("rule"), marked.where(F.col("rule").isNotNull())


def ddl(name: str) -> str:
    """CREATE TABLE text of a table, with its constraints as comments: plain Parquet tables hold none, ``table_rules`` checks them."""
    columns, maybe, rules = TABLES[name]
    lines = [c + ("" if c.split(" ")[0] in maybe else " NOT NULL") for c in columns.split(", ")]
    told = "".join(f"\n-- {k}: {v}" for k, v in rules.items())
    return f"CREATE TABLE {name} (\n  " + ",\n  ".join(lines) + f"\n) USING parquet{told}"


def table_rules(name: str) -> list[tuple[str, Column]]:
    """A table's constraints as predicates: columns that may not be null, then its own rules; as in SQL an unknown outcome of those passes."""
    columns, maybe, rules = TABLES[name]
    needed = [c.split(" ")[0] for c in columns.split(", ") if c.split(" ")[0] not in maybe]
    return [(f"missing:{c}", F.col(c).isNotNull()) for c in needed] + [(k, F.coalesce(F.expr(v), F.lit(True))) for k, v in rules.items()]
