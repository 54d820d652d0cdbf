"""The offline stand-in for a model: answers made from a document's own structure, as column expressions.

A valuation page gives a group for each of a row's five durations; a schedule of
``label: value`` parts between bars gives a group for each line that names an asset class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from termloom.functions import text as T
from termloom.operators.extract import MISSING, sections
from termloom.operators.semantic import FIVE_NUMBERS, SECURITIES

FOUND, GUESSED = 0.7, 0.5
NOT_STATED = "[not stated in document]"
#: Duration buckets with their years, and how many groups end a valuation page.
DURATIONS = [("0-1", "0", "1"), (">1-3", "1", "3"), (">3-5", "3", "5"), (">5-10", "5", "10"), (">10", "10", None)]
MAX_GROUPS = 20
#: Labels of a line's parts and of a header, in order of preference.
ASSET = "asset class"
HAIRCUT = ("valuation haircut", "haircut")
CONCENTRATION = ("concentration cap", "concentration limit")
RATING = ("rating floor",)
CURRENCIES = ("currencies", "currency")
MATURITY = ("residual maturity cap", "tenor cap", "maturity cap")
COUNTERPARTY = ("collateral giver", "counterparty", "collateral provider")
AGREEMENT = ("profile reference", "agreement id", "reference")
VALID_FROM = ("effective", "valid from", "effective date")
NO_RATING = ("n/a", "na", "none")
NUMBER = "(-?\\d+(?:\\.\\d+)?)"
ROW = "struct<field_path:string,raw_value:string,normalized_value:string,value_type:string,source_clause:string,source_locator:string,confidence:double,ambiguity_flag:boolean,unit:string>"


def row(path: Column, raw: Column, value: Column, kind: str, clause: Column, place: Column, unit: str | None = None) -> Column:
    return F.struct(path, raw, value, F.lit(kind), clause, place, F.lit(FOUND), F.lit(False), F.lit(unit).cast("string")).cast(ROW)


def missing_row(path: Column) -> Column:
    return F.struct(path, F.lit(""), F.lit("not_found"), F.lit("not_found"), F.lit(NOT_STATED), F.lit("not_found"), F.lit(GUESSED), F.lit(False), F.lit(None).cast("string")).cast(ROW)


def slug(text: Column) -> Column:
    """Lower-case letters and digits joined by underscores; what has none is unspecified."""
    out = F.regexp_replace(F.regexp_replace(T.casefold(F.trim(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out == "", "unspecified").otherwise(out)


def iso_date_in(text: Column) -> Column:
    """The first ISO date that a text holds; null without one."""
    return F.nullif(F.regexp_extract(text, "(\\d{4}-\\d{2}-\\d{2})", 1), F.lit(""))


def dotted_date(text: Column) -> Column:
    """The first month.day.year that a text holds as an ISO date; null without one."""
    m, d, y = (F.regexp_extract(text, "(\\d{1,2})\\.(\\d{1,2})\\.(\\d{4})", k) for k in (1, 2, 3))
    return F.when(y != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))


def first_line_with(lines: Column, phrase: str) -> Column:
    """The first line that holds a phrase in whatever case and spacing; null without one."""
    return F.get(F.filter(lines, lambda x: F.contains(T.casefold(T.collapse(x)), F.lit(phrase.lower()))), F.lit(0))


def is_valuation(text: Column) -> Column:
    return F.contains(T.casefold(text), F.lit("collateral valuation")) & F.contains(T.casefold(text), F.lit(SECURITIES))


def valuation_rows(docs: DataFrame) -> DataFrame:
    """doc_id, place and the row of each value of valuation pages: the header's, then six or five for each of a row's durations.

    Table rows count until twenty groups are begun; of a row's numbers the last five are its values.
    """
    lines = F.filter(F.transform(T.split_lines(F.col("text")), lambda x: F.trim(x)), lambda x: x != "")
    pages = docs.where(is_valuation(F.col("text"))).select("doc_id", lines.alias("lines"))
    updated, by, why = (first_line_with(F.col("lines"), p) for p in ("Last Updated:", "Federal Reserve Bank", "discount window programs"))
    said, day = F.trim(F.substring_index(updated, ":", -1)), dotted_date(updated)
    at = F.lit("document=header")
    dated = F.when(day.isNotNull(), row(F.lit("document.last_updated"), said, day, "date", updated, at)).otherwise(row(F.lit("document.last_updated"), said, said, "string", updated, at))
    head = F.array(
        F.when(updated.isNotNull(), dated),
        F.when(by.isNotNull(), row(F.lit("document.publisher"), F.lit("Federal Reserve Bank"), F.lit("Federal Reserve"), "string", by, at)),
        F.when(why.isNotNull(), row(F.lit("document.program_context"), F.lit("discount window programs"), F.lit("Discount Window lending and Payment System Risk"), "string", why, at)),
    )
    label = lambda x: F.trim(F.regexp_replace(T.collapse(x), FIVE_NUMBERS, ""))
    numbers = lambda x: F.regexp_extract_all(T.collapse(x), F.lit("(\\b\\d{2,3}\\b)"), 1)
    is_row = lambda x: (F.size(numbers(x)) >= 5) & (label(x) != "") & ~T.casefold(label(x)).startswith("duration buckets") & ~T.casefold(label(x)).startswith("securities margins")
    table = F.slice(F.filter("lines", is_row), 1, MAX_GROUPS // len(DURATIONS))

    def groups(line: Column, r: Column) -> Column:
        out = []
        for k, (bucket, low, high) in enumerate(DURATIONS):
            n = r * len(DURATIONS) + k
            path = lambda f, n=n: F.concat(F.lit("valuation_margin["), n.cast("string"), F.lit(f"].{f}"))
            where = F.concat(F.lit("line="), (n + 1).cast("string"))
            value = F.get(F.slice(numbers(line), -5, 5), F.lit(k))
            cut = (100 - value.cast("int")).cast("string")
            out += [
                row(path("asset_category"), label(line), label(line), "string", line, where), row(path("duration_bucket"), F.lit(bucket), F.lit(bucket), "string", line, where), row(path("duration_min_years"), F.lit(low), F.lit(low), "integer", line, where),
                row(path("collateral_value_pct"), value, value, "percentage", line, where, "percent_of_market_value"), row(path("implied_haircut_pct"), cut, cut, "percentage", line, where, "percent"),
            ]
            if high:
                out.append(row(path("duration_max_years"), F.lit(high), F.lit(high), "integer", line, where))
        return F.array(*out)

    body = F.flatten(F.transform(table, lambda x, i: groups(x, i)))
    every = F.filter(F.concat(head, body), lambda x: x.isNotNull())
    return pages.select("doc_id", F.posexplode(every).alias("place", "r")).select("doc_id", "place", "r.*")


def asset_rows(docs: DataFrame) -> DataFrame:
    """doc_id, place and the row of each value of schedules: for each line that names an asset class its own values, then the header's, or that they are missing."""
    lines = F.transform(T.split_lines(F.col("text")), lambda x, i: F.struct((i + 1).alias("n"), x.alias("line"), sections(x).alias("parts")))
    plain = docs.where(~is_valuation(F.col("text"))).select("doc_id", lines.alias("lines"))
    # A header line has one label and no bar; the first of a label counts.
    header = F.filter("lines", lambda x: (F.instr(x["line"], "|") == 0) & (F.instr(x["line"], ":") > 0) & (T.label_of(x["line"]) != "") & (T.value_of(x["line"]) != ""))
    assets = F.filter("lines", lambda x: F.exists(x["parts"], lambda p: p["label"] == ASSET))
    items = plain.select("doc_id", header.alias("header"), F.posexplode(assets).alias("i", "a")).select("doc_id", "header", "i", "a.*")

    def part(labels: tuple[str, ...]) -> Column:
        """The value of the first of the labels that the line has (its last part of that label), or an empty text."""
        found = []
        for name in labels:
            hits = F.filter("parts", lambda p: p["label"] == name)  # noqa: B023
            found.append(F.get(hits, F.size(hits) - 1)["value"])
        return F.coalesce(*found, F.lit(""))

    def number(value: Column) -> Column:
        return F.nullif(F.regexp_extract(value, NUMBER, 1), F.lit(""))

    path = lambda f: F.concat(F.lit("eligibility["), F.col("i").cast("string"), F.lit(f"].{f}"))
    line, at = F.col("line"), F.concat(F.lit("line="), F.col("n").cast("string"))
    name, rating, money, years = part((ASSET,)), part(RATING), part(CURRENCIES), number(part(MATURITY))
    days = F.floor(years.cast("double") * 365).cast("long").cast("string")

    def from_header(field: str, labels: tuple[str, ...], kind: str) -> Column:
        out = []
        for want in labels:
            hit = F.get(F.filter("header", lambda x: T.label_of(x["line"]) == want), F.lit(0))  # noqa: B023
            value = T.value_of(hit["line"])
            normal = iso_date_in(value) if kind == "date" else value
            out.append(F.when(normal.isNotNull(), row(path(field), value, normal, kind, hit["line"], F.lit("header"))))
        return F.coalesce(*out, missing_row(path(field)))

    every = F.array(
        row(path("asset_criterion"), name, slug(name), "string", line, at), row(path("eligible"), F.lit("eligible"), F.lit("true"), "boolean", line, at),
        F.when(number(part(HAIRCUT)).isNotNull(), row(path("haircut_pct"), part(HAIRCUT), number(part(HAIRCUT)), "percentage", line, at, "percent")),
        F.when(number(part(CONCENTRATION)).isNotNull(), row(path("concentration_limit_pct"), part(CONCENTRATION), number(part(CONCENTRATION)), "percentage", line, at, "percent")),
        F.when((rating != "") & ~T.casefold(rating).isin(*NO_RATING), row(path("rating_floor"), rating, rating, "string", line, at)), F.when(money != "", row(path("currency_scope"), money, money, "string_array", line, at)),
        F.when(years.isNotNull(), row(path("tenor_cap_days"), part(MATURITY), days, "integer", line, at)),
        from_header("counterparty", COUNTERPARTY, "string"), from_header("agreement_id", AGREEMENT, "string"), from_header("valid_from", VALID_FROM, "date"), missing_row(path("margin_type")), missing_row(path("schedule_version")),
    )
    told = items.select("doc_id", "i", F.posexplode(F.filter(every, lambda x: x.isNotNull())).alias("k", "r"))
    return told.withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy("i", "k")) - 1).select("doc_id", "place", "r.*")


def extraction_answers(docs: DataFrame) -> DataFrame:
    """doc_id, content: the answer that a model would give, as JSON; documents without a known structure give none."""
    rows = valuation_rows(docs).unionByName(asset_rows(docs))
    item = F.struct("place", F.struct("field_path", "raw_value", "normalized_value", "value_type", "source_clause", "source_locator", "confidence", "ambiguity_flag", "unit").alias("r"))
    lists = rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["r"]).alias("extractions"))
    return lists.select("doc_id", F.to_json(F.struct("extractions")).alias("content"))


def judgment_answers(docs: DataFrame, silver: DataFrame) -> DataFrame:
    """doc_id, content: every row confirmed, with the clause that its path is derived from anew, or else the document's first line, as evidence."""
    again = valuation_rows(docs).unionByName(asset_rows(docs)).select(F.col("doc_id").alias("_d"), F.col("field_path").alias("_p"), F.col("source_clause").alias("_c"))
    first = docs.select(F.col("doc_id").alias("_f"), F.get(F.filter(T.split_lines(F.col("text")), lambda x: F.trim(x) != ""), F.lit(0)).alias("_line"))
    j = silver.join(again, (F.col("doc_id") == F.col("_d")) & (F.col("field_path") == F.col("_p")), "left").join(first, F.col("doc_id") == F.col("_f"), "left")
    gone = F.col("normalized_value") == "not_found"
    told = F.struct("extraction_id", F.lit("confirmed").alias("status"), F.when(gone, MISSING).otherwise(F.coalesce("_c", "_line")).alias("evidence_clause"), F.when(gone, "not_found").otherwise("revalidated").alias("evidence_locator"))
    return j.groupBy("doc_id").agg(F.array_sort(F.collect_list(told)).alias("judgments")).select("doc_id", F.to_json(F.struct("judgments")).alias("content"))
