"""What a reviewer reads and answers: packets, listings, the gate, the dashboard and reports.

Pages are made on the driver from one document's rows or from aggregates of a few rows.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators import quality as Q
from termloom.schemas import SETTLED, STATUSES, effective_value

#: The columns of the audit's appendix.
APPENDIX = ["doc_id", "extraction_id", "field_path", "normalized_value", "source_clause", "source_locator", "validator_status"]
SHOWN = ["extraction_id", "field_path", "normalized_value", "corrected_value", "validator_status", "source_locator", "source_clause"]
COLOURS = {"confirmed": "#1a7f37", "corrected": "#0969da", "disputed": "#cf222e", "pending": "#bf8700"}


def pending(silver: DataFrame) -> DataFrame:
    """Rows that still need a reviewer: all but the confirmed ones."""
    return silver.where(F.col("validator_status") != "confirmed")


def audit_appendix(silver: DataFrame) -> DataFrame:
    return silver.select(*APPENDIX)


def packet_rows(silver: DataFrame) -> DataFrame:
    """doc_id, payload, html: one row a silver row, as JSON and as an escaped table row; no page leaves Spark for this."""
    cell = lambda c: F.concat(F.lit("<td>"), T.html_escape(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    status = F.col("validator_status")
    mark = F.concat(F.when(status == "disputed", '<td class="disputed">').otherwise("<td>"), T.html_escape(status), F.lit("</td>"))
    line = F.concat(F.lit("<tr>"), cell(F.col("field_path")), cell(effective_value()), mark, cell(F.col("source_locator")), cell(F.col("source_clause")), F.lit("</tr>"))
    return silver.select("doc_id", "field_path", F.to_json(F.struct(*silver.columns), {"ignoreNullFields": "false"}).alias("payload"), line.alias("html"))


def packets(silver: DataFrame) -> DataFrame:
    """doc_id, json, page: a document's review packet, its rows in order of their paths."""
    rows = packet_rows(silver).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("field_path", "payload", "html"))).alias("r"))
    body = F.array_join(F.transform("r", lambda x: x["html"]), "\n")
    doc = T.html_escape(F.col("doc_id"))
    page = F.concat(
        F.lit('<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>Review of '), doc, F.lit("</title><style>td,th{border:1px solid #bbb;padding:.4rem;vertical-align:top}.disputed{color:#cf222e;font-weight:600}</style></head><body>\n<h1>Review of "), doc,
        F.lit("</h1>\n<p>Read only: confirm, correct or dispute values by the review command. Disputed values hold the document back.</p>\n<table><thead><tr><th>Field</th><th>Value</th><th>Status</th><th>Locator</th><th>Clause</th></tr></thead><tbody>\n"), body, F.lit("\n</tbody></table>\n</body></html>\n"),
    )
    return rows.select("doc_id", F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["payload"]), ",\n"), F.lit("]\n")).alias("json"), page.alias("page"))


def memory_hint(fix: Column, n: Column) -> Column:
    """What the memory says of a value: its last correction, or that it was disputed; null without either."""
    times = F.concat(F.lit("("), n.cast("string"), F.lit("×)"))
    return F.when(n.isNull(), F.lit(None)).when(fix.isNotNull(), F.concat(F.lit("↳ memory: previously corrected to '"), fix, F.lit("' "), times)).otherwise(F.concat(F.lit("↳ memory: previously disputed "), times, F.lit(" — review carefully")))


def listing(silver: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """doc_id, listing: a document's rows as numbered text, with the memory's hints (extraction_id, n, suggested_value)."""
    rows = silver.select("doc_id", *SHOWN, effective_value().alias("value"))
    rows = rows.join(hints.select("extraction_id", "n", "suggested_value"), "extraction_id", "left") if hints is not None else rows.withColumn("n", F.lit(None).cast("long")).withColumn("suggested_value", F.lit(None).cast("string"))
    hint = memory_hint(F.col("suggested_value"), F.col("n"))
    item = F.struct("field_path", "value", "validator_status", "source_locator", "source_clause", hint.alias("hint"))
    per = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("r"))

    def shown(x: Column, i: Column) -> Column:
        mark = F.when(x["validator_status"] == "disputed", "  << disputed").otherwise("")
        parts = [F.concat(F.lit("["), F.lpad((i + 1).cast("string"), 2, " "), F.lit("] "), x["field_path"], mark)]
        parts += [F.concat(F.lit(f"      {name:<9}"), x[key]) for name, key in (("value:", "value"), ("status:", "validator_status"), ("locator:", "source_locator"), ("clause:", "source_clause"))]
        return F.concat_ws("\n", *parts, F.when(x["hint"].isNotNull(), F.concat(F.lit("      "), x["hint"])))

    return per.select("doc_id", F.array_join(F.transform("r", lambda x, i: shown(x, i)), "\n").alias("listing"))


def decide(silver: DataFrame, reviewer: str, approved: bool, decided_at: Column, note: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Decisions of documents, and doc_id, problem of those that may not be approved: any row pending or disputed. A decision needs a reviewer."""
    if not reviewer.strip():
        raise ValueError("a decision needs a reviewer")
    per = silver.groupBy("doc_id").agg(F.count_if(~F.col("validator_status").isin(*SETTLED)).alias("open"))
    ok = (F.col("open") == 0) | F.lit(not approved)
    kept = per.where(ok).select("doc_id", F.lit(approved).alias("approved"), F.lit(reviewer).alias("decided_by"), decided_at.alias("decided_at"), F.lit(note).cast("string").alias("note"))
    return kept, per.where(~ok).select("doc_id", F.lit("pending_or_disputed").alias("problem"))


def review_loop(rows: Iterable[dict], ask: Callable[[str], str], say: Callable[[str], None], pending_only: bool = False, hints: dict[str, tuple[str | None, int]] | None = None) -> list[dict]:
    """Requests of a reviewer at a terminal, row by row: confirm, correct (with a value, or the remembered one), dispute (with a reason), skip, quit."""
    out: list[dict] = []
    rows = list(rows)
    for n, r in enumerate(rows, 1):
        if pending_only and r["validator_status"] == "confirmed":
            continue
        remembered, times = (hints or {}).get(r["extraction_id"], (None, 0))
        say(f"({n}/{len(rows)}) {r['field_path']}: {r.get('corrected_value') or r['normalized_value']} [{r['validator_status']}] {r['source_locator']}\n      {r['source_clause']}")
        if times:
            say(f"      ↳ memory: {f'corrected to {remembered!r}' if remembered else 'disputed'} ({times}×)")
        while True:
            choice = ask("confirm, correct, dispute, skip or quit (c/o/d/s/q): ").strip().lower()
            answer = {"c": "confirm", "o": "correct", "d": "dispute", "s": "skip", "": "skip", "q": "quit"}.get(choice, choice)
            request = {"extraction_id": r["extraction_id"], "action": answer, "new_value": None, "note": None}
            if answer == "correct":
                request["new_value"] = ask("corrected value: ").strip() or remembered
                if not request["new_value"]:
                    say("a correction needs a value")
                    continue
                request["note"] = ask("note: ").strip() or None
            elif answer == "dispute":
                request["note"] = ask("reason: ").strip()
                if not request["note"]:
                    say("a dispute needs a reason")
                    continue
            elif answer not in ("confirm", "skip", "quit"):
                say("answer c, o, d, s or q")
                continue
            break
        if answer == "quit":
            break
        if answer != "skip":
            out.append(request)
    return out


def requests_of(text: str) -> tuple[list[dict], float | None]:
    """Requests, and review seconds where they are told, of a corrections file: a list, or an object that holds one; an empty one is an error."""
    told = json.loads(text)
    rows = told.get("corrections") if isinstance(told, dict) else told
    if not isinstance(rows, list) or not rows:
        raise ValueError("the file holds no corrections")
    seconds = told.get("review_seconds") if isinstance(told, dict) else None
    return [{"extraction_id": r["extraction_id"], "action": r["action"], "new_value": r.get("corrected_value"), "note": r.get("note")} for r in rows], None if seconds is None else float(seconds)


def action_counts(requests: DataFrame) -> DataFrame:
    """How many requests there are of each action; all three are named."""
    names = F.explode(F.array(*[F.lit(a) for a in ("confirm", "correct", "dispute")])).alias("action")
    return requests.sparkSession.range(1).select(names).join(requests.groupBy("action").agg(F.count(F.lit(1)).alias("n")), "action", "left").select("action", F.coalesce("n", F.lit(0)).alias("n"))


def over_target(timings: DataFrame, seconds: str, target_minutes: float = 15) -> DataFrame:
    """Reviews that took longer than the target, longest first."""
    return timings.where(F.col(seconds) / 60 > target_minutes).orderBy(F.desc(seconds))


def memory_list(memory: DataFrame) -> DataFrame:
    return memory.orderBy("doc_class", "suffix", "original_value")


def briefing(kpi: dict, documents: int) -> str:
    return f"Processed {documents} document(s): {kpi['completeness']:.1%} of fields found, {kpi['mean_confidence']:.1%} mean confidence, {kpi['n_disputed']} disputed and {kpi['n_ambiguous']} ambiguous field(s). Nothing is promoted without validation and approval."


def dashboard(silver: DataFrame, title: str = "Quality") -> str:
    """A page that needs nothing else: six tiles, a bar of states, and each document's completeness; every text is escaped."""
    told = Q.kpis(silver, []).first().asDict()
    per = [r.asDict() for r in Q.kpis(silver, ["doc_id"]).orderBy("doc_id").collect()]
    say = lambda x: html.escape(str(x))
    tiles = [("Documents", len(per)), ("Fields extracted", told["n"]), ("Field completeness", f"{told['completeness'] * 100:.1f}%"), ("Mean confidence", f"{told['mean_confidence'] * 100:.0f}%"), ("Open disputes", told["n_disputed"]), ("Ambiguous fields", told["n_ambiguous"])]
    whole = max(told["n"], 1)
    bar = "".join(f'<span class="part" style="width:{told[f"n_{s}"] / whole * 100:.3f}%;background:{c}" title="{s}: {told[f"n_{s}"]}"></span>' for s, c in COLOURS.items() if told[f"n_{s}"])
    legend = "".join(f"<li>{s}: {told[f'n_{s}']}</li>" for s in STATUSES)
    meter = lambda share: f'<span class="meter"><span style="width:{min(max(share * 100, 0), 100):.1f}%"></span></span>'
    rows = "".join(f"<tr><td>{say(r['doc_id'])}</td><td>{r['n']}</td><td>{meter(r['completeness'])}</td><td>{r['n_disputed']}</td></tr>" for r in per)
    style = "body{font:14px sans-serif}.tile{display:inline-block;margin:1rem}.tile b{display:block;font-size:1.6rem}.bar,.meter{display:block;background:#ddd;height:.8rem}.bar{display:flex}.part{height:100%}.meter span{display:block;height:100%;background:#0969da}"
    head = "".join(f'<div class="tile"><b>{say(v)}</b>{say(k)}</div>' for k, v in tiles)
    return f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>{say(title)}</title><style>{style}</style></head><body><h1>{say(title)}</h1><p>{say(briefing(told, len(per)))}</p>{head}<div class="bar">{bar}</div><ul>{legend}</ul><table><tr><th>Document</th><th>Fields</th><th>Completeness</th><th>Disputes</th></tr>{rows}</table></body></html>\n'


def distilled_markdown(rules: list[dict], golden: int, unresolved: list[dict], corrections: int) -> str:
    """What the log teaches, for a reader: proposed rules, golden cases and disputes that are open."""
    out = ["# Proposals from corrections", "", f"{corrections} action(s) of reviewers were replayed.", "", f"- Rules: {len(rules)}", f"- Golden cases: {golden}", f"- Open disputes: {len(unresolved)}", "", "## Rules"]
    for r in rules:
        what = f"normalise `{r['previous_value']}` to `{r['targets']}`" if r["kind"] == "normalization" else f"ask for review ({r['targets'] or 'no reason given'})"
        out.append(f"- **{r['schema']}.{r['suffix']}**: {what}, {r['n']}×, by {r['reviewers']}")
    out += [] if rules else ["_None: nothing was corrected or disputed repeatedly._"]
    out += ["", "## Open disputes"] + [f"- {d['doc_id']} `{d['field_path']}` (by {d['reviewer']}){' — ' + d['note'] if d['note'] else ''}" for d in unresolved]
    out += [] if unresolved else ["_None._"]
    return "\n".join(out) + "\n"
