"""Removal of repeated multi-line chunks across all documents, by DataFrame functions alone.

Lines are hashed; rolling hashes of the last two and three lines decide whether a chunk
ends after a line, so the same lines are cut alike wherever they stand in a text. Several
rolling hashes cut each text in their own ways, and a chunk of two lines or more counts.

A passage need not hold an end of a chunk at its borders, so each line also begins a
chunk, and ends one: the fewest lines from it on, or up to it, that hold ``PASSAGE_WORDS``
words. A passage of that many words that repeats is covered by such chunks, whatever
lines stand around it; one line that holds as many is one.

Chunks are counted by hash over all documents. Of those that occur again all but the first
occurrence (by doc_id, then text digest, then line) are removed, where they are equal in
bytes: they have the same lines by hash, one by one, and each line of them is compared as
bytes with all others of its hash, so every line goes to that comparison once, however
many chunks hold it. (A chunk with a line whose hash is another line's too stays.) Some
occurrence of each line always stays: the first one of all is never removed.

Chunks of many occurrences are split: a chunk's occurrences are dealt to one part for each
``PART`` of them, and the few that hold a large share of all are joined by broadcast.

Defined cases: a null text stays null; an empty text is one empty line; rows equal
in id and text are one document here and come out alike; ids may be null (first);
a text whose lines all go becomes empty; an empty table gives an empty result; extra
columns pass through ``dedup_lines`` whatever they are called, unless they begin with ``_ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import spread_join, written

#: A repeated chunk of so many words counts even where it is one line.
PASSAGE_WORDS = 50
#: Lines in each rolling hash's window, and its multiplier.
CUTTERS = [(2, 1_103_515_245), (3, 214_013)]
PRIME = (1 << 31) - 1
#: Occurrences of a chunk that are compared in one part.
PART = 1000


def _digest(id_col: str, text_col: str) -> Column:
    """Identity of a row: its id and text; never null, so joins add no filter and their shuffles of texts can be one."""
    told = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("\u0000")), F.lit("\u0001"), F.coalesce(F.col(text_col), F.lit("\u0000")))
    return F.coalesce(F.unhex(F.md5(told.cast("binary"))), F.lit(b""))


def line_hash(line: Column) -> Column:
    """28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def identities(lines: Column) -> Column:
    """64 bits of each line's hash."""
    return F.transform(lines, lambda line: F.xxhash64(line))


def word_count(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _rolled(hashes: Column, i: Column, window: int, by: int) -> Column:
    """The rolling hash of line ``i`` (from 0) and the lines before it; none counts as 0."""
    out = F.lit(0).cast("long")
    for k in range(window - 1, -1, -1):
        out = F.pmod((out + F.coalesce(F.get(hashes, i - k), F.lit(0))) * F.lit(by), F.lit(PRIME))
    return out


def _passage(words: Column, i: Column, step: int) -> Column:
    """How many lines from line ``i`` (from 0) on, or back, hold PASSAGE_WORDS words; null where all that there are don't.

    A line counts one word at least, so as many lines always do.
    """
    near = F.slice(words, i + 1, F.lit(PASSAGE_WORDS)) if step > 0 else F.reverse(F.slice(words, F.greatest(i + 2 - PASSAGE_WORDS, F.lit(1)), F.least(i + 1, F.lit(PASSAGE_WORDS))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum"))
    more = lambda s, w: F.when(s["sum"] >= PASSAGE_WORDS, s).otherwise(F.struct((s["n"] + 1).alias("n"), (s["sum"] + w).alias("sum")))
    run = F.aggregate(near, start, more)
    return F.when(F.get(words, i) >= PASSAGE_WORDS, F.lit(1)).otherwise(F.when(run["sum"] >= PASSAGE_WORDS, run["n"]))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The chunks of every document that may be removed: _ld_row, _ld_from, _ld_to (lines from 1) and _ld_key; rows equal in id and text give theirs each. No shuffle."""
    base = docs.where(F.col(text_col).isNotNull()).select(_digest(id_col, text_col).alias("_ld_row"), F.split(text_col, "\n", -1).alias("_ld_all"))
    lines = base.select("_ld_row", F.transform("_ld_all", line_hash).alias("_ld_h"), F.transform("_ld_all", word_count).alias("_ld_w"), identities(F.col("_ld_all")).alias("_ld_x"))
    h, w, x = F.col("_ld_h"), F.col("_ld_w"), F.col("_ld_x")
    places = F.sequence(F.lit(0), F.size(h) - 1)
    ends = [F.filter(places, lambda i: (i == F.size(h) - 1) | (_rolled(h, i, window, by) % 2 == 0)).alias(f"_ld_e{k}") for k, (window, by) in enumerate(CUTTERS)]
    ahead = F.transform(places, lambda i: F.struct(i.alias("a"), (i + _passage(w, i, 1) - 1).alias("b")))
    back = F.transform(places, lambda i: F.struct((i - _passage(w, i, -1) + 1).alias("a"), i.alias("b")))
    lines = lines.select("_ld_row", "_ld_x", *ends, F.filter(F.concat(ahead, back), lambda s: s["a"].isNotNull() & s["b"].isNotNull()).alias("_ld_p"))
    # A chunk begins after the end before it.
    cut = [F.filter(F.transform(f"_ld_e{k}", lambda b, j: F.struct(F.coalesce(F.get(F.col(f"_ld_e{k}"), j - 1) + 1, F.lit(0)).alias("a"), b.alias("b"))), lambda s: s["b"] > s["a"]) for k in range(len(CUTTERS))]
    spans = lines.select("_ld_row", "_ld_x", F.array_distinct(F.concat("_ld_p", *cut)).alias("_ld_s"))
    key = lambda s: F.xxhash64(F.slice(x, s["a"] + 1, s["b"] - s["a"] + 1))
    each = spans.select("_ld_row", F.explode(F.transform("_ld_s", lambda s: F.struct((s["a"] + 1).alias("a"), (s["b"] + 1).alias("b"), key(s).alias("k")))).alias("s"))
    return each.select("_ld_row", F.col("s.a").alias("_ld_from"), F.col("s.b").alias("_ld_to"), F.col("s.k").alias("_ld_key"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks gone from ``text_col``, and ``_ld_lines``, ``_ld_removed``: lines before, lines removed."""
    cut = written(chunks(docs, id_col, text_col), "line-chunks")
    again = written(cut.groupBy("_ld_key").agg(F.count(F.lit(1)).alias("_ld_n")).where("_ld_n > 1"), "line-repeats")
    spans = spread_join(cut, again, "_ld_key", "_ld_n", cut.count())
    wanted = spans.groupBy("_ld_row").agg(F.collect_set(F.struct(F.col("_ld_from").alias("a"), F.col("_ld_to").alias("b"), F.col("_ld_n").alias("n"))).alias("_ld_spans"))
    keyed = docs.withColumn("_ld_row", _digest(id_col, text_col))
    lines = F.split(text_col, "\n", -1)
    # With the id taken from here, this join and the last one shuffle the same columns: Spark then does it once.
    held = keyed.join(wanted, "_ld_row").select("_ld_row", F.col(id_col).alias("_ld_id"), lines.alias("_ld_all"), "_ld_spans")
    inside = F.flatten(F.transform("_ld_spans", lambda s: F.slice("_ld_all", s["a"], s["b"] - s["a"] + 1)))
    line = held.select("_ld_id", F.explode(F.array_distinct(inside)).alias("_ld_line")).groupBy(F.xxhash64("_ld_line").alias("_ld_x")).agg(F.min("_ld_line").alias("lo"), F.max("_ld_line").alias("hi"), F.count("_ld_id").alias("n"))
    # Hashes of unlike lines: 1 in 2**64 for any two, so as good as never any. As a subquery of the same plan, with the same columns (so it counts ids), it shares the shuffle of the texts.
    unlike = F.coalesce(line.where("lo != hi AND n >= 0").agg(F.collect_list("_ld_x").alias("u")).scalar(), F.array().cast("array<long>"))
    told = held.select("_ld_row", "_ld_id", identities(F.col("_ld_all")).alias("_ld_x"), F.explode("_ld_spans").alias("s"))
    told = told.select("_ld_row", "_ld_id", F.col("s.a").alias("_ld_from"), F.col("s.b").alias("_ld_to"), F.slice("_ld_x", F.col("s.a"), F.col("s.b") - F.col("s.a") + 1).alias("_ld_seq"), F.ceil(F.col("s.n") / PART).cast("int").alias("_ld_parts"))
    told = told.where(~F.arrays_overlap("_ld_seq", unlike))
    place = F.struct(F.col("_ld_id"), F.col("_ld_row"), F.col("_ld_from"))
    first = told.groupBy("_ld_seq", "_ld_parts").agg(F.min(place).alias("_ld_first")).withColumn("_ld_part", F.explode(F.sequence(F.lit(0), F.col("_ld_parts") - 1))).drop("_ld_parts")
    dealt = told.withColumn("_ld_part", F.pmod(F.xxhash64("_ld_row", "_ld_from"), F.col("_ld_parts")).cast("int"))
    gone = (
        dealt.join(first, ["_ld_seq", "_ld_part"])
        .where(~place.eqNullSafe(F.col("_ld_first")))
        .groupBy("_ld_row")
        .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("_ld_from", "_ld_to")))).alias("_ld_gone"))
    )
    out = keyed.join(gone, "_ld_row", "left")
    count = F.coalesce(F.size(lines), F.lit(0))
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), "_ld_gone"), lambda i: F.get(lines, i - 1))
    return out.withColumns({
        "_ld_lines": F.when(F.col(text_col).isNull(), 0).otherwise(count).cast("int"),
        "_ld_removed": F.coalesce(F.size("_ld_gone"), F.lit(0)).cast("int"),
        text_col: F.when(F.col("_ld_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
    }).select(*[F.col(f"`{c}`") for c in docs.columns], "_ld_lines", "_ld_removed")


def op1_query(docs: DataFrame) -> DataFrame:
    """Every document with its text after removal."""
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "text", F.col("_ld_lines").alias("n_lines"), F.col("_ld_removed").alias("n_removed"))


def _sql() -> str:
    ends = []
    for k, (window, by) in enumerate(CUTTERS):
        rolled = "0"
        for j in range(window - 1, -1, -1):
            rolled = f"(({rolled} + h{j}) * {by}) % {PRIME}"
        ends.append(f"(next IS NULL OR ({rolled}) % 2 = 0) AS e{k}")
    parts = [f"SELECT rid, doc_id, coalesce(max(CASE WHEN e{k} THEN pos + 1 END) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS a, pos AS b, e{k} AS at_end, 2 AS least FROM ended" for k in range(len(CUTTERS))]
    return f"""
WITH base AS (SELECT doc_id, text, md5(coalesce(doc_id::VARCHAR, chr(0)) || chr(1) || text) AS rid FROM documents),
split AS (SELECT DISTINCT rid, doc_id, string_split(text, chr(10)) AS lines FROM base WHERE text IS NOT NULL),
lined AS (SELECT rid, doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM split),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h0, length(line) - length(replace(line, ' ', '')) + 1 AS w FROM lined),
near AS (SELECT *, coalesce(lag(h0) OVER o, 0) AS h1, coalesce(lag(h0, 2) OVER o, 0) AS h2, lead(pos) OVER o AS next, sum(w) OVER (PARTITION BY rid ORDER BY pos)::BIGINT AS till, sum(w) OVER (PARTITION BY rid)::BIGINT AS words, count(*) OVER (PARTITION BY rid) AS n FROM hashed WINDOW o AS (PARTITION BY rid ORDER BY pos)),
ended AS (SELECT *, till - w AS since, {", ".join(ends)} FROM near),
ahead AS (SELECT rid, doc_id, pos AS a, coalesce(min(pos) OVER (PARTITION BY rid ORDER BY since RANGE BETWEEN {PASSAGE_WORDS} FOLLOWING AND UNBOUNDED FOLLOWING) - 1, CASE WHEN words - since >= {PASSAGE_WORDS} THEN n END) AS b, true AS at_end, 1 AS least FROM ended),
back AS (SELECT rid, doc_id, CASE WHEN till >= {PASSAGE_WORDS} THEN coalesce(max(pos) OVER (PARTITION BY rid ORDER BY till RANGE BETWEEN UNBOUNDED PRECEDING AND {PASSAGE_WORDS} PRECEDING) + 1, 1) END AS a, pos AS b, true AS at_end, 1 AS least FROM ended),
spans AS (SELECT DISTINCT rid, doc_id, a, b FROM (SELECT * FROM ahead UNION ALL SELECT * FROM back UNION ALL {" UNION ALL ".join(parts)}) WHERE at_end AND a IS NOT NULL AND b IS NOT NULL AND b - a + 1 >= least),
once AS (SELECT s.rid, s.doc_id, a, b, string_agg(line, chr(10) ORDER BY pos) AS body FROM spans s JOIN lined l ON l.rid = s.rid AND l.pos BETWEEN s.a AND s.b GROUP BY s.rid, s.doc_id, a, b),
told AS (SELECT *, row_number() OVER (PARTITION BY body, b - a ORDER BY doc_id NULLS FIRST, rid, a) AS nth FROM once),
gone AS (SELECT DISTINCT rid, unnest(range(a, b + 1)) AS pos FROM told WHERE nth > 1),
rest AS (SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS body, count(g.pos) AS n FROM lined l LEFT JOIN gone g ON l.rid = g.rid AND l.pos = g.pos GROUP BY l.rid)
SELECT b.doc_id, CASE WHEN b.text IS NULL THEN NULL ELSE coalesce(r.body, '') END AS text, coalesce(len(string_split(b.text, chr(10))), 0)::INTEGER AS n_lines, coalesce(r.n, 0)::INTEGER AS n_removed
FROM base b LEFT JOIN rest r ON b.rid = r.rid"""


OP1_SQL = _sql()
