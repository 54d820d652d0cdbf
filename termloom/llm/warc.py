"""WARC records of pages, and a Merkle audit of replicas.

``records`` are WARC/1.1 resource records, one a page. A record is known by its page_id, url
and occurrence (among records of equal page_id and url, by digest); a hash of those is its
place, whatever other records a replica holds. Places of equal leading digits (base 8) are a
branch: a segment is a range of places that is expected to hold at most ``SEGMENT_RECORDS``
records, in order of place with running byte offsets, and is cut into 64 ordered ranges of
its own. A range hashes its records' offsets (within the range), lengths and digests, a node its
up to 8 ordered children, up to one root. ``audit`` compares two replicas' roots and follows
only branches whose hashes differ, level by level, down to ranges; there records are compared
one by one, so a record that a replica lacks, or has too many, condemns no other.

``write_warc`` and ``read_warc`` store and parse the files themselves.

Defined cases: null url or html count as empty; a null id prints as nothing; repeated pages
are records each; an empty table has no root and nothing to find; a record that the replica
lacks is damaged; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from termloom.llm.common import HOT_SHARE, ranked, written

SEGMENT_RECORDS = 512
FANOUT = 8
#: Levels from a segment to its ranges: FANOUT ** 2 = 64 of them.
RANGE_LEVELS = 2
#: Digits (base 8) of a place: 60 bits of MD5.
DIGITS = 20


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page's WARC record as text."""
    body = F.coalesce(html, F.lit(""))
    name = F.md5(F.concat_ws("|", page_id.cast("string"), F.coalesce(url, F.lit(""))).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def segment_digits(n: int) -> int:
    """Leading digits that name a segment where a replica has ``n`` records."""
    digits = 0
    while SEGMENT_RECORDS * FANOUT**digits < n:
        digits += 1
    return digits


def range_of(place: Column, digits: int) -> Column:
    """The branch of a place that has ``digits`` leading digits in common."""
    return F.shiftright(place, 3 * (DIGITS - digits))


def leaves(pages: DataFrame) -> DataFrame:
    """place, page_id, url, nth, length, record_sha256 of every record; bodies don't move."""
    r = record(F.col("page_id"), F.col("url"), F.col("html"))
    told = written(
        pages.select("page_id", "url", "html").select("page_id", F.coalesce("url", F.lit("")).alias("url"), r.alias("r")).select("page_id", "url", F.octet_length("r").cast("long").alias("length"), F.sha2("r", 256).alias("record_sha256")),
        "warc-records",
    )
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "url", F.col("nth").cast("string"))
    place = F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")
    return numbered(told).withColumn("place", place)


def numbered(told: DataFrame) -> DataFrame:
    """``told`` (page_id, url, record_sha256, ...) with nth, the record's number among those of its page_id and url.

    Groups with more than HOT_SHARE of all records are few: they are told apart by broadcast
    and ranked over all tasks; each other group is small enough for one window.
    """
    group = ["page_id", "url"]
    sizes = told.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(sizes.where((F.col("n") > 1) & (F.col("n") > told.count() * HOT_SHARE)).select(F.col("page_id").alias("_p"), F.col("url").alias("_u")))
    same = F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("url") == F.col("_u"))
    usual = told.join(hot, same, "left_anti").withColumn("nth", (F.row_number().over(W.partitionBy(*group).orderBy("record_sha256")) - 1).cast("long"))
    return usual.unionByName(ranked(told.join(hot, same, "left_semi"), group, ["record_sha256"], "nth"))


def ranges(leaf: DataFrame, digits: int, name: str) -> DataFrame:
    """node, ``name``: the hash of each range of places with ``digits`` digits, over its ordered records and their offsets in it."""
    order = F.array_sort(F.collect_list(F.struct("place", "page_id", "url", "nth", "length", "record_sha256")))
    rows = leaf.groupBy(range_of(F.col("place"), digits).alias("node")).agg(order.alias("r"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("range").alias("told"))
    told = F.aggregate("r", start, lambda s, x: F.struct((s["at"] + x["length"]).alias("at"), F.sha2(F.concat_ws(":", s["told"], x["place"], s["at"], x["length"], x["record_sha256"]), 256).alias("told")))
    return rows.select("node", told["told"].alias(name))


def grown(level: DataFrame) -> DataFrame:
    """The next level of two trees: node, a, b of each node over its ordered children (node, a, b)."""
    kids = F.array_sort(F.collect_list(F.struct("node", "a", "b")))

    def of(side: str) -> Column:
        # A child that a replica lacks has no hash there.
        told = F.transform("k", lambda x: F.concat_ws("=", (x["node"] % FANOUT).cast("string"), x[side]))
        return F.when(F.exists("k", lambda x: x[side].isNotNull()), F.sha2(F.concat(F.lit("node:"), F.array_join(told, ":")), 256)).alias(side)

    return level.groupBy(F.shiftright("node", 3).alias("node")).agg(kids.alias("k")).select("node", of("a"), of("b"))


def trees(one: DataFrame, other: DataFrame, digits: int) -> list[DataFrame]:
    """Levels (node, a, b: both replicas' hashes) from the ranges up to one root."""
    levels = [written(ranges(one, digits, "a").join(ranges(other, digits, "b"), "node", "full"), "warc-level")]
    for _ in range(digits):
        levels.append(written(grown(levels[-1]), "warc-level"))
    return levels


def audit(levels: list[DataFrame]) -> DataFrame:
    """node of every range that differs between two replicas, found from the root down."""
    bad = None
    for level in reversed(levels):
        if bad is not None:
            level = level.withColumn("up", F.shiftright("node", 3)).join(bad.withColumnRenamed("node", "up"), "up", "left_semi").drop("up")
        bad = written(level.where(~F.col("a").eqNullSafe(F.col("b"))).select("node"), "warc-bad")
    return bad


def compared(pages: DataFrame, replica: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Both replicas' records, and the trees' segments (segment, segment_root) of the first; the last is a segment's digits.

    The records have ``damaged``: of the first replica, those that differ or that the other
    lacks; of the other, those that the first lacks.
    """
    one, other = leaves(pages), leaves(replica)
    digits = segment_digits(one.count())
    levels = trees(one, other, digits + RANGE_LEVELS)
    bad = audit(levels)
    inside = lambda x: x.join(bad, range_of(F.col("place"), digits + RANGE_LEVELS) == F.col("node"), "left_semi").select("place", "page_id", "url", "nth", "record_sha256")
    names = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("place", "page_id", "url", "nth")]
    both = inside(one).alias("a").join(inside(other).alias("b"), names[0] & names[1] & names[2] & names[3], "full")
    wrong = written(both.where(~F.col("a.record_sha256").eqNullSafe(F.col("b.record_sha256"))).select(*[F.col(f"a.{k}").alias(k) for k in ("place", "nth", "record_sha256")], *[F.col(f"b.{k}").alias(f"b_{k}") for k in ("place", "nth", "record_sha256")]), "warc-wrong")

    def marked(x: DataFrame, side: str, only: Column) -> DataFrame:
        hurt = wrong.where(only & F.col(f"{side}record_sha256").isNotNull()).select(F.col(f"{side}place").alias("place"), F.col(f"{side}nth").alias("nth"), F.col(f"{side}record_sha256").alias("record_sha256"), F.lit(True).alias("damaged")).distinct()
        return x.join(hurt, ["place", "nth", "record_sha256"], "left").withColumn("damaged", F.coalesce("damaged", F.lit(False)))

    roots = levels[RANGE_LEVELS].where(F.col("a").isNotNull()).select(F.col("node").alias("segment"), F.col("a").alias("segment_root"))
    return marked(one, "", F.lit(True)), marked(other, "b_", F.col("record_sha256").isNull()), roots, digits


def fixity(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of ``pages`` with its segment, slot and byte offset there, digest, its segment's root, and whether the replica's record differs or is missing."""
    one, _, roots, digits = compared(pages, replica)
    order = W.partitionBy("segment").orderBy("place", "page_id", "url", "nth")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    placed = one.withColumn("segment", range_of(F.col("place"), digits)).withColumn("slot", F.row_number().over(order) - 1).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return placed.join(roots, "segment").select("page_id", "segment", F.col("slot").cast("int").alias("slot"), "offset", "length", "record_sha256", "segment_root", "damaged")


def surplus(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """page_id, url, record_sha256 of the replica's records that ``pages`` lack."""
    return compared(pages, replica)[1].where("damaged").select("page_id", "url", "record_sha256")


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A stand-in for a second site's copy: where MD5 of the id begins with 00, one character of the body has changed."""
    hurt = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), 1, 2) == "00"
    half = F.floor(F.length("html") / 2).cast("int")
    return pages.withColumn("html", F.when(hurt & (F.length("html") > 1), F.concat(F.expr("substring(html, 1, int(floor(length(html) / 2)))"), F.lit("\u0007"), F.substring(F.col("html"), half + 2, F.length("html")))).otherwise(F.col("html")))


def op4_query(pages: DataFrame) -> DataFrame:
    """The audit of all pages against a copy with planted damage."""
    return fixity(pages, damaged_copy(pages.select("page_id", "url", "html")))


def write_warc(pages: DataFrame, path: str, files: int) -> None:
    """Writes pages as ``files`` WARC files (part-*.txt), in order of page_id; a line's end closes each record."""
    r = record(F.col("page_id"), F.col("url"), F.col("html"))
    pages.repartitionByRange(files, "page_id", "url").sortWithinPartitions("page_id", "url").select(F.expr("1").alias("_"), r.alias("r")).select(F.expr("substring(r, 1, length(r) - 2)").alias("value")).write.option("lineSep", "\r\n").text(path)


def parse_warc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes | None, str | None]]:
    """offset, length, headers, content, error of each record of a file, plain or gzipped (offsets in plain bytes)."""
    if data[:2] == b"\x1f\x8b":
        out, rest = [], data
        while rest[:2] == b"\x1f\x8b":
            d = zlib.decompressobj(31)
            try:
                out.append(d.decompress(rest))
            except zlib.error:
                break
            rest = d.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            yield at, len(data) - at, {}, None, "no record header"
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = headers.get("content-length", "")
        if not size.isdigit() or end + 4 + int(size) > len(data):
            yield at, len(data) - at, headers, None, "record is cut off"
            return
        stop = end + 4 + int(size)
        nxt = stop + 4 if data[stop : stop + 4] == b"\r\n\r\n" else stop
        yield at, nxt - at, headers, data[end + 4 : stop], None if nxt > stop else "no record end"
        at = nxt


def read_warc(spark, path: str) -> DataFrame:  # noqa: ANN001
    """file, offset, length, type, uri, content, error of every record of the WARC files at ``path``."""
    names = ["file", "offset", "length", "type", "uri", "content", "error"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = [(file, o, n, h.get("warc-type"), h.get("warc-target-uri"), c, e) for o, n, h, c, e in parse_warc(data)]
                yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t) for i, t in enumerate(types)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, "file string, offset long, length long, type string, uri string, content binary, error string")


def _sql() -> str:
    def rec(html: str) -> str:
        return f"""'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:' || substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12)
 || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen({html}) || chr(13) || chr(10) || chr(13) || chr(10) || {html} || chr(13) || chr(10) || chr(13) || chr(10)"""

    hurt = "CASE WHEN substr(md5(coalesce(page_id::VARCHAR, '')), 1, 2) = '00' AND length(html) > 1 THEN html[1:length(html) // 2] || chr(7) || html[length(html) // 2 + 2:] ELSE html END"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, coalesce({hurt}, '') AS hurt, md5(concat_ws('|', page_id::VARCHAR, coalesce(url, ''))) AS m FROM pages),
r AS (SELECT page_id, coalesce(url, '') AS url, {rec("html")} AS good, {rec("hurt")} AS other FROM p),
d AS (SELECT page_id, url, strlen(good) AS length, sha256(good) AS record_sha256, good <> other AS damaged FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY record_sha256) - 1 AS nth FROM d),
i AS (SELECT *, ('0x' || substr(md5(coalesce(page_id::VARCHAR, '-') || '|' || url || '|' || nth), 1, 15))::BIGINT AS place, CASE {" ".join(f"WHEN n <= {SEGMENT_RECORDS * FANOUT**g} THEN {g}" for g in range(13))} END AS digits FROM k, (SELECT count(*) AS n FROM pages)),
s AS (SELECT *, place >> (3 * ({DIGITS} - digits)) AS segment, place >> (3 * ({DIGITS - RANGE_LEVELS} - digits)) AS node FROM i),
o AS (SELECT *, row_number() OVER w - 1 AS slot, coalesce(sum(length) OVER (PARTITION BY segment ORDER BY place, page_id NULLS FIRST, url, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
 coalesce(sum(length) OVER (PARTITION BY node ORDER BY place, page_id NULLS FIRST, url, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS starts FROM s WINDOW w AS (PARTITION BY segment ORDER BY place, page_id NULLS FIRST, url, nth)),
x AS (SELECT node, list(place || ':' || starts || ':' || length || ':' || record_sha256 ORDER BY place, page_id NULLS FIRST, url, nth) AS told FROM o GROUP BY node),
l0 AS (SELECT node, list_reduce(list_prepend('range', told), lambda s, t: sha256(s || ':' || t)) AS hash FROM x),
{", ".join(f"l{k} AS (SELECT node >> 3 AS node, sha256('node:' || string_agg((node % {FANOUT}) || '=' || hash, ':' ORDER BY node)) AS hash FROM l{k - 1} GROUP BY node >> 3)" for k in range(1, RANGE_LEVELS + 1))}
SELECT o.page_id, o.segment, o.slot::INTEGER AS slot, o."offset", o.length, o.record_sha256, l{RANGE_LEVELS}.hash AS segment_root, o.damaged FROM o JOIN l{RANGE_LEVELS} ON l{RANGE_LEVELS}.node = o.segment"""


OP4_SQL = _sql()
