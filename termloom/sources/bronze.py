"""Raw documents: the landing folder, content addressing, pages, lines and layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as T

#: What the landing folder takes.
SUFFIXES = (".txt", ".md", ".pdf")
IGNORED = ("README.md",)
PAGE_JOIN = "\n\u000c\n"


def landing(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the files to take in; dot files, other suffixes and ignored names are left."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ends = F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1))).isin(*SUFFIXES)
    return files.where(ends & ~name.startswith(".") & ~name.isin(*IGNORED)).select("path", "content", F.col("modificationTime").alias("received_at"))


def content_id(content: Column) -> Column:
    return F.concat(F.lit("doc-"), F.substring(F.sha2(content, 256), 1, 24))


def ingest(files: DataFrame, content: str, received: str) -> DataFrame:
    """One row per distinct content, of its first receipt (``received``), and how often it came."""
    others = [c for c in files.columns if c not in (content, received)]
    hashed = files.select(F.sha2(F.col(content).cast("binary"), 256).alias("file_hash"), F.struct(received, *others).alias("r"))
    return hashed.groupBy("file_hash").agg(F.min("r").alias("r"), F.count(F.lit(1)).alias("n_received")).select(F.concat(F.lit("doc-"), F.substring("file_hash", 1, 24)).alias("doc_id"), "file_hash", "r.*", "n_received")


def to_store(files: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contents (doc_id, file_hash, content, ...) that a content-addressed store lacks, and doc_id, problem of collisions: another content under the same id."""
    known = held.select(F.col("doc_id").alias("_d"), F.col("file_hash").alias("_h")).distinct()
    j = files.join(known, F.col("doc_id") == F.col("_d"), "left")
    new = j.where("_d IS NULL").drop("_d", "_h").dropDuplicates(["file_hash"])
    clash = j.where("_h != file_hash").select("doc_id", F.lit("other_content_under_this_id").alias("problem")).distinct()
    return new, clash


def pages(text: Column) -> Column:
    return F.split(text, "\u000c", -1)


def joined(page_texts: Column) -> Column:
    return F.array_join(page_texts, PAGE_JOIN)


def layout_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line: page, line (from 1), text, locator, box and tokens; an empty line has no tokens."""
    by_page = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(pages(F.col(text))).alias("page", "body"))
    lines = by_page.select("doc_id", (F.col("page") + 1).alias("page"), F.posexplode(T.split_lines(F.col("body"))).alias("line", "text"))
    n = F.col("line") + 1
    return lines.select(
        "doc_id", "page", n.alias("line"), "text", F.concat(F.lit("page="), F.col("page").cast("string"), F.lit(";line="), n.cast("string")).alias("locator"),
        F.lit(0.0).alias("x0"), F.col("line").cast("double").alias("y0"), F.length("text").cast("double").alias("x1"), n.cast("double").alias("y1"),
        F.when(F.length(F.trim("text")) == 0, 0).otherwise(F.size(F.split(T.collapse(F.col("text")), " "))).alias("n_tokens"), F.lit(1.0).alias("confidence"),
    )


def layout_quality(docs: DataFrame, floor: float = 0.95, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: pages, lines, characters, mean confidence, issues and status; text without a character, and a page without a line, fail."""
    by_page = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(pages(F.col(text))).alias("page", "body"))
    told = by_page.select("doc_id", T.split_lines(F.col("body")).alias("ls"))
    told = told.select("doc_id", F.size("ls").alias("n"), F.aggregate("ls", F.lit(0), lambda s, x: s + F.length(x)).alias("chars"))
    sums = told.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("n_lines"), F.sum("chars").alias("n_characters"), F.count_if(F.col("n") == 0).alias("n_empty"))
    mean = F.when(F.col("n_lines") > 0, 1.0).otherwise(0.0)
    issues = F.array_compact(F.array(F.when(F.col("n_characters") == 0, "no_text_coordinates"), F.when(F.col("n_empty") > 0, "missing_reading_order"), F.when(mean < floor, "low_layout_confidence")))
    return sums.select("doc_id", "n_pages", "n_lines", "n_characters", mean.alias("mean_confidence"), F.array_join(issues, ",").alias("issues"), F.when(F.size(issues) == 0, "passed").otherwise("failed").alias("status"))


def clustered_lines(words: DataFrame, page: str, tolerance: float = 6.0) -> DataFrame:
    """Words (page, text, x0, y0, x1, y1, confidence) as lines: in order of their centre, a word joins the current line while it is within ``tolerance`` of the line's running mean.

    The mean moves, so this is a fold over a page's sorted words, not a session window;
    a page's words are in one row, as they are in its layout.
    """
    centre = (F.col("y0") + F.col("y1")) / 2
    word = F.struct(centre.alias("c"), "x0", "text", "y0", "x1", "y1", "confidence")
    kind = "struct<c:double,x0:double,text:string,y0:double,x1:double,y1:double,confidence:double>"
    seq = words.select(page, word.cast(kind).alias("w")).groupBy(page).agg(F.array_sort(F.collect_list("w")).alias("ws"))
    start = F.struct(F.array().cast(f"array<array<{kind}>>").alias("lines"), F.array().cast(f"array<{kind}>").alias("cur"), F.lit(0.0).alias("sum"))

    def step(s: Column, w: Column) -> Column:
        fits = (F.size(s["cur"]) > 0) & (F.abs(w["c"] - s["sum"] / F.size(s["cur"])) <= tolerance)
        kept = F.when(F.size(s["cur"]) > 0, F.concat(s["lines"], F.array(s["cur"]))).otherwise(s["lines"])
        return F.when(fits, F.struct(s["lines"].alias("lines"), F.concat(s["cur"], F.array(w)).alias("cur"), (s["sum"] + w["c"]).alias("sum"))).otherwise(F.struct(kept.alias("lines"), F.array(w).alias("cur"), w["c"].alias("sum")))

    folded = F.aggregate("ws", start, step, lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["lines"], F.array(s["cur"]))).otherwise(s["lines"]))
    rows = seq.select(page, F.posexplode(folded).alias("line", "ws"))
    by_x = F.array_sort("ws", lambda a, b: F.when(a["x0"] < b["x0"], -1).when(a["x0"] > b["x0"], 1).otherwise(0))
    num = lambda f, name: F.aggregate(F.transform("ws", lambda w: w[name]), F.lit(0.0), lambda x, y: x + y) if f == "sum" else (F.array_min if f == "min" else F.array_max)(F.transform("ws", lambda w: w[name]))
    return rows.select(page, (F.col("line") + 1).alias("line"), F.array_join(F.transform(by_x, lambda w: w["text"]), " ").alias("text"), num("min", "x0").alias("x0"), num("min", "y0").alias("y0"), num("max", "x1").alias("x1"), num("max", "y1").alias("y1"), (num("sum", "confidence") / F.size("ws")).alias("confidence"), F.size("ws").alias("n_words"))
