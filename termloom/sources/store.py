"""Snapshot tables on plain Parquet, stages, logs and JSON.

A snapshot table's commit is a new immutable folder; then one small pointer file, named by
the commit's number, is created, which only one writer can do: of two that began from the
same number the other is told so and nothing of it is seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from termloom.operators.gold import close_versions

#: Parts that a stage's documents are dealt to; a write rewrites the parts that its documents are in.
STAGE_PARTS = 64


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    """The file system of a path, whatever store it names, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


class SnapshotTable:
    """A table whose commits are folders under ``path`` and files of its pointer log."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def _names(self) -> list[str]:
        files, log = _files(self.spark, f"{self.path}/_log")
        return sorted(s.getPath().getName() for s in files.listStatus(log)) if files.exists(log) else []

    def version(self) -> int:
        """The last commit's number; -1 without one."""
        names = self._names()
        return int(names[-1].split("-", 1)[0]) if names else -1

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or an earlier version's; a table without commits is empty."""
        names = {int(n.split("-", 1)[0]): n.split("-", 1)[1] for n in self._names()}
        at = max(names, default=-1) if version is None else version
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v-{names[at]}") if at in names else self.spark.createDataFrame([], self.schema)

    def commit(self, rows: DataFrame, after: int | None = None) -> int:
        """Writes a new snapshot, then its pointer: readers see the old one or all of the new one.

        ``after`` is the version that ``rows`` are made from; another commit since then is a Conflict.
        """
        at = (self.version() if after is None else after) + 1
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/v-{name}")
        files, log = _files(self.spark, f"{self.path}/_log")
        files.mkdirs(log)
        lock = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_claims/{at:010d}")
        # A claim is created by one writer only; the pointer follows it.
        if not files.exists(lock.getParent()):
            files.mkdirs(lock.getParent())
        try:
            files.create(lock, False).close()
        except Exception as e:
            raise Conflict(f"version {at} is another writer's") from e
        files.create(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log/{at:010d}-{name}"), False).close()
        return at

    def upsert(self, rows: DataFrame, key: list[str], seq: list[str]) -> int:
        """Adds versions, in order of ``seq`` (columns of ``rows``), and closes the open ones of the same key; rows that aren't later than theirs are refused."""
        at = self.version()
        held = self.read(at)
        turn = F.struct(*[F.col(s) for s in seq])
        new = rows.select(*held.columns, F.lit(1).alias("_new"), turn.alias("_turn"))
        old = held.select("*", F.lit(0).alias("_new"), F.lit(None).cast(new.schema["_turn"].dataType).alias("_turn"))
        good, bad = close_versions(old.unionByName(new), key, ["_new", "_turn", "knowledge_from"])
        if not bad.where("_new = 1").isEmpty():
            raise ValueError("a new version must be known later than the one that it closes")
        return self.commit(good.drop("_new", "_turn"), at)


def write_stage(rows: DataFrame, path: str, stage: str) -> None:
    """Silver rows of one stage; they replace what their documents held there, and no other document's rows.

    Documents are dealt to parts by hash; the parts that are touched are written anew, whole,
    beside the table first, so a failure leaves the table as it was or a part as it will be.
    """
    if rows.isEmpty():
        raise ValueError("no silver rows to write")
    spark = rows.sparkSession
    dealt = rows.withColumn("stage", F.lit(stage)).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(STAGE_PARTS)).cast("int"))
    beside = f"{path}.new-{uuid.uuid4().hex}"
    files, at = _files(spark, path)
    if files.exists(at):
        held = spark.read.schema(dealt.schema).parquet(path).where(F.col("stage") == stage)
        ids = dealt.select("doc_id", "part").distinct()
        kept = held.join(F.broadcast(ids.select("part").distinct()), "part", "left_semi").join(ids.select("doc_id"), "doc_id", "left_anti")
        dealt = dealt.unionByName(kept.select(*dealt.columns))
    dealt.write.parquet(beside)
    spark.read.schema(dealt.schema).parquet(beside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "part").parquet(path)
    files.delete(_files(spark, beside)[1], True)


def read_stages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of all stages, with their ``stage``; a table that isn't there is empty."""
    files, at = _files(spark, path)
    if not files.exists(at):
        return spark.createDataFrame([], f"{schema}, stage string")
    return spark.read.schema(f"{schema}, stage string, part int").parquet(path).drop("part")


def write_once(spark: SparkSession, path: str, content: bytes) -> bool:
    """Writes a file that may not change: False where it is there with the same bytes; other bytes are an error."""
    files, at = _files(spark, path)
    if files.exists(at):
        if bytes(spark.read.format("binaryFile").load(path).first()["content"]) != content:
            raise ValueError(f"{path} holds other content and may not change")
        return False
    out = files.create(at, False)
    out.write(bytearray(content))
    out.close()
    return True


def write_per_document(rows: DataFrame, path: str) -> None:
    """Rows by doc_id, as JSON; a document's rows replace those that it had, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_id").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Adds to an append-only log; its order is in its ``seq`` column, not in its files."""
    rows.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str, doc_id: str | None = None) -> DataFrame:
    """A log's rows, all or one document's; a log that isn't there is empty. Callers order them by ``seq``."""
    files, at = _files(spark, path)
    rows = spark.read.schema(schema).parquet(path) if files.exists(at) else spark.createDataFrame([], schema)
    return rows if doc_id is None else rows.where(F.col("doc_id") == doc_id)


def write_sorted(rows: DataFrame, path: str, by: list[str]) -> None:
    """A small table rewritten whole, in order."""
    rows.orderBy(*by).coalesce(1).write.mode("overwrite").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


#: What a layout file holds. A file of before the quality report was added has none.
LAYOUT = (
    "doc_id string, adapter string, adapter_version string, pages array<struct<page:int,width:double,height:double,lines:array<struct<line:int,text:string,locator:string,x0:double,y0:double,x1:double,y1:double,confidence:double,"
    "tokens:array<struct<text:string,x0:double,y0:double,x1:double,y1:double,confidence:double>>>>>>, quality struct<status:string,mean_confidence:double,issues:array<string>>"
)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """Layout files, one a document; where one has no quality report it is made from its pages."""
    rows = spark.read.schema(LAYOUT).option("mode", "FAILFAST").option("multiLine", "true").json(path)
    lines = F.flatten(F.transform("pages", lambda p: p["lines"]))
    mean = F.when(F.size(lines) > 0, F.aggregate(lines, F.lit(0.0), lambda s, x: s + x["confidence"]) / F.size(lines)).otherwise(0.0)
    chars = F.aggregate(lines, F.lit(0), lambda s, x: s + F.length(x["text"]))
    floor = F.when(F.contains(F.lower("adapter"), F.lit("ocr")) | F.contains(F.lower("adapter"), F.lit("tesseract")), 0.80).otherwise(0.95)
    empty = F.exists("pages", lambda p: F.size(p["lines"]) == 0)
    issues = F.array_compact(F.array(F.when(chars == 0, "no_text_coordinates"), F.when(empty, "missing_reading_order"), F.when(mean < floor, "low_layout_confidence")))
    made = F.struct(F.when(F.size(issues) == 0, "passed").otherwise("failed").alias("status"), mean.alias("mean_confidence"), issues.alias("issues"))
    return rows.withColumn("quality", F.coalesce("quality", made))


def passed_layouts(layouts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Layouts that may go on, and the others with their issues: what has not passed is held back."""
    ok = F.coalesce(F.col("quality.status") == "passed", F.lit(False))
    return layouts.where(ok), layouts.where(~ok).select("doc_id", F.coalesce(F.array_join("quality.issues", ","), F.lit("no_quality")).alias("problem"))


def latest_stage(rows: DataFrame) -> DataFrame:
    """Per document all rows of its reviewed stage, or else of its validated one."""
    order = F.when(F.col("stage") == "reviewed", 0).when(F.col("stage") == "validated", 1)
    ranked = rows.withColumn("_o", order).where(F.col("_o").isNotNull())
    best = ranked.groupBy("doc_id").agg(F.min("_o").alias("_b"))
    return ranked.join(best, "doc_id").where("_o = _b").drop("_o", "_b")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a temporary folder only where the master is local and none is set."""
    kept = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not kept:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        kept = tempfile.mkdtemp(prefix="termloom-")
    return f"{kept.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def struct_of(ddl: str) -> ST.StructType:
    return ST._parse_datatype_string(ddl)  # type: ignore[return-value]
