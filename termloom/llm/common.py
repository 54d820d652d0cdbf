"""Helpers that several corpus operators share: the shared folder, cut lineage, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of an Arrow batch that carries texts; keeps a Python worker's batch in the low megabytes.
TEXT_BATCH_ROWS = 256
#: A key with more than this share of all rows is hot.
HOT_SHARE = 1 / 5000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark's own reader whatever store the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Bounds the rows of Arrow batches before a Python operator reads texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the cluster names none, and the master is local, is a temporary
    folder made; on a cluster the setting is required.
    """
    kept = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if kept:
        return kept.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    kept = tempfile.mkdtemp(prefix="termloom-")
    spark.conf.set("spark.checkpoint.dir", kept)
    return kept


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and rereads it.

    Cuts lineage: a lost executor costs a reread, not the work above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """Adds a gapless rank from 0 within ``group``, by ``order``, without one task for a group.

    Rows are range-sorted by group and order, so a group of any size spreads over
    partitions; each row's place in its partition plus the count of the group's
    rows in earlier partitions is its rank. The table of offsets has one row per
    partition and per group in it, and is broadcast: groups have to be few (none, or
    shards, or hot keys), whatever their sizes.

    ``df`` should be cheap to read (range partitioning samples it first). Nulls sort first.
    """
    keys = [*group, *order]
    placed = written(
        df.repartitionByRange(*keys, F.xxhash64(*df.columns))
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    )
    held = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), "_first", "_before"
    )
    same: Column = placed["_part"] == offsets["_p"]
    for i, g in enumerate(group):
        same = same & placed[g].eqNullSafe(offsets[f"_g{i}"])
    return (
        placed.join(F.broadcast(offsets), same)
        .withColumn(rank, (F.col("_place") - F.col("_first") + F.col("_before")).cast("long"))
        .drop("_part", "_place", "_p", "_first", "_before", *[f"_g{i}" for i in range(len(group))])
    )


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """``rows`` joined with ``groups``, which has one row a key with the number of its rows (``size``).

    Keys of more than 1 in 5,000 of all rows are fewer than 5,000, so they are broadcast and
    their rows stay where they are; the others are joined as Spark sees fit, none of them large.
    """
    hot = groups.where(F.col(size) > n_rows * HOT_SHARE)
    usual = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(F.col(size) <= n_rows * HOT_SHARE), key)
    return usual.unionByName(rows.join(F.broadcast(hot), key))


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted`` as a column's name that no column of ``taken`` has, in whatever case."""
    name, held = f"_{wanted}", {x.lower() for x in taken}
    while name.lower() in held:
        name += "_"
    return name
