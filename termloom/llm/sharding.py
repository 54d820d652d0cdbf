"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's key and the number of shards decide its shard; no ring table is kept.
When shards are appended, a row either stays or moves to a new shard.

Defined cases: a null key is the key ``""`` with a null mark of its own; a null
text has 0 bytes and CRC 0; rows that repeat are placed alike and get slots of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ranked, written

#: Bytes that a row takes in a shard besides its text.
ROW_OVERHEAD = 8
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, for all keys at once."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = np.array(keys, dtype=np.uint64)
    found = np.zeros(len(state), dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            found[live] = jump[live]
            state[live] = state[live] * _STEP + np.uint64(1)
            draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            jump[live] = ((found[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            live = live[jump[live] < shards]
    return found.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key of any type; its 64-bit hash is Spark's ``xxhash64`` of its text."""

    @F.pandas_udf("int")
    def jumped(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(np.int64).view(np.uint64), shards))

    return jumped(F.xxhash64(key.isNull(), F.coalesce(key.cast("string"), F.lit(""))))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard among ``shards`` and among one more, its size, and its slot in its shard."""
    body = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(key),
        (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    sized = written(
        sized.withColumn("shard", shard_of(F.col(key), shards)).withColumn("grown_shard", shard_of(F.col(key), shards + 1)),
        "sharded",
    )
    return ranked(sized, ["shard"], [key, "text_crc32", "size"], "slot")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", spread: int = 8) -> None:
    """Writes whole rows to one folder per shard; ``spread`` tasks share a shard, so no shard is one task."""
    (
        docs.withColumn("shard", shard_of(F.col(key), shards))
        .repartition(shards * spread, "shard", F.pmod(F.xxhash64(*docs.columns), F.lit(spread)))
        .write.partitionBy("shard")
        .parquet(path)
    )


def op6_query(docs: DataFrame) -> DataFrame:
    """24 shards by key, as the result contract of op6 has it."""
    return assign(docs, 24).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
