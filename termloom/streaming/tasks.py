"""The continuous twin: a landing folder read as a stream, and task states kept by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.classify import classify
from termloom.operators.workflow import STATES, STEPS
from termloom.sources import bronze


def landed(spark: SparkSession, path: str, watermark: str = "1 day") -> DataFrame:
    """New text files of a folder, once per content within the watermark, classified.

    Event time is the file's time; a content that comes again later than the watermark opens a new row.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ends = F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1))).isin(".txt", ".md")
    docs = files.where(ends & ~name.startswith(".") & ~name.isin(*bronze.IGNORED)).select(bronze.content_id(F.col("content")).alias("doc_id"), F.col("modificationTime").alias("received_at"), F.decode("content", "UTF-8").alias("text"))
    return classify(docs.withWatermark("received_at", watermark).dropDuplicatesWithinWatermark(["doc_id"]))


def task_states(attempts: DataFrame, key: str = "doc_id", order: str = "seq", status: str = "status") -> DataFrame:
    """Per key and batch the state after its attempts; illegal ones are refused and counted.

    Attempts are taken in order within a batch, and batches as they come: equal to the
    batch fold where no attempt comes in a later batch than one after it. The state is a
    word and a number a task; a task that has ended takes no more of it than that.
    """
    legal = STEPS | {("", STATES[0])}
    kind = attempts.schema[key].dataType.simpleString()

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        at, refused = state.get if state.exists else ("", 0)
        for s in pd.concat(list(batches)).sort_values(order)[status]:
            if (at, s) in legal:
                at = s
            else:
                refused += 1
        state.update((at, refused))
        yield pd.DataFrame({key: [k[0]], "state": [at], "refused": [refused]})

    return attempts.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, state string, refused int", "state string, refused int", "update", "NoTimeout")


def close_into(table, key: list[str], seq: list[str]):  # noqa: ANN001, ANN201
    """A foreachBatch function that adds each batch's versions, in order of ``seq``, to a snapshot table."""

    def batch(rows: DataFrame, epoch: int) -> None:
        if not rows.isEmpty():
            table.upsert(rows, key, seq)

    return batch
