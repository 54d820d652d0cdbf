"""A training-data pipeline of five corpus operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and reread as the next stage's documents. All stages
but the last return the columns of ``documents``:

1. toxicity: documents with a score of 0.7 or more go;
2. line_dedup: repeated chunks of lines go from the texts;
3. near_duplicates: one document of each class stays;
4. decontamination: documents that hold a benchmark item go;
5. packing: the rest is packed into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import decontam, linededup, neardup, packing, toxicity
from termloom.llm.common import read_table, text_batches, written
from termloom.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Training, sketches and packing have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of a data folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
