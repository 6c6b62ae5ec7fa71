"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns a table with their columns;
the last returns the pieces of the packed sequences. Stages are written and read again, so
none is computed twice and a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import exact_dedup, near_dedup, packing, substring_dedup, toxicity
from lamina.llm.common import read_documents, release_shuffles, tokenizer_path
from lamina.session import Staging

WORD_BPE = "word_bpe_49k.json"
#: Rows of whole texts that pass between the JVM and Python at once: 10,000, Spark's own
#: number, are tens of megabytes in each of four places of a task.
BATCH_ROWS = 1000
#: Fewer rows where they are larger, such as chunks of texts and shingle sets: Spark's own 64 MB
#: would pass a whole partition of them at once.
BATCH_BYTES = 2 << 20


def in_small_batches(stage):
    """``stage`` with at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` to an Arrow batch."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents the toxicity model rejects."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


@in_small_batches
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.keep_one(docs, Staging(spark))


@in_small_batches
def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_dedup.keep_one(docs, Staging(spark))


@in_small_batches
def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a document with a smaller id has as well."""
    left = substring_dedup.with_kept_texts(docs, Staging(spark))
    if "n_chars" in left.columns:
        kind = left.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.length("text").cast(kind))
    return left


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that hold all that is left."""
    return packing.pack_documents(docs, tokenizer_path(WORD_BPE))


STAGES = [
    ("toxicity", clean),
    ("exact dedup", distinct),
    ("near dedup", dissimilar),
    ("substring dedup", unrepeated),
    ("packing", packed),
]
#: Signatures, trained scores and suffix arrays are beyond SQL; the tests compare near and
#: substring dedup with plain versions and check properties of the stages, not the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, staging = read_documents(spark, sf_dir), Staging(spark)
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        release_shuffles(spark)
    return docs
