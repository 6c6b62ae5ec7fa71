"""Small helpers the operators share."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of bytes other than these (space and \t \n \v \f \r), as bytes.split() cuts them.
SPACES = " \t\n\x0b\x0c\r"
#: For written tables of whole texts that stay while later steps run.
COMPACT = {"compression": "zstd"}
TOKENIZER_FOLDER = "/opt/tokenizers"


def tokenizer_path(name: str, folder: str = TOKENIZER_FOLDER) -> str:
    return os.path.join(folder, name)


def ascii_lower(column):
    """Lower-case A-Z and nothing else; in a text of ASCII alone that is what ``lower`` does."""
    ascii_only = F.octet_length(column) == F.length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text becomes empty.

    Whatever else ``docs`` has, whatever its columns are called, stays outside.
    """
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def slices_by_size(
    batches: Iterator[pa.RecordBatch], column: str, rows: int, n_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, and of ``n_bytes`` of ``column`` where
    more than one row is left to a batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if at > start and (held + size > n_bytes or at - start >= rows):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of finished steps before the next one writes its own.

    The cleaner removes a shuffle once the driver no longer refers to it, which otherwise
    waits for the driver to collect its garbage.
    """
    for _ in range(2):  # what the first round frees lets go of more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def is_held_out(column, modulus: int):
    """Whether crc32 of the id as text leaves 2; a null id is never held out."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus == 2, F.lit(False))
