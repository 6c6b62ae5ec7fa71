"""How much may be broadcast, and measuring it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits(n_rows: int, n_bytes: int) -> bool:
    return n_rows <= MAX_BROADCAST_ROWS and n_bytes <= MAX_BROADCAST_BYTES


def is_small(df: DataFrame, columns: list[str]) -> bool:
    """Whether the given columns of ``df`` may be broadcast, measured in one aggregate."""
    width = F.lit(0).cast("bigint")
    for c in columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return fits(found["n"], found["bytes"] or 0)
