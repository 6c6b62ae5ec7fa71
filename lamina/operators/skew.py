"""Joins whose many-row side may have most of its rows under a few keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a task is to get of one key: a key with more is dealt to as many join keys as that takes.
ROWS_PER_TASK = 250_000
# Hot keys are looked for with sketches of frequent items, one for each of so many shares of the
# keys' hashes; each names so many keys and tracks so many. A count is too high by at most
# 3.5 / TRACKED of its share's rows, and no key above that error goes unnoticed.
SHARDS, KEYS_PER_SHARD, TRACKED = 16, 64, 4096


def hot_keys(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``_hash, _spread``: the hash of each key with more rows than a task is to get of one, at
    most ``SHARDS * KEYS_PER_SHARD`` of them, and over how many join keys to deal its rows.

    Lazy, as part of the join's own plan: a scan of the key columns and sketches that
    tasks fill and Spark merges. What is found decides how rows are dealt, never the result.
    """
    hashed = df.select(F.xxhash64(*keys).alias("_hash"))
    sketch = F.expr(f"approx_top_k(_hash, {KEYS_PER_SHARD}, {TRACKED})").alias("_top")
    shards = hashed.groupBy(F.pmod("_hash", F.lit(SHARDS)).alias("_shard")).agg(sketch)
    found = shards.select(F.inline("_top")).where(F.col("count") > ROWS_PER_TASK)
    spread = F.ceil(F.col("count") / ROWS_PER_TASK).cast("int")
    return found.select(F.col("item").alias("_hash"), spread.alias("_spread"))


def join_spread(
    many: DataFrame,
    one: DataFrame,
    pairs: list[tuple[str, str]],
    how: str,
    row_id: Column,
) -> DataFrame:
    """Join rows that may crowd under a key with rows unique by that key.

    ``pairs`` names the key columns of both sides; they must have equal types, and null
    matches null. Rows of a hot key are dealt by ``row_id`` to as many join keys as its share
    calls for, and the one matching row is copied to each, so the result is the same as without. An
    outer, semi or anti join must keep the side of the many rows. No job is started.
    """
    left, right = ([F.col(f"`{p[i]}`") for p in pairs] for i in (0, 1))
    columns = many.columns
    hot = hot_keys(many, left)
    spread = F.coalesce(F.col("_spread"), F.lit(1))

    def with_spread(df: DataFrame, keys: list[Column]) -> DataFrame:
        # at most SHARDS * KEYS_PER_SHARD rows of two numbers
        hashed = df.withColumn("_own_hash", F.xxhash64(*keys))
        return hashed.join(F.broadcast(hot), F.col("_own_hash") == F.col("_hash"), "left")

    salt = F.pmod(F.xxhash64(row_id), spread).cast("int")
    dealt = with_spread(many, left).withColumn("_many_salt", salt)
    dealt = dealt.drop("_own_hash", "_hash", "_spread")
    copies = F.explode(F.sequence(F.lit(0), spread - 1)).alias("_one_salt")
    copied = with_spread(one, right).select(*[one[f"`{c}`"] for c in one.columns], copies)
    pairs = [*pairs, ("_many_salt", "_one_salt")]
    same = reduce(lambda a, b: a & b, [dealt[a].eqNullSafe(copied[b]) for a, b in pairs])
    joined = dealt.join(copied, same, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*columns)
    return joined.drop("_many_salt", "_one_salt")
