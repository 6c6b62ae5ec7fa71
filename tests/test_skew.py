import pytest
from pyspark.sql import functions as F

from lamina.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows under one key, a third under null, the rest apart."""
    many = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id")).cast("bigint").alias("k"),
    )
    one = spark.range(0, 3000, 4).select(
        F.when(F.col("id") == 8, F.lit(None)).otherwise(F.col("id") - 1).alias("o"),
        F.col("id").alias("v"),
    )
    return many, one


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spreading_changes_nothing(sides, monkeypatch, how):
    many, one = sides
    plain = many.join(one, F.col("k").eqNullSafe(F.col("o")), how)
    args = (many, one, [("k", "o")], how, F.col("id"))
    assert sorted(map(tuple, skew.join_spread(*args).collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    hot = {r["_hash"]: r["_spread"] for r in skew.hot_keys(many, [F.col("k")]).collect()}
    assert len(hot) == 2 and min(hot.values()) >= 10 and max(hot.values()) <= 11
    spread = skew.join_spread(*args)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )


def test_rows_of_a_hot_key_leave_one_partition(spark, sides, monkeypatch):
    many, one = sides
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        joined = skew.join_spread(many, one, [("k", "o")], "left", F.col("id"))
        hot = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) == 4 and max(r["count"] for r in hot) < 600
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_half_of_all_rows_under_one_key(spark, monkeypatch):
    """Each join key gets about as many rows of it as a task is to get, and no job is started early."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 500)
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    one = spark.range(0, 100).select((F.col("id") - 1).alias("o"))
    group = "one join"
    spark.sparkContext.setJobGroup(group, group)
    joined = skew.join_spread(rows, one, [("k", "o")], "left_semi", F.col("id"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert joined.count() == 20_000 + 49
    hot = skew.hot_keys(rows, [F.col("k")]).collect()
    assert len(hot) == 1 and 40 <= hot[0]["_spread"] <= 41
    dealt = rows.where("k = -1").groupBy(F.pmod(F.xxhash64("id"), F.lit(hot[0]["_spread"]))).count()
    assert dealt.agg(F.max("count")).first()[0] <= 700
