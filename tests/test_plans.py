"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lamina import Layer
from lamina.session import Staging
from workload import layers as on

FOLDER = "/root/testdata/sf0.001"
# results that are one row are the only ones a single task may produce
ONE_ROW = {"query_count", "query_extent", "coercion_counts", "has_failures"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_bottleneck(spark, monkeypatch, name):
    plans = []
    write = Staging.write
    monkeypatch.setattr(
        Staging, "write", lambda self, df, label: plans.append(plan_of(df)) or write(self, df, label)
    )
    plans.append(plan_of(entry.queries()[name](spark, FOLDER)))
    for text in plans:
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
        if name not in ONE_ROW:
            assert "SinglePartition" not in text


def formatted(df):
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_reads_what_it_needs(spark):
    df = on.orders(spark, FOLDER).query("o_orderstatus = 'F'", "o_custkey").to_frame()
    text = plan_of(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text


def test_diff_reads_id_and_keys_only(spark):
    deletes = on.orders_renumbered(spark, FOLDER).diff(
        on.order_feed(spark, FOLDER), ["o_orderkey"]
    )[2]
    text = plan_of(deletes)
    assert "o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_window_is_a_top_k(spark):
    df = on.orders(spark, FOLDER).query(resultOffset=5, resultRecordCount=10).to_frame()
    assert "TakeOrderedAndProject(limit=15, offset=5" in plan_of(df)


def test_envelope_filter_reaches_the_scan(spark, tmp_path):
    on.spots(spark, FOLDER).rows.write.parquet(str(tmp_path / "spots"))
    layer = Layer.from_parquet(spark, str(tmp_path / "spots"), on.SPOTS)
    counted = layer.query(geometry="-1,-1,1,1", returnCountOnly=True).df
    text = formatted(counted)
    assert "LessThanOrEqual(geometry.bbox.xmin,1.0)" in text
    assert "coordinates" not in text


def test_small_edits_do_not_shuffle_the_layer(spark):
    outcome = on.orders(spark, FOLDER).apply_edits(
        updates=spark.createDataFrame([(5, 1.0)], "objectid bigint, o_totalprice double"),
        deletes=[7],
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(outcome.rows.select(F.col("objectid"), F.col("o_totalprice")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in text.splitlines() if "o_orderkey" in line and "FileScan" in line)
    depth = text.splitlines().index(scan)
    above = text.splitlines()[:depth]
    joins = [line for line in above if "Join" in line]
    assert any("LeftAnti" in j and "BroadcastHashJoin" in j for j in joins)
    assert any("LeftOuter" in j and "BroadcastHashJoin" in j for j in joins)
