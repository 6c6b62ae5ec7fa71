import datetime as dt
import json

import pytest
from conftest import LAYER_SCHEMA, STATUS, metadata, values
from pyspark.sql import functions as F

from lamina import (
    InvalidParameterError,
    Layer,
    LayerCapabilityError,
    LayerContract,
    LayerStore,
    StaleLayerError,
)
from lamina.functions import geometry as geo
from lamina.operators import batches, sizes, skew
from lamina.operators.payloads import serialize_features, writable_columns

ALL = ["OBJECTID", "Name", "Status", "Score"]


def names(spark, rows, schema="OBJECTID bigint, Name string"):
    return spark.createDataFrame(rows, schema)


def outcomes(outcome):
    frame = outcome.results.metadata_frame().collect()
    order = {"adds": 0, "updates": 1, "deletes": 2}
    frame.sort(key=lambda r: (order[r["kind"]], r["position"]))
    return [(r["kind"], r["status"], r["object_id"]) for r in frame]


@pytest.fixture
def layer(people, coded):
    return Layer(people, coded)


def test_all_kinds(spark, layer):
    outcome = layer.apply_edits(
        adds=names(spark, [("new",)], "Name string"),
        updates=names(spark, [(2, "Rob")]),
        deletes=[1],
    )
    assert outcomes(outcome) == [
        ("adds", "succeeded", 4), ("updates", "succeeded", 2), ("deletes", "succeeded", 1)]
    assert values(outcome.rows, *ALL) == [
        (2, "Rob", 0, 2.5), (3, "Cy", 1, None), (4, "new", None, None)]
    assert not outcome.results.has_failures
    assert values(layer.rows) == values(layer.rows)  # the layer itself did not change
    assert layer.rows.count() == 3


@pytest.mark.parametrize("large", [False, True])
def test_missing_id_without_rollback(spark, layer, monkeypatch, large):
    if large:
        monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", 0)
        monkeypatch.setattr(skew, "ROWS_PER_TASK", 1)
    outcome = layer.apply_edits(
        updates=names(spark, [(1, "X"), (99, "Y"), (None, "Z"), (1, "W")]),
        deletes=[2, 98],
        rollback_on_failure=False,
    )
    assert outcomes(outcome) == [
        ("updates", "succeeded", 1), ("updates", "failed", 99), ("updates", "failed", -1),
        ("updates", "succeeded", 1), ("deletes", "succeeded", 2), ("deletes", "failed", 98)]
    assert values(outcome.rows, *ALL) == [(1, "W", 1, 1.5), (3, "Cy", 1, None)]
    assert outcome.results.has_failures
    texts = values(outcome.results.metadata_frame().where("status = 'failed'"), "error_description")
    assert texts == [(f"Object id {i} does not exist.",) for i in ("98", "99", "null")]


def test_rollback_is_per_batch(spark, layer):
    rows = [(1, "a"), (99, "b"), (2, "c"), (3, "d")]
    whole = layer.apply_edits(updates=names(spark, rows))
    assert {s for _, s, _ in outcomes(whole)} == {"failed"}
    assert values(whole.rows, *ALL) == values(layer.rows, *ALL)
    error = whole.items.first()["error"]
    assert (error["code"], error["message"], error["extra"]) == (
        400, "Unable to complete operation.", {"extended_code": "-2146"})
    assert error["details"] == ["Operation rolled back.", "Object id 99 does not exist."]
    # one edit per batch: the bad one fails alone
    single = layer.apply_edits(updates=names(spark, rows), max_batch_bytes=1)
    assert [s for _, s, _ in outcomes(single)] == ["succeeded", "failed", "succeeded", "succeeded"]
    # {"attributes":{"OBJECTID":1,"Name":"a"}} has 40 bytes (41 for 99): two to a batch
    pairs = layer.apply_edits(
        updates=names(spark, rows), max_batch_bytes=batches.OVERHEAD_BYTES + 82
    )
    assert [s for _, s, _ in outcomes(pairs)] == ["failed", "failed", "succeeded", "succeeded"]


def test_rollback_needs_support(spark, people, coded):
    fixed = Layer(people, coded.with_(supports_rollback_parameter=False))
    outcome = fixed.apply_edits(deletes=[1, 99], rollback_on_failure=False)
    assert [s for _, s, _ in outcomes(outcome)] == ["failed", "failed"]


def test_delete_wins_over_update(spark, layer):
    outcome = layer.apply_edits(updates=names(spark, [(1, "X")]), deletes=[1, 1])
    assert [s for _, s, _ in outcomes(outcome)] == ["succeeded"] * 3
    assert values(outcome.rows, "OBJECTID") == [(2,), (3,)]


def test_sent_null_replaces_and_absent_column_stays(spark, layer):
    outcome = layer.apply_edits(updates=names(spark, [(1, None)]))
    assert values(outcome.rows.where("OBJECTID = 1"), *ALL) == [(1, None, 1, 1.5)]


def test_values_are_coerced(spark, layer):
    df = spark.createDataFrame(
        [("a name of sixteen", "Active", "1.5", dt.datetime(2020, 1, 1, 0, 0, 0, 1999), "x"),
         ("b", "Unknown", "bad", None, "y")],
        "Name string, Status string, Score string, EventDate timestamp_ntz, Extra string",
    )
    outcome = layer.append(df, apply_coded_values=True)
    new = outcome.rows.where("OBJECTID > 3").select(*ALL, F.unix_millis("EventDate"))
    assert values(new) == [(4, "a name of ", 1, 1.5, 1577836800001), (5, "b", None, None, None)]
    assert outcome.dropped == {"adds": ["Extra"]}
    counts = outcome.reports["adds"].counts()
    assert counts == {"Name:truncated": 1, "Status:failed": 1, "Score:failed": 1,
                      "EventDate:naive": 1}


def test_append_ignores_given_ids(spark, layer):
    outcome = layer.append(names(spark, [(1, "n1"), (50, "n2")]))
    assert values(outcome.rows.where("OBJECTID > 3"), "OBJECTID", "Name") == [(4, "n1"), (5, "n2")]


def test_append_to_an_empty_layer(spark, coded):
    empty = Layer(spark.createDataFrame([], LAYER_SCHEMA), coded)
    outcome = empty.append(names(spark, [("n",)], "Name string"))
    assert values(outcome.rows, "OBJECTID", "Name") == [(1, "n")]


def test_upsert_and_sync(spark, layer):
    df = spark.createDataFrame([("Alice", 9.0), ("Dan", 8.0)], "Name string, Score double")
    up = layer.upsert(df, ["Name"])
    assert values(up.rows, *ALL) == [
        (1, "Alice", 1, 9.0), (2, "Bob", 0, 2.5), (3, "Cy", 1, None), (4, "Dan", None, 8.0)]
    sync = layer.sync(df, ["Name"])
    assert values(sync.rows, *ALL) == [(1, "Alice", 1, 9.0), (4, "Dan", None, 8.0)]
    assert outcomes(sync) == [
        ("adds", "succeeded", 4), ("updates", "succeeded", 1),
        ("deletes", "succeeded", 2), ("deletes", "succeeded", 3)]


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_sync_leaves_exactly_the_keys_of_the_input(spark, layer, monkeypatch, small):
    monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", small)
    df = spark.range(40).select(F.concat(F.lit("n"), "id").alias("Name"))
    first = layer.sync(df.unionByName(names(spark, [("Bob",)], "Name string")), ["Name"])
    wanted = sorted([("Bob",)] + [(f"n{i}",) for i in range(40)])
    assert values(first.rows, "Name") == wanted
    assert first.rows.select("OBJECTID").distinct().count() == 41
    again = Layer(first.rows, layer.contract).sync(df.limit(0), ["Name"])
    assert again.rows.count() == 0
    assert {k for k, _, _ in outcomes(again)} == {"deletes"}


def test_nothing_to_do(spark, layer):
    for outcome in (
        layer.apply_edits(),
        layer.apply_edits(deletes=[]),
        layer.append(names(spark, [], "Name string")),
    ):
        assert outcomes(outcome) == [] and not outcome.results.has_failures
        assert outcome.rows.count() == 3


def test_required_fields(spark, people):
    meta = metadata()
    meta["fields"][1]["nullable"] = False
    strict = Layer(people, LayerContract.from_metadata(meta))
    outcome = strict.apply_edits(
        adds=spark.createDataFrame([("ok",), (None,)], "Name string"),
        updates=spark.createDataFrame([(1, 5.0)], "OBJECTID bigint, Score double"),
        rollback_on_failure=False,
    )
    assert [s for _, s, _ in outcomes(outcome)] == ["succeeded", "failed", "succeeded"]
    bare = strict.append(spark.createDataFrame([(1.0,)], "Score double"))
    assert [s for _, s, _ in outcomes(bare)] == ["failed"]


def test_capability_and_size_gates(spark, people, contract):
    with pytest.raises(LayerCapabilityError):
        Layer(people, contract.with_(capabilities="Query,Create,Update,Delete")).append(people)
    for size in (0, 6_000_001):
        with pytest.raises(InvalidParameterError):
            Layer(people, contract).append(people, max_batch_bytes=size)


def test_global_ids(spark):
    meta = metadata(globalIdField="GlobalID")
    meta["fields"].append({"name": "GlobalID", "type": "esriFieldTypeGlobalID"})
    rows = spark.createDataFrame([(1, "a", "{G}")], "OBJECTID bigint, Name string, GlobalID string")
    outcome = Layer(rows, LayerContract.from_metadata(meta)).append(
        names(spark, [("b",), ("c",)], "Name string")
    )
    new = outcome.rows.where("OBJECTID > 1").collect()
    told = {r["object_id"]: r["global_id"] for r in outcome.items.collect()}
    assert {r["OBJECTID"]: r["GlobalID"] for r in new} == told
    assert all(len(g) == 38 and g[0] == "{" for g in told.values()) and len(set(told.values())) == 2


def test_geometry_edits(spark, contract):
    def rows(data):
        df = spark.createDataFrame(data, "OBJECTID bigint, Name string, text string")
        shape = geo.geometry_from_geojson(F.col("text"), contract.crs)
        return df.select("OBJECTID", "Name", shape.alias("geometry"))

    point, other = ('{"type":"Point","coordinates":[%d,2]}' % x for x in (1, 7))
    layer = Layer(rows([(1, "a", point), (2, "b", point)]), contract)
    odd = '{"type":"GeometryCollection","geometries":[]}'
    outcome = layer.apply_edits(
        adds=rows([(None, "n", other), (None, "bad", odd)]).drop("OBJECTID"),
        updates=rows([(1, "a2", None), (2, "b2", other)]),
        rollback_on_failure=False,
    )
    assert [s for _, s, _ in outcomes(outcome)] == ["succeeded", "failed", "succeeded", "succeeded"]
    # an omitted geometry stays; a sent one replaces
    assert values(outcome.rows, "OBJECTID", "Name", "geometry.bbox.xmin") == [
        (1, "a2", 1.0), (2, "b2", 7.0), (3, "n", 7.0)]


def test_payload(spark, coded):
    df = spark.createDataFrame(
        [(1, "é", "Active", None, "s"), (2, None, None, 2.5, "t")],
        "OBJECTID bigint, Name string, Status string, Score double, Secret string",
    )
    assert writable_columns(df, coded, with_oid=False) == (
        ["Name", "Status", "Score"], ["OBJECTID", "Secret"])
    assert writable_columns(df, coded, with_oid=True)[1] == ["Secret"]
    features, _ = serialize_features(df, coded, with_oid=True, apply_coded_values=True)
    assert [json.loads(r["feature"]) for r in features.collect()] == [
        {"attributes": {"OBJECTID": 1, "Name": "é", "Status": 1, "Score": None}},
        {"attributes": {"OBJECTID": 2, "Name": None, "Status": None, "Score": 2.5}},
    ]
    shaped = df.select("Name", geo.point(F.col("Score"), F.lit(1.0), 4326).alias("geometry"))
    features, _ = serialize_features(shaped, coded)
    assert [json.loads(r["feature"]) for r in features.collect()] == [
        {"attributes": {"Name": "é"}},
        {"attributes": {"Name": None}, "geometry": {"x": 2.5, "y": 1.0}},
    ]


@pytest.mark.parametrize("buckets", [None, 3])
def test_store(spark, people, coded, tmp_path, buckets):
    store = LayerStore(spark, str(tmp_path / "layer"))
    store.create(people, "OBJECTID", buckets=buckets)
    layer = Layer(None, coded, store=LayerStore.open(spark, str(tmp_path / "layer")))
    before = layer.rows
    outcome = layer.upsert(names(spark, [("Alice",), ("Dan",)], "Name string"), ["Name"])
    outcome.release()
    assert outcome.rows.count() == layer.count() == 4
    assert before.count() == 3  # readers of the old version are undisturbed
    assert store.state()["version"] == 1
    told = store.results(1)
    assert values(told, "kind", "status") == [("adds", "succeeded"), ("updates", "succeeded")]
    # ids are not given out twice, even if the largest was deleted
    layer.apply_edits(deletes=[4])
    layer.append(names(spark, [("Eve",)], "Name string"))
    assert values(layer.rows, "OBJECTID") == [(1,), (2,), (3,), (5,)]
    assert store.read(version=1).count() == 4
    # a version that is taken is an error, and the table stays
    with pytest.raises(StaleLayerError):
        store.commit(people, base=store.state(1))
    assert layer.count() == 4
    if buckets:
        plan = layer.rows.join(spark.range(9).hint("merge"), F.col("OBJECTID") == F.col("id"))
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Bucketed: true" in text


@pytest.mark.parametrize("limit", [1_000_000, 1, -1])
def test_large_append(spark, monkeypatch, limit):
    """Ids from tags equal ids from a join, with and without failures."""
    meta = metadata(globalIdField="GlobalID")
    meta["fields"].append({"name": "GlobalID", "type": "esriFieldTypeGlobalID"})
    meta["fields"][1]["nullable"] = False
    layer = Layer(
        spark.createDataFrame([(1, "a", "{G}")], "OBJECTID bigint, Name string, GlobalID string"),
        LayerContract.from_metadata(meta),
    )
    monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", limit)
    good = spark.range(0, 500, numPartitions=5).select(F.concat(F.lit("n"), "id").alias("Name"))
    bad = good.select(F.when(F.col("Name").endswith("7"), None).otherwise(F.col("Name")).alias("Name"))
    for df, kept in ((good, range(500)), (bad, [i for i in range(500) if i % 10 != 7])):
        outcome = layer.append(df, rollback_on_failure=False)
        new = outcome.rows.where("OBJECTID > 1").collect()
        assert sorted((r["OBJECTID"], r["Name"]) for r in new) == [(i + 2, f"n{i}") for i in kept]
        told = {r["object_id"]: r["global_id"] for r in outcome.items.where("success").collect()}
        assert {r["OBJECTID"]: r["GlobalID"] for r in new} == told


@pytest.mark.parametrize("limit", [1_000_000, 300, 1])
def test_large_updates(spark, coded, monkeypatch, limit):
    """A third of the updates name one id, some name none or a missing one."""
    rows = spark.range(1, 400).select(F.col("id").alias("OBJECTID"), F.lit(0.0).alias("Score"))
    if limit < 1000:
        monkeypatch.setattr(sizes, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", limit)
    updates = spark.range(0, 600, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") > 580, F.lit(None))
        .otherwise(F.col("id")).cast("bigint").alias("OBJECTID"),
        F.col("id").cast("double").alias("Score"),
    )
    outcome = Layer(rows, coded).apply_edits(updates=updates, rollback_on_failure=False)
    wanted = {i: float(i) if i % 3 else 0.0 for i in range(1, 400)}
    wanted[7] = 597.0
    assert dict(values(outcome.rows, "OBJECTID", "Score")) == wanted
    plain = updates.where("OBJECTID < 400 and OBJECTID <> 7")  # nothing to clear away
    outcome = Layer(rows, coded).apply_edits(updates=plain, rollback_on_failure=False)
    wanted[7] = 0.0
    assert dict(values(outcome.rows, "OBJECTID", "Score")) == wanted


def test_input_order_gives_positions(spark, layer):
    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 500 == 0, F.lit("Bob")).otherwise(F.lit("x")).alias("Score"),
        F.concat(F.lit("k"), "id").alias("Name"),
        "id",
    )
    outcome = layer.append(df, rollback_on_failure=False)
    rows = outcome.results.to_frame().select("id", "_edit_object_id").collect()
    assert all(r["_edit_object_id"] == 4 + r["id"] for r in rows) and len(rows) == 3000


def test_coded_layer_round_trip(spark):
    contract = LayerContract.from_metadata(metadata(STATUS))
    rows = spark.createDataFrame([(1, "a", 1)], "OBJECTID bigint, Name string, Status int")
    decoded = Layer(rows, contract).query(out_fields="OBJECTID,Name,Status", apply_coded_values=True)
    outcome = Layer(rows, contract).upsert(decoded.to_frame(), ["Name"], apply_coded_values=True)
    assert values(outcome.rows) == values(rows)


def test_bodies(spark, layer):
    args = dict(
        adds=spark.createDataFrame([("n1", "Active"), ("n2", None)], "Name string, Status string"),
        updates=names(spark, [(2, "Rob")]),
        deletes=[1, 3],
    )
    whole = layer.edit_bodies(**args, apply_coded_values=True).collect()
    assert [json.loads(r["body"]) for r in whole] == [
        {
            "adds": [{"attributes": {"Name": "n1", "Status": 1}},
                     {"attributes": {"Name": "n2", "Status": None}}],
            "updates": [{"attributes": {"OBJECTID": 2, "Name": "Rob"}}],
            "deletes": "1,3",
        }
    ]
    single = layer.edit_bodies(**args, max_batch_bytes=1).orderBy("batch_id").collect()
    assert [list(json.loads(r["body"])) for r in single] == [
        ["adds"], ["adds"], ["updates"], ["deletes"], ["deletes"]]
    assert layer.edit_bodies().count() == 0
