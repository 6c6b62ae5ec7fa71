import glob
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from conftest import values
from pyspark.sql import functions as F

from lamina import (
    InvalidParameterError,
    Layer,
    LayerCapabilityError,
    LayerContract,
    LayerStore,
    StaleLayerError,
)
from lamina.operators import attachments as att
from lamina.operators import skew
from workload.layers import ATTACHMENT_PROPERTIES

FLAGS = {
    "supportsQueryAttachments": True,
    "supportsQueryAttachmentsCountOnly": True,
    "supportsQueryAttachmentsOrderByFields": True,
}


def contract(**more):
    return LayerContract.from_metadata(
        {
            "objectIdField": "OBJECTID",
            "capabilities": "Query,Editing,Update",
            "hasAttachments": True,
            "attachmentProperties": ATTACHMENT_PROPERTIES,
            "advancedQueryCapabilities": FLAGS,
            "fields": [
                {"name": "OBJECTID", "type": "esriFieldTypeOID"},
                {"name": "Name", "type": "esriFieldTypeString", "editable": True},
            ],
            **more,
        }
    )


SCHEMA = (
    "parentObjectId bigint, parentGlobalId string, id bigint, globalId string, name string, "
    "size bigint, contentType string, keywords string, url string, content binary"
)
FILES = [
    (1, "g1", 10, "a", "x.jpg", 100, "image/jpeg", "roof, north", "u10", b"x" * 100),
    (1, "g1", 11, "b", "y.pdf", 2000, "application/pdf", None, "u11", b"y" * 2000),
    (2, "g2", 12, "c", "z.jpg", 500, "image/jpeg", "south", "u12", b"z" * 500),
]


@pytest.fixture
def layer(spark):
    rows = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "OBJECTID bigint, Name string")
    return Layer(rows, contract(), attachments=spark.createDataFrame(FILES, SCHEMA))


def found(result):
    return [r[0] for r in values(result.df, "id")]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize(
    ("arguments", "ids"),
    [
        ({"object_ids": [1]}, [10, 11]),
        ({"object_ids": "1,2"}, [10, 11, 12]),
        ({"global_ids": ["g2"]}, [12]),
        ({"definition_expression": "Name = 'p'"}, [10, 11]),
        ({"object_ids": [2], "definition_expression": "Name = 'p'"}, []),
        ({"object_ids": [1, 2], "size": (500,)}, [11, 12]),
        ({"object_ids": [1, 2], "size": "100,500"}, [10, 12]),
        ({"object_ids": [1, 2], "size": "1000,"}, [11]),
        ({"object_ids": [1, 2], "attachment_types": ["image/jpeg"]}, [10, 12]),
        ({"object_ids": [1, 2], "attachment_types": "image/png,application/pdf"}, [11]),
        ({"object_ids": [1, 2], "keywords": ["north", "south"]}, [10, 12]),
        ({"object_ids": [1, 2], "keywords": "south"}, [12]),
        ({"object_ids": [1, 2], "attachments_definition_expression": "ATT_NAME LIKE '%.jpg'"},
         [10, 12]),
        ({"object_ids": [1, 2], "attachments_definition_expression": "name = 'y.pdf'"}, [11]),
    ],
)
def test_filters(layer, monkeypatch, hot, arguments, ids):
    if hot:
        monkeypatch.setattr(skew, "ROWS_PER_TASK", 1)
    assert found(layer.query_attachments(**arguments)) == ids


def test_order_and_window(layer):
    def names(**arguments):
        out = layer.query_attachments(object_ids=[1, 2], **arguments)
        return [r["id"] for r in out.df.collect()]

    assert names(order_by_fields="DATA_SIZE DESC") == [11, 12, 10]
    assert names(order_by_fields="name") == [10, 11, 12]
    assert names(order_by_fields="size DESC", result_offset=1) == [12, 10]
    assert names(order_by_fields="size DESC", result_offset=1, result_record_count=1) == [12]
    with pytest.raises(InvalidParameterError):
        names(order_by_fields="nope")


def test_columns(layer):
    result = layer.query_attachments(object_ids=[2])
    assert result.to_frame().columns == [
        "parentObjectId", "parentGlobalId", "id", "globalId", "name", "size", "contentType",
        "keywords"]
    assert result.to_frame(use_field_names=True).columns[2:] == [
        "ATTACHMENTID", "GLOBALID", "ATT_NAME", "DATA_SIZE", "CONTENT_TYPE", "KEYWORDS"]
    with_url = layer.query_attachments(object_ids=[2], return_url=True)
    assert with_url.to_frame(use_field_names=True).columns[-1] == "url"
    counts = layer.query_attachments(object_ids=[1, 2, 3], return_count_only=True).to_frame()
    assert counts.columns == ["parentObjectId", "parentGlobalId", "count"]
    assert values(counts) == [(1, "g1", 2), (2, "g2", 1)]


def test_columns_without_or_beyond_the_response(layer, caplog):
    df = layer.attachments.select("parentObjectId", "parentGlobalId", "id")
    bare = att.AttachmentsQueryResult(df)
    assert bare.to_frame(use_field_names=True).columns == df.columns
    assert "keep their response names" in caplog.text
    thin = att.AttachmentsQueryResult(df, tuple(ATTACHMENT_PROPERTIES)).to_frame()
    assert thin.where("parentObjectId = 2").first()["name"] is None


@pytest.mark.parametrize(
    "arguments",
    [
        {},
        {"object_ids": [1], "global_ids": ["g"]},
        *[{"object_ids": [1], "size": s}
          for s in ((1, 2, 3), (), (1000, None), (None, 1000), ",1000", "1,2,3")],
        {"object_ids": [1], "return_metadata": True},
    ],
)
def test_arguments_are_refused(layer, arguments):
    with pytest.raises(InvalidParameterError):
        layer.query_attachments(**arguments)


@pytest.mark.parametrize("size", [(1000,), [1000], (1000, 2000), "1000", "1000,", "1000,2000"])
def test_sizes_accepted(size):
    low, high = att.size_bounds(size)
    assert low == 1000 and high in (None, 2000)


def test_gates(layer):
    off = [{**p, "isEnabled": p["name"] != "keywords"} for p in ATTACHMENT_PROPERTIES]
    limited = Layer(layer.rows, contract(attachmentProperties=off, advancedQueryCapabilities={
        "supportsQueryAttachments": True}), attachments=layer.attachments)
    for arguments in ({"keywords": "x"}, {"order_by_fields": "name"}):
        with pytest.raises(InvalidParameterError):
            limited.query_attachments(object_ids=[1], **arguments)
    with pytest.raises(LayerCapabilityError):
        limited.query_attachments(object_ids=[1], return_count_only=True)
    none = Layer(layer.rows, contract(hasAttachments=False, advancedQueryCapabilities={}),
                 attachments=layer.attachments)
    for call in (
        lambda: none.query_attachments(object_ids=[1]),
        lambda: none.add_attachments(1, b"x", "n"),
        lambda: none.delete_attachments(1, 10),
        lambda: Layer(layer.rows, contract(capabilities="Query,Editing"),
                      attachments=layer.attachments).update_attachments(1, 10, b"x", "n"),
    ):
        with pytest.raises(LayerCapabilityError):
            call()


@pytest.mark.parametrize(
    ("name", "wanted"),
    [
        ("a.txt", "text/plain"), ("A.JPG", "image/jpeg"), ("a.b.html", "text/html"),
        ("a.json.gz", "application/json"), ("a.tgz", "application/x-tar"), ("a.gz", None),
        (".txt", None), ("noext", None), ("a.unknown-ext", None),
    ],
)
def test_content_types(spark, name, wanted):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(att.guess_content_type(F.col("n"))).first()[0] == wanted
    kind = att.content_type_of(F.lit(None).cast("string"), F.col("n"))
    assert df.select(kind).first()[0] == (wanted or "application/octet-stream")
    assert df.select(att.content_type_of(F.lit("x/y"), F.col("n"))).first()[0] == "x/y"


def test_request_shapes():
    rows = att.request_rows(1, b"x", "n")
    assert rows == [(1, None, None, b"x", "n", None)]
    assert [r[0] for r in att.request_rows(1, ["a", "b"])] == [1, 1]
    assert [r[:3] for r in att.request_rows([1, 2], ["a", "b"], None, None, [5, 6])] == [
        (1, 5, "a"), (2, 6, "b")]
    for bad in (([1, 2], ["a"]), ([1], ["a"], ["n", "m"]), (1, b"bytes without a name")):
        with pytest.raises(InvalidParameterError):
            att.request_rows(*bad)
    assert att.delete_pairs(1, 5) == [(1, 5)]
    assert att.delete_pairs(1, [5, 6]) == [(1, 5), (1, 6)]
    with pytest.raises(InvalidParameterError):
        att.delete_pairs([1, 2], [5])


@pytest.mark.parametrize("hot", [False, True])
def test_add_files(layer, tmp_path, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(skew, "ROWS_PER_TASK", 1)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "note.txt").write_bytes(b"hello")
    paths = [str(tmp_path / "sub" / "note.txt"), str(tmp_path / "gone.txt"), b"raw"]
    outcome = layer.add_attachments(
        [3, 3, 77], paths, ["", "other.png", "raw.bin"], folder=str(tmp_path)
    )
    rows = outcome.results.items.orderBy("position").collect()
    assert [(r["object_id"], r["success"]) for r in rows] == [(13, True), (-1, False), (-1, False)]
    assert rows[1]["error"]["exception"] == "FileNotFoundError"
    assert rows[2]["error"]["description"] == "Object id 77 does not exist."
    assert outcome.results.failed.count() == 2 and outcome.results.has_failures
    new = outcome.attachments.where("id > 12")
    assert values(new, "parentObjectId", "id", "name", "size", "contentType") == [
        (3, 13, "note.txt", 5, "text/plain")]
    assert bytes(new.first()["content"]) == b"hello"
    assert outcome.attachments.count() == 4
    columns = outcome.results.to_frame().columns
    assert columns[:4] == ["object_id", "global_id", "success", "error_code"]


def test_update_files(layer):
    outcome = layer.update_attachments(
        [1, 1, 2, 1], [10, 11, 10, 10], [b"1", b"22", b"3", b"4444"], ["a.txt", "b.txt", "c", "d.md"]
    )
    rows = outcome.results.items.orderBy("position").collect()
    assert [(r["object_id"], r["success"]) for r in rows] == [
        (10, True), (11, True), (-1, False), (10, True)]
    assert rows[2]["error"]["description"] == "Attachment 10 does not exist."
    assert values(outcome.attachments, "id", "name", "size") == [
        (10, "d.md", 4), (11, "b.txt", 2), (12, "z.jpg", 500)]


def test_delete_files(layer):
    outcome = layer.delete_attachments([1, 2, 1, 1], [10, 99, 12, 10])
    rows = outcome.results.items.orderBy("position").collect()
    assert [(r["object_id"], r["success"]) for r in rows] == [
        (10, True), (99, False), (12, False), (10, True)]
    error = rows[1]["error"]
    assert (error["description"], error["exception"], error["outcome_unknown"]) == (
        "No result returned for attachment 99.", "LookupError", True)
    assert found(att.AttachmentsQueryResult(outcome.attachments)) == [11, 12]


def test_delete_requests(spark):
    """A feature with many attachments takes many requests; every id is in exactly one."""
    pairs = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("parentObjectId"), "id"
    )
    grouped = att.delete_requests(pairs.union(pairs), ids_per_request=100)
    rows = grouped.collect()
    assert sorted(i for r in rows for i in r["ids"]) == list(range(5000))
    hot = [r["n_ids"] for r in rows if r["parentObjectId"] == 1]
    assert len(hot) == 17 and max(hot) < 200
    assert all(r["ids"] == sorted(r["ids"]) for r in rows)


def test_stored_attachments(spark, layer, tmp_path):
    store = LayerStore(spark, str(tmp_path / "files"))
    store.create(layer.attachments, "id")
    stored = Layer(layer.rows, layer.contract, attachment_store=store)
    outcome = stored.delete_attachments(1, 10)
    assert outcome.results.items.first()["success"]
    assert stored.attachments.count() == 2
    stored.add_attachments(3, b"new", "n.txt")
    assert found(stored.query_attachments(object_ids=[3])) == [13]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, layer, tmp_path):
    store = LayerStore(spark, str(tmp_path / "files"))
    store.create(layer.attachments, "id", buckets=4)
    return Layer(layer.rows, layer.contract, attachment_store=store)


def written(layer):
    paths = glob.glob(f"{layer.attachment_store.path}/data/**/part-*.parquet", recursive=True)
    return {p: pq.read_table(p, columns=["id"])["id"].to_pylist() for p in paths}


def test_only_buckets_of_touched_files_are_written(stored):
    before = written(stored)
    stored.update_attachments(1, 11, b"new", "y.txt").release()
    new = {p: ids for p, ids in written(stored).items() if p not in before}
    beside = next(ids for ids in before.values() if 11 in ids)
    assert sorted(i for ids in new.values() for i in ids) == sorted(beside)
    assert values(stored.attachments, "id", "name", "size") == [
        (10, "x.jpg", 100), (11, "y.txt", 3), (12, "z.jpg", 500)]
    assert values(stored.attachment_store.results(), "object_id", "success") == [(11, True)]
    before = written(stored)
    stored.add_attachments(3, b"more", "m.txt").release()
    new = {p: ids for p, ids in written(stored).items() if p not in before}
    assert list(new.values()) == [[13]]


def test_ids_of_deleted_files_are_not_given_again(stored):
    stored.delete_attachments(2, 12).release()
    outcome = stored.add_attachments(3, b"next", "n.txt")
    assert outcome.results.items.first()["object_id"] == 13
    assert values(stored.attachments, "id") == [(10,), (11,), (13,)]


def test_a_stale_attachment_writer_is_refused(stored):
    base, table = stored._attachment_state()
    slow = att.delete_attachments(table, stored._requests([(1, 10, None, None, None, None)]))
    stored.delete_attachments(1, 11)
    with pytest.raises(StaleLayerError):
        stored._commit_attachments(slow, base)
    assert found(att.AttachmentsQueryResult(stored.attachments)) == [10, 12]


def test_global_ids_of_files(spark, layer):
    """A new file carries its feature's, and its own, which results tell too."""
    rows = layer.rows.withColumn("GlobalID", F.concat(F.lit("p"), "OBJECTID"))
    owned = replace(layer.contract, globalid_field="GlobalID")
    outcome = Layer(rows, owned, attachments=layer.attachments).add_attachments([1, 3], [b"a", b"b"], ["a", "b"])
    new = outcome.attachments.where("id > 12")
    assert values(new, "parentObjectId", "parentGlobalId") == [(1, "p1"), (3, "p3")]
    told = {r["object_id"]: r["global_id"] for r in outcome.results.items.collect()}
    assert told == {r["id"]: r["globalId"] for r in new.collect()} and len(set(told.values())) == 2
    had = {r["id"]: r["globalId"] for r in layer.attachments.collect()}
    for edit in (layer.update_attachments(1, 10, b"x", "x"), layer.delete_attachments(1, 10)):
        assert edit.results.items.first()["global_id"] == had[10]


def test_content_of_other_files_does_not_move(spark, layer, monkeypatch):
    """The table's content crosses no exchange, in frames nor in stores."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for edit in (
            layer.update_attachments(1, 10, b"new", "n.txt"), layer.delete_attachments(1, 10)
        ):
            kept = edit.change.kept(layer.attachments.select("*", F.lit(b"z").alias("mark")))
            assert "Exchange hashpartitioning" not in plan_of(kept)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stores_of_another_layout_are_refused(spark, layer, tmp_path):
    store = LayerStore(spark, str(tmp_path / "other"))
    store.create(layer.attachments, "parentObjectId", buckets=2)
    with pytest.raises(InvalidParameterError):
        Layer(layer.rows, layer.contract, attachment_store=store).delete_attachments(1, 10)
