import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import STATUS, metadata, values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import FieldSet, InvalidParameterError, Layer, LayerContract
from lamina.functions import keys
from lamina.operators import diff, sizes, skew

CONTRACT = LayerContract.from_metadata(metadata())
CONTRACT = CONTRACT.with_(
    fields=FieldSet(
        f | ({"type": "esriFieldTypeString"} if f["name"] == "Status" else {})
        for f in CONTRACT.fields
    )
)
SCHEMA = "OBJECTID bigint, Status string, Name string"
PEOPLE = [(1, "A", "Alice"), (2, "B", "Bob"), (3, "C", "Cy")]

CASES = [
    # input, its schema, layer rows, keys, adds, updates as (oid, name), deletes
    ([("Alice",), ("Bob",)], "Name string", [], ["Name"], ["Alice", "Bob"], [], []),
    ([("Alice",)], "Name string", [(5, "A", "Alice")], ["Name"], [], [(5, "Alice")], []),
    ([("Alice",)], "Name string", PEOPLE[:2], ["Name"], [], [(1, "Alice")], [(2,)]),
    ([("Alice", "A"), ("Alice", "I")], "Name string, Status string", PEOPLE[:1],
     ["Name", "Status"], ["Alice"], [(1, "Alice")], []),
    ([], "Name string", PEOPLE[:2], ["Name"], [], [], [(1,), (2,)]),
    ([("Alice", "A")], "Name string, Status string", PEOPLE, ["Name", "Status"], [],
     [(1, "Alice")], [(2,), (3,)]),
    # nulls match nulls; the delimiter of joined keys is an ordinary text
    ([(None,), ("x",)], "Name string", [(4, "A", None), (9, "A", None)], ["Name"], ["x"],
     [(9, None)], []),
    ([("a||b", "c"), ("a", "z")], "Name string, Status string", [(1, "b||c", "a")],
     ["Name", "Status"], ["a", "a||b"], [], [(1,)]),
    # the largest object id owns a key that several layer rows have
    ([("Alice",)], "Name string", [(1, "A", "Alice"), (8, "A", "Alice"), (3, "A", "Alice")],
     ["Name"], [], [(8, "Alice")], []),
]


@pytest.mark.parametrize("sampled", [False, True])
@pytest.mark.parametrize(("rows", "schema", "layer", "keys", "adds", "updates", "deletes"), CASES)
def test_diff(spark, monkeypatch, sampled, rows, schema, layer, keys, adds, updates, deletes):
    if sampled:  # every key counts as hot, so every row goes through the spreading
        monkeypatch.setattr(skew, "ROWS_PER_TASK", 1)
        monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", -1)
    target = Layer(spark.createDataFrame(layer, SCHEMA), CONTRACT)
    found = target.diff(spark.createDataFrame(rows, schema), keys)
    assert values(found[0], "Name") == sorted(((n,) for n in adds), key=repr)
    assert values(found[1], "OBJECTID", "Name") == updates
    assert values(found[2], "OBJECTID") == deletes
    assert found[2].columns == ["OBJECTID", *keys]
    assert set(found[0].columns) == set(spark.createDataFrame([], schema).columns)


def test_matched_id_overwrites_the_given_one(spark):
    target = Layer(spark.createDataFrame(PEOPLE, SCHEMA), CONTRACT)
    given = spark.createDataFrame([(77, "Bob")], "OBJECTID bigint, Name string")
    assert values(target.diff(given, ["Name"])[1], "OBJECTID", "Name") == [(2, "Bob")]


def test_object_id_as_key(spark):
    target = Layer(spark.createDataFrame(PEOPLE, SCHEMA), CONTRACT)
    given = spark.createDataFrame([(2, "B2"), (9, "N")], "OBJECTID bigint, Name string")
    adds, updates, deletes = target.diff(given, ["OBJECTID"])
    assert values(adds, "Name") == [("N",)]
    assert values(updates, "OBJECTID", "Name") == [(2, "B2")]
    assert deletes.columns == ["OBJECTID"] and values(deletes) == [(1,), (3,)]


def test_typed_keys(spark):
    """Numbers, names and dates find the layer's codes and timestamps."""
    contract = LayerContract.from_metadata(metadata(STATUS))
    rows = spark.sql(
        "SELECT 1L AS OBJECTID, 1 AS Status, TIMESTAMP '2020-01-01 00:00:00' AS EventDate "
        "UNION ALL SELECT 2L, 0, TIMESTAMP '2020-01-02 00:00:00'"
    )
    target = Layer(rows, contract)
    named = spark.createDataFrame([("Active", "2020-01-01"), ("Inactive", "2021-01-01")],
                                  "Status string, EventDate string")
    adds, updates, deletes = target.diff(named, ["Status", "EventDate"], apply_coded_values=True)
    assert values(updates, "OBJECTID", "Status") == [(1, "Active")]
    assert values(adds, "Status") == [("Inactive",)]
    assert values(deletes, "OBJECTID") == [(2,)]
    numbers = spark.createDataFrame([(1.0,), (5.0,)], "Status double")
    assert values(target.diff(numbers, ["Status"])[1], "OBJECTID") == [(1,)]


def test_keys_the_layer_cannot_hold_match_nothing(spark):
    """Text that is no number is an add, and does not stand for a null key."""
    contract = LayerContract.from_metadata(metadata())
    rows = spark.createDataFrame([(1, None), (2, 5)], "OBJECTID bigint, Status int")
    df = spark.createDataFrame([("x",), ("y",), ("5",)], "Status string")
    adds, updates, deletes = Layer(rows, contract).diff(df, ["Status"])
    assert values(adds) == [("x",), ("y",)]
    assert values(updates, "OBJECTID") == [(2,)]
    assert values(deletes, "OBJECTID") == [(1,)]


@pytest.mark.parametrize(
    ("rows", "keys", "reason"),
    [
        ([("a", "x")], [], "empty"),
        ([("a", "x")], ["Nope"], "not present"),
        ([("a", "x"), ("a", "y")], ["Name"], "Duplicate key examples"),
        ([("a", "x"), ("a", "x")], ["Name", "Status"], "Duplicate key examples"),
        ([(None, "x"), (None, "y")], ["Name"], "Duplicate key examples"),
    ],
)
def test_key_gate(spark, rows, keys, reason):
    target = Layer(spark.createDataFrame([], SCHEMA), CONTRACT)
    df = spark.createDataFrame(rows, "Name string, Status string")
    for call in (target.diff, target.upsert, target.sync):
        with pytest.raises(InvalidParameterError, match=reason):
            call(df, keys)


def test_gate_shows_five_examples(spark):
    target = Layer(spark.createDataFrame([], SCHEMA), CONTRACT)
    df = spark.createDataFrame([(str(i % 9),) for i in range(18)], "Name string")
    with pytest.raises(InvalidParameterError) as caught:
        target.diff(df, ["Name"])
    assert str(caught.value).count("',)") == 5


def test_fractional_key_is_no_integers_key(spark, contract, people):
    given = spark.createDataFrame([(1.5, "a"), (2.0, "b")], "Status double, Name string")
    layer = people.where("Status IS NOT NULL").withColumn("Status", F.col("OBJECTID").cast("int"))
    adds, updates, _ = diff.diff(given, layer, contract, ["Status"])
    assert [r["Name"] for r in adds.collect()] == ["a"]
    assert [r["Name"] for r in updates.collect()] == ["b"]


def test_keys_are_compared_after_coding(spark, coded, people):
    given = spark.createDataFrame([("Active",), ("1",)], "Status string")
    with pytest.raises(InvalidParameterError):
        diff.diff(given, people, coded, ["Status"], apply_coded_values=True)


@pytest.mark.parametrize(
    ("sent", "key"),
    [
        ("1", 1), ("01", 1), ("1e0", 1), ("1.0", 1), (" 1 ", 1), ("1.", 1), ("10e-1", 1), ("+1", 1),
        ("-0", 0), ("9007199254740993", 9007199254740993), ("9007199254740993.0", 9007199254740993),
        ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("0.5", None),
        ("1e-20", None), ("1.0000000000000000000001", None), ("x", None), ("1d", None), ("", None),
        ("1e30", None), ("100000000000000000001e-20", None), (None, None),
    ],
)
def test_text_as_whole_number_keys(spark, sent, key):
    df = spark.createDataFrame([(sent,)], "k string")
    field = {"name": "k", "type": "esriFieldTypeBigInteger"}
    found, lost = keys.normal_key(field, F.col("k"), T.StringType(), T.LongType())
    assert tuple(df.select(found, lost).first()) == (key, sent is not None and key is None)


@pytest.mark.parametrize(
    ("sent", "dtype", "kind", "target", "fits"),
    [
        (1.5, "double", "Integer", "int", False), (2.0, "double", "Integer", "int", True),
        (float("nan"), "double", "Integer", "int", False), (2**31, "bigint", "Integer", "int", False),
        (2**53 + 1, "bigint", "Double", "double", False), (2**53, "bigint", "Double", "double", True),
        (D("0.1"), "decimal(5,2)", "Double", "double", True), (D("1.5"), "decimal(5,2)", "Integer", "int", False),
        ("0.10", "string", "Double", "double", True), ("1e300", "string", "Double", "double", True),
        ("0.10000000000000001", "string", "Double", "double", False),
        (dt.datetime(2020, 1, 1, 0, 0, 0, 5000), "timestamp_ntz", "Date", "timestamp", True),
        (dt.datetime(2020, 1, 1, 0, 0, 0, 5001), "timestamp_ntz", "Date", "timestamp", False),
        ("2020-01-01 00:00:00.0005", "string", "Date", "timestamp", False),
        ("2020-01-01 00:00:00.5", "string", "Date", "timestamp", True),
        (1.5, "double", "Date", "timestamp", False), (1500, "bigint", "Date", "timestamp", True),
    ],
)
def test_keys_that_lose_nothing(spark, sent, dtype, kind, target, fits):
    df = spark.createDataFrame([(sent,)], f"k {dtype}")
    wanted = spark.createDataFrame([], f"k {target}").schema["k"].dataType
    field = {"name": "k", "type": f"esriFieldType{kind}"}
    _, lost = keys.normal_key(field, F.col("k"), df.schema["k"].dataType, wanted)
    assert df.select(lost).first()[0] is not fits


def test_texts_of_one_number_are_one_key(spark, people, contract):
    """"1.5" is not 1, so both may be sent; "1" and "01" are the same key twice."""
    layer = Layer(people, contract)
    feed = spark.createDataFrame([("1.5", "a"), ("1", "b"), ("0.5", "c")], "Status string, Name string")
    adds, updates, _ = layer.diff(feed, ["Status"])
    assert values(adds, "Name") == [("a",), ("c",)] and values(updates, "Name") == [("b",)]
    twice = spark.createDataFrame([("1",), ("01",)], "Status string")
    with pytest.raises(InvalidParameterError):
        layer.diff(twice, ["Status"])
