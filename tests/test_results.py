import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import EditResults, InvalidParameterError
from lamina.operators.results import (
    ERROR_TYPE,
    any_failure,
    error_struct,
    error_text,
    failed_batches,
    merge_batches,
    snake_case,
    stack,
)

ITEMS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("oid", T.LongType()),
        T.StructField("object_id", T.LongType()),
        T.StructField("global_id", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error", ERROR_TYPE),
    ]
)
REJECTED = (1016, "Setting of value failed.", None, None, None, None, None, None)
LOST = (-1, "timed out", "ReadTimeout", True, None, None, None, None)


@pytest.fixture
def mixed(spark):
    """Adds a ok, b rejected, c unknown; updates d ok, e rejected; one delete ok."""
    rows = [
        ("adds", 0, 0, None, 71, None, True, None),
        ("adds", 1, 1, None, -1, None, False, REJECTED),
        ("adds", 2, 2, None, -1, None, False, LOST),
        ("updates", 0, 0, 46, 46, None, True, None),
        ("updates", 1, 1, 45, 45, None, False, REJECTED),
        ("deletes", 0, 0, 8, 8, None, True, None),
    ]
    inputs = {
        "adds": spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "name string, _seq bigint"),
        "updates": spark.createDataFrame(
            [("d", 46, 0), ("e", 45, 1)], "name string, OBJECTID bigint, _seq bigint"
        ),
        "deletes": spark.createDataFrame([(8, 0)], "OBJECTID bigint, _seq bigint"),
    }
    return EditResults(spark.createDataFrame(rows, ITEMS), inputs, "OBJECTID")


def test_metadata(mixed):
    frame = mixed.to_frame(include_input=False, ordered=True)
    assert frame.columns[:10] == [
        "kind", "status", "object_id", "global_id", "position", "error_code", "error_description",
        "error_exception", "error_outcome_unknown", "error_status_url"]
    rows = [(r["kind"], r["status"], r["object_id"], r["position"]) for r in frame.collect()]
    assert rows == [
        ("adds", "succeeded", 71, 0), ("adds", "failed", -1, 1), ("adds", "unknown", -1, 2),
        ("updates", "succeeded", 46, 0), ("updates", "failed", 45, 1),
        ("deletes", "succeeded", 8, 0)]
    kinds = dict(frame.dtypes)
    assert (kinds["error_code"], kinds["error_outcome_unknown"]) == ("bigint", "boolean")


def test_input_rows(mixed):
    frame = mixed.to_frame(ordered=True)
    assert frame.columns[:2] == ["name", "OBJECTID"]
    assert dict(frame.dtypes)["OBJECTID"] == "bigint"
    rows = [(r["name"], r["OBJECTID"], r["_edit_status"]) for r in frame.collect()]
    assert rows == [
        ("a", None, "succeeded"), ("b", None, "failed"), ("c", None, "unknown"),
        ("d", 46, "succeeded"), ("e", 45, "failed"), (None, 8, "succeeded")]
    assert "_edit_position" not in frame.columns


@pytest.mark.parametrize(
    ("kinds", "statuses", "wanted"),
    [
        (None, "failed", ["b", "e"]),
        ("adds", None, ["a", "b", "c"]),
        (["adds"], ["failed", "unknown"], ["b", "c"]),
        ("updates", "succeeded", ["d"]),
        ("updates", "unknown", []),
    ],
)
def test_filter(mixed, kinds, statuses, wanted):
    frame = mixed.filter(kinds=kinds, statuses=statuses).to_frame(include_metadata=False)
    assert sorted(r["name"] for r in frame.collect()) == wanted
    assert not any(c.startswith("_") for c in frame.columns)


def test_arguments(mixed):
    with pytest.raises(InvalidParameterError, match="nope, zip.*adds, updates, deletes"):
        mixed.filter(kinds=["zip", "nope"])
    with pytest.raises(InvalidParameterError, match="statuses"):
        mixed.filter(statuses="ok")
    with pytest.raises(InvalidParameterError, match="cannot both"):
        mixed.to_frame(include_input=False, include_metadata=False)
    with pytest.raises(InvalidParameterError, match="columns of its own|metadata_prefix"):
        clash = {"adds": mixed.inputs["adds"].withColumn("kind", F.lit(1))}
        EditResults(mixed.items, clash).to_frame(metadata_prefix="")


def test_failures(spark, mixed):
    assert [mixed.failed(k).count() for k in ("adds", "updates", "deletes")] == [2, 1, 0]
    assert mixed.failed_adds.count() == 2 and mixed.failed_deletes.count() == 0
    assert mixed.has_failures
    assert not mixed.filter(statuses="succeeded").has_failures
    assert any_failure(spark.createDataFrame([], ITEMS)).first()[0] is False


@pytest.mark.parametrize(
    ("description", "message", "details", "wanted"),
    [
        (None, "Unable.", ["Rolled back.", "Why."], "Unable. Rolled back. Why."),
        (None, "Unable.", None, "Unable."),
        (None, None, ["a", "b"], "a b"),
        ("", "m", [], "m"),
        ("d", "m", ["x"], "d"),
        (None, None, None, None),
        ("", "", [], None),
    ],
)
def test_error_text(spark, description, message, details, wanted):
    df = spark.createDataFrame(
        [(description, message, details)], "d string, m string, l array<string>"
    )
    assert df.select(error_text(F.col("d"), F.col("m"), F.col("l"))).first()[0] == wanted


def test_snake_case(spark):
    """Every capital but a first one begins a new word."""
    words = ["alpha", "be", "c", "delta9"]
    names = ["".join([w[0], *[x.capitalize() for x in w[1:]]]) for w in (words[:n] for n in (1, 2, 3, 4))]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int")
    found = [r[0] for r in df.orderBy("i").select(snake_case(F.col("n"))).collect()]
    assert found == ["_".join(words[:n]) for n in (1, 2, 3, 4)]
    assert df.select(snake_case(F.lit("Title"))).first()[0] == "title"


def test_stack(spark):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([(2, 5)], "i bigint, a int")
    out = stack([a, b, spark.createDataFrame([(3,)], "i int")])
    assert values(out) == [(1, "x"), (2, "5"), (3, None)]
    assert dict(out.dtypes)["i"] == "bigint"
    shapes = [
        spark.range(1).withColumn("geometry", F.lit(1)).withMetadata("geometry", {"crs": crs})
        for crs in (4326, 3857)
    ]
    with pytest.raises(InvalidParameterError, match="CRS"):
        stack(shapes)
    assert stack([shapes[0], shapes[0], spark.range(1)]).count() == 3


def test_merge_batches(spark, mixed):
    parts = [
        mixed.items.where("kind <> 'deletes'").select(
            F.lit(b).alias("batch"), "kind", "position", "object_id"
        )
        for b in range(3)
    ]
    merged = merge_batches(parts, [F.col("batch"), F.col("object_id")])
    found = merged.orderBy("kind", "position").collect()
    assert [r["position"] for r in found if r["kind"] == "adds"] == list(range(9))
    assert [r["position"] for r in found if r["kind"] == "updates"] == list(range(6))
    assert [r["batch"] for r in found if r["kind"] == "updates"] == [0, 0, 1, 1, 2, 2]


def test_failed_batches(spark):
    packed = spark.createDataFrame(
        [("adds", 0, 1, None), ("updates", 0, 1, 7), ("updates", 1, 1, None), ("deletes", 0, 1, 4),
         ("deletes", 1, 2, 5)],
        "kind string, position bigint, batch_id bigint, oid bigint",
    )
    failures = spark.range(1).select(
        F.lit(1).cast("bigint").alias("batch_id"),
        error_struct(code=F.lit(-1), description=F.lit("timed out"), exception=F.lit("ReadTimeout"),
                     outcome_unknown=F.lit(True), status_url=F.lit("u")).alias("error"),
    )
    frame = EditResults(failed_batches(packed, failures)).metadata_frame()
    assert values(frame, "kind", "position", "object_id", "status", "error_status_url") == [
        ("adds", 0, -1, "unknown", "u"), ("deletes", 0, 4, "unknown", "u"),
        ("updates", 0, 7, "unknown", "u"), ("updates", 1, -1, "unknown", "u")]
