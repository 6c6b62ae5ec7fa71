import pytest
from conftest import STATUS, metadata, values
from pyspark.sql import functions as F

from lamina import (
    InvalidParameterError,
    Layer,
    LayerCapabilityError,
    LayerContract,
    MissingGeometryError,
)
from lamina.functions import geometry as geo
from lamina.operators import query as query_module, selection
from lamina.operators.numbering import number_in_place, number_rows
from lamina.operators.query import keep_ids
from lamina.operators.selection import SortKey, take_window

IDS = LayerContract.from_metadata(
    {
        "objectIdField": "id",
        "capabilities": "Query",
        "fields": [
            {"name": "id", "type": "esriFieldTypeOID"},
            {"name": "v", "type": "esriFieldTypeInteger"},
            {"name": "at", "type": "esriFieldTypeDate"},
        ],
    },
    {"maxRecordCount": 1000, "spatialReference": {"latestWkid": 4326}},
)


@pytest.fixture(scope="module")
def many(spark):
    rows = spark.range(0, 2500, numPartitions=5).select(
        "id", (F.col("id") % 7).cast("int").alias("v"),
        F.timestamp_millis(F.col("id") * 1000).alias("at"),
    )
    return Layer(rows, IDS)


def ids(result):
    return [r["id"] for r in result.to_frame().collect()]


@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize(
    ("offset", "count"),
    [(None, 1500), (500, None), (2000, 1000), (None, 1), (500, 1), (2499, 5), (2500, 10), (0, 2500)],
)
def test_windows(many, monkeypatch, limit, offset, count):
    """The same rows in the same order, as a top-k and by selection."""
    monkeypatch.setattr(selection, "MAX_TOP_ROWS", limit)
    monkeypatch.setattr(selection, "SAMPLE_ROWS", 200)
    options = {"resultOffset": offset, "resultRecordCount": count}
    found = ids(many.query(**{k: v for k, v in options.items() if v is not None}))
    start = offset or 0
    end = 2500 if count is None else min(2500, start + count)
    assert found == list(range(start, end))


def test_windows_concatenate_to_the_ordered_result(many):
    whole = ids(many.query(orderByFields="v DESC"))
    assert whole == sorted(range(2500), key=lambda i: (-(i % 7), i))
    parts = [
        ids(many.query(orderByFields="v DESC", resultOffset=o, resultRecordCount=900))
        for o in (0, 900, 1800)
    ]
    assert parts[0] + parts[1] + parts[2] == whole


def test_window_arguments_are_cast(many):
    assert ids(many.query(resultOffset="3", resultRecordCount="2")) == [3, 4]


def test_pages(many):
    pages = many.plan(out_fields="id").pages(400).collect()
    assert {r["id"]: (r["position"], r["page_id"]) for r in pages} == {
        i: (i, i // 400) for i in range(2500)
    }
    # never more than the service allows, and that much when nothing was asked
    assert max(r["page_id"] for r in many.plan().pages(5000).collect()) == 2
    assert max(r["page_id"] for r in many.plan().pages(0).collect()) == 2


def test_numbering_is_contiguous_under_skew(spark):
    """Most rows share the leading order value; they are still split over tasks."""
    rows = spark.range(0, 9000, numPartitions=6).withColumn(
        "k", F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id"))
    )
    found = number_rows(rows, [F.col("k"), F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(9000))
    wanted = sorted((5 if i % 3 < 2 else i, i) for i in range(9000))
    assert [(r["k"], r["id"]) for r in found] == wanted
    kept = number_in_place(rows).orderBy("position").collect()
    assert [r["id"] for r in kept] == list(range(9000))


def test_filters_and_forms(many):
    assert many.count("v = 3") == 357
    assert many.count(orderByFields="v", resultRecordCount=5) == 2500
    assert ids(many.query("v = 3 AND id < 20")) == [3, 10, 17]
    assert values(many.query(out_fields="v", returnDistinctValues=True).to_frame()) == [
        (i,) for i in range(7)
    ]
    distinct = many.query(
        out_fields="v", returnDistinctValues=True, orderByFields="v DESC", resultRecordCount=2
    )
    assert [r[0] for r in distinct.to_frame().collect()] == [6, 5]
    assert values(many.query("id < 3", returnIdsOnly=True).df) == [(0,), (1,), (2,)]
    only = many.query(returnUniqueIdsOnly=True, resultOffset=2498)
    assert values(only.df) == [(2498,), (2499,)]


@pytest.mark.parametrize(
    ("time", "wanted"),
    [("5000", [5]), (5000, [5]), ("5000,7000", [5, 6, 7]), ("null,1000", [0, 1]),
     ([2498000, None], [2498, 2499])],
)
def test_time(many, time, wanted):
    assert sorted(ids(many.query(time=time))) == wanted


def test_object_ids(spark, many, monkeypatch):
    table = spark.createDataFrame([(7,), (7,), (9999,)], "id bigint")
    for given in ("3,5", [3, 5], (5, 3)):
        assert sorted(ids(many.query(objectIds=given))) == [3, 5]
    assert ids(many.query(objectIds=table)) == [7]
    monkeypatch.setattr(query_module, "MAX_INLINE_IDS", 1)
    assert sorted(ids(many.query(objectIds=[3, 5, 5]))) == [3, 5]
    named = spark.createDataFrame([("a",), ("b",)], "g string")
    assert values(keep_ids(named, "g", "a, c")) == [("a",)]


def test_statistics_having_forms(many):
    spec = '[{"statisticType":"sum","onStatisticField":"id","outStatisticFieldName":"s"}]'
    for having in ("SUM(id) > 446000", "s > 446000"):
        found = many.query(
            outStatistics=spec, groupByFieldsForStatistics="v", havingClause=having
        ).df
        assert values(found) == [
            (v, s) for v in range(7) if (s := sum(range(v, 2500, 7))) > 446000
        ]
    total = many.query(outStatistics=[{"statisticType": "MAX", "onStatisticField": "id"}]).df
    assert values(total) == [(2499,)]


@pytest.mark.parametrize(
    "options",
    [
        {"out_fields": "ID"},
        {"orderByFields": "nope"},
        {"orderByFields": "id SIDEWAYS"},
        {"where": "at = '2020-01-01'"},
        {"outStatistics": [{"statisticType": "mode", "onStatisticField": "id"}]},
        {"outStatistics": [{"statisticType": "max", "onStatisticField": "nope"}]},
        {"maxAllowableOffset": 3},
        {"time": "1,2,3"},
        {"out_fields": "v", "returnDistinctValues": True, "orderByFields": "id"},
        {"geometry": "0,0,1,1", "spatialRel": "esriSpatialRelContains"},
    ],
)
def test_arguments_are_refused(many, options):
    with pytest.raises(InvalidParameterError):
        many.query(**options)


def test_transport_options_are_ignored(many):
    assert ids(many.query("id = 4", f="json", resultType="standard")) == [4]


def test_query_capability(many):
    with pytest.raises(LayerCapabilityError):
        Layer(many.rows, IDS.with_(capabilities="Editing")).query()


def test_empty_result_keeps_columns(many):
    found = many.query("id < 0", ["v", "id"]).to_frame()
    assert found.columns == ["v", "id"] and found.collect() == []


def test_decode_types_first(spark):
    contract = LayerContract.from_metadata(metadata(STATUS))
    rows = spark.createDataFrame([(1, "1", 0), (2, "9", None)],
                                 "OBJECTID bigint, Status string, EventDate bigint")
    fields = "OBJECTID,Status,EventDate"
    layer = Layer(rows, contract)
    found = layer.query(out_fields=fields, apply_coded_values=True).to_frame()
    assert values(found, "OBJECTID", "Status") == [(1, "Active"), (2, "9")]
    assert dict(found.dtypes)["EventDate"] == "timestamp"
    raw = layer.query(out_fields=fields).to_frame()
    assert dict(raw.dtypes)["EventDate"] == "bigint"
    # decoding without domains does not type anything
    plain = Layer(rows, LayerContract.from_metadata(metadata()))
    found = plain.query(out_fields=fields, apply_coded_values=True).to_frame()
    assert dict(found.dtypes)["EventDate"] == "bigint"
    typed = plain.query(out_fields=fields).to_frame(parse_dtypes=True)
    assert dict(typed.dtypes) == {"OBJECTID": "bigint", "Status": "int", "EventDate": "timestamp"}


def test_geometry_output(spark):
    rows = spark.range(3).select(
        "id", F.lit(1).alias("v"), F.current_timestamp().alias("at"),
        geo.point(F.col("id"), F.lit(1), 4326).alias("geometry"),
    )
    layer = Layer(rows, IDS)
    found = layer.query(out_fields="id", out_sr=3857)
    assert found.crs == 3857
    frame = found.to_geodataframe()
    assert frame.schema["geometry"].metadata == {"crs": 3857}
    assert frame.first()["geometry"]["crs"] == 3857
    assert found.to_frame().columns == ["id"]
    bare = layer.query(return_geometry=False, out_sr=3857)
    assert bare.crs is None
    with pytest.raises(MissingGeometryError):
        bare.to_geodataframe()
    assert layer.count(geometry="0.5,0,9,9") == 2
    assert layer.count(geometry="55659,0,1e7,1e7", inSR=3857) == 2
    window = layer.query(out_fields="id", resultRecordCount=1, resultOffset=1)
    assert window.to_geodataframe().first()["geometry"]["bbox"]["xmin"] == 1.0


def test_top_rows_without_order_column_selected(many):
    top = take_window(many.rows, [SortKey(F.col("v"), True), F.col("id")], 1, 2).select("id")
    assert [r[0] for r in top.collect()] == [13, 20]
