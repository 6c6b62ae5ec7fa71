import json

import pytest
from conftest import STATUS, metadata, values
from pyspark.sql import functions as F

from lamina import LayerContract, MissingGeometryError
from lamina.sources.pages import page_bodies, parse_pages, read_pages
from lamina.sources.responses import (
    outcome_unknown,
    parse_attachment_groups,
    parse_edit_responses,
    triage_errors,
)

SERVICE = {"spatialReference": {"latestWkid": 4326}, "maxRecordCount": 2}
CONTRACT = LayerContract.from_metadata(metadata(STATUS), SERVICE)


def write(folder, pages):
    for i, page in enumerate(pages):
        (folder / f"page-{i:03}.json").write_text(json.dumps(page))


def test_attribute_pages(spark, tmp_path):
    rows = [
        {"OBJECTID": 1, "Name": "a", "Status": "1", "Score": 2, "EventDate": 1577836800000},
        {"OBJECTID": 2, "Name": None, "Status": 9, "Score": 1.5, "EventDate": None, "Other": 1},
    ]
    write(tmp_path, [
        {"features": [{"attributes": rows[0]}], "exceededTransferLimit": True},
        {"features": [{"attributes": rows[1]}]},
        {"features": []},
        {},
    ])
    pages = read_pages(spark, str(tmp_path))
    result = parse_pages(pages, CONTRACT, keep=["page"], apply_coded_values=True)
    raw = parse_pages(pages, CONTRACT).to_frame()
    assert values(raw) == [(1, "a", 1, 2.0, 1577836800000), (2, None, 9, 1.5, None)]
    assert dict(raw.dtypes)["EventDate"] == "bigint"
    decoded = result.to_frame()
    assert values(decoded, "OBJECTID", "Status") == [(1, "Active"), (2, "9")]
    assert dict(decoded.dtypes)["EventDate"] == "timestamp"
    assert decoded.select("page").distinct().count() == 2
    with pytest.raises(MissingGeometryError):
        result.to_geodataframe()


def test_geojson_pages(spark, tmp_path):
    def feature(oid, geometry):
        return {"type": "Feature", "properties": {"OBJECTID": oid, "Name": "n"}, "geometry": geometry}

    write(tmp_path, [{"features": [
        feature(1, {"type": "Point", "coordinates": [0.5, 1]}),
        feature(2, None),
        feature(3, {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}),
    ]}])
    result = parse_pages(
        read_pages(spark, str(tmp_path)), CONTRACT, out_fields=["OBJECTID", "Name"], geojson=True
    )
    frame = result.to_geodataframe()
    assert frame.schema["geometry"].metadata == {"crs": 4326}
    assert values(frame, "OBJECTID", "geometry.type", "geometry.bbox.xmax") == [
        (1, "Point", 0.5), (2, None, None), (3, "LineString", 3.0)]
    assert result.to_frame().columns == ["OBJECTID", "Name"]


def test_page_bodies(spark):
    rows = spark.sql(
        "SELECT id AS OBJECTID, concat('n', id) AS Name, id AS position, "
        "id div 2 AS page_id FROM range(5)"
    )
    pages = {r[0]: json.loads(r[1]) for r in page_bodies(rows, CONTRACT, ["OBJECTID", "Name"]).collect()}
    assert [len(pages[i]["features"]) for i in range(3)] == [2, 2, 1]
    assert [pages[i]["exceededTransferLimit"] for i in range(3)] == [True, True, False]
    assert pages[1]["features"][0] == {"attributes": {"OBJECTID": 2, "Name": "n2"}}


def test_edit_responses(spark):
    bodies = [
        (0, json.dumps({"addResults": [{"objectId": 5, "globalId": "G", "success": True}, {}],
                        "deleteResults": [{"objectId": 7, "success": False, "error": {
                            "code": 400, "extendedCode": -2146, "message": "m",
                            "details": ["a", "b"]}}]})),
        (1, json.dumps({"updateResults": []})),
        (2, "{}"),
    ]
    df = spark.createDataFrame(bodies, "batch int, body string")
    rows = parse_edit_responses(df, ["batch"]).orderBy("kind", "item").collect()
    assert [(r["kind"], r["item"], r["object_id"], r["global_id"], r["success"]) for r in rows] == [
        ("adds", 0, 5, "G", True), ("adds", 1, -1, None, False), ("deletes", 0, 7, None, False)]
    error = rows[2]["error"]
    assert (error["code"], error["message"], error["details"], error["extra"]) == (
        400, "m", ["a", "b"], {"extended_code": "-2146"})
    assert rows[0]["error"] is None


def test_attachment_groups(spark):
    body = {"attachmentGroups": [
        {"parentObjectId": 1, "parentGlobalId": "g1", "attachmentInfos": [
            {"id": 10, "name": "a", "size": 5}, {"id": 11, "name": "b", "size": 6}]},
        {"parentObjectId": 2, "parentGlobalId": "g2", "attachmentInfos": []},
        {"parentObjectId": 3, "parentGlobalId": "g3", "attachmentInfos": [{"id": 12}]},
    ]}
    counts = {"attachmentGroups": [{"parentObjectId": 1, "parentGlobalId": "g1", "count": 2}]}
    df = spark.createDataFrame([(json.dumps(body),), ("{}",)], "body string")
    assert values(parse_attachment_groups(df, ["id", "name", "size"])) == [
        (1, "g1", 10, "a", 5), (1, "g1", 11, "b", 6), (3, "g3", 12, None, None)]
    df = spark.createDataFrame([(json.dumps(counts),)], "body string")
    assert values(parse_attachment_groups(df, ["id"], count_only=True)) == [(1, "g1", 2)]


@pytest.mark.parametrize(
    ("body", "wanted"),
    [
        ({"error": {"code": 498, "message": "m", "details": ["d"]}},
         ("TokenExpiredError", 498, "m", ["d"])),
        ({"error": {"code": 499}}, ("TokenMissingError", 499, "Unknown error", [])),
        ({"error": {"code": 403}}, ("AuthorizationError", 403, "Unknown error", [])),
        ({"error": {"code": 404}}, ("NotFoundError", 404, "Unknown error", [])),
        ({"error": {"code": 500}}, ("ServiceError", 500, "Unknown error", [])),
        ({"error": {}}, ("ServiceError", -1, "Unknown error", [])),
        ({"features": []}, (None, None, None, None)),
    ],
)
def test_triage(spark, body, wanted):
    df = triage_errors(spark.createDataFrame([(json.dumps(body),)], "body string"))
    assert tuple(df.drop("body").first()) == wanted


@pytest.mark.parametrize(
    ("status", "failure", "wanted"),
    [
        (500, "HTTPStatusError", True), (503, None, True), (404, "HTTPStatusError", False),
        (None, "ConnectError", False), (None, "ConnectTimeout", False), (None, "PoolTimeout", False),
        (None, "ReadTimeout", True), (None, "JSONDecodeError", True), (None, "KeyError", True),
        (None, "TimeoutError", True), (None, "InvalidParameterError", False), (None, None, False),
    ],
)
def test_outcome_unknown(spark, status, failure, wanted):
    df = spark.createDataFrame([(status, failure)], "s int, f string")
    assert df.select(outcome_unknown(F.col("s"), F.col("f"))).first()[0] is wanted
