import pytest
from conftest import STATUS, metadata

from lamina import FieldSet, InvalidParameterError, LayerContract


def test_defaults_of_empty_metadata():
    c = LayerContract.from_metadata({})
    assert (c.objectid_field, c.globalid_field, c.crs, c.max_record_count, c.description) == (
        "OBJECTID", None, 3857, 1000, "")
    assert not (c.supports_query or c.supports_apply_edits or c.has_attachments)


def test_service_scalars():
    service = {"spatialReference": {"latestWkid": 4326}, "maxRecordCount": 50,
               "serviceDescription": "d"}
    c = LayerContract.from_metadata("{}", service)
    assert (c.crs, c.max_record_count, c.description) == (4326, 50, "d")


@pytest.mark.parametrize(
    ("capabilities", "query", "editing", "update"),
    [
        ("Query,Create,Update,Delete", True, False, True),
        ("QUERY,EDITING", True, True, False),
        ("", False, False, False),
    ],
)
def test_capabilities_are_substrings(capabilities, query, editing, update):
    c = LayerContract.from_metadata({"capabilities": capabilities})
    assert (c.supports_query, c.supports_apply_edits, c.supports_update) == (query, editing, update)


@pytest.mark.parametrize(
    ("criteria", "names"),
    [
        ({"names": ["Score", "Name"]}, ["Name", "Score"]),
        ({"types": "esriFieldTypeDate"}, ["EventDate"]),
        ({"types": ["esriFieldTypeOID", "esriFieldTypeDouble"]}, ["OBJECTID", "Score"]),
        ({"editable": True}, ["Name", "Status", "Score", "EventDate"]),
        ({"editable": False}, ["OBJECTID"]),
        ({"nullable": False}, ["OBJECTID"]),
        ({"nullable": True}, ["Name", "Status", "Score", "EventDate"]),
        ({"names": []}, []),
        ({"names": ["Name", "OBJECTID"], "editable": True}, ["Name"]),
    ],
)
def test_filter(contract, criteria, names):
    assert contract.fields.filter(**criteria).names == names


def test_filter_rejects(contract):
    with pytest.raises(InvalidParameterError, match="together"):
        contract.fields.filter(names=["Name"], types="esriFieldTypeOID")
    with pytest.raises(InvalidParameterError, match="Nope"):
        contract.fields.filter(types=["Nope", "esriFieldTypeOID"])


def test_domain_maps_later_entry_wins():
    doubled = {"type": "codedValue", "codedValues": [
        {"code": 1, "name": "A"}, {"code": 1, "name": "B"}, {"code": 2, "name": "B"}]}
    fields = FieldSet([
        {"name": "x", "type": "esriFieldTypeInteger", "domain": doubled},
        {"name": "y", "type": "esriFieldTypeInteger", "domain": {"type": "range"}},
    ])
    assert set(fields.domain_maps) == {"x"}
    assert fields.domain_maps["x"]["to_name"] == {1: "B", 2: "B"}
    assert fields.domain_maps["x"]["to_code"] == {"A": 1, "B": 2}


@pytest.mark.parametrize(
    ("given", "names"),
    [
        (None, ["OBJECTID", "Name", "Status", "Score", "EventDate"]),
        ("*", ["OBJECTID", "Name", "Status", "Score", "EventDate"]),
        ([" Name ", "Score"], ["Name", "Score"]),
        (" Name,Score ", ["Name", "Score"]),
    ],
)
def test_out_fields(contract, given, names):
    assert contract.resolve_out_fields(given) == names


@pytest.mark.parametrize("given", ["Ghost", "Foo,Bar", "name", "Name, Score"])
def test_unknown_out_fields(contract, given):
    with pytest.raises(InvalidParameterError, match="No such columns"):
        contract.resolve_out_fields(given)


def test_catalogue_and_schema(spark):
    fields = LayerContract.from_metadata(metadata(STATUS)).fields
    rows = fields.to_frame(spark).collect()
    assert [r["name"] for r in rows] == fields.names
    assert rows[1]["length"] == 10 and "Pending" in rows[2]["domain"]
    kinds = {f.name: f.dataType.simpleString() for f in fields.schema()}
    assert kinds == {"OBJECTID": "bigint", "Name": "string", "Status": "int",
                     "Score": "double", "EventDate": "timestamp"}
