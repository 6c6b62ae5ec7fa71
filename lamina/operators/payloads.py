"""What an edit sends: writable columns, typed values, payload JSON."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import geometry as geo
from lamina.functions.coerce import CoercionReport, outbound, outbound_checks, stored
from lamina.functions.domains import recode_domains
from lamina.plans.contract import GEOMETRY_COLUMN, FieldSet, LayerContract

log = logging.getLogger(__name__)


def writable_columns(
    df: DataFrame, contract: LayerContract, *, with_oid: bool
) -> tuple[list[str], list[str]]:
    """Columns of ``df`` an edit may send, in layer order, and those it drops.

    Editable fields are sent, and the object id where it names the row to change.
    Geometry travels on its own and counts as neither.
    """
    wanted = set(contract.fields.filter(editable=True).names)
    if with_oid:
        wanted.add(contract.objectid_field)
    kept = [n for n in contract.fields.names if n in wanted and n in df.columns]
    dropped = sorted(set(df.columns) - {*kept, GEOMETRY_COLUMN})
    if dropped:
        log.warning("Not editable, not sent: %s", ", ".join(repr(c) for c in dropped))
    return kept, dropped


def sent_frame(
    df: DataFrame,
    contract: LayerContract,
    names: list[str],
    apply_coded_values: bool = False,
    *,
    observe: bool = True,
) -> tuple[DataFrame, CoercionReport]:
    """``df`` with the named columns as an edit sends them: names to codes, then types."""
    fields = FieldSet(f for f in contract.fields if f["name"] in names)
    if apply_coded_values:
        df, _ = recode_domains(df, fields, direction="to_esri", observe=False)
    dtypes = {f.name: f.dataType for f in df.schema}
    report, columns = CoercionReport(df), {}
    for field_def in fields:
        c = F.col(f"`{field_def['name']}`")
        outbound_checks(report, field_def, c, dtypes[field_def["name"]])
        columns[field_def["name"]] = outbound(field_def, c, dtypes[field_def["name"]])
    observed = report.observe(df) if observe else df
    return (observed.withColumns(columns) if columns else observed), report


def attributes_json(names: list[str]) -> Column:
    """Attributes as JSON. A null is written out: sending it sets the field to null."""
    if not names:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})


def feature_json(names: list[str], geometry: Column | None) -> Column:
    """One feature; a null geometry is left out, which keeps what the layer has."""
    opening = F.concat(F.lit('{"attributes":'), attributes_json(names))
    if geometry is None:
        return F.concat(opening, F.lit("}"))
    wire = geo.geometry_to_wire(geometry)
    tail = F.coalesce(F.concat(F.lit(',"geometry":'), wire, F.lit("}")), F.lit("}"))
    return F.concat(opening, tail)


def geometry_of(df: DataFrame) -> Column | None:
    return F.col(GEOMETRY_COLUMN) if GEOMETRY_COLUMN in df.columns else None


def serialize_features(
    df: DataFrame,
    contract: LayerContract,
    *,
    with_oid: bool = False,
    apply_coded_values: bool = False,
    keep: list[str] | None = None,
) -> tuple[DataFrame, CoercionReport]:
    """Feature JSON of every row in a column ``feature``, next to the ``keep`` columns."""
    names, _ = writable_columns(df, contract, with_oid=with_oid)
    sent, report = sent_frame(df, contract, names, apply_coded_values)
    feature = feature_json(names, geometry_of(df)).alias("feature")
    return sent.select(*(keep or []), feature), report


def stored_columns(contract: LayerContract, names: list[str], layer: T.StructType) -> dict[str, Column]:
    """Sent columns in the types the layer's table stores."""
    types = {f.name: f.dataType for f in layer}
    return {
        n: stored(contract.fields.get(n), F.col(f"`{n}`"), types[n]) for n in names if n in types
    }
