"""Feature pages: JSON responses to rows, and rows to page JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import geometry as geo
from lamina.functions.coerce import to_epoch_ms, to_float, to_integer
from lamina.operators.query import QueryResult
from lamina.plans.contract import (
    DATE_TYPE,
    FLOAT_TYPES,
    GEOMETRY_COLUMN,
    INTEGER_TYPES,
    FieldSet,
    LayerContract,
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page file: ``page`` (its path) and ``body``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("page"), F.col("value").alias("body"))


def _page_schema(fields: FieldSet, geojson: bool) -> T.StructType:
    # attribute values are read as text first: a number sent as a string still types
    attributes = T.StructType([T.StructField(n, T.StringType()) for n in fields.names])
    parts = [T.StructField("properties" if geojson else "attributes", attributes)]
    if geojson:
        parts.append(T.StructField(GEOMETRY_COLUMN, T.StringType()))
    return T.StructType([T.StructField("features", T.ArrayType(T.StructType(parts)))])


def raw_value(field_def: dict, text: Column) -> Column:
    """Attribute text as the JSON type the service uses: numbers, or text."""
    kind, text_type = field_def.get("type"), T.StringType()
    if kind in INTEGER_TYPES or kind == DATE_TYPE:
        return to_integer(text, text_type, T.LongType())
    if kind in FLOAT_TYPES:
        return to_float(text, text_type)
    return text


def parse_pages(
    pages: DataFrame,
    contract: LayerContract,
    *,
    out_fields: list[str] | None = None,
    geojson: bool = False,
    apply_coded_values: bool = False,
    keep: list[str] | None = None,
) -> QueryResult:
    """Features of all pages as rows; a page without features gives none.

    ``geojson`` pages carry ``properties`` and a geometry, others ``attributes``.
    ``keep`` names columns of ``pages`` to repeat on each row, such as an offset.
    """
    names = contract.resolve_out_fields(out_fields)
    fields = contract.fields.filter(names=names)
    parsed = F.from_json(F.col("body"), _page_schema(fields, geojson))
    rows = pages.select(*(keep or []), F.explode(parsed["features"]).alias("_f"))
    source = F.col("_f.properties" if geojson else "_f.attributes")
    columns = [raw_value(f, source[f["name"]]).alias(f["name"]) for f in fields]
    if geojson:
        columns.append(
            geo.geometry_from_geojson(F.col(f"_f.{GEOMETRY_COLUMN}"), contract.crs).alias(
                GEOMETRY_COLUMN
            )
        )
    df = rows.select(*(keep or []), *columns)
    return QueryResult(df, fields, contract.crs if geojson else None, apply_coded_values)


def page_bodies(numbered: DataFrame, contract: LayerContract, names: list[str]) -> DataFrame:
    """Page JSON from rows with ``position`` and ``page_id``.

    A page has at most the layer's maximum record count, so it can be collected.
    The last page says that nothing follows.
    """
    wire = []
    for n in names:
        dtype, c = numbered.schema[n].dataType, F.col(f"`{n}`")
        is_date = contract.fields.get(n).get("type") == DATE_TYPE
        wire.append((to_epoch_ms(c, dtype) if is_date else c).alias(n))
    geojson = GEOMETRY_COLUMN in numbered.columns
    attributes = F.to_json(F.struct(*wire), {"ignoreNullFields": "false"})
    if geojson:
        g = F.col(GEOMETRY_COLUMN)
        shape = F.concat(
            F.lit('{"type":"'), g["type"], F.lit('","coordinates":'), g["coordinates"], F.lit("}")
        )
        feature = F.concat(
            F.lit('{"type":"Feature","properties":'), attributes,
            F.lit(',"geometry":'), F.coalesce(shape, F.lit("null")), F.lit("}"),
        )
    else:
        feature = F.concat(F.lit('{"attributes":'), attributes, F.lit("}"))
    grouped = numbered.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("position", feature.alias("f")))).alias("rows")
    )
    last_page = numbered.agg(F.max("page_id")).first()[0]
    more = F.when(F.col("page_id") < F.lit(last_page), F.lit("true")).otherwise(F.lit("false"))
    body = F.concat(
        F.lit('{"features":['),
        F.array_join(F.transform("rows", lambda r: r["f"]), ","),
        F.lit('],"exceededTransferLimit":'), more, F.lit("}"),
    )
    return grouped.select("page_id", body.alias("body"))
