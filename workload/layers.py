"""The test tables as layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import Layer, LayerContract
from lamina.functions import geometry as geo
from lamina.session import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def field(name: str, kind: str, **more) -> dict:
    return {"name": name, "type": f"esriFieldType{kind}", "editable": True, "nullable": True, **more}


def oid(name: str) -> dict:
    return field(name, "OID", editable=False, nullable=False)


def coded(**names: str) -> dict:
    values = [{"code": code, "name": name} for code, name in names.items()]
    return {"type": "codedValue", "name": "codes", "codedValues": values}


EDITABLE = "Query,Editing,Create,Update,Delete"

# "P" has no entry on purpose: it must pass through
ORDER_STATUS = coded(F="Finished", O="Open")

ORDERS = LayerContract.from_metadata(
    {
        "objectIdField": "objectid",
        "capabilities": EDITABLE,
        "supportsRollbackOnFailureParameter": True,
        "fields": [
            oid("objectid"),
            field("o_orderkey", "BigInteger"),
            field("o_custkey", "BigInteger"),
            field("o_orderstatus", "String", length=8, domain=ORDER_STATUS),
            field("o_totalprice", "Double"),
            field("o_orderdate", "Date"),
            field("o_orderpriority", "String", length=15),
        ],
    },
    {"maxRecordCount": 1000, "spatialReference": {"latestWkid": 4326}},
)

CUSTOMERS = LayerContract.from_metadata(
    {
        "objectIdField": "c_custkey",
        "capabilities": EDITABLE,
        "fields": [
            oid("c_custkey"),
            field("c_name", "String", length=25),
            field("c_nationkey", "Integer", domain={
                "type": "codedValue",
                "codedValues": [
                    {"code": 0, "name": "Zero"}, {"code": 1, "name": "One"},
                    {"code": 2, "name": "Two"}, {"code": 3, "name": "Three"},
                ],
            }),
            field("c_acctbal", "Double", nullable=False),
            field("c_mktsegment", "String", length=10),
        ],
    }
)

EVENTS = LayerContract.from_metadata(
    {
        "objectIdField": "event_id",
        "capabilities": "Query",
        "fields": [
            oid("event_id"),
            field("ts", "Date"),
            field("user_id", "BigInteger"),
            field("event_type", "String", length=20),
            field("value", "Double"),
        ],
    }
)

CLOCKED = LayerContract.from_metadata(
    {
        "objectIdField": "event_id",
        "capabilities": "Query",
        "fields": [
            oid("event_id"),
            field("clock", "TimeOnly"),
            field("event_type", "String", length=20),
        ],
    }
)

SPOTS = LayerContract.from_metadata(
    {
        "objectIdField": "vec_id",
        "capabilities": "Query",
        "fields": [oid("vec_id"), field("label", "Integer")],
    },
    {"spatialReference": {"latestWkid": 4326}},
)

# Crosswalk of attachment properties to table fields.
ATTACHMENT_PROPERTIES = [
    {"name": "id", "fieldName": "ATTACHMENTID", "isEnabled": True},
    {"name": "globalId", "fieldName": "GLOBALID", "isEnabled": True},
    {"name": "name", "fieldName": "ATT_NAME", "isEnabled": True},
    {"name": "size", "fieldName": "DATA_SIZE", "isEnabled": True},
    {"name": "contentType", "fieldName": "CONTENT_TYPE", "isEnabled": True},
    {"name": "keywords", "fieldName": "KEYWORDS", "isEnabled": True},
    {"name": "exifInfo", "fieldName": "EXIFINFO", "isEnabled": False},
]

DOCUMENTS = LayerContract.from_metadata(
    {
        "objectIdField": "doc_id",
        "capabilities": EDITABLE,
        "hasAttachments": True,
        "advancedQueryCapabilities": {
            "supportsQueryAttachments": True,
            "supportsQueryAttachmentsCountOnly": True,
            "supportsQueryAttachmentsOrderByFields": True,
        },
        "attachmentProperties": ATTACHMENT_PROPERTIES,
        "fields": [
            oid("doc_id"),
            field("lang", "String", length=2),
            field("source", "String", length=20),
            field("n_chars", "BigInteger"),
        ],
    }
)


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    return rows.select((F.col("o_orderkey") + 1).alias("objectid"), *rows.columns)


def orders(spark: SparkSession, folder: str) -> Layer:
    return Layer(order_rows(spark, folder), ORDERS)


#: Added to the numbers of the orders of 2000 and later, beyond any number in the tables.
RENUMBERED = 10_000_000_000


def orders_renumbered(spark: SparkSession, folder: str) -> Layer:
    """All orders, those of 2000 and later under numbers of their own, which no feed knows."""
    late = F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    more = F.when(late, F.lit(RENUMBERED)).otherwise(F.lit(0))
    rows = order_rows(spark, folder)
    return Layer(rows.withColumns({c: F.col(c) + more for c in ("objectid", "o_orderkey")}), ORDERS)


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """What the line items say about each order: total, state, first shipping date."""
    total = F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double")
    n_open = F.count_if(F.col("l_linestatus") == "O")
    state = (
        F.when(n_open == 0, "Finished").when(n_open == F.count(F.lit(1)), "Open").otherwise("P")
    )
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        state.alias("o_orderstatus"),
        total.alias("o_totalprice"),
        F.min("l_shipdate").alias("o_orderdate"),
    )


def customers(spark: SparkSession, folder: str) -> Layer:
    return Layer(table(spark, folder, "customer"), CUSTOMERS)


def events(spark: SparkSession, folder: str) -> Layer:
    return Layer(table(spark, folder, "events").drop("props"), EVENTS)


def clocked_events(spark: SparkSession, folder: str) -> Layer:
    """Events by their time of day, as text; written, as a layer that is queried often would be."""
    rows = table(spark, folder, "events")
    clock = F.date_format("ts", "HH:mm:ss").alias("clock")
    return Layer(stage(rows.select("event_id", clock, "event_type"), "clocked"), CLOCKED)


def _at(i: int, scale: float):
    return F.get("embedding", F.lit(i)).cast("double") * scale


def spots(spark: SparkSession, folder: str) -> Layer:
    """Embeddings as points: the first two numbers are longitude and latitude."""
    rows = table(spark, folder, "embeddings")
    place = geo.point(_at(0, 100.0), _at(1, 50.0), SPOTS.crs)
    return Layer(rows.select("vec_id", "label", place.alias("geometry")), SPOTS)


def thousandths(x):
    """Rounded by plain arithmetic, which gives the same double everywhere."""
    return F.floor(x * 1000 + 0.5) / 1000.0


def tracks(spark: SparkSession, folder: str) -> Layer:
    """Embeddings as lines: each pair of numbers is one position with height 1."""
    rows = table(spark, folder, "embeddings")
    step = F.sequence(F.lit(0), (F.size("embedding") / 2 - 1).cast("int"))
    line = F.transform(
        step,
        lambda i: F.array(
            thousandths(F.get("embedding", 2 * i).cast("double") * 100),
            thousandths(F.get("embedding", 2 * i + 1).cast("double") * 50),
            F.lit(1.0),
        ),
    )
    shape = geo.make_geometry(F.lit("LineString"), F.to_json(line), SPOTS.crs)
    return Layer(rows.select("vec_id", "label", shape.alias("geometry")), SPOTS)


def attachment_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as files of the document with the conversation's number."""
    ending = F.when(F.col("role") == "user", ".txt").when(F.col("role") == "system", ".log")
    name = F.concat("role", F.lit("-"), F.col("turn"), F.coalesce(ending, F.lit(".md")))
    content = F.encode("text", "UTF-8")
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("parentObjectId"),
        F.concat(F.lit("doc-"), "conv_id").alias("parentGlobalId"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.concat(F.lit("file-"), "conv_id", F.lit("-"), "turn").alias("globalId"),
        name.alias("name"),
        F.octet_length(content).cast("bigint").alias("size"),
        F.when(F.col("role") == "assistant", "text/markdown")
        .otherwise("text/plain")
        .alias("contentType"),
        F.concat(F.col("role"), F.lit(", turn"), F.col("turn")).alias("keywords"),
        content.alias("content"),
    )


def documents(spark: SparkSession, folder: str) -> Layer:
    """Documents with the conversations' turns attached. Their text is not read."""
    rows = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return Layer(rows, DOCUMENTS, attachments=attachment_rows(spark, folder))
