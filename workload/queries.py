"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import Layer, LayerStore
from lamina.functions import coerce, geometry as geo
from lamina.functions.domains import recode_domains
from lamina.operators import attachments as att
from lamina.operators import batches, diff, results
from lamina.operators.edits import tag_input
from lamina.operators.numbering import POSITION
from lamina.operators.payloads import serialize_features
from lamina.operators.selection import SortKey, take_window
from lamina.plans.literals import literal_is_valid
from lamina.session import shared_folder, stage
from lamina.sources import pages as page_files
from lamina.sources import responses
from workload import layers as on

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


ORDER_ROWS = "(SELECT o_orderkey + 1 AS objectid, * FROM orders)"
_MORE = f"CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN {on.RENUMBERED} ELSE 0 END"
RENUMBERED = f"""(SELECT * REPLACE (objectid + {_MORE} AS objectid, o_orderkey + {_MORE} AS o_orderkey)
                 FROM {ORDER_ROWS})"""
FEED = """(
    SELECT l_orderkey AS o_orderkey,
           CASE WHEN count(*) FILTER (WHERE l_linestatus = 'O') = 0 THEN 'Finished'
                WHEN count(*) FILTER (WHERE l_linestatus = 'O') = count(*) THEN 'Open'
                ELSE 'P' END AS o_orderstatus,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS o_totalprice,
           min(l_shipdate) AS o_orderdate
    FROM lineitem GROUP BY l_orderkey)"""
CODE = "CASE {0} WHEN 'Finished' THEN 'F' WHEN 'Open' THEN 'O' ELSE {0} END"
SPOT_ROWS = """(SELECT vec_id, label, embedding[1]::DOUBLE * 100.0 AS x,
                       embedding[2]::DOUBLE * 50.0 AS y FROM embeddings)"""


# ---- queries: filters, fields, order, windows -------------------------------


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderdate >= DATE '1997-01-01' AND o_orderstatus = 'F'"""
)
def query_where_date(spark, folder):
    return on.orders(spark, folder).query(
        "o_orderdate >= DATE '1997-01-01' AND o_orderstatus = 'F'",
        ["o_orderkey", "o_custkey", "o_totalprice"],
    ).to_frame()


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderdate NOT BETWEEN TIMESTAMP '1996-01-01 00:00:00'
                                 AND TIMESTAMP '1999-12-31 00:00:00'"""
)
def query_where_between(spark, folder):
    return on.orders(spark, folder).query(
        "o_orderdate NOT BETWEEN TIMESTAMP '1996-01-01 00:00:00' "
        "AND TIMESTAMP '1999-12-31 00:00:00'",
        "o_orderkey,o_totalprice",
    ).to_frame()


@query(
    """SELECT o_orderkey + 1 AS objectid, o_orderkey FROM orders
       ORDER BY objectid LIMIT 50 OFFSET 137"""
)
def query_window(spark, folder):
    return on.orders(spark, folder).query(
        out_fields="objectid,o_orderkey", resultOffset=137, resultRecordCount=50
    ).to_frame()


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey OFFSET 250"""
)
def query_window_open_end(spark, folder):
    return on.orders(spark, folder).query(
        out_fields="o_orderkey,o_totalprice",
        orderByFields="o_totalprice DESC",
        resultOffset=250,
    ).to_frame()


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
         SELECT *, row_number() OVER (
           ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    l_quantity, l_discount, l_tax, l_shipdate) AS line_id FROM lineitem)
       ORDER BY line_id LIMIT 25"""
)
def query_order_topk(spark, folder):
    """Top rows by price over the largest table, ties broken by the whole row."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_discount", "l_tax", "l_shipdate"]
    rows = on.table(spark, folder, "lineitem")
    columns = [SortKey(F.col("l_extendedprice"), True), *map(F.col, order)]
    return take_window(rows, columns, 0, 25).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query("SELECT count(*) AS count FROM orders WHERE o_orderstatus IN ('O', 'P')")
def query_count(spark, folder):
    return on.orders(spark, folder).query(
        "o_orderstatus IN ('O', 'P')", returnCountOnly=True, orderByFields="o_totalprice DESC"
    ).df


@query("SELECT o_orderkey + 1 AS objectid FROM orders WHERE o_totalprice > 300000")
def query_ids(spark, folder):
    return on.orders(spark, folder).query("o_totalprice > 300000", returnIdsOnly=True).df


@query("SELECT DISTINCT event_id FROM events WHERE event_type <> 'view'")
def query_unique_ids(spark, folder):
    return on.events(spark, folder).query(
        "event_type <> 'view'", returnUniqueIdsOnly=True
    ).df


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def query_distinct(spark, folder):
    return on.orders(spark, folder).query(
        out_fields="o_orderstatus,o_orderpriority",
        return_geometry=False,
        returnDistinctValues=True,
    ).to_frame()


@query(
    """SELECT user_id, event_type, count(value) AS n, round(sum(value), 2) AS total,
              min(value) AS low, max(value) AS high, round(avg(value), 4) AS mean,
              round(stddev(value), 4) AS spread, round(var_samp(value), 3) AS variance
       FROM events GROUP BY user_id, event_type HAVING count(event_id) > 12"""
)
def query_statistics(spark, folder):
    def statistic(kind, name):
        return {"statisticType": kind, "onStatisticField": "value", "outStatisticFieldName": name}

    names = {"count": "n", "sum": "total", "min": "low", "max": "high", "avg": "mean",
             "stddev": "spread", "var": "variance"}
    found = on.events(spark, folder).query(
        outStatistics=[statistic(k, n) for k, n in names.items()],
        groupByFieldsForStatistics="user_id,event_type",
        havingClause="COUNT(event_id) > 12",
    ).df
    digits = {"total": 2, "mean": 4, "spread": 4, "variance": 3}
    return found.withColumns({n: F.round(n, d) for n, d in digits.items()})


@query(
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
         SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def query_object_ids(spark, folder):
    urgent = on.orders(spark, folder).query("o_orderpriority = '1-URGENT'", "o_custkey")
    return on.customers(spark, folder).query(
        out_fields="c_custkey,c_name", objectIds=urgent.to_frame()
    ).to_frame()


@query(
    """SELECT event_id, user_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'"""
)
def query_time_extent(spark, folder):
    return on.events(spark, folder).query(
        out_fields="event_id,user_id", time="1704412800000,1705752000000"
    ).to_frame()


@query(
    f"""SELECT objectid, o_orderkey, o_custkey,
               CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'
                                  ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, epoch_ms(o_orderdate) AS o_orderdate, o_orderpriority
        FROM {ORDER_ROWS}"""
)
def query_typed_and_decoded(spark, folder):
    found = on.orders(spark, folder).query(apply_coded_values=True).to_frame(parse_dtypes=True)
    return found.withColumn("o_orderdate", F.unix_millis("o_orderdate"))


@query(
    """SELECT position, CAST(position // 1000 AS BIGINT) AS page_id, o_orderkey FROM (
         SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1
                AS position FROM orders)"""
)
def query_pages(spark, folder):
    return on.orders(spark, folder).plan(
        out_fields="o_orderkey", orderByFields="o_totalprice DESC"
    ).pages().select("position", "page_id", "o_orderkey")


# ---- geometry -----------------------------------------------------------------


@query(
    f"SELECT vec_id, label FROM {SPOT_ROWS} WHERE x BETWEEN -10 AND 12.5 AND y BETWEEN -6 AND 7.5"
)
def envelope_filter(spark, folder):
    return on.spots(spark, folder).query(
        geometry="-10,-6,12.5,7.5", geometryType="esriGeometryEnvelope", inSR=4326
    ).to_frame()


@query(
    f"""SELECT vec_id FROM {SPOT_ROWS}
        WHERE radians(x) * 6378137 BETWEEN -1000000 AND 1200000
          AND ln(tan(pi() / 4 + radians(y) / 2)) * 6378137 BETWEEN -500000 AND 700000"""
)
def envelope_filter_mercator(spark, folder):
    return on.spots(spark, folder).query(
        out_fields="vec_id", geometry="-1000000,-500000,1200000,700000", inSR=3857
    ).to_frame()


@query(
    f"""SELECT vec_id, round(radians(x) * 6378137, 3) AS x,
               round(ln(tan(pi() / 4 + radians(y) / 2)) * 6378137, 3) AS y
        FROM {SPOT_ROWS}"""
)
def reproject_mercator(spark, folder):
    moved = on.spots(spark, folder).query(out_fields="vec_id", out_sr=3857).to_geodataframe()
    return moved.select(
        "vec_id",
        F.round("geometry.bbox.xmin", 3).alias("x"),
        F.round("geometry.bbox.ymin", 3).alias("y"),
    )


@query(
    f"SELECT vec_id, round(x, 2) AS x, round(y, 2) AS y FROM {SPOT_ROWS}"
)
def geometry_precision(spark, folder):
    found = on.spots(spark, folder).query(out_fields="vec_id", geometryPrecision=2)
    box = F.col("geometry.bbox")
    return found.to_geodataframe().select(
        "vec_id", box["xmin"].alias("x"), box["ymin"].alias("y")
    )


TRACK_ROWS = """(SELECT vec_id, label,
    list_transform(embedding[1:len(embedding):2], lambda v: floor(v::DOUBLE * 100 * 1000 + 0.5) / 1000.0) AS xs,
    list_transform(embedding[2:len(embedding):2], lambda v: floor(v::DOUBLE * 50 * 1000 + 0.5) / 1000.0) AS ys
    FROM embeddings)"""


@query(
    f"""SELECT vec_id, list_min(xs) AS xmin, list_min(ys) AS ymin,
               list_max(xs) AS xmax, list_max(ys) AS ymax FROM {TRACK_ROWS}"""
)
def feature_envelopes(spark, folder):
    found = on.tracks(spark, folder).query(out_fields="vec_id", returnEnvelope=True).df
    return found.select("vec_id", "envelope.*")


@query(
    f"SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM {SPOT_ROWS}"
)
def query_extent(spark, folder):
    return on.spots(spark, folder).query(returnExtentOnly=True).df


@query(
    f"""SELECT vec_id, '{{"paths":[[' || array_to_string(list_transform(
              list_zip(xs, ys), lambda p: '[' || p[1]::VARCHAR || ',' || p[2]::VARCHAR || ',1.0]'),
              ',') || ']],"hasZ":true}}' AS wire FROM {TRACK_ROWS}"""
)
def geometry_wire(spark, folder):
    rows = on.tracks(spark, folder).rows
    return rows.select("vec_id", geo.geometry_to_wire(F.col("geometry")).alias("wire"))


@query(
    f"""SELECT vec_id, '[' || array_to_string(list_transform(
              list_zip(xs, ys), lambda p: '[' || p[1]::VARCHAR || ',' || p[2]::VARCHAR || ']'),
              ',') || ']' AS coordinates FROM {TRACK_ROWS}"""
)
def geometry_without_z(spark, folder):
    found = on.tracks(spark, folder).query(out_fields="vec_id", returnZ=False)
    return found.to_geodataframe().select("vec_id", "geometry.coordinates")


# ---- scalar functions -----------------------------------------------------------


@query(
    """SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'Zero' WHEN 1 THEN 'One' WHEN 2 THEN 'Two'
              WHEN 3 THEN 'Three' ELSE c_nationkey::VARCHAR END AS c_nationkey FROM customer"""
)
def decode_domain(spark, folder):
    layer = on.customers(spark, folder)
    return recode_domains(layer.rows, layer.fields)[0].select("c_custkey", "c_nationkey")


@query(
    """SELECT n_nationkey, CASE n_name WHEN 'Zero' THEN 0 WHEN 'One' THEN 1
              ELSE NULL END::INTEGER AS c_nationkey
       FROM (SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'Zero' WHEN 1 THEN 'One'
                                 ELSE n_name END AS n_name FROM nation)"""
)
def encode_domain(spark, folder):
    """Names to codes on the way out; a name without a code ends as null."""
    nation = on.table(spark, folder, "nation")
    name = F.when(F.col("n_nationkey") == 0, "Zero").when(F.col("n_nationkey") == 1, "One")
    rows = nation.select("n_nationkey", F.coalesce(name, "n_name").alias("c_nationkey"))
    coded, _ = recode_domains(rows, on.CUSTOMERS.fields, direction="to_esri")
    return coerce.enforce_types(coded, on.CUSTOMERS.fields, direction="to_esri")[0]


@query("SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events")
def date_to_epoch_ms(spark, folder):
    rows = on.events(spark, folder).rows.select("event_id", "ts")
    fields = on.EVENTS.fields.filter(names=["ts"])
    return coerce.enforce_types(rows, fields, direction="to_esri")[0]


@query(
    """SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts
       FROM events"""
)
def epoch_ms_to_date(spark, folder):
    sent = date_to_epoch_ms(spark, folder)
    typed, _ = coerce.enforce_types(sent, on.EVENTS.fields.filter(names=["ts"]))
    return typed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


_NUMERIC_TEXT = "CASE WHEN event_type = 'view' THEN event_type ELSE value::VARCHAR END"


def _numeric_text(spark, folder):
    """Event values as text, with words where the type is a view."""
    text = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(
        F.col("value").cast("string")
    )
    return on.table(spark, folder, "events").select("event_id", text.alias("number"))


@query(
    f"""SELECT event_id, CAST(trunc(TRY_CAST({_NUMERIC_TEXT} AS DOUBLE)) AS INTEGER) AS number
        FROM events"""
)
def to_integer(spark, folder):
    number = coerce.to_integer(F.col("number"), T.StringType(), T.IntegerType())
    return _numeric_text(spark, folder).withColumn("number", number)


@query(f"SELECT event_id, TRY_CAST({_NUMERIC_TEXT} AS DOUBLE) AS number FROM events")
def to_float(spark, folder):
    return _numeric_text(spark, folder).withColumn(
        "number", coerce.to_float(F.col("number"), T.StringType())
    )


@query(
    """SELECT doc_id, substr(text, 1, list_max(list_filter(range(0, 102),
              lambda k: strlen(substr(text, 1, k)) <= 101))) AS text FROM documents"""
)
def truncate_utf8(spark, folder):
    text = coerce.truncate_utf8(F.col("text"), 101)
    return on.table(spark, folder, "documents").select("doc_id", text.alias("text"))


@query(
    """SELECT doc_id, CASE WHEN lang = 'en' THEN upper('{' || md5(source) || '}')
              ELSE '{' || upper(md5(source)) || '}' END AS guid FROM documents"""
)
def guid_format(spark, folder):
    bare = F.md5("source")
    given = F.when(F.col("lang") == "en", F.concat(F.lit("{"), bare, F.lit("}"))).otherwise(bare)
    return on.table(spark, folder, "documents").select("doc_id", coerce.to_guid(given).alias("guid"))


_DAY_TEXT = """year(o_orderdate) || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '-' END
    || lpad((month(o_orderdate) + o_custkey % 3)::VARCHAR, 2, '0') || '-'
    || (day(o_orderdate) + o_custkey % 2)"""


@query(
    f"""SELECT o_orderkey, regexp_full_match(t, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
               AND try_strptime(t, '%Y-%m-%d') IS NOT NULL AS is_valid
        FROM (SELECT o_orderkey, {_DAY_TEXT} AS t FROM orders)"""
)
def literal_valid(spark, folder):
    """Day texts of mixed quality: wrong separators, one-digit days, months beyond 12."""
    day = F.col("o_orderdate")
    text = F.concat(
        F.year(day),
        F.when(F.col("o_orderstatus") == "P", "/").otherwise("-"),
        F.lpad((F.month(day) + F.col("o_custkey") % 3).cast("string"), 2, "0"),
        F.lit("-"),
        F.dayofmonth(day) + F.col("o_custkey") % 2,
    )
    rows = on.table(spark, folder, "orders").select("o_orderkey", text.alias("t"))
    valid = literal_is_valid(F.col("t"), "esriFieldTypeDateOnly", "DATE")
    return rows.select("o_orderkey", valid.alias("is_valid"))


@query(
    """SELECT count(*) FILTER (WHERE o_orderpriority IS NOT NULL) AS priority_failed,
              count(*) FILTER (WHERE o_totalprice <> trunc(o_totalprice)) AS price_fractional,
              count(*) FILTER (WHERE strlen(o_orderpriority) > 6) AS priority_truncated,
              count(*) AS date_naive FROM orders"""
)
def coercion_counts(spark, folder):
    """What a coercion would change, counted per column."""
    fields = on.LayerContract.from_metadata({"fields": [
        on.field("o_orderpriority", "Integer"),
        on.field("o_totalprice", "Integer"),
        on.field("o_orderdate", "Date"),
    ]}).fields
    rows = on.table(spark, folder, "orders")
    numbers = coerce.enforce_types(rows, fields, direction="to_esri")[1]
    short = on.LayerContract.from_metadata({"fields": [
        on.field("o_orderpriority", "String", length=6)]}).fields
    texts = coerce.enforce_types(rows, short, direction="to_esri")[1]
    report = coerce.CoercionReport(rows, numbers.checks | texts.checks)
    return report.frame().select(
        F.col("`o_orderpriority:failed`").alias("priority_failed"),
        F.col("`o_totalprice:fractional`").alias("price_fractional"),
        F.col("`o_orderpriority:truncated`").alias("priority_truncated"),
        F.col("`o_orderdate:naive`").alias("date_naive"),
    )


@query(
    """SELECT event_id, coalesce(nullif(d, ''), nullif(trim(coalesce(m, '') || ' ' ||
              coalesce(array_to_string(l, ' '), '')), '')) AS error_description
       FROM (SELECT event_id,
                    CASE event_type WHEN 'error' THEN event_type WHEN 'view' THEN '' END AS d,
                    CASE WHEN event_type <> 'signup' THEN 'Event ' || user_id END AS m,
                    CASE WHEN value > 50 THEN [event_type, props] END AS l FROM events)"""
)
def error_text(spark, folder):
    kind = F.col("event_type")
    text = results.error_text(
        F.when(kind == "error", kind).when(kind == "view", ""),
        F.when(kind != "signup", F.concat(F.lit("Event "), "user_id")),
        F.when(F.col("value") > 50, F.array("event_type", "props")),
    )
    return on.table(spark, folder, "events").select("event_id", text.alias("error_description"))


# ---- key comparison -------------------------------------------------------------


def _diff(spark, folder):
    return on.orders_renumbered(spark, folder).diff(
        on.order_feed(spark, folder), ["o_orderkey"], apply_coded_values=True
    )


@query(
    f"""SELECT o_orderkey, o_orderstatus, o_totalprice FROM {FEED}
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {RENUMBERED})"""
)
def diff_adds(spark, folder):
    return _diff(spark, folder)[0].select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    f"""SELECT l.objectid, f.o_orderkey, f.o_orderstatus, f.o_totalprice
        FROM {FEED} f JOIN {RENUMBERED} l ON f.o_orderkey = l.o_orderkey"""
)
def diff_updates(spark, folder):
    return _diff(spark, folder)[1].select(
        "objectid", "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    f"""SELECT objectid, o_orderkey FROM {RENUMBERED}
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def diff_deletes(spark, folder):
    return _diff(spark, folder)[2]


@query(
    """SELECT c.c_custkey, s.* FROM
         (SELECT s_nationkey AS c_nationkey, max(s_acctbal) AS c_acctbal
          FROM supplier GROUP BY s_nationkey) s
       JOIN (SELECT c_nationkey, max(c_custkey) AS c_custkey
             FROM customer GROUP BY c_nationkey) c USING (c_nationkey)"""
)
def diff_duplicate_layer_keys(spark, folder):
    """Many layer rows per key: the largest object id owns it."""
    feed = on.table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey"))
    _, updates, _ = on.customers(spark, folder).diff(
        feed.agg(F.max("s_acctbal").alias("c_acctbal")), ["c_nationkey"]
    )
    return updates.select("c_custkey", "c_nationkey", "c_acctbal")


_PRIORITY = "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END"


@query(
    f"""SELECT objectid, p AS o_orderpriority, o_orderstatus
        FROM (SELECT objectid, {_PRIORITY} AS p, o_orderstatus FROM {ORDER_ROWS}) l
        WHERE NOT EXISTS (
          SELECT 1 FROM (SELECT DISTINCT {_PRIORITY} AS p, l_linestatus AS o_orderstatus
                         FROM orders JOIN lineitem ON l_orderkey = o_orderkey) f
          WHERE f.p IS NOT DISTINCT FROM l.p AND f.o_orderstatus = l.o_orderstatus)"""
)
def diff_null_keys(spark, folder):
    """Two-field keys with nulls, each shared by many layer rows: null matches null."""
    priority = F.when(
        F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")
    )
    rows = on.order_rows(spark, folder).withColumn("o_orderpriority", priority)
    lines = on.table(spark, folder, "lineitem").select("l_orderkey", "l_linestatus")
    feed = (
        rows.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_orderpriority", F.col("l_linestatus").alias("o_orderstatus"))
        .distinct()
    )
    layer = Layer(rows, on.ORDERS)
    return layer.diff(feed, ["o_orderpriority", "o_orderstatus"])[2]


@query(
    """SELECT c_nationkey, c_mktsegment, count(*) AS n_rows FROM customer
       GROUP BY ALL HAVING count(*) > 1"""
)
def dup_key_gate(spark, folder):
    return diff.duplicate_keys(
        on.table(spark, folder, "customer"), ["c_nationkey", "c_mktsegment"]
    )


# ---- edits ------------------------------------------------------------------------

_UPDATED = f"""SELECT l.objectid, l.o_orderkey, l.o_custkey,
    CASE WHEN f.o_orderkey IS NULL THEN l.o_orderstatus ELSE {CODE.format('f.o_orderstatus')} END
      AS o_orderstatus,
    CASE WHEN f.o_orderkey IS NULL THEN l.o_totalprice ELSE f.o_totalprice END AS o_totalprice,
    epoch_ms(CASE WHEN f.o_orderkey IS NULL THEN l.o_orderdate ELSE f.o_orderdate END)
      AS o_orderdate,
    l.o_orderpriority, f.o_orderkey IS NOT NULL AS hit
    FROM {RENUMBERED} l LEFT JOIN {FEED} f ON f.o_orderkey = l.o_orderkey"""
_ADDED = f"""SELECT o_orderkey, NULL::BIGINT AS o_custkey,
    {CODE.format('o_orderstatus')} AS o_orderstatus, o_totalprice,
    epoch_ms(o_orderdate) AS o_orderdate, NULL::VARCHAR AS o_orderpriority
    FROM {FEED} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {RENUMBERED})"""


def _natural(rows: DataFrame) -> DataFrame:
    """Layer rows without the object id, which new rows get in arrival order."""
    return rows.drop("objectid").withColumn(
        "o_orderdate", F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    )


@query(f"SELECT * EXCLUDE (objectid, hit) FROM ({_UPDATED}) UNION ALL {_ADDED}")
def upsert_snapshot(spark, folder):
    outcome = on.orders_renumbered(spark, folder).upsert(
        on.order_feed(spark, folder), ["o_orderkey"], apply_coded_values=True
    )
    return _natural(outcome.rows)


@query(f"SELECT * EXCLUDE (objectid, hit) FROM ({_UPDATED}) WHERE hit UNION ALL {_ADDED}")
def sync_snapshot(spark, folder):
    outcome = on.orders_renumbered(spark, folder).sync(
        on.order_feed(spark, folder), ["o_orderkey"], apply_coded_values=True
    )
    return _natural(outcome.rows)


@query(
    f"""SELECT f.o_orderkey, f.o_orderstatus, 'updates' AS kind, 'succeeded' AS status
        FROM {FEED} f JOIN {RENUMBERED} l ON f.o_orderkey = l.o_orderkey
        UNION ALL SELECT o_orderkey, o_orderstatus, 'adds', 'succeeded' FROM {FEED}
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {RENUMBERED})
        UNION ALL SELECT o_orderkey, NULL, 'deletes', 'succeeded' FROM {RENUMBERED}
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def sync_results(spark, folder):
    """Every edit next to the input row it came from."""
    outcome = on.orders_renumbered(spark, folder).sync(
        on.order_feed(spark, folder), ["o_orderkey"], apply_coded_values=True
    )
    return outcome.results.to_frame().select(
        "o_orderkey",
        "o_orderstatus",
        F.col("_edit_kind").alias("kind"),
        F.col("_edit_status").alias("status"),
    )


@query(
    """SELECT * FROM customer UNION ALL
       SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey),
              s_name, s_nationkey, s_acctbal, NULL FROM supplier"""
)
def append_snapshot(spark, folder):
    """Suppliers become customers; the layer numbers them in input order."""
    new = on.table(spark, folder, "supplier").orderBy("s_suppkey")
    return on.customers(spark, folder).append(
        new.select(
            F.col("s_name").alias("c_name"),
            F.col("s_nationkey").alias("c_nationkey"),
            F.col("s_acctbal").alias("c_acctbal"),
        )
    ).rows


def _price_updates(spark, folder):
    """New prices for every order by its first number, which the layer may not have."""
    rows = on.order_rows(spark, folder)
    return rows.select("objectid", (F.col("o_totalprice") * 2).alias("o_totalprice"))


@query(
    f"""SELECT 'updates' AS kind, o.objectid AS object_id, l.objectid IS NOT NULL AS success,
               CASE WHEN l.objectid IS NULL
                    THEN 'Object id ' || o.objectid || ' does not exist.' END AS description
        FROM {ORDER_ROWS} o LEFT JOIN {RENUMBERED} l ON l.objectid = o.objectid"""
)
def edits_no_rollback(spark, folder):
    """Without rollback each edit stands alone."""
    outcome = on.orders_renumbered(spark, folder).apply_edits(
        updates=_price_updates(spark, folder), rollback_on_failure=False
    )
    return outcome.items.select(
        "kind", "object_id", "success", F.col("error.description").alias("description")
    )


@query(
    f"""SELECT objectid, CASE WHEN objectid < {on.RENUMBERED} THEN o_totalprice * 2
                              ELSE o_totalprice END AS o_totalprice FROM {RENUMBERED}"""
)
def edits_no_rollback_snapshot(spark, folder):
    outcome = on.orders_renumbered(spark, folder).apply_edits(
        updates=_price_updates(spark, folder), rollback_on_failure=False
    )
    return outcome.rows.select("objectid", "o_totalprice")


# Ids of seven digits cost nine bytes each, so a budget of 45 bytes holds five.
_SHIFT = 1_000_000
_FIVE_DELETES = batches.OVERHEAD_BYTES + 45


@query(
    f"""WITH edits AS (
          SELECT o_orderkey + {_SHIFT} AS object_id, o_orderdate < TIMESTAMP '2000-01-01' AS found,
                 (row_number() OVER (ORDER BY o_orderkey) - 1) // 5 AS batch FROM orders)
        SELECT object_id, bool_and(found) OVER (PARTITION BY batch) AS success,
               CASE WHEN NOT bool_and(found) OVER (PARTITION BY batch)
                    THEN 400::BIGINT END AS error_code
        FROM edits"""
)
def edits_rollback(spark, folder):
    """With rollback one bad delete fails its whole batch, and no other."""
    return _rolled_back(spark, folder, on.table(spark, folder, "orders"))


@query(SQL["edits_rollback"])
def edits_rollback_many_tasks(spark, folder):
    """The same edits from many tasks: batches and verdicts stay."""
    return _rolled_back(spark, folder, _in_tasks(on.table(spark, folder, "orders")))


def _in_tasks(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey")


def _rolled_back(spark, folder, edited: DataFrame) -> DataFrame:
    shifted = F.col("o_orderkey") + _SHIFT
    rows = on.orders_renumbered(spark, folder).rows.withColumn("objectid", shifted)
    ids = edited.select(shifted.alias("objectid"))
    outcome = Layer(rows, on.ORDERS).apply_edits(deletes=ids, max_batch_bytes=_FIVE_DELETES)
    return outcome.results.metadata_frame().select(
        "object_id", (F.col("status") == "succeeded").alias("success"), "error_code"
    )


@query(
    f"""SELECT batch AS batch_id,
               '{{"deletes":"' || string_agg(object_id::VARCHAR, ',' ORDER BY object_id) || '"}}' AS body
        FROM (SELECT o_orderkey + {_SHIFT} AS object_id,
                     (row_number() OVER (ORDER BY o_orderkey) - 1) // 5 AS batch FROM orders)
        GROUP BY batch"""
)
def edit_bodies(spark, folder):
    """Deletes as request bodies of at most 45 bytes."""
    ids = on.table(spark, folder, "orders").select((F.col("o_orderkey") + _SHIFT).alias("objectid"))
    return on.orders(spark, folder).edit_bodies(deletes=ids, max_batch_bytes=_FIVE_DELETES)


@query(SQL["edit_bodies"])
def edit_bodies_many_tasks(spark, folder):
    """The same bodies from many tasks."""
    rows = _in_tasks(on.table(spark, folder, "orders"))
    ids = rows.select((F.col("o_orderkey") + _SHIFT).alias("objectid"))
    return on.orders(spark, folder).edit_bodies(deletes=ids, max_batch_bytes=_FIVE_DELETES)


@query(
    f"""SELECT objectid, o_totalprice * 2 AS o_totalprice FROM {ORDER_ROWS}
        WHERE o_orderdate >= TIMESTAMP '2000-01-01'"""
)
def result_filter_failed(spark, folder):
    """The rejected input rows as they came, ready for another try."""
    outcome = on.orders_renumbered(spark, folder).apply_edits(
        updates=_price_updates(spark, folder), rollback_on_failure=False
    )
    rejected = outcome.results.filter(kinds="updates", statuses=["failed", "unknown"])
    return rejected.to_frame(include_metadata=False)


@query("SELECT count(*) > 0 AS has_failures FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def has_failures(spark, folder):
    outcome = on.orders_renumbered(spark, folder).apply_edits(
        deletes=on.order_rows(spark, folder).select("objectid"), rollback_on_failure=False
    )
    return results.any_failure(outcome.items)


@query(
    """WITH RECURSIVE items AS (
         SELECT o_orderkey AS oid, row_number() OVER (ORDER BY o_orderkey) - 1 AS position,
                sum(length(o_orderkey::VARCHAR) + 2) OVER (ORDER BY o_orderkey) AS upto
         FROM orders),
       starts AS (
         SELECT 0::BIGINT AS number, 0::BIGINT AS first, 0::HUGEINT AS before
         UNION ALL
         SELECT s.number + 1,
                (SELECT max(i.position) + 1 FROM items i WHERE i.upto <= s.before + 20000),
                (SELECT max(i.upto) FROM items i WHERE i.upto <= s.before + 20000)
         FROM starts s WHERE s.before + 20000 < (SELECT max(upto) FROM items))
       SELECT i.oid, i.position, max(s.number) AS batch_id
       FROM items i JOIN starts s ON i.position >= s.first GROUP BY ALL"""
)
def batch_packing(spark, folder):
    """Deletes packed into requests of 20,000 bytes, in order."""
    return _packed_deletes(on.table(spark, folder, "orders"))


@query(SQL["batch_packing"])
def batch_packing_many_tasks(spark, folder):
    """The same batches from many tasks."""
    return _packed_deletes(_in_tasks(on.table(spark, folder, "orders")))


def _packed_deletes(rows: DataFrame) -> DataFrame:
    ids = stage(tag_input(rows.select("o_orderkey")), "deletes")
    edits = ids.select(
        F.lit(2).alias("kind_rank"),
        F.col("_seq").alias("seq"),
        F.col("o_orderkey").alias("oid"),
        F.lit(None).cast("string").alias("problem"),
        batches.delete_size(F.col("o_orderkey")).cast("bigint").alias("size"),
    )
    pack = batches.pack_edits(edits, 20_000 + batches.OVERHEAD_BYTES)
    return pack.edits.select("oid", "position", "batch_id")


@query(
    """SELECT c_custkey, '{"attributes":{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
              || ',"c_acctbal":' || c_acctbal::VARCHAR || ',"c_mktsegment":' ||
              CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}}'
              AS feature FROM customer"""
)
def feature_payload(spark, folder):
    """Feature JSON: a null attribute is written out."""
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    rows = on.table(spark, folder, "customer").withColumn("c_mktsegment", segment)
    return serialize_features(rows, on.CUSTOMERS, keep=["c_custkey"])[0]


@query(
    """WITH rows AS (SELECT o_orderkey AS oid, o_orderkey // 50 AS batch_id FROM orders)
       SELECT CAST(batch_id AS BIGINT) AS batch_id,
              '{"deletes":"' || string_agg(oid::VARCHAR, ',' ORDER BY oid) || '"}' AS body
       FROM rows GROUP BY batch_id"""
)
def batch_bodies(spark, folder):
    """Request bodies of batches that are already formed."""
    rows = on.table(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / 50).cast("bigint").alias("batch_id"),
        F.lit("deletes").alias("kind"),
        F.col("o_orderkey").alias("position"),
        F.lit(None).cast("string").alias("feature"),
        F.col("o_orderkey").alias("oid"),
    )
    return batches.batch_bodies(rows)


# ---- pages and responses -------------------------------------------------------------


@query(
    f"""SELECT objectid, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               epoch_ms(o_orderdate) AS o_orderdate, o_orderpriority FROM {ORDER_ROWS}"""
)
def pages_round_trip(spark, folder):
    """Orders to page JSON and back."""
    layer = on.orders(spark, folder)
    bodies = page_files.page_bodies(
        layer.plan(return_geometry=False).pages(), layer.contract, layer.fields.names
    )
    return page_files.parse_pages(bodies, layer.contract).to_frame()


@query(f"SELECT vec_id, label, x, y, 4326 AS crs FROM {SPOT_ROWS}")
def geojson_pages_round_trip(spark, folder):
    layer = on.spots(spark, folder)
    bodies = page_files.page_bodies(layer.plan().pages(), layer.contract, layer.fields.names)
    found = page_files.parse_pages(bodies, layer.contract, geojson=True)
    typed = found.to_geodataframe(parse_dtypes=True)
    box = F.col("geometry.bbox")
    return typed.select(
        "vec_id", "label", box["xmin"].alias("x"), box["ymin"].alias("y"), "geometry.crs"
    )


def _edit_responses(spark, folder):
    """One response per line item: an update result, and an add result if it was returned."""
    update = F.concat(
        F.lit('"updateResults":[{"objectId":'), "l_orderkey", F.lit(',"success":true}]')
    )
    failed = F.lit('{"success":false,"error":{"code":1016,"description":"No field."}}')
    add = F.concat(
        F.lit('"addResults":['), failed, F.lit(',{"objectId":'), "l_partkey",
        F.lit(',"globalId":"G'), "l_suppkey", F.lit('","success":true}],'),
    )
    body = F.concat(
        F.lit("{"), F.when(F.col("l_returnflag") == "R", add).otherwise(""), update, F.lit("}")
    )
    return on.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", body.alias("body"))


@query(
    """SELECT l_orderkey, l_linenumber, 'updates' AS kind, 0::BIGINT AS item,
              l_orderkey AS object_id, NULL AS global_id, true AS success,
              NULL::BIGINT AS code FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'adds', 0, -1, NULL, false, 1016
       FROM lineitem WHERE l_returnflag = 'R'
       UNION ALL SELECT l_orderkey, l_linenumber, 'adds', 1, l_partkey, 'G' || l_suppkey, true, NULL
       FROM lineitem WHERE l_returnflag = 'R'"""
)
def edit_responses(spark, folder):
    items = responses.parse_edit_responses(
        _edit_responses(spark, folder), ["l_orderkey", "l_linenumber"]
    )
    return items.withColumn("code", F.col("error.code")).drop("error")


@query(
    """SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY c, i) - 1 AS position, object_id
       FROM (SELECT 'updates' AS kind, c_custkey AS c, 0 AS i, c_custkey AS object_id FROM customer
             UNION ALL SELECT 'adds', c_custkey, 0, -1 FROM customer WHERE c_acctbal < 0
             UNION ALL SELECT 'adds', c_custkey, 1, c_custkey * 10 FROM customer
             WHERE c_acctbal < 0)"""
)
def merged_batch_results(spark, folder):
    """Results of many responses numbered per kind, in posting order."""
    rows = on.table(spark, folder, "customer")
    add = F.concat(F.lit(',"addResults":[{},{"success":true,"objectId":'),
                   F.col("c_custkey") * 10, F.lit("}]"))
    body = F.concat(
        F.lit('{"updateResults":[{"success":true,"objectId":'), "c_custkey", F.lit("}]"),
        F.when(F.col("c_acctbal") < 0, add).otherwise(""), F.lit("}"),
    )
    items = responses.parse_edit_responses(
        rows.select("c_custkey", body.alias("body")), ["c_custkey"]
    ).withColumn(POSITION, F.lit(None).cast("bigint"))
    merged = results.merge_batches([items], [F.col("c_custkey"), F.col("item")])
    return merged.select("kind", POSITION, "object_id")


@query(
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'adds' WHEN 'O' THEN 'updates' ELSE 'deletes' END
                AS kind, o_orderkey AS position,
              CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_custkey END AS object_id,
              'unknown' AS status, c.c_name AS error_description
       FROM orders JOIN customer c ON o_custkey = c_custkey WHERE c_acctbal < 0"""
)
def failed_batch_items(spark, folder):
    """Batches (one per customer) that failed as a whole give one item per edit."""
    state = F.col("o_orderstatus")
    packed = on.table(spark, folder, "orders").select(
        F.when(state == "F", "adds").when(state == "O", "updates").otherwise("deletes").alias("kind"),
        F.col("o_orderkey").alias("position"),
        F.col("o_custkey").alias("batch_id"),
        F.col("o_custkey").alias("oid"),
    )
    failures = on.table(spark, folder, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("batch_id"),
        results.error_struct(
            code=F.lit(-1),
            description=F.col("c_name"),
            exception=F.lit("ReadTimeout"),
            outcome_unknown=F.lit(True),
        ).alias("error"),
    )
    items = results.failed_batches(packed, failures)
    return results.EditResults(items).metadata_frame().select(
        "kind", "position", "object_id", "status", "error_description"
    )


@query(
    """SELECT event_id,
              CASE WHEN event_type = 'error' THEN CASE code WHEN 498 THEN 'TokenExpiredError'
                WHEN 499 THEN 'TokenMissingError' WHEN 403 THEN 'AuthorizationError'
                WHEN 404 THEN 'NotFoundError' ELSE 'ServiceError' END END AS error_class,
              CASE WHEN event_type = 'error' THEN coalesce(code, -1) END AS error_code,
              CASE WHEN event_type = 'error' THEN coalesce('Code ' || code, 'Unknown error') END
                AS error_message
       FROM (SELECT event_id, event_type, CASE WHEN value < 20 THEN NULL
               WHEN value < 40 THEN 498 WHEN value < 60 THEN 499 WHEN value < 80 THEN 403
               WHEN value < 100 THEN 404 ELSE 500 END::BIGINT AS code FROM events)"""
)
def error_triage(spark, folder):
    """Events as a log of response bodies; the errors among them are envelopes."""
    value = F.col("value")
    code = F.when(value >= 20, F.when(value < 40, 498).when(value < 60, 499).when(
        value < 80, 403).when(value < 100, 404).otherwise(500))
    inside = F.coalesce(
        F.concat(F.lit('"code":'), code, F.lit(',"message":"Code '), code, F.lit('"')), F.lit("")
    )
    body = F.when(
        F.col("event_type") == "error", F.concat(F.lit('{"error":{'), inside, F.lit("}}"))
    ).otherwise(F.lit('{"features":[]}'))
    log = on.table(spark, folder, "events").select("event_id", body.alias("body"))
    return responses.triage_errors(log).drop("body", "error_details")


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN value >= 100
         ELSE event_type IN ('view', 'click') END AS outcome_unknown FROM events"""
)
def outcome_unknown(spark, folder):
    """Requests that may have been applied, by status code or kind of failure."""
    kind = F.col("event_type")
    status = F.when(kind == "error", F.when(F.col("value") >= 100, 503).otherwise(404))
    failure = (
        F.when(kind == "view", "ReadTimeout").when(kind == "click", "JSONDecodeError")
        .when(kind == "purchase", "ConnectError").otherwise("InvalidParameterError")
    )
    return on.table(spark, folder, "events").select(
        "event_id", responses.outcome_unknown(status, failure).alias("outcome_unknown")
    )


# ---- attachments -----------------------------------------------------------------------

ATTACHED = """(SELECT conv_id AS "parentObjectId", 'doc-' || conv_id AS "parentGlobalId",
    conv_id * 1000 + turn AS id, 'file-' || conv_id || '-' || turn AS "globalId",
    role || '-' || turn || CASE role WHEN 'user' THEN '.txt' WHEN 'system' THEN '.log'
      ELSE '.md' END AS name,
    strlen(text) AS size,
    CASE role WHEN 'assistant' THEN 'text/markdown' ELSE 'text/plain' END AS "contentType",
    role || ', turn' || turn AS keywords FROM conversations)"""


@query(
    f"""SELECT a.* FROM {ATTACHED} a WHERE a."parentObjectId" IN (
          SELECT doc_id FROM documents WHERE lang = 'en')
        AND size BETWEEN 100 AND 2000 AND "contentType" IN ('text/plain')"""
)
def attach_query(spark, folder):
    return on.documents(spark, folder).query_attachments(
        definition_expression="lang = 'en'", size=(100, 2000), attachment_types=["text/plain"]
    ).to_frame()


@query(
    f"""SELECT "parentObjectId", "parentGlobalId", id AS "ATTACHMENTID", "globalId" AS "GLOBALID",
               name AS "ATT_NAME", size AS "DATA_SIZE", "contentType" AS "CONTENT_TYPE",
               keywords AS "KEYWORDS" FROM {ATTACHED}
        WHERE size > 300 AND (keywords LIKE 'user,%' OR keywords LIKE '%, turn0')"""
)
def attach_field_names(spark, folder):
    """Attachment expression and keywords; columns under their table field names."""
    return on.documents(spark, folder).query_attachments(
        definition_expression="1=1",
        attachments_definition_expression="DATA_SIZE > 300",
        keywords=["user", "turn0"],
    ).to_frame(use_field_names=True)


@query(
    f"""SELECT "parentObjectId", "parentGlobalId", count(*) AS count FROM {ATTACHED}
        WHERE "parentObjectId" IN (SELECT doc_id FROM documents) AND size >= 50
        GROUP BY ALL"""
)
def attach_count(spark, folder):
    return on.documents(spark, folder).query_attachments(
        definition_expression="1=1", size="50,", return_count_only=True
    ).to_frame()


@query(
    f"""SELECT id, name, size FROM (
          SELECT *, row_number() OVER (ORDER BY size DESC, id) AS place FROM {ATTACHED})
        WHERE place BETWEEN 11 AND 40"""
)
def attach_window(spark, folder):
    return on.documents(spark, folder).query_attachments(
        definition_expression="1=1",
        order_by_fields="DATA_SIZE DESC",
        result_offset=10,
        result_record_count=30,
    ).to_frame().select("id", "name", "size")


@query(
    f"""SELECT "parentObjectId", "parentGlobalId", id, name, size FROM {ATTACHED}
        WHERE "contentType" = 'text/plain'"""
)
def attach_groups(spark, folder):
    """Responses with one group per turn; groups with an empty list vanish."""
    info = F.to_json(F.struct("id", "name", "size"))
    infos = F.when(F.col("contentType") == "text/plain", info).otherwise("")
    body = F.concat(
        F.lit('{"attachmentGroups":[{"parentObjectId":'), "parentObjectId",
        F.lit(',"parentGlobalId":"'), "parentGlobalId", F.lit('","attachmentInfos":['),
        infos, F.lit("]}]}"),
    )
    bodies = on.attachment_rows(spark, folder).select(body.alias("body"))
    return responses.parse_attachment_groups(bodies, ["id", "name", "size"])


def _page_requests(spark, folder):
    """Web pages as files of documents, some of which do not exist. Pages whose address has
    a query get a name of their own, the others the last part of the address."""
    return on.table(spark, folder, "pages").select(
        (F.col("page_id") * 8).alias("parentObjectId"),
        F.lit(None).cast("bigint").alias("id"),
        F.split("url", r"\?")[0].alias("path"),
        F.encode("html", "UTF-8").alias("content"),
        F.when(
            F.col("url").contains("?"), F.concat(F.lit("page-"), "page_id", F.lit(".html"))
        ).alias("filename"),
        F.lit(None).cast("string").alias("content_type"),
    )


_REQUESTED = """(SELECT page_id, page_id * 8 AS parent,
    CASE WHEN contains(url, '?') THEN 'page-' || page_id || '.html'
         ELSE split_part(rtrim(split_part(url, '?', 1), '/'), '/', -1) END AS name,
    strlen(html) AS size,
    (SELECT max(conv_id * 1000 + turn) FROM conversations) + row_number() OVER (ORDER BY page_id)
      AS new_id FROM pages)"""


@query(
    f"""SELECT "parentObjectId", id, name, size, "contentType" FROM {ATTACHED}
        UNION ALL SELECT parent, new_id, name, size,
          CASE WHEN name LIKE '%_.html' THEN 'text/html' ELSE 'application/octet-stream' END
        FROM {_REQUESTED} WHERE parent IN (SELECT doc_id FROM documents)"""
)
def attach_add(spark, folder):
    outcome = on.documents(spark, folder).add_attachments(
        requests=_page_requests(spark, folder)
    )
    return outcome.attachments.select("parentObjectId", "id", "name", "size", "contentType")


@query(
    f"""SELECT CASE WHEN ok THEN new_id ELSE -1 END AS object_id, ok AS success,
               CASE WHEN NOT ok THEN 'Object id ' || parent || ' does not exist.' END
                 AS error_description
        FROM (SELECT *, parent IN (SELECT doc_id FROM documents) AS ok FROM {_REQUESTED})"""
)
def attach_add_results(spark, folder):
    outcome = on.documents(spark, folder).add_attachments(
        requests=_page_requests(spark, folder)
    )
    return outcome.results.to_frame().select("object_id", "success", "error_description")


def _replacements(spark, folder):
    """New text for every assistant turn, asked for under the turn's own number."""
    return on.table(spark, folder, "conversations").where("role = 'assistant'").select(
        F.col("conv_id").alias("parentObjectId"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.lit(None).cast("string").alias("path"),
        F.encode(F.concat("text", F.lit("!")), "UTF-8").alias("content"),
        F.lit("answer.json").alias("filename"),
        F.lit(None).cast("string").alias("content_type"),
    )


@query(
    f"""SELECT id, CASE WHEN a THEN 'answer.json' ELSE name END AS name,
               CASE WHEN a THEN size + 1 ELSE size END AS size,
               CASE WHEN a THEN 'application/json' ELSE "contentType" END AS "contentType"
        FROM (SELECT *, keywords LIKE 'assistant,%' AS a FROM {ATTACHED})"""
)
def attach_update(spark, folder):
    outcome = on.documents(spark, folder).update_attachments(
        requests=_replacements(spark, folder)
    )
    return outcome.attachments.select("id", "name", "size", "contentType")


def _delete_pairs(spark, folder):
    """Every user turn, and for every page a file that nobody has."""
    turns = on.table(spark, folder, "conversations").where("role = 'user'")
    absent = on.table(spark, folder, "pages").select(
        F.col("page_id").alias("parentObjectId"), (-1 - F.col("page_id")).alias("id")
    )
    return turns.select(
        F.col("conv_id").alias("parentObjectId"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
    ).union(absent)


@query(f"""SELECT id FROM {ATTACHED} WHERE keywords NOT LIKE 'user,%'""")
def attach_delete(spark, folder):
    outcome = on.documents(spark, folder).delete_attachments(pairs=_delete_pairs(spark, folder))
    return outcome.attachments.select("id")


@query(
    f"""SELECT id AS object_id, true AS success, NULL AS error_description
        FROM {ATTACHED} WHERE keywords LIKE 'user,%'
        UNION ALL SELECT -1 - page_id, false,
          'No result returned for attachment ' || (-1 - page_id) || '.' FROM pages"""
)
def attach_delete_results(spark, folder):
    outcome = on.documents(spark, folder).delete_attachments(pairs=_delete_pairs(spark, folder))
    return outcome.results.to_frame().select("object_id", "success", "error_description")


@query(
    """SELECT conv_id AS "parentObjectId",
              CAST(('0x' || substr(md5((conv_id * 1000 + turn)::VARCHAR), 1, 8))::BIGINT
                   % ceil(count(*) OVER (PARTITION BY conv_id) / 4.0)::BIGINT AS BIGINT) AS request,
              conv_id * 1000 + turn AS id FROM conversations"""
)
def attach_delete_requests(spark, folder):
    """Deletes grouped per feature, about four ids to a request."""
    pairs = on.attachment_rows(spark, folder).select("parentObjectId", "id")
    grouped = att.delete_requests(pairs, ids_per_request=4)
    return grouped.select("parentObjectId", "request", F.explode("ids").alias("id"))


# ---- times of day, empty results, deep windows, keys as text ------------------------


@query(
    """SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events
       WHERE strftime(ts, '%H:%M:%S') BETWEEN '08:30:00' AND '17:00:00'
         AND strftime(ts, '%H:%M:%S') <> '12:00:00'"""
)
def query_where_time(spark, folder):
    """A time-of-day field between two TIME literals."""
    return on.clocked_events(spark, folder).query(
        "clock BETWEEN TIME '08:30:00' AND TIME '17:00:00' AND clock <> TIME '12:00:00'",
        "event_id,clock",
    ).to_frame()


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice < -1000000000")
def query_where_nothing(spark, folder):
    """No row matches: an empty result with the asked columns."""
    return on.orders(spark, folder).query(
        "o_totalprice < -1000000000", ["o_orderkey", "o_orderstatus"]
    ).to_frame(parse_dtypes=True)


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM (
         SELECT *, row_number() OVER (
           ORDER BY l_shipdate DESC, l_extendedprice, l_orderkey, l_linenumber, l_partkey,
                    l_suppkey, l_quantity, l_discount, l_tax) AS place FROM lineitem)
       WHERE place > 1000 AND place <= 13500"""
)
def query_deep_window(spark, folder):
    """A window too deep for a top-k, found by counting; ties broken by the whole row."""
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
             "l_quantity", "l_discount", "l_tax"]
    keys = [SortKey(F.col("l_shipdate"), True), *map(F.col, order)]
    return take_window(on.table(spark, folder, "lineitem"), keys, 1000, 12500).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


_TEXT_KEY = """CASE o_orderkey % 5 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN '0' || o_orderkey
    WHEN 2 THEN o_orderkey || 'e0' WHEN 3 THEN ' ' || o_orderkey || '.0' ELSE o_orderkey || '.5' END"""


@query(
    f"""SELECT 'updates' AS kind, o_orderkey + 1 AS objectid, {_TEXT_KEY} AS o_orderkey
        FROM orders WHERE o_orderkey % 5 <> 4
        UNION ALL SELECT 'adds', NULL, {_TEXT_KEY} FROM orders WHERE o_orderkey % 5 = 4
        UNION ALL SELECT 'deletes', o_orderkey + 1, o_orderkey::VARCHAR FROM orders
        WHERE o_orderkey % 5 = 4"""
)
def diff_text_keys(spark, folder):
    """Keys sent as text to a whole-number field: equal numbers match however they are written,
    and a fraction is nobody's key."""
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    form = F.array(
        text, F.concat(F.lit("0"), text), F.concat(text, F.lit("e0")),
        F.concat(F.lit(" "), text, F.lit(".0")), F.concat(text, F.lit(".5")),
    )
    feed = on.table(spark, folder, "orders").select(
        F.get(form, (key % 5).cast("int")).alias("o_orderkey"), "o_totalprice"
    )
    adds, updates, deletes = on.orders(spark, folder).diff(feed, ["o_orderkey"])
    parts = [
        updates.select(F.lit("updates").alias("kind"), "objectid", "o_orderkey"),
        adds.select(F.lit("adds").alias("kind"), F.lit(None).cast("bigint").alias("objectid"), "o_orderkey"),
        deletes.select(F.lit("deletes").alias("kind"), "objectid", F.col("o_orderkey").cast("string")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- stored layers ----------------------------------------------------------------


def _stored(spark: SparkSession, rows: DataFrame, key: str) -> LayerStore:
    """A new store of these rows in the shared folder."""
    store = LayerStore(spark, f"{shared_folder(spark)}/lamina/store-{uuid.uuid4().hex}")
    store.create(rows, key)
    return store


def _stored_orders(spark: SparkSession, folder: str) -> Layer:
    rows = on.orders_renumbered(spark, folder).rows
    return Layer(None, on.ORDERS, store=_stored(spark, rows, "objectid"))


@query(SQL["sync_snapshot"])
def store_sync(spark, folder):
    """A sync committed to a store, and read back from it."""
    layer = _stored_orders(spark, folder)
    layer.sync(on.order_feed(spark, folder), ["o_orderkey"], apply_coded_values=True).release()
    return _natural(LayerStore.open(spark, layer.store.path).read())


@query(
    f"""SELECT kind, object_id, status FROM (
          SELECT 'updates' AS kind, objectid AS object_id, 'succeeded' AS status FROM {RENUMBERED}
          WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT 'deletes', objectid, 'succeeded' FROM {RENUMBERED}
          WHERE o_orderpriority = '5-LOW')"""
)
def store_results(spark, folder):
    """The result table that a commit leaves with its version."""
    layer = _stored_orders(spark, folder)
    rows = layer.rows
    layer.apply_edits(
        updates=rows.where("o_orderpriority = '1-URGENT'").select("objectid", "o_totalprice"),
        deletes=rows.where("o_orderpriority = '5-LOW'").select("objectid"),
    ).release()
    return layer.store.results().select("kind", "object_id", "status")


@query(
    f"""SELECT version, objectid, o_totalprice FROM (
          SELECT 0 AS version, objectid, o_totalprice FROM {RENUMBERED}
          UNION ALL SELECT 1, objectid, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END
          FROM {RENUMBERED}
          UNION ALL SELECT 2, objectid, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END
          FROM {RENUMBERED} WHERE o_orderstatus <> 'F')"""
)
def store_versions(spark, folder):
    """Every version of a store stays readable after the edits that followed it."""
    layer = _stored_orders(spark, folder)
    rows = layer.rows
    part = rows.where("o_orderstatus = 'P'").select("objectid", F.lit(0.0).alias("o_totalprice"))
    layer.apply_edits(updates=part).release()
    layer.apply_edits(deletes=rows.where("o_orderstatus = 'F'").select("objectid")).release()
    versions = [
        layer.store.read(v).select(F.lit(v).alias("version"), "objectid", "o_totalprice")
        for v in range(3)
    ]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


@query(
    f"""SELECT id, name, md5(content) AS digest FROM (
          SELECT conv_id * 1000 + turn AS id,
                 CASE WHEN role = 'assistant' THEN 'answer.json' ELSE name END AS name,
                 CASE WHEN role = 'assistant' THEN text || '!' ELSE text END AS content
          FROM conversations JOIN {ATTACHED} ON id = conv_id * 1000 + turn
          WHERE role <> 'system')"""
)
def store_attachments(spark, folder):
    """Files replaced and deleted in a stored attachment table; the others' bytes stay."""
    store = _stored(spark, on.attachment_rows(spark, folder), "id")
    layer = Layer(on.documents(spark, folder).rows, on.DOCUMENTS, attachment_store=store)
    layer.update_attachments(requests=_replacements(spark, folder)).release()
    gone = on.table(spark, folder, "conversations").where("role = 'system'").select(
        F.col("conv_id").alias("parentObjectId"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
    )
    layer.delete_attachments(pairs=gone).release()
    return store.read().select("id", "name", F.md5("content").alias("digest"))


@query(
    f"""SELECT parent AS "parentObjectId", 'doc-' || parent AS "parentGlobalId", new_id AS id
        FROM {_REQUESTED} WHERE parent IN (SELECT doc_id FROM documents)"""
)
def attach_add_parent_ids(spark, folder):
    """New files carry the global id of their feature."""
    layer = on.documents(spark, folder)
    rows = layer.rows.withColumn("globalid", F.concat(F.lit("doc-"), "doc_id"))
    with_ids = replace(on.DOCUMENTS, globalid_field="globalid")
    outcome = Layer(rows, with_ids, attachments=layer.attachments).add_attachments(
        requests=_page_requests(spark, folder)
    )
    return outcome.change.new.select("parentObjectId", "parentGlobalId", "id")
