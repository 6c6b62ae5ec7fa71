"""Edit, attachment and error responses as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.batches import KINDS
from lamina.operators.results import ERROR_TYPE, NO_OBJECT_ID, snake_case

# Response lists per kind, and the keys an error value may have.
_RESULT_LISTS = {"adds": "addResults", "updates": "updateResults", "deletes": "deleteResults"}
_ITEM = "struct<objectId:bigint,globalId:string,success:boolean,error:map<string,string>>"

# Error classes by code, and what an envelope without a key means.
ERROR_CLASSES = {
    498: "TokenExpiredError",
    499: "TokenMissingError",
    403: "AuthorizationError",
    404: "NotFoundError",
}
OTHER_ERROR_CLASS = "ServiceError"
MISSING_CODE = -1
MISSING_MESSAGE = "Unknown error"

# Failures by whether the request can have reached the server.
NOT_SENT = ("ConnectError", "ConnectTimeout", "PoolTimeout")
MAY_HAVE_ARRIVED = (
    "TransportError", "TimeoutException", "ReadTimeout", "WriteTimeout", "NetworkError",
    "ReadError", "WriteError", "CloseError", "ProtocolError", "LocalProtocolError",
    "RemoteProtocolError", "ProxyError", "UnsupportedProtocol", "ValueError",
    "JSONDecodeError", "UnicodeDecodeError", "KeyError", "TimeoutError",
)


def error_of(entries: Column) -> Column:
    """Error value from its entries as text; those without a column go to ``extra``, named in
    snake case. Only a list is parsed again, for its items."""
    own = [f for f in ERROR_TYPE if f.name != "extra"]
    parts = []
    for f in own:
        text = entries[f.name]
        listed = isinstance(f.dataType, T.ArrayType)
        value = F.from_json(text, f.dataType) if listed else text.try_cast(f.dataType)
        parts.append(value.alias(f.name))
    rest = F.map_filter(entries, lambda k, _: ~k.isin([f.name for f in own]))
    extra = F.when(F.size(rest) > 0, F.transform_keys(rest, lambda k, _: snake_case(k)))
    return F.when(entries.isNotNull(), F.struct(*parts, extra.alias("extra"))).cast(ERROR_TYPE)


def parse_error(text: Column) -> Column:
    """Error value from its JSON text."""
    return error_of(F.from_json(text, "map<string,string>"))


def parse_edit_responses(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Result items of every response, in one pass: a missing list counts as empty.

    ``keep`` names columns that identify the response; ``item`` is the item's place
    in its list.
    """
    schema = ", ".join(f"{name} array<{_ITEM}>" for name in _RESULT_LISTS.values())
    parsed = responses.select(*keep, F.from_json(F.col("body"), schema).alias("_body"))

    def tagged(kind: str) -> Column:
        listed = F.coalesce(F.col("_body")[_RESULT_LISTS[kind]], F.lit([]).cast(f"array<{_ITEM}>"))
        return F.transform(
            listed,
            lambda r, i: F.struct(
                F.lit(kind).alias("kind"), i.cast("bigint").alias("item"), r.alias("r")
            ),
        )

    rows = parsed.select(*keep, F.explode(F.concat(*[tagged(k) for k in KINDS])).alias("_e"))
    r = F.col("_e.r")
    return rows.select(
        *keep,
        F.col("_e.kind").alias("kind"),
        F.col("_e.item").alias("item"),
        F.coalesce(r["objectId"], F.lit(NO_OBJECT_ID).cast("bigint")).alias("object_id"),
        r["globalId"].alias("global_id"),
        F.coalesce(r["success"], F.lit(False)).alias("success"),
        error_of(r["error"]).alias("error"),
    )


def parse_attachment_groups(
    responses: DataFrame, properties: list[str], *, count_only: bool = False
) -> DataFrame:
    """One row per attachment with its parent's ids, or one per parent with its count.

    A parent whose list is empty gives no attachment rows.
    """
    integers = {"id", "size"}
    infos = ", ".join(f"{p}:{'bigint' if p in integers else 'string'}" for p in properties)
    group = (
        f"struct<parentObjectId:bigint,parentGlobalId:string,count:bigint,"
        f"attachmentInfos:array<struct<{infos}>>>"
    )
    body = F.from_json(F.col("body"), f"attachmentGroups array<{group}>")
    groups = responses.select(F.explode(body["attachmentGroups"]).alias("g"))
    parents = [F.col("g.parentObjectId"), F.col("g.parentGlobalId")]
    if count_only:
        return groups.select(*parents, F.col("g.count").alias("count"))
    rows = groups.select(*parents, F.explode("g.attachmentInfos").alias("i"))
    return rows.select("parentObjectId", "parentGlobalId", "i.*")


def error_class(code: Column) -> Column:
    found = F.create_map(*[F.lit(x) for pair in ERROR_CLASSES.items() for x in pair])
    return F.coalesce(found[code.cast("int")], F.lit(OTHER_ERROR_CLASS))


def triage_errors(responses: DataFrame) -> DataFrame:
    """Error envelopes among logged responses, classified; other rows stay with nulls."""
    error = F.from_json(
        F.col("body"), "error struct<code:bigint,message:string,details:array<string>>"
    )["error"]
    found = error.isNotNull()
    code = F.coalesce(error["code"], F.lit(MISSING_CODE))
    return responses.withColumns(
        {
            "error_class": F.when(found, error_class(code)),
            "error_code": F.when(found, code),
            "error_message": F.when(found, F.coalesce(error["message"], F.lit(MISSING_MESSAGE))),
            "error_details": F.when(
                found, F.coalesce(error["details"], F.lit([]).cast(T.ArrayType(T.StringType())))
            ),
        }
    )


def outcome_unknown(status_code: Column, exception: Column) -> Column:
    """Whether a failed request may have been applied all the same.

    A status of 500 or more: yes; a lower one: no. Without a status, a failure to
    connect means no, and any other transport, parse, key or timeout failure yes.
    """
    return (
        F.when(status_code.isNotNull(), status_code >= 500)
        .when(exception.isin(list(NOT_SENT)), F.lit(False))
        .otherwise(F.coalesce(exception.isin(list(MAY_HAVE_ARRIVED)), F.lit(False)))
    )
