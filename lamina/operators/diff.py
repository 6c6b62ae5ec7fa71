"""Key comparison of an incoming table with a layer: adds, updates, deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.errors import InvalidParameterError
from lamina.functions.domains import mapped
from lamina.functions.keys import normal_key
from lamina.operators.sizes import is_small
from lamina.operators.skew import join_spread
from lamina.plans.contract import GUID_TYPES, LayerContract

MAX_EXAMPLES = 5
MATCHED_OID = "_matched_oid"
IS_MATCHED = "_is_matched"


def check_key_names(df: DataFrame, key_fields: list[str]) -> None:
    if not key_fields:
        raise InvalidParameterError("At least one key field is needed; key_fields is empty.")
    missing = [k for k in key_fields if k not in df.columns]
    if missing:
        raise InvalidParameterError(
            "Key columns not present in the input: "
            f"{', '.join(repr(m) for m in missing)}."
        )


def duplicate_keys(df: DataFrame, key_fields: list[str]) -> DataFrame:
    """Keys that more than one input row has, with their row counts.

    The count is combined before the shuffle, so a key held by most rows costs
    no more than any other.
    """
    keys = [F.col(f"`{k}`") for k in key_fields]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def repeated_keys(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool = False,
) -> DataFrame:
    """Keys that more than one input row has once they are coded and typed as the layer's,
    with their row counts; a key the layer cannot hold counts as it was sent."""
    columns, unfit = input_keys(df, layer, contract, key_fields, apply_coded_values)
    if unfit is not None:
        sent = F.to_json(F.struct(*[F.col(f"`{k}`") for k in key_fields]))
        columns = {**columns, "_unfit": F.when(unfit, sent)}
    return duplicate_keys(df.select(*[c.alias(n) for n, c in columns.items()]), list(columns))


def check_unique_keys(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool = False,
) -> None:
    """Raise, with at most five examples, unless the keys identify the input rows."""
    check_key_names(df, key_fields)
    repeated = repeated_keys(df, layer, contract, key_fields, apply_coded_values)
    examples = repeated.limit(MAX_EXAMPLES).collect()
    if examples:
        shown = [tuple(row[_key_name(k)] for k in key_fields) for row in examples]
        raise InvalidParameterError(
            f"Several input rows share a key of {key_fields!r}. "
            f"Duplicate key examples: {shown}"
        )


def _key_name(k: str) -> str:
    return f"_key_{k}"


def input_keys(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool,
) -> tuple[dict[str, Column], Column | None]:
    """Key expressions over the input, in the layer's own column types.

    Names become codes and dates the stored type, so a decoded key finds its row. The
    second value says which rows have a key that the layer's type cannot hold, which no
    layer row has, null or not; it is None where no conversion can fail.
    """
    columns, failures = {}, []
    for k in key_fields:
        c, dtype, target = F.col(f"`{k}`"), df.schema[k].dataType, layer.schema[k].dataType
        field_def = contract.fields.get(k)
        domain = contract.fields.domain_maps.get(k)
        if apply_coded_values and domain is not None and isinstance(dtype, T.StringType):
            c = F.coalesce(mapped(c, dtype, domain.to_code), c)
        if dtype == target and field_def.get("type") not in GUID_TYPES:
            columns[_key_name(k)] = c
            continue
        columns[_key_name(k)], lost = normal_key(field_def, c, dtype, target)
        failures.append(lost)
    return columns, (reduce(lambda a, b: a | b, failures) if failures else None)


def _same_keys(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in map(_key_name, names)]
    )


def layer_keys(layer: DataFrame, contract: LayerContract, key_fields: list[str]) -> DataFrame:
    """Object id and key columns of every layer row; nothing else is read."""
    return layer.select(
        F.col(f"`{contract.objectid_field}`").alias(MATCHED_OID),
        *[F.col(f"`{k}`").alias(_key_name(k)) for k in key_fields],
    )


def match_input(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool = False,
    *,
    small_input: bool = False,
) -> DataFrame:
    """The input with the object id its key has in the layer.

    A key that several layer rows share belongs to the largest object id; reducing
    the layer to one row per key first keeps the join one-to-one and unskewed. With
    ``small_input``, for an input whose keys were measured, the layer is first cut to
    those keys where it is read, and never shuffled as a whole.
    """
    columns, unfit = input_keys(df, layer, contract, key_fields, apply_coded_values)
    keyed = (df if unfit is None else df.where(~unfit)).withColumns(columns)
    names = [_key_name(k) for k in key_fields]
    rows = layer_keys(layer, contract, key_fields)
    if small_input:
        wanted = keyed.select(*names)
        rows = rows.join(F.broadcast(wanted), _same_keys(rows, wanted, key_fields), "left_semi")
    owners = (
        rows.groupBy(*names)
        .agg(F.max(MATCHED_OID).alias(MATCHED_OID))
        .withColumn(IS_MATCHED, F.lit(True))
    )
    joined = keyed.join(owners, _same_keys(keyed, owners, key_fields), "left")
    matched = joined.select(
        *[keyed[f"`{c}`"] for c in df.columns],
        owners[MATCHED_OID],
        F.coalesce(owners[IS_MATCHED], F.lit(False)).alias(IS_MATCHED),
    )
    if unfit is None:
        return matched
    oid_type = matched.schema[MATCHED_OID].dataType
    return matched.unionByName(
        df.where(unfit).withColumns(
            {MATCHED_OID: F.lit(None).cast(oid_type), IS_MATCHED: F.lit(False)}
        )
    )


def adds_of(matched: DataFrame) -> DataFrame:
    return matched.where(~F.col(IS_MATCHED)).drop(MATCHED_OID, IS_MATCHED)


def updates_of(matched: DataFrame, objectid_field: str) -> DataFrame:
    """Matched input rows; the matched object id replaces any the input had."""
    return (
        matched.where(F.col(IS_MATCHED))
        .withColumn(objectid_field, F.col(MATCHED_OID))
        .drop(*{MATCHED_OID, IS_MATCHED} - {objectid_field})
    )


def deletes_of(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool = False,
    *,
    small_input: bool = False,
) -> DataFrame:
    """Layer rows whose key the input lacks: the object id, then the key fields.

    A ``small_input`` is broadcast to where the layer is read. Otherwise both sides are
    shuffled, and layer rows that crowd under one key are spread.
    """
    columns, unfit = input_keys(df, layer, contract, key_fields, apply_coded_values)
    fit = df if unfit is None else df.where(~unfit)
    keys = fit.select(*[c.alias(f"_in{n}") for n, c in columns.items()])
    rows = layer_keys(layer, contract, key_fields)
    pairs = [(_key_name(k), f"_in{_key_name(k)}") for k in key_fields]
    if small_input:
        same = reduce(lambda a, b: a & b, [rows[x].eqNullSafe(keys[y]) for x, y in pairs])
        gone = rows.join(F.broadcast(keys), same, "left_anti")
    else:
        gone = join_spread(rows, keys, pairs, "left_anti", F.col(MATCHED_OID))
    oid = contract.objectid_field
    return gone.select(
        F.col(MATCHED_OID).alias(oid),
        *[F.col(_key_name(k)).alias(k) for k in key_fields if k != oid],
    )


def diff(
    df: DataFrame,
    layer: DataFrame,
    contract: LayerContract,
    key_fields: list[str],
    apply_coded_values: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Adds, updates and deletes that turn the layer's keys into the input's."""
    check_key_names(df, key_fields)
    contract.check_names(key_fields)
    check_unique_keys(df, layer, contract, key_fields, apply_coded_values)
    args = (layer, contract, key_fields, apply_coded_values)
    small = is_small(df, key_fields)
    matched = match_input(df, *args, small_input=small)
    return (
        adds_of(matched),
        updates_of(matched, contract.objectid_field),
        deletes_of(df, *args, small_input=small),
    )
