"""Coded-value domains: codes to names and back."""

from __future__ import annotations

from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.coerce import CoercionReport, mixed_columns  # noqa: F401
from lamina.plans.contract import FieldSet

# A lookup this small is a literal map inside the expression; a longer one is a
# table of its own, broadcast only while its known length is moderate.
MAX_LITERAL_ENTRIES = 200
MAX_BROADCAST_ENTRIES = 200_000


def _usable(code: Any, dtype: T.DataType) -> bool:
    """Whether a code can equal a value of the column: text with text, number with number."""
    return isinstance(code, str) == isinstance(dtype, T.StringType)


NUMBERS = (T.FloatType, T.DoubleType, T.DecimalType)


def _entries(lookup: dict, dtype: T.DataType) -> list[tuple]:
    """Lookup as pairs of a key and a text; the key is a number where the column may have
    fractions, because a number has several texts, and its text otherwise."""
    if isinstance(dtype, T.StringType):
        return [(k, str(v)) for k, v in lookup.items() if isinstance(k, str)]
    numeric = [(k, v) for k, v in lookup.items() if _usable(k, dtype)]
    if isinstance(dtype, T.DecimalType):
        return [(Decimal(str(k)), str(v)) for k, v in numeric if _holds(dtype, k)]
    if isinstance(dtype, NUMBERS):
        return [(float(k), str(v)) for k, v in numeric]
    return [(str(int(k)), str(v)) for k, v in numeric if float(k).is_integer()]


def _holds(dtype: T.DecimalType, code: Any) -> bool:
    """Whether a code is one of the values a decimal column can have."""
    number = Decimal(str(code))
    whole, places = dtype.precision - dtype.scale, Decimal(1).scaleb(-dtype.scale)
    return number.is_finite() and abs(number) < 10**whole and number % places == 0


def _key_type(dtype: T.DataType) -> str:
    """Type codes are compared in: a decimal column's own, else double or text."""
    if isinstance(dtype, T.DecimalType):
        return dtype.simpleString()
    return "double" if isinstance(dtype, NUMBERS) else "string"


def _lookup_key(c: Column, dtype: T.DataType) -> Column:
    return c.cast(_key_type(dtype))


def mapped(c: Column, dtype: T.DataType, lookup: dict) -> Column:
    """The looked-up text, or null where the domain has no entry."""
    entries = _entries(lookup, dtype)
    if not entries:
        return F.lit(None).cast("string")
    kind = _key_type(dtype)
    literal = F.create_map(*[part for k, v in entries for part in (F.lit(k).cast(kind), F.lit(v))])
    return literal[_lookup_key(c, dtype)]


def recode_domains(
    df: DataFrame, fields: FieldSet, *, direction: str = "from_esri", observe: bool = True
) -> tuple[DataFrame, CoercionReport]:
    """Replace codes by names (``from_esri``) or names by codes (``to_esri``).

    Values without an entry pass through and null stays null. A recoded column is
    text, because one Spark column cannot hold both names and numeric codes.
    ``observe=False`` leaves the counting out, so filters can move through.
    """
    direction_key = "to_name" if direction == "from_esri" else "to_code"
    dtypes = {f.name: f.dataType for f in df.schema}
    report, recoded, looked_up, out = CoercionReport(df), {}, [], df
    for name, domain in fields.domain_maps.items():
        if name not in dtypes:
            continue
        c, dtype, lookup = F.col(f"`{name}`"), dtypes[name], domain[direction_key]
        if direction == "to_esri" and not isinstance(dtype, T.StringType):
            continue  # values that are not text cannot be names: they stay codes
        if len(lookup) > MAX_LITERAL_ENTRIES:
            looked_up.append(f"_entry{len(looked_up)}")
            out = _with_entry(out, c, dtype, lookup, looked_up[-1])
            found = F.col(looked_up[-1])
        else:
            found = mapped(c, dtype, lookup)
        recoded[name] = F.coalesce(found, c.cast("string"))
        report.add(name, "mapped", found.isNotNull())
        report.add(name, "unmapped", c.isNotNull() & found.isNull())
    if observe:
        out = report.observe(out)
    if recoded:
        out = out.withColumns(recoded)
    return out.drop(*looked_up), report


def _with_entry(df: DataFrame, c: Column, dtype: T.DataType, lookup: dict, entry: str) -> DataFrame:
    """``df`` with the looked-up text as column ``entry``, null where there is none."""
    entries = _entries(lookup, dtype)
    table = df.sparkSession.createDataFrame(
        entries, f"_key {_key_type(dtype)}, {entry} string"
    )
    if len(entries) <= MAX_BROADCAST_ENTRIES:
        table = F.broadcast(table)
    return df.join(table, _lookup_key(c, dtype) == F.col("_key"), "left").drop("_key")
