"""One normal form for keys: a sent value as the layer's type, and whether nothing of it is lost.

A key is typed, written back and compared. Texts are compared as decimals, so ``"01"``, ``"1.0"`` and
``"1e0"`` are the whole number 1 and ``"0.5"`` is none; numbers as their own type, so
a whole number a double cannot hold, or 1.5 for an integer field, is nobody's key; dates as
microseconds, of which a service keeps milliseconds. A value that loses something is a key of no row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.coerce import NUMBER, outbound, stored
from lamina.plans.contract import DATE_TYPE

#: Wide enough for every 64-bit whole number; what it cannot hold exactly is told by its text.
DECIMAL = "decimal(38,18)"
_BEYOND = r"\.\d{18}\d*[1-9]"  # a digit past the eighteenth of a fraction
_EXPONENT = r"[eE]"


def exact_decimal(text: Column) -> Column:
    """The number a text spells, or null where a decimal of 18 places would change it."""
    digits = F.length(F.regexp_replace(F.regexp_replace(text, r"[eE].*$", ""), r"[^0-9]", ""))
    number = F.when(text.rlike(NUMBER), F.trim(text).try_cast(DECIMAL))
    kept = F.when(text.rlike(_EXPONENT), digits <= 18).otherwise(~text.rlike(_BEYOND))
    # a tiny number is rounded to 0, which its double is not
    alike = number.cast("double") == F.trim(text).try_cast("double")
    return F.when(kept & alike, number)


def normal_key(
    field_def: dict, c: Column, dtype: T.DataType, target: T.DataType
) -> tuple[Column, Column]:
    """A sent key as the layer's column type, and whether it is not null and lost something."""
    key = stored(field_def, outbound({**field_def, "length": None}, c, dtype), target)
    is_text = isinstance(dtype, T.StringType)
    if isinstance(target, T.IntegralType) and is_text and field_def.get("type") != DATE_TYPE:
        number = exact_decimal(c)
        key = F.when(number == number.cast("decimal(20,0)"), number.try_cast(target))
        return key, c.isNotNull() & key.isNull()
    lost = key.isNull()
    if field_def.get("type") == DATE_TYPE:
        lost = lost | _parts_of_a_millisecond(c, dtype)
    elif is_text and isinstance(target, T.FractionalType):
        lost = lost | F.coalesce(exact_decimal(c) != exact_decimal(key.cast("string")), F.lit(False))
    elif isinstance(dtype, T.NumericType) and isinstance(target, (T.IntegralType, T.DoubleType)):
        back = key.try_cast(dtype)
        lost = lost | back.isNull() | (back != c)
    return key, c.isNotNull() & lost


def _parts_of_a_millisecond(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.FractionalType):
        return c != F.floor(c)
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    elif isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(c)
    elif isinstance(dtype, T.StringType):
        micros = F.unix_micros(c.try_cast("timestamp"))
    else:
        return F.lit(False)
    return F.coalesce(F.pmod(micros, F.lit(1000)) != 0, F.lit(False))
