"""Typing of attribute columns in both directions, as column expressions.

``from_esri`` types what a service sends (epoch milliseconds become timestamps);
``to_esri`` produces the values an edit sends. A value that cannot be converted
becomes null and is counted in a :class:`CoercionReport`; nothing is raised, and
no extra pass over the data is made to count.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.plans.contract import (
    DATE_TYPE,
    FIELD_TYPES,
    FLOAT_TYPES,
    GUID_TYPES,
    INTEGER_TYPES,
    TEXT_TYPES,
    FieldSet,
)

log = logging.getLogger(__name__)

MAX_EXAMPLES = 5
# Timestamps are microseconds in a long.
MAX_MILLIS = (2**63 - 1) // 1000
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_FLOATING = (T.FloatType, T.DoubleType)


def _parsed_double(c: Column) -> Column:
    """Text to double; Spark also reads ``'12d'`` and ``'1f'``, which are not numbers here."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_integer(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """Whole number, fraction cut toward zero; null if unparseable or out of range."""
    if isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL, T.BooleanType)):
        return c.try_cast(target)
    text = c.cast("string")
    # whole numbers are parsed as such: beyond 2^53 they must not pass through double
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast(target)).when(
        text.rlike(NUMBER), text.try_cast("double").try_cast(target)
    )


def to_float(c: Column, dtype: T.DataType) -> Column:
    """Double; null if unparseable or NaN."""
    if isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL, T.BooleanType)):
        value = c.cast("double")
    else:
        text = c.cast("string")
        value = F.coalesce(
            _parsed_double(text),
            F.when(text.rlike(_INFINITY), F.trim(text).try_cast("double")),
        )
    return F.when(~F.isnan(value), value)


def _in_range(millis: Column) -> Column:
    """Milliseconds a timestamp can hold; null for others, which would fail the job."""
    return F.when(millis.between(-MAX_MILLIS, MAX_MILLIS), millis)


def to_epoch_ms(c: Column, dtype: T.DataType) -> Column:
    """UTC epoch milliseconds. Zone-less values are read as UTC; whole numbers
    are taken as milliseconds already."""
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
        # floored in whole numbers: doubles are too coarse for late dates
        return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(dtype, T.DateType):
        return F.unix_millis(c.cast("timestamp"))
    if isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL)):
        return _in_range(c.try_cast("bigint"))
    return F.unix_millis(c.cast("string").try_cast("timestamp"))


def from_epoch_ms(c: Column, dtype: T.DataType) -> Column:
    """Timestamp of a stored or received date value."""
    if isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL)):
        return F.timestamp_millis(_in_range(c.try_cast("bigint")))
    if isinstance(dtype, T.StringType):
        whole = F.timestamp_millis(_in_range(c.try_cast("bigint")))
        return F.when(c.rlike(_WHOLE_NUMBER), whole).otherwise(c.try_cast("timestamp"))
    return c.cast("timestamp")


def truncate_utf8(text: Column, limit: int) -> Column:
    """At most ``limit`` bytes of UTF-8; a character that straddles the limit is dropped.

    A UTF-8 character has at most four bytes, so one of the four longest byte
    prefixes ends between characters.
    """
    raw = text.cast("binary")
    prefixes = [
        F.try_validate_utf8(F.substring(raw, 1, limit - cut).cast("string"))
        for cut in range(min(4, limit + 1))
    ]
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.coalesce(*prefixes))


def to_text(c: Column, dtype: T.DataType, limit: int | None = None) -> Column:
    text = c if isinstance(dtype, T.StringType) else c.cast("string")
    return text if limit is None else truncate_utf8(text, limit)


def to_guid(c: Column) -> Column:
    """Upper case, with both braces added unless the text starts with one."""
    text = F.upper(c.cast("string"))
    return F.when(text.startswith("{"), text).otherwise(F.concat(F.lit("{"), text, F.lit("}")))


def inbound(field_def: dict, c: Column, dtype: T.DataType) -> Column:
    """Received value as the field's Spark type."""
    kind = field_def.get("type")
    if kind in INTEGER_TYPES:
        return to_integer(c, dtype, FIELD_TYPES[kind])
    if kind in FLOAT_TYPES:
        return to_float(c, dtype).cast(FIELD_TYPES[kind])
    if kind == DATE_TYPE:
        return from_epoch_ms(c, dtype)
    if kind in GUID_TYPES | TEXT_TYPES:
        return to_text(c, dtype)
    return c


def outbound(field_def: dict, c: Column, dtype: T.DataType) -> Column:
    """Value an edit sends for the field."""
    kind = field_def.get("type")
    if kind in INTEGER_TYPES:
        return to_integer(c, dtype, FIELD_TYPES[kind])
    if kind in FLOAT_TYPES:
        return to_float(c, dtype)
    if kind == DATE_TYPE:
        return to_epoch_ms(c, dtype)
    if kind in GUID_TYPES:
        return to_guid(c)
    if kind == "esriFieldTypeString":
        return to_text(c, dtype, field_def.get("length"))
    if kind in TEXT_TYPES:
        return to_text(c, dtype)
    return c


def stored(field_def: dict, sent: Column, dtype: T.DataType) -> Column:
    """Sent value as the type the layer's column has."""
    if field_def.get("type") == DATE_TYPE and isinstance(
        dtype, (T.TimestampType, T.TimestampNTZType)
    ):
        return F.timestamp_millis(_in_range(sent)).cast(dtype)
    return sent.try_cast(dtype)


def mixed_columns(counts: dict[str, int]) -> list[str]:
    """Columns in which some values had a domain entry and some had not."""
    mapped, others = (
        {key.removesuffix(end) for key in counts if key.endswith(end) and counts[key]}
        for end in (":mapped", ":unmapped")
    )
    return sorted(mapped & others)


@dataclass
class CoercionReport:
    """What a coercion changed. ``counts()`` has values once an action on the
    coerced DataFrame has run; ``examples`` starts a small job of its own."""

    source: DataFrame
    checks: dict[str, Column] = field(default_factory=dict)
    columns: dict[str, str] = field(default_factory=dict)
    observation: Observation | None = None

    def counts(self) -> dict[str, int]:
        """Affected values per ``column:problem``, zeros left out. A column of which only some
        values have a domain entry is warned of: it now mixes names and codes."""
        if self.observation is None:
            return {}
        counts = {k: v for k, v in self.observation.get.items() if v}
        for name in mixed_columns(counts):
            log.warning(
                "%s mixes names and codes: %d of its values have no domain entry.",
                name, counts[f"{name}:unmapped"],
            )
        return counts

    def frame(self) -> DataFrame:
        """The counts as one lazy row, for when no other action is going to run."""
        return self.source.agg(*[F.count_if(c).alias(name) for name, c in self.checks.items()])

    def examples(self, check: str) -> list:
        """At most five distinct values a check counted."""
        rows = (
            self.source.where(self.checks[check])
            .select(self.columns[check])
            .distinct()
            .limit(MAX_EXAMPLES)
            .collect()
        )
        return [row[0] for row in rows]

    def observe(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        self.observation = Observation()
        return df.observe(
            self.observation, *[F.count_if(c).alias(name) for name, c in self.checks.items()]
        )

    def add(self, column: str, problem: str, condition: Column) -> None:
        name = f"{column}:{problem}"
        self.checks[name], self.columns[name] = condition, column


def outbound_checks(report: CoercionReport, field_def: dict, c: Column, dtype: T.DataType) -> None:
    """Register what can go wrong when ``field_def`` is sent."""
    name, kind = field_def["name"], field_def.get("type")
    sent = outbound(field_def, c, dtype)
    present = c.isNotNull()
    if isinstance(dtype, _FLOATING):
        present = present & ~F.isnan(c)
    if kind in INTEGER_TYPES | FLOAT_TYPES | {DATE_TYPE}:
        report.add(name, "failed", present & sent.isNull())
    if kind in INTEGER_TYPES and not isinstance(dtype, (*_INTEGRAL, T.BooleanType)):
        number = to_float(c, dtype)
        report.add(name, "fractional", present & (number != F.rint(number)))
    if kind == DATE_TYPE:
        if isinstance(dtype, T.TimestampNTZType):
            report.add(name, "naive", present)
        elif isinstance(dtype, T.StringType):
            zoned = c.rlike(r"(?i)(z|utc|[+-]\d{2}(:?\d{2})?)\s*$") & c.contains(":")
            report.add(name, "naive", sent.isNotNull() & ~zoned)
    if kind == "esriFieldTypeString" and field_def.get("length") is not None:
        text = c.cast("string")
        report.add(name, "truncated", F.octet_length(text) > field_def["length"])


def enforce_types(
    df: DataFrame, fields: FieldSet, *, direction: str = "from_esri"
) -> tuple[DataFrame, CoercionReport]:
    """Type every column that is a known field; other columns are left alone."""
    convert = inbound if direction == "from_esri" else outbound
    dtypes = {f.name: f.dataType for f in df.schema}
    report, columns = CoercionReport(df), {}
    for field_def in fields:
        name = field_def["name"]
        if name not in dtypes:
            continue
        c = F.col(f"`{name}`")
        columns[name] = convert(field_def, c, dtypes[name])
        if direction == "to_esri":
            outbound_checks(report, field_def, c, dtypes[name])
    observed = report.observe(df)
    return (observed.withColumns(columns) if columns else observed), report
