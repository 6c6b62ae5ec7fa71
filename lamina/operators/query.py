"""Layer queries: one lazy plan per query."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.errors import InvalidParameterError, MissingGeometryError
from lamina.functions import geometry as geo
from lamina.functions.coerce import enforce_types
from lamina.functions.domains import recode_domains
from lamina.operators.numbering import POSITION, number_rows
from lamina.operators.selection import SortKey, orderings, take_window
from lamina.operators.sizes import fits
from lamina.operators.skew import join_spread
from lamina.plans.contract import DATE_TYPE, GEOMETRY_COLUMN, FieldSet, LayerContract
from lamina.plans.literals import bind_time_literals, check_date_literals
from lamina.session import Staging

# Ids given as a Python list: compared inline, or joined as a broadcast table.
MAX_INLINE_IDS = 500
MAX_BROADCAST_IDS = 1_000_000

# Query options by what they do to a query.
_OPTIONS = {
    "orderByFields", "resultOffset", "resultRecordCount", "objectIds", "geometry",
    "geometryType", "spatialRel", "inSR", "time", "timeField", "returnCountOnly",
    "returnIdsOnly", "returnUniqueIdsOnly", "returnExtentOnly", "returnDistinctValues",
    "outStatistics", "groupByFieldsForStatistics", "havingClause", "geometryPrecision",
    "returnZ", "returnEnvelope",
}
_TRANSPORT_ONLY = {"f", "resultType", "resultPaginationToken", "returnExceededLimitFeatures"}
_STATISTICS = {
    "count": F.count,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "stddev": F.stddev,
    "var": F.variance,
}


@dataclass(frozen=True)
class QueryResult:
    """Rows of a query, still lazy, with the definitions of their fields."""

    df: DataFrame
    fields: FieldSet
    crs: int | None = None
    apply_coded_values: bool = False

    def to_frame(self, *, parse_dtypes: bool = False) -> DataFrame:
        """Attributes only. With ``parse_dtypes`` columns get their contract types."""
        return self._typed(self.df.drop(GEOMETRY_COLUMN), parse_dtypes)

    def to_geodataframe(self, *, parse_dtypes: bool = False) -> DataFrame:
        """Attributes and geometry; the geometry column's metadata holds the CRS."""
        if GEOMETRY_COLUMN not in self.df.columns:
            raise MissingGeometryError("The query returned no geometry: set return_geometry.")
        if not self.crs:
            raise MissingGeometryError("The query result has no CRS: set out_sr.")
        typed = self._typed(self.df, parse_dtypes)
        return typed.withMetadata(GEOMETRY_COLUMN, {"crs": self.crs})

    def _typed(self, df: DataFrame, parse_dtypes: bool) -> DataFrame:
        # types come first, because domain codes only match typed values
        decode = self.apply_coded_values and bool(self.fields.domain_maps)
        if parse_dtypes or decode:
            df, _ = enforce_types(df, self.fields)
        if decode:
            df, _ = recode_domains(df, self.fields, observe=False)
        return df


@dataclass
class QueryPlan:
    """Checked arguments of one query over a layer's rows."""

    rows: DataFrame
    contract: LayerContract
    where: str = "1=1"
    out_fields: list[str] | str | None = None
    return_geometry: bool = True
    out_sr: int | None = None
    apply_coded_values: bool = False
    options: dict[str, Any] = field(default_factory=dict)
    _staging: Staging | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        unknown = sorted(self.options.keys() - _OPTIONS - _TRANSPORT_ONLY)
        if unknown:
            raise InvalidParameterError(f"Unsupported query options: {', '.join(unknown)}.")
        self.names = self.contract.resolve_out_fields(self.out_fields)
        check_date_literals(self.where, self.contract.fields)

    # ---- filters ---------------------------------------------------------

    def matching(self) -> DataFrame:
        """All rows the filters keep, every layer column still present.

        ``where`` may be any Spark SQL condition, so it must come from a trusted caller.
        """
        where = bind_time_literals(self.where, self.contract.fields, self.rows.schema)
        df = self.rows.where(where)
        if self.options.get("objectIds") is not None:
            df = keep_ids(df, self.contract.objectid_field, self.options["objectIds"])
        if self.options.get("geometry") is not None:
            df = self._within_envelope(df)
        if self.options.get("time") is not None:
            df = df.where(self._time_condition(df))
        return df

    def _within_envelope(self, df: DataFrame) -> DataFrame:
        kind = self.options.get("geometryType", "esriGeometryEnvelope")
        relation = self.options.get("spatialRel", "esriSpatialRelIntersects")
        if kind != "esriGeometryEnvelope" or relation != "esriSpatialRelIntersects":
            raise InvalidParameterError("Only envelope-intersects filters are supported.")
        source = int(self.options.get("inSR") or self.contract.crs)
        box = geo.parse_envelope(self.options["geometry"], source, self.contract.crs)
        return df.where(geo.intersects_envelope(F.col(GEOMETRY_COLUMN), box))

    def _time_condition(self, df: DataFrame) -> Column:
        name = self.options.get("timeField")
        if name is None:
            dates = self.contract.fields.filter(types=DATE_TYPE).names
            if len(dates) != 1:
                raise InvalidParameterError("time needs timeField when date fields are not one.")
            name = dates[0]
        self.contract.check_names([name])
        return time_condition(F.col(f"`{name}`"), df.schema[name].dataType, self.options["time"])

    # ---- order and window -------------------------------------------------

    def order(self) -> list[SortKey]:
        """Caller's order, or the object id's; the object id always breaks ties."""
        keys = parse_order(self.options.get("orderByFields"), self.contract.check_names)
        return [*keys, SortKey(F.col(f"`{self.contract.objectid_field}`"))]

    def _window(self) -> tuple[int, int | None]:
        offset = int(self.options.get("resultOffset") or 0)
        count = self.options.get("resultRecordCount")
        return offset, None if count is None else int(count)

    # ---- output forms -----------------------------------------------------

    def run(self) -> QueryResult:
        o = self.options
        fields = self.contract.fields.filter(names=self.names)
        if o.get("returnCountOnly"):
            return QueryResult(self.count(), FieldSet())
        if o.get("returnIdsOnly") or o.get("returnUniqueIdsOnly"):
            return QueryResult(self.ids(), self.contract.fields.filter(
                names=[self.contract.objectid_field]))
        if o.get("returnExtentOnly"):
            return QueryResult(self.extent(), FieldSet(), self.out_sr or self.contract.crs)
        if o.get("outStatistics"):
            return QueryResult(self.statistics(), FieldSet())
        if o.get("returnDistinctValues"):
            return QueryResult(
                self.distinct(), fields, apply_coded_values=self.apply_coded_values
            )
        crs = (self.out_sr or self.contract.crs) if self.return_geometry else None
        return QueryResult(self.features(), fields, crs, self.apply_coded_values)

    def features(self) -> DataFrame:
        """Requested columns of the matching rows, ordered only if that can be seen."""
        df = self.matching()
        offset, count = self._window()
        geometry = self.return_geometry and GEOMETRY_COLUMN in df.columns
        wanted = [*self.names, *([GEOMETRY_COLUMN] if geometry else [])]
        if offset or count is not None:
            df = take_window(self._prune(df, wanted), self.order(), offset, count)
        elif self.options.get("orderByFields"):
            df = df.orderBy(*orderings(self.order()))
        out = df.select(*[F.col(f"`{n}`") for n in self.names])
        if geometry:
            out = df.select(
                *[F.col(f"`{n}`") for n in self.names],
                *self._shaped(F.col(GEOMETRY_COLUMN)),
            )
        return out

    def _prune(self, df: DataFrame, wanted: list[str]) -> DataFrame:
        """Only the columns the output or the order needs, before rows are moved."""
        ordered = order_names(self.options.get("orderByFields"))
        keep = {*wanted, *ordered, self.contract.objectid_field}
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep])

    def _shaped(self, geom: Column) -> list[Column]:
        target = self.out_sr or self.contract.crs
        digits = self.options.get("geometryPrecision")
        shaped = geo.reshape(
            geom,
            self.contract.crs,
            target,
            keep_z=self.options.get("returnZ") is not False,
            digits=None if digits is None else int(digits),
        )
        columns = [shaped.alias(GEOMETRY_COLUMN)]
        if self.options.get("returnEnvelope"):
            columns.append(shaped["bbox"].alias("envelope"))
        return columns

    def count(self) -> DataFrame:
        """One row; order, window and geometry options do not matter for a count."""
        return self.matching().agg(F.count(F.lit(1)).alias("count"))

    def ids(self) -> DataFrame:
        oid = self.contract.objectid_field
        ids = self.matching().select(F.col(f"`{oid}`"))
        if self.options.get("returnUniqueIdsOnly"):
            ids = ids.distinct()
        offset, count = self._window()
        if offset or count is not None:
            return take_window(ids, [F.col(f"`{oid}`")], offset, count)
        return ids

    def extent(self) -> DataFrame:
        """Box around all matching geometries, from the stored boxes alone."""
        box = F.col(f"{GEOMETRY_COLUMN}.bbox")
        total = self.matching().agg(
            F.min(box["xmin"]).alias("xmin"),
            F.min(box["ymin"]).alias("ymin"),
            F.max(box["xmax"]).alias("xmax"),
            F.max(box["ymax"]).alias("ymax"),
        )
        target = self.out_sr or self.contract.crs
        if target == self.contract.crs:
            return total
        corners = [
            geo.reshape(
                geo.point(F.col(x), F.col(y), self.contract.crs), self.contract.crs, target
            )
            for x, y in (("xmin", "ymin"), ("xmax", "ymax"))
        ]
        moved = total.select(*[c["bbox"].alias(n) for c, n in zip(corners, ("low", "high"))])
        return moved.select("low.xmin", "low.ymin", "high.xmax", "high.ymax")

    def distinct(self) -> DataFrame:
        names = [F.col(f"`{n}`") for n in self.names]
        out = self.matching().select(*names).distinct()
        order = parse_order(self.options.get("orderByFields"), self._check_selected)
        offset, count = self._window()
        if offset or count is not None:
            # distinct rows have no object id: the whole row breaks ties
            return take_window(out, [*order, *names], offset, count)
        return out.orderBy(*orderings(order)) if order else out

    def _check_selected(self, names: list[str]) -> None:
        missing = sorted(set(names) - set(self.names))
        if missing:
            raise InvalidParameterError(
                f"Distinct rows can only be ordered by selected fields, not {missing}."
            )

    def statistics(self) -> DataFrame:
        """Grouped statistics with an optional condition on the groups."""
        spec = self.options["outStatistics"]
        spec = json.loads(spec) if isinstance(spec, str) else spec
        groups = order_names(self.options.get("groupByFieldsForStatistics"))
        self.contract.check_names(groups)
        columns = [self._statistic(item) for item in spec]
        grouped = self.matching().groupBy(*[F.col(f"`{g}`") for g in groups])
        having = self.options.get("havingClause")
        if not having:
            return grouped.agg(*columns)
        try:  # a condition on aggregates, such as COUNT(*) > 5
            return grouped.agg(*columns, F.expr(having).alias("_having")).where(
                "_having"
            ).drop("_having")
        except AnalysisException:  # a condition on the output names
            return grouped.agg(*columns).where(having)

    def _statistic(self, item: dict) -> Column:
        kind, name = item["statisticType"].lower(), item["onStatisticField"]
        if kind not in _STATISTICS:
            raise InvalidParameterError(
                f"Unknown statistic '{kind}'. Expected one of: {', '.join(_STATISTICS)}."
            )
        self.contract.check_names([name])
        out = item.get("outStatisticFieldName") or f"{kind}_{name}"
        return _STATISTICS[kind](F.col(f"`{name}`")).alias(out)

    @property
    def staging(self) -> Staging:
        """Holds the written rows of :meth:`pages`; release it once those have been read."""
        if self._staging is None:
            self._staging = Staging(self.rows.sparkSession)
        return self._staging

    def release(self) -> None:
        """Delete what :meth:`pages` wrote. Whatever still reads it must have run."""
        self.staging.release()

    def pages(self, page_size: int | None = None) -> DataFrame:
        """The whole ordered result with ``position`` and ``page_id`` columns. The numbered rows
        are written once, and stay until :meth:`release`."""
        limit = self.contract.max_record_count
        size = min(page_size or limit, limit) or limit
        wanted = list(self.names)
        if self.return_geometry and GEOMETRY_COLUMN in self.rows.columns:
            wanted.append(GEOMETRY_COLUMN)
        rows = self._prune(self.matching(), wanted)
        numbered = number_rows(rows, orderings(self.order()), self.staging)
        page_id = F.floor(F.col(POSITION) / size).cast("bigint")
        return numbered.select(
            *[F.col(f"`{n}`") for n in wanted], F.col(POSITION), page_id.alias("page_id")
        )


def order_names(order_by: str | list[str] | None) -> list[str]:
    if not order_by:
        return []
    items = order_by.split(",") if isinstance(order_by, str) else order_by
    return [item.split()[0] for item in items]


def parse_order(order_by: str | list[str] | None, check: Any) -> list[SortKey]:
    """``"name [ASC|DESC], ..."`` as sort keys; ``check`` sees the names."""
    if not order_by:
        return []
    items = order_by.split(",") if isinstance(order_by, str) else order_by
    keys = []
    for item in items:
        name, *direction = item.split()
        check([name])
        word = " ".join(direction).upper() or "ASC"
        if word not in ("ASC", "DESC"):
            raise InvalidParameterError(f"Cannot order by '{item.strip()}'.")
        keys.append(SortKey(F.col(f"`{name}`"), word == "DESC"))
    return keys


def keep_ids(df: DataFrame, column: str, ids: Any, row_id: Column | None = None) -> DataFrame:
    """Rows whose ``column`` is among ``ids``: comma text, a list, or a DataFrame.

    With ``row_id`` many rows may have one id: those are spread where the ids are too many
    to be broadcast.
    """
    c = F.col(f"`{column}`")
    dtype = df.schema[column].dataType
    if not isinstance(ids, DataFrame):
        values = ids.split(",") if isinstance(ids, str) else list(ids)
        values = [int(v) if isinstance(dtype, T.IntegralType) else str(v).strip() for v in values]
        if len(values) <= MAX_INLINE_IDS:
            return df.where(c.isin(values))
        table = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType(
            [T.StructField("_wanted", dtype)]))
        if len(values) <= MAX_BROADCAST_IDS and fits(len(values), sum(map(_width, values))):
            return df.join(F.broadcast(table), c == F.col("_wanted"), "left_semi")
        table = table.distinct()
    else:
        source = column if column in ids.columns else ids.columns[0]
        table = ids.select(F.col(f"`{source}`").cast(dtype).alias("_wanted")).distinct()
    if row_id is not None:
        table = table.where(F.col("_wanted").isNotNull())
        return join_spread(df, table, [(column, "_wanted")], "left_semi", row_id)
    return df.join(table, c == F.col("_wanted"), "left_semi")


def _width(value: Any) -> int:
    return len(value.encode()) if isinstance(value, str) else 8


def time_condition(c: Column, dtype: T.DataType, time: Any) -> Column:
    """Instant or ``start,end`` in epoch milliseconds; ``null`` leaves an end open.

    The bounds are folded to the column's own type, so the scan can skip on them.
    """
    parts = time.split(",") if isinstance(time, str) else (
        list(time) if isinstance(time, (list, tuple)) else [time])
    bounds = [None if p is None or str(p).strip().lower() == "null" else int(p) for p in parts]
    if not 1 <= len(bounds) <= 2:
        raise InvalidParameterError("time is an instant or a start,end pair.")

    def literal(ms: int) -> Column:
        if isinstance(dtype, T.LongType):
            return F.lit(ms)
        return F.timestamp_millis(F.lit(ms)).cast(dtype)

    if len(bounds) == 1:
        return c == literal(bounds[0]) if bounds[0] is not None else F.lit(True)
    low, high = bounds
    condition = F.lit(True)
    if low is not None:
        condition = condition & (c >= literal(low))
    if high is not None:
        condition = condition & (c <= literal(high))
    return condition
