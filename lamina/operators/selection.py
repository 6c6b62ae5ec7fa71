"""Rows by their place in an order, without sorting the table.

The rows that stand at the two ends of a window are found by counting: a sample of the order's
columns gives probes near the wanted rank, one pass counts the rows below each, and the search
goes on between two probes, a few hundred times narrower, until so few rows are left that they
can be looked at. The window is then a filter between two rows, and only what it keeps is sorted.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A window that ends within this many rows is a top-k, of which each task keeps that many rows;
# the search for a rank ends in a range of that many.
MAX_TOP_ROWS = 4_000
# Rows of a sample, and which of them, counted from the expected place, are probes. The place
# of a rank in a sample of n is off by about the root of n.
SAMPLE_ROWS = 4_000
PROBES = (-96, -64, -48, -32, -24, -16, -8, 0, 8, 16, 24, 32, 48, 64, 96)


@dataclass(frozen=True)
class SortKey:
    """One column of an order; nulls come first, or last in a descending one."""

    column: Column
    descending: bool = False

    @property
    def ordering(self) -> Column:
        return self.column.desc() if self.descending else self.column.asc()


def sort_keys(order: list[Column | SortKey]) -> list[SortKey]:
    """A plain column counts as ascending."""
    return [k if isinstance(k, SortKey) else SortKey(k) for k in order]


def orderings(order: list[Column | SortKey]) -> list[Column]:
    return [k.ordering for k in sort_keys(order)]


def take_window(
    df: DataFrame, order: list[Column | SortKey], offset: int, count: int | None
) -> DataFrame:
    """Rows ``[offset, offset + count)`` of the ordered rows, in that order.

    End the order with a unique column: of rows that are alike in all of it any may be taken.
    """
    keys = sort_keys(order)
    by = [k.ordering for k in keys]
    if count is not None and offset + count <= MAX_TOP_ROWS:
        return df.orderBy(*by).offset(offset).limit(count)
    line = Line(df, keys)
    ranks = [*([offset] if offset else []), *([] if count is None else [offset + count])]
    if not ranks:
        return df.orderBy(*by)
    edges = line.rows_at(ranks)
    start = edges[0] if offset else None
    stop = None if count is None else edges[-1]
    if offset and start is None:
        return df.limit(0)
    if start and stop and line.alike(start, stop):
        return df.where(line.same(start)).limit(stop.before - start.before)
    inside = F.lit(True)
    if start:
        inside = line.after(start) if start.before else line.at_or_after(start)
    if stop:
        inside = inside & line.before(stop)
    parts = df.where(inside)
    if start and start.before:
        alike = df.where(line.same(start))
        parts = parts.unionByName(alike.limit(alike.count() - start.before))
    if stop and stop.before:
        parts = parts.unionByName(df.where(line.same(stop)).limit(stop.before))
    return parts.orderBy(*by)


@dataclass(frozen=True)
class Edge:
    """The order's columns of the row at a rank, and how many rows like it come before it."""

    values: tuple
    before: int = 0


@dataclass
class _Search:
    """One rank, the rows it must be between, and how many lie below and in that range."""

    rank: int
    below: int
    left: int
    low: tuple | None = None
    high: tuple | None = None
    found: Edge | None = None


class Line:
    """The rows of a table in an order, seen through the order's columns alone."""

    def __init__(self, df: DataFrame, keys: list[SortKey]):
        self.keys = keys
        self.narrow = df.select(*[k.column.alias(f"_k{i}") for i, k in enumerate(keys)])
        self.types = [f.dataType for f in self.narrow.schema]
        self.own = [SortKey(F.col(f"_k{i}"), k.descending) for i, k in enumerate(keys)]

    # ---- comparing rows with given values ---------------------------------

    def _literal(self, i: int, value: Any) -> Column:
        kind = self.types[i]
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit(value))
        if isinstance(value, (dt.datetime, dt.time)):
            return F.lit(str(value)).cast(kind)
        return F.lit(value).cast(kind)

    def _past(self, keys: list[SortKey], values: tuple, least: bool) -> Column:
        """Whether a row comes after the values, or with ``least`` is like them."""
        out = F.lit(least)
        for i in reversed(range(len(keys))):
            c, v = keys[i].column, values[i]
            if v is None:
                beyond = F.lit(False) if keys[i].descending else c.isNotNull()
                out = beyond | (c.isNull() & out)
                continue
            v = self._literal(i, v)
            beyond = (c < v) | c.isNull() if keys[i].descending else c > v
            out = F.coalesce(beyond, F.lit(False)) | (c.eqNullSafe(v) & out)
        return out

    def _bounded(self, values: tuple, least: bool) -> Column:
        """The same over the table's own columns, with a bound on the first that a scan can use."""
        past, first, v = self._past(self.keys, values, least), self.keys[0], values[0]
        if v is None:
            return past
        v = self._literal(0, v)
        near = (first.column <= v) | first.column.isNull() if first.descending else first.column >= v
        return near & past

    def after(self, edge: Edge) -> Column:
        return self._bounded(edge.values, False)

    def at_or_after(self, edge: Edge) -> Column:
        return self._bounded(edge.values, True)

    def before(self, edge: Edge) -> Column:
        past, first, v = self._past(self.keys, edge.values, True), self.keys[0], edge.values[0]
        if v is None:
            return ~past
        v = self._literal(0, v)
        near = first.column >= v if first.descending else (first.column <= v) | first.column.isNull()
        return near & ~past

    def same(self, edge: Edge) -> Column:
        out = F.lit(True)
        for i, (key, v) in enumerate(zip(self.keys, edge.values)):
            same = key.column.isNull() if v is None else key.column.eqNullSafe(self._literal(i, v))
            out = out & same
        return out

    @staticmethod
    def alike(a: Edge, b: Edge) -> bool:
        return repr(a.values) == repr(b.values)

    # ---- finding rows -----------------------------------------------------

    def _collect(self, rows: DataFrame, most: int) -> list[tuple]:
        """At most ``most`` rows in order; timestamps as microseconds, which are exact."""
        shown = [
            F.unix_micros(f"_k{i}") if isinstance(t, T.TimestampType) else F.col(f"_k{i}")
            for i, t in enumerate(self.types)
        ]
        ordered = rows.orderBy(*[k.ordering for k in self.own]).limit(most)
        return [tuple(r) for r in ordered.select(*shown).collect()]

    def _range(self, search: _Search) -> DataFrame:
        rows = self.narrow
        if search.low is not None:
            rows = rows.where(self._past(self.own, search.low, False))
        if search.high is not None:
            rows = rows.where(~self._past(self.own, search.high, True))
        return rows

    def rows_at(self, ranks: list[int]) -> list[Edge | None]:
        """The row at each rank; None beyond the last one."""
        total = self.narrow.count()
        searches = [_Search(r, 0, total) for r in ranks]
        open_ = [s for s in searches if s.rank < total]
        while open_:
            probes = {}
            for s in open_:
                if s.left <= MAX_TOP_ROWS:
                    s.found = self._look(s)
                else:
                    probes[id(s)] = self._probes(s)
            open_ = [s for s in open_ if s.found is None]
            if open_:
                self._narrow(open_, [probes[id(s)] for s in open_])
            open_ = [s for s in open_ if s.found is None]
        return [s.found for s in searches]

    def _look(self, s: _Search) -> Edge:
        """The row itself, from a range small enough to be read."""
        rows = self._collect(self._range(s), s.rank - s.below + 1)
        last = repr(rows[-1])
        return Edge(rows[-1], sum(repr(r) == last for r in rows) - 1)

    def _probes(self, s: _Search) -> list[tuple]:
        """Values of rows near the rank, from a sample of its range."""
        fraction = min(1.0, SAMPLE_ROWS / s.left)
        rows: list[tuple] = []
        while not rows:  # a sample of thousands is hardly ever empty
            rows = self._collect(self._range(s).sample(fraction), 2 * SAMPLE_ROWS)
        place = int((s.rank - s.below) * fraction)
        at = sorted({min(max(place + p, 0), len(rows) - 1) for p in PROBES})
        distinct = {repr(rows[i]): rows[i] for i in at}
        return list(distinct.values())

    def _narrow(self, searches: list[_Search], probes: list[list[tuple]]) -> None:
        """One pass over the narrow columns: rows before each probe and up to it."""
        columns = []
        for n, values in enumerate(probes):
            for i, v in enumerate(values):
                for name, least in (("lt", True), ("le", False)):
                    below = F.when(self._past(self.own, v, least), 0).otherwise(1)
                    columns.append(F.sum(below).alias(f"{name}_{n}_{i}"))
        counts = self.narrow.agg(*columns).first()
        for n, (s, values) in enumerate(zip(searches, probes)):
            upto = s.below + s.left
            for i, v in enumerate(values):
                lt, le = counts[f"lt_{n}_{i}"], counts[f"le_{n}_{i}"]
                if lt <= s.rank < le:
                    s.found = Edge(v, s.rank - lt)
                elif le <= s.rank and le >= s.below:
                    s.low, s.below = v, le
                elif lt > s.rank and lt < upto:
                    s.high, upto = v, lt
            s.left = upto - s.below
