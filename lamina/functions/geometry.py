"""Geometry columns without a geometry library.

A geometry is ``struct<type, coordinates, crs, bbox>``: the GeoJSON type, the
GeoJSON coordinates as JSON text (so one column can hold every type), the CRS
code, and the bounding box. The box is computed once, when the struct is made;
envelope filters and extents then read four numbers, which parquet can prune
and skip on, and never parse coordinates.
"""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.errors import InvalidParameterError
from lamina.functions.binding import bind

# Supported GeoJSON types, with how deep positions are nested.
NESTING = {
    "Point": 0,
    "MultiPoint": 1,
    "LineString": 1,
    "MultiLineString": 2,
    "Polygon": 2,
    "MultiPolygon": 3,
}
EARTH_RADIUS = 6378137.0

BBOX_TYPE = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")]
)
GEOMETRY_TYPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
        T.StructField("crs", T.IntegerType()),
        T.StructField("bbox", BBOX_TYPE),
    ]
)


def _of_depth(geom: Column, depth: int) -> Column:
    return geom["type"].isin([t for t, d in NESTING.items() if d == depth])


def _parsed(geom: Column, depth: int) -> Column:
    schema: T.DataType = T.ArrayType(T.DoubleType())
    for _ in range(depth):
        schema = T.ArrayType(schema)
    return F.from_json(geom["coordinates"], schema)


def positions(geom: Column) -> Column:
    """All positions of a geometry in one flat array; null for an unsupported type."""

    def flat(depth: int) -> Column:
        parsed = _parsed(geom, depth)
        if depth == 0:
            return F.array(parsed)
        for _ in range(depth - 1):
            parsed = F.flatten(parsed)
        return parsed

    return F.coalesce(*[F.when(_of_depth(geom, d), flat(d)) for d in range(4)])


def _box(flat: Column) -> Column:
    def of(xs: Column, ys: Column) -> Column:
        return F.struct(
            F.array_min(xs).alias("xmin"),
            F.array_min(ys).alias("ymin"),
            F.array_max(xs).alias("xmax"),
            F.array_max(ys).alias("ymax"),
        )

    def axis(i: int) -> Column:
        return F.transform(flat, lambda p: F.get(p, F.lit(i)))

    return F.when(F.size(flat) > 0, of(axis(0), axis(1)))


def make_geometry(kind: Column, coordinates: Column, crs: Column | int) -> Column:
    """Geometry struct from a GeoJSON type and its coordinates as JSON text."""
    crs = crs if isinstance(crs, Column) else F.lit(crs)
    raw = F.struct(
        kind.alias("type"), coordinates.alias("coordinates"), crs.cast("int").alias("crs")
    )

    def build(parts: Column) -> Column:
        return F.struct(
            parts["type"].alias("type"),
            parts["coordinates"].alias("coordinates"),
            parts["crs"].alias("crs"),
            bind(positions(parts), _box).alias("bbox"),
        )

    # a type without coordinates of its own is kept, to be refused when it is sent
    present = kind.isNotNull() & (coordinates.isNotNull() | ~kind.isin(list(NESTING)))
    return F.when(present, bind(raw, build))


def geometry_from_geojson(text: Column, crs: Column | int) -> Column:
    """Geometry struct from GeoJSON geometry text; null text or ``null`` gives null."""
    parsed = F.from_json(text, "type string, coordinates string")
    return bind(parsed, lambda p: make_geometry(p["type"], p["coordinates"], crs))


def point(x: Column, y: Column, crs: int) -> Column:
    """Point geometry from two numeric columns; null if either is."""
    x, y = x.cast("double"), y.cast("double")
    return F.when(
        x.isNotNull() & y.isNotNull(),
        F.struct(
            F.lit("Point").alias("type"),
            F.to_json(F.array(x, y)).alias("coordinates"),
            F.lit(crs).alias("crs"),
            F.struct(x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax")).alias(
                "bbox"
            ),
        ),
    )


def is_unsupported(geom: Column) -> Column:
    """A geometry is present but of a type that cannot be sent."""
    return geom.isNotNull() & ~F.coalesce(geom["type"].isin(list(NESTING)), F.lit(False))


def geometry_to_wire(geom: Column) -> Column:
    """Geometry as the JSON an edit sends: ``x``/``y``/``z``, ``points``, ``paths`` or ``rings``.

    A position keeps its third number only if it has exactly three. Null, and any
    unsupported type (see :func:`is_unsupported`), gives null.
    """

    def trimmed(parsed: Column, depth: int) -> Column:
        if depth == 0:
            return F.when(F.size(parsed) == 3, parsed).otherwise(F.slice(parsed, 1, 2))
        return F.transform(parsed, lambda part: trimmed(part, depth - 1))

    def wire(geom: Column, has_z: Column) -> Column:
        def shape(key: str, parts: Column) -> Column:
            flag = F.when(has_z, F.lit(True))
            return F.to_json(F.struct(parts.alias(key), flag.alias("hasZ")))

        at, one, two, three = (_parsed(geom, d) for d in range(4))
        kind = geom["type"]
        axes = [F.get(at, F.lit(i)).alias(n) for i, n in enumerate(("x", "y", "z"))]
        return (
            F.when(kind == "Point", F.to_json(F.struct(*axes)))
            .when(kind == "MultiPoint", shape("points", trimmed(one, 1)))
            .when(kind == "LineString", shape("paths", F.array(trimmed(one, 1))))
            .when(kind == "MultiLineString", shape("paths", trimmed(two, 2)))
            .when(kind == "Polygon", shape("rings", trimmed(two, 2)))
            .when(kind == "MultiPolygon", shape("rings", F.flatten(trimmed(three, 3))))
        )

    has_z = F.exists(positions(geom), lambda p: F.size(p) == 3)
    return F.when(
        geom.isNotNull() & ~is_unsupported(geom), bind(has_z, lambda z: wire(geom, z))
    )


Change = Callable[[Column], Column]


def map_positions(geom: Column, change: Change, crs: Column | None = None) -> Column:
    """Apply ``change`` to every position and rebuild the struct, box included."""

    def nested(parsed: Column, depth: int) -> Column:
        if depth == 0:
            return change(parsed)
        return F.transform(parsed, lambda part: nested(part, depth - 1))

    text = F.coalesce(
        *[F.when(_of_depth(geom, d), F.to_json(nested(_parsed(geom, d), d))) for d in range(4)]
    )
    crs = geom["crs"] if crs is None else crs
    return F.when(
        geom.isNotNull(), bind(text, lambda changed: make_geometry(geom["type"], changed, crs))
    )


def rounded(digits: int) -> Change:
    return lambda p: F.transform(p, lambda v: F.round(v, digits))


def without_z(p: Column) -> Column:
    return F.slice(p, 1, 2)


def _to_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    north = F.log(F.tan(F.lit(math.pi / 4) + F.radians(y) / 2))
    return F.radians(x) * EARTH_RADIUS, north * EARTH_RADIUS


def _to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    north = F.lit(2.0) * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(math.pi / 2)
    return F.degrees(x / EARTH_RADIUS), F.degrees(north)


_PROJECTIONS = {(4326, 3857): _to_mercator, (3857, 4326): _to_degrees}


def projection(source: int, target: int) -> Change | None:
    """Position change between 4326 and 3857; None for the same CRS, others raise."""
    if source == target:
        return None
    project = _PROJECTIONS.get((source, target))
    if project is None:
        raise InvalidParameterError(
            f"Cannot reproject from {source} to {target}; only 4326 and 3857 are supported."
        )

    def move(p: Column) -> Column:
        x, y = project(F.get(p, F.lit(0)), F.get(p, F.lit(1)))
        return F.concat(F.array(x, y), F.slice(p, 3, 1))

    return move


def reshape(
    geom: Column,
    source: int,
    target: int,
    *,
    keep_z: bool = True,
    digits: int | None = None,
) -> Column:
    """Reproject, drop Z and round in a single pass over the positions."""
    changes = [
        projection(source, target),
        None if keep_z else without_z,
        None if digits is None else rounded(digits),
    ]
    changes = [c for c in changes if c is not None]
    if not changes:
        return geom

    def change(p: Column) -> Column:
        for step in changes:
            p = bind(p, step)
        return p

    return map_positions(geom, change, F.lit(target))


def parse_envelope(envelope: str | list | tuple, source: int, target: int) -> tuple[float, ...]:
    """``"xmin,ymin,xmax,ymax"`` as numbers in the layer's CRS (driver side)."""
    parts = envelope.split(",") if isinstance(envelope, str) else list(envelope)
    if len(parts) != 4:
        raise InvalidParameterError("An envelope needs xmin, ymin, xmax and ymax.")
    xmin, ymin, xmax, ymax = (float(p) for p in parts)
    if source == target:
        return xmin, ymin, xmax, ymax
    if (source, target) == (4326, 3857):
        def move(x: float, y: float) -> tuple[float, float]:
            north = math.log(math.tan(math.pi / 4 + math.radians(y) / 2))
            return math.radians(x) * EARTH_RADIUS, north * EARTH_RADIUS
    elif (source, target) == (3857, 4326):
        def move(x: float, y: float) -> tuple[float, float]:
            north = 2 * math.atan(math.exp(y / EARTH_RADIUS)) - math.pi / 2
            return math.degrees(x / EARTH_RADIUS), math.degrees(north)
    else:
        raise InvalidParameterError(f"Cannot read an envelope in {source} for CRS {target}.")
    return (*move(xmin, ymin), *move(xmax, ymax))


def intersects_envelope(geom: Column, box: tuple[float, ...]) -> Column:
    """The geometry's bounding box touches the envelope; null geometry never does."""
    xmin, ymin, xmax, ymax = box
    own = geom["bbox"]
    return (
        (own["xmin"] <= xmax) & (own["xmax"] >= xmin) & (own["ymin"] <= ymax) & (own["ymax"] >= ymin)
    )
