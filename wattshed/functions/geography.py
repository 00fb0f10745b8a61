"""Points, axis order, the national grid to longitude and latitude, and WKB.

The grid transform is a list of steps. Over a DataFrame each is a projection in
generated code; within a single column, where Spark has no projections, each is bound
to a lambda variable, which Spark interprets. WKB is walked in NumPy over whole
Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .steps import Get, Step, bound, staged
from .text import ColumnLike, col

# Fixed values, published by the national mapping agency: the Airy 1830 and
# WGS84 ellipsoids, the grid's projection, and the 7-parameter datum shift.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
WGS_A, WGS_B = 6378137.0, 6356752.314245
SCALE = 0.9996012717
LAT0, LON0 = math.radians(49.0), math.radians(-2.0)
E0, N0 = 400000.0, -100000.0
SHIFT_X, SHIFT_Y, SHIFT_Z = 446.448, -125.157, 542.060
SHIFT_PPM = -20.4894e-6
ROT_X, ROT_Y, ROT_Z = (math.radians(s / 3600) for s in (0.1502, 0.2470, 0.8421))

AIRY_E2 = 1 - (AIRY_B / AIRY_A) ** 2
WGS_E2 = 1 - (WGS_B / WGS_A) ** 2
AIRY_N = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
ARC = (
    1 + AIRY_N + 1.25 * AIRY_N**2 + 1.25 * AIRY_N**3,
    3 * AIRY_N + 3 * AIRY_N**2 + 2.625 * AIRY_N**3,
    1.875 * (AIRY_N**2 + AIRY_N**3),
    35 / 24 * AIRY_N**3,
)
ARC_STEPS = 5
LATITUDE_STEPS = 4


def point(x: ColumnLike, y: ColumnLike) -> Column:
    return F.struct(col(x).alias("x"), col(y).alias("y"))


def swap_axes(p: ColumnLike) -> Column:
    return F.struct(col(p)["y"].alias("x"), col(p)["x"].alias("y"))


def swap_ring_axes(ring: ColumnLike) -> Column:
    """The same swap for a ring of ``[x, y]`` pairs."""
    return F.transform(col(ring), lambda p: F.array(p[1], p[0]))


def _arc(lat: Column) -> Column:
    d, s = lat - LAT0, lat + LAT0
    a0, a1, a2, a3 = ARC
    return (AIRY_B * SCALE) * (
        a0 * d
        - a1 * F.sin(d) * F.cos(s)
        + a2 * F.sin(2 * d) * F.cos(2 * s)
        - a3 * F.sin(3 * d) * F.cos(3 * s)
    )


def _lat_shift(g: Get) -> Column:
    t2, eta2, u2 = g("t2"), g("eta2"), g("u") * g("u")
    return (g("t") * g("nu") / g("rho")) * u2 * (
        F.lit(0.5)
        - u2 / 24 * (5 + 3 * t2 + eta2 - 9 * t2 * eta2)
        + u2 * u2 / 720 * (61 + 90 * t2 + 45 * t2 * t2)
    )


def _lon_shift(g: Get) -> Column:
    t2, u = g("t2"), g("u")
    u2 = u * u
    return g("sec") * u * (
        1
        - u2 / 6 * (g("nu") / g("rho") + 2 * t2)
        + u2 * u2 / 120 * (5 + 28 * t2 + 24 * t2 * t2)
        - u2 * u2 * u2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
    )


_SCALED = AIRY_A * SCALE
_ROOT: Step = {"root": lambda g: 1 - AIRY_E2 * F.sin(g("lat")) * F.sin(g("lat"))}
#: Easting and northing (``e``, ``n``) to ``lat`` and ``lon`` in radians on the grid's own datum.
TO_AIRY: list[Step] = [
    {
        "de": lambda g: g("e").cast("double") - E0,
        "dn": lambda g: g("n").cast("double") - N0,
    },
    {"lat": lambda g: LAT0 + g("dn") / _SCALED},
    *[{"lat": lambda g: g("lat") + (g("dn") - _arc(g("lat"))) / _SCALED}] * ARC_STEPS,
    _ROOT,
    {
        "nu": lambda g: _SCALED / F.sqrt(g("root")),
        "rho": lambda g: _SCALED * (1 - AIRY_E2) / (g("root") * F.sqrt(g("root"))),
        "t": lambda g: F.tan(g("lat")),
        "sec": lambda g: 1 / F.cos(g("lat")),
    },
    {
        "t2": lambda g: g("t") * g("t"),
        "u": lambda g: g("de") / g("nu"),
        "eta2": lambda g: g("nu") / g("rho") - 1,
    },
    {"lat": lambda g: g("lat") - _lat_shift(g), "lon": lambda g: LON0 + _lon_shift(g)},
]
_K = 1 + SHIFT_PPM
#: These to ``x`` and ``y``, degrees of longitude and latitude of WGS84.
TO_DEGREES: list[Step] = [
    _ROOT,
    {"nu": lambda g: AIRY_A / F.sqrt(g("root"))},
    {
        "ax": lambda g: g("nu") * F.cos(g("lat")) * F.cos(g("lon")),
        "ay": lambda g: g("nu") * F.cos(g("lat")) * F.sin(g("lon")),
        "az": lambda g: g("nu") * (1 - AIRY_E2) * F.sin(g("lat")),
    },
    {
        "wx": lambda g: SHIFT_X + _K * g("ax") - ROT_Z * g("ay") + ROT_Y * g("az"),
        "wy": lambda g: SHIFT_Y + ROT_Z * g("ax") + _K * g("ay") - ROT_X * g("az"),
        "wz": lambda g: SHIFT_Z - ROT_Y * g("ax") + ROT_X * g("ay") + _K * g("az"),
    },
    {"p": lambda g: F.sqrt(g("wx") * g("wx") + g("wy") * g("wy"))},
    {"lat": lambda g: F.atan2(g("wz"), g("p") * (1 - WGS_E2))},
    *[
        {"sin": lambda g: F.sin(g("lat"))},
        {
            "lat": lambda g: F.atan2(
                g("wz") + WGS_E2 * WGS_A * g("sin") / F.sqrt(1 - WGS_E2 * g("sin") * g("sin")), g("p")
            )
        },
    ]
    * LATITUDE_STEPS,
    {"x": lambda g: F.degrees(F.atan2(g("wy"), g("wx"))), "y": lambda g: F.degrees(g("lat"))},
]


def grid_to_airy(easting: ColumnLike, northing: ColumnLike) -> Column:
    """A struct of ``lat`` and ``lon`` in radians on the grid's own datum."""
    pair = lambda r: F.struct(r["lat"].alias("lat"), r["lon"].alias("lon"))
    return bound({"e": col(easting), "n": col(northing)}, TO_AIRY, pair)


def grid_to_lonlat(
    df: DataFrame, easting: str, northing: str, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Add longitude and latitude in degrees of a point of the national grid, to about 5 m."""
    return staged(df, {"e": easting, "n": northing}, TO_AIRY + TO_DEGREES, {lon: "x", lat: "y"})


def grid_to_points(df: DataFrame, easting: str, northing: str, out: str) -> DataFrame:
    """Add the longitude-latitude point, a struct of ``x`` and ``y`` in that order."""
    placed = grid_to_lonlat(df, easting, northing, "_x", "_y")
    return placed.withColumn(out, point("_x", "_y")).drop("_x", "_y")


#: Type names by WKB type number.
# Fixed values of the well-known binary form.
WKB_TYPES = {
    1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon",
    7: "GeometryCollection",
}
_Z, _M, _SRID = 0x80000000, 0x40000000, 0x20000000
_LINE = T.ArrayType(T.ArrayType(T.DoubleType()))
SHAPE = T.StructType().add("type", T.StringType()).add("parts", T.ArrayType(T.ArrayType(_LINE)))


class _Bytes:
    """Reads numbers at many places of one buffer, each in its own byte order."""

    def __init__(self, data: np.ndarray):
        # Reading past the end gives zeros; the walk checks its places itself.
        self.data = np.concatenate([data, np.zeros(16, dtype=np.uint8)])

    def u32(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        raw = self.data[at[:, None] + np.arange(4)].astype(np.int64)
        low = raw @ (1 << np.array([0, 8, 16, 24]))
        high = raw @ (1 << np.array([24, 16, 8, 0]))
        return np.where(little, low, high)

    def doubles(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        raw = self.data[at[:, None] + np.arange(8)]
        raw = np.where(little[:, None], raw, raw[:, ::-1])
        return np.ascontiguousarray(raw).view("<f8").ravel()


def walk_wkb(column: pa.Array) -> pa.Array:
    """Structs (type, parts) of a binary column of WKB; see wkb_parts.

    All geometries are walked at once, one count or one ring of each at a time, so
    the steps taken in Python are as many as the longest geometry has rings.
    """
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    held = column.buffers()[2]
    read = _Bytes(np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8))
    given = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    at, end = offsets[:-1].copy(), offsets[1:]
    kind_of = np.zeros(n, dtype=np.int64)
    # Geometries still to be read, and rings still to be read of the one begun.
    parts_left, rings_left = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    parts_left[given] = 1
    kind, little, size = (np.zeros(n, dtype=t) for t in (np.int64, bool, np.int64))
    part = np.full(n, -1, dtype=np.int64)
    part_rows: list[np.ndarray] = []
    ring_rows: list[tuple] = []

    def need(rows: np.ndarray, many) -> None:
        if (at[rows] + many > end[rows]).any():
            raise ValueError("WKB ends too early")

    def rings(rows: np.ndarray, counted: np.ndarray) -> None:
        """Takes one run of points of each row; a point has no count before it."""
        need(rows, np.where(counted, 4, 0))
        points = np.where(counted, read.u32(at[rows], little[rows]), 1)
        at[rows] += np.where(counted, 4, 0)
        need(rows, points * size[rows])
        ring_rows.append((rows, part[rows], at[rows].copy(), points, little[rows], size[rows].copy()))
        at[rows] += points * size[rows]

    while True:
        inside = np.flatnonzero(rings_left > 0)
        if len(inside):
            rings(inside, np.ones(len(inside), dtype=bool))
            rings_left[inside] -= 1
        heads = np.flatnonzero((rings_left == 0) & (parts_left > 0))
        if not len(heads) and not len(inside):
            break
        if not len(heads):
            continue
        need(heads, 5)
        order = read.data[at[heads]]
        if (order > 1).any():
            raise ValueError("WKB byte order is neither 0 nor 1")
        little[heads] = order == 1
        code = read.u32(at[heads] + 1, little[heads])
        at[heads] += 5 + np.where(code & _SRID, 4, 0)
        plain = code & 0x0FFFFFFF
        kind[heads] = plain % 1000
        iso = plain // 1000
        size[heads] = 8 * (2 + ((code & _Z) > 0) + ((code & _M) > 0) + np.array([0, 1, 1, 2])[np.minimum(iso, 3)])
        if (iso > 3).any() or not np.isin(kind[heads], list(WKB_TYPES)).all():
            raise ValueError(f"unknown WKB type {int(code[(iso > 3) | ~np.isin(kind[heads], list(WKB_TYPES))][0])}")
        first = heads[kind_of[heads] == 0]
        kind_of[first] = kind[first]
        parts_left[heads] -= 1
        single = heads[kind[heads] <= 3]
        part[single] += 1
        part_rows.append(np.stack([single, part[single]]))
        counts = heads[kind[heads] >= 3]
        need(counts, 4)
        many = read.u32(at[counts], little[counts])
        at[counts] += 4
        rings_left[counts] = np.where(kind[counts] == 3, many, 0)
        parts_left[counts] += np.where(kind[counts] > 3, many, 0)
        rows = heads[kind[heads] <= 2]
        if len(rows):
            rings(rows, kind[rows] == 2)
    if (at[given] != end[given]).any():
        raise ValueError("WKB goes on behind its geometry")

    rows, parts, begin, points, order, width = (
        np.concatenate([r[i] for r in ring_rows]) if ring_rows else np.zeros(0, dtype=np.int64) for i in range(6)
    )
    by_place = np.lexsort((begin, rows))
    rows, parts, begin, points, order, width = (x[by_place] for x in (rows, parts, begin, points, order, width))
    edges = np.concatenate([[0], np.cumsum(points)])
    which = np.repeat(np.arange(len(points)), points)
    places = begin[which] + (np.arange(edges[-1]) - edges[which]) * width[which]
    x, y = (read.doubles(places + 8 * i, order[which].astype(bool)) for i in (0, 1))
    pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * 2), pa.array(np.stack([x, y], axis=1).ravel()))
    lines = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pairs)
    held_parts = np.concatenate(part_rows, axis=1) if part_rows else np.zeros((2, 0), dtype=np.int64)
    held_parts = held_parts[:, np.lexsort((held_parts[1], held_parts[0]))]
    code_of = lambda r, p: r * (int(part.max(initial=0)) + 2) + p
    starts = np.searchsorted(code_of(rows, parts), code_of(held_parts[0], held_parts[1]))
    in_parts = pa.ListArray.from_arrays(pa.array(np.append(starts, len(rows)).astype(np.int32)), lines)
    starts = np.searchsorted(held_parts[0], np.arange(n + 1)).astype(np.int32)
    nulls = pa.array(~column.is_valid().to_numpy(zero_copy_only=False))
    shape = pa.ListArray.from_arrays(pa.array(starts), in_parts)
    names = pa.array(["", *WKB_TYPES.values()])
    return pa.StructArray.from_arrays([names.take(pa.array(kind_of)), shape], ["type", "parts"], mask=nulls)


@F.arrow_udf(SHAPE)
def wkb_parts(wkb: pa.Array) -> pa.Array:
    """Type and coordinates of WKB of any type and byte order, with or without Z, M or SRID.

    ``parts`` are the simple geometries in it, each an array of rings or lines of
    ``[x, y]`` pairs: a point is one line of one pair. Geometries within
    collections count as parts of the whole. NULL stays NULL; bytes that are not WKB
    are an error. Spark reads WKB into a geometry but gives no access to its
    coordinates.
    """
    return walk_wkb(wkb)


def wkb_rings(wkb: ColumnLike) -> Column:
    """Rings of a WKB polygon or multipolygon, all parts together; other types are an error."""
    shape = wkb_parts(col(wkb))
    other = F.raise_error(F.concat(F.lit("not a polygon: "), shape["type"]))
    rings = F.flatten(shape["parts"])
    areas = shape["type"].isNull() | shape["type"].isin("Polygon", "MultiPolygon")
    return F.when(areas, rings).otherwise(other.cast("array<array<array<double>>>"))
