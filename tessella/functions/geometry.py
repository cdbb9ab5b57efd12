"""Polygons as columns: an array of rings, each an array of struct(x, y) whose last point joins the first; rings after the first are holes.

What sums over vertices is a higher-order expression in the JVM; hulls and rectangles are Arrow-batched functions, and ``overlay`` has those that
cut polygons by each other.
Rows: a null polygon gives null; a polygon without rings, or a ring of fewer than three points, has no area, holds no point and has an empty text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = "struct<x:double,y:double>"
RING, POLYGON = f"array<{POINT}>", f"array<array<{POINT}>>"
_NUMBERS = lambda *names: T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _sides(ring: Column) -> Column:
    """The sides of a ring, as an array of struct(a, b)."""
    n = F.size(ring)
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i <= n), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i % n + 1).alias("b")))


def inside(x: Column, y: Column, polygon: Column) -> Column:
    """Whether a point is strictly inside: even-odd over all rings, and on no side of any of them."""

    def crosses(s: Column) -> Column:
        a, b = s["a"], s["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"]))

    def touches(s: Column) -> Column:
        a, b = s["a"], s["b"]
        on = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return on & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    sides = F.flatten(F.transform(polygon, _sides))
    odd = F.aggregate(sides, F.lit(False), lambda s, side: s != F.coalesce(crosses(side), F.lit(False)))
    return odd & ~F.exists(sides, touches)


def _ring_sums(ring: Column) -> Column:
    """struct(a, p, x, y): twice the signed area, the perimeter, and the sums of the centroid."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("a", "p", "x", "y")])

    def add(s: Column, side: Column) -> Column:
        a, b = side["a"], side["b"]
        cross = a["x"] * b["y"] - b["x"] * a["y"]
        length = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        return F.struct((s["a"] + cross).alias("a"), (s["p"] + length).alias("p"), (s["x"] + (a["x"] + b["x"]) * cross).alias("x"), (s["y"] + (a["y"] + b["y"]) * cross).alias("y"))

    return F.aggregate(_sides(ring), zero, add)


def measures(polygon: Column) -> Column:
    """struct(area, length, cx, cy, minx, miny, maxx, maxy); holes are taken off the area and add to the length."""
    # each ring's sums once: as its own array, in which an outer ring counts for and a hole against
    sums = F.transform(polygon, lambda r, i: F.struct(_ring_sums(r).alias("s"), F.when(i == 0, 1.0).otherwise(-1.0).alias("w")))
    turned = F.transform(sums, lambda t: F.struct((t["w"] * F.signum(t["s"]["a"])).alias("w"), t["s"].alias("s")))
    total = lambda f: F.aggregate(turned, F.lit(0.0), lambda z, t: z + f(t))
    area = total(lambda t: t["w"] * t["s"]["a"])
    outer = F.get(polygon, 0)
    bound = lambda f, c: f(F.transform(outer, lambda p: p[c]))
    return F.struct(
        (area / 2).alias("area"), total(lambda t: t["s"]["p"]).alias("length"), F.try_divide(total(lambda t: t["w"] * t["s"]["x"]), 3 * area).alias("cx"), F.try_divide(total(lambda t: t["w"] * t["s"]["y"]), 3 * area).alias("cy"),
        bound(F.array_min, "x").alias("minx"), bound(F.array_min, "y").alias("miny"), bound(F.array_max, "x").alias("maxx"), bound(F.array_max, "y").alias("maxy"),
    )


def bounds(polygon: Column) -> dict[str, Column]:
    """minx, miny, maxx and maxy of all rings, as columns of their own."""
    points = F.flatten(polygon)
    return {name + c: f(F.transform(points, lambda p: p[c])) for name, f in (("min", F.array_min), ("max", F.array_max)) for c in ("x", "y")}


def area(polygon: Column) -> Column:
    """The area without holes."""
    ring = lambda r: F.abs(F.aggregate(_sides(r), F.lit(0.0), lambda z, s: z + s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])) / 2
    areas = F.transform(polygon, ring)
    return 2 * F.get(areas, 0) - F.aggregate(areas, F.lit(0.0), lambda z, a: z + a)


def moved(polygon: Column, a: float, b: float, tx: float, d: float, e: float, ty: float) -> Column:
    """The polygon under x' = a x + b y + tx, y' = d x + e y + ty."""
    return F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.struct((a * p["x"] + b * p["y"] + tx).alias("x"), (d * p["x"] + e * p["y"] + ty).alias("y"))))


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(corner(minx, miny), corner(maxx, miny), corner(maxx, maxy), corner(minx, maxy)))


def to_wkt(polygon: Column) -> Column:
    """The text of a polygon; every ring repeats its first point at the end."""
    point = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), point), ", "), F.lit(")"))
    return F.when(F.size(polygon) > 0, F.concat(F.lit("POLYGON ("), F.array_join(F.transform(polygon, ring), ", "), F.lit(")"))).when(polygon.isNotNull(), "POLYGON EMPTY")


def from_wkt(text: Column) -> Column:
    """The polygon of a text; of a multipolygon the first part (``parts_of_wkt`` gives all); null for other kinds."""
    return F.get(parts_of_wkt(text), 0)


def parts_of_wkt(text: Column) -> Column:
    """The parts of a POLYGON or MULTIPOLYGON text, as an array of polygons."""
    number = lambda p, i: F.get(F.split(F.trim(p), r"\s+"), i).cast("double")
    point = lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y"))
    open_ring = lambda r: F.when((F.size(r) > 1) & (F.get(r, 0) == F.element_at(r, -1)), F.slice(r, 1, F.size(r) - 1)).otherwise(r)
    rings = lambda part: F.transform(F.regexp_extract_all(part, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda r: open_ring(F.transform(F.split(r, ","), point)))
    parts = F.regexp_extract_all(text, F.lit(r"\(\s*\([^()]+\)(?:\s*,\s*\([^()]+\))*\s*\)"), F.lit(0))
    return F.when(text.rlike(r"(?i)^\s*(MULTI)?POLYGON\b"), F.transform(parts, rings))


def hull(points: np.ndarray) -> np.ndarray:
    """The convex hull of points (n x 2), counter-clockwise, without points on its sides."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def half(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1]))


def ring_area(ring: np.ndarray) -> float:
    """Signed; positive if counter-clockwise."""
    if len(ring) < 3:
        return 0.0
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def shortest_over_longest(points: np.ndarray) -> float | None:
    """Side ratio, long to short, of the smallest rectangle around the points; null where they lie on a line."""
    h = hull(points)
    if len(h) < 3:
        return None
    side = np.roll(h, -1, 0) - h
    side = side / np.hypot(side[:, 0], side[:, 1])[:, None]
    along, across = h @ side.T, h @ np.stack([-side[:, 1], side[:, 0]], 1).T
    wide, tall = np.ptp(along, 0), np.ptp(across, 0)
    best = int(np.argmin(np.round(wide * tall, 9)))
    return float(max(wide[best], tall[best]) / min(wide[best], tall[best]))


def _array(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)


@F.pandas_udf(_NUMBERS("hull_area", "anisotropy"))
def hull_measures(outer: pd.Series) -> pd.DataFrame:
    """Area of the convex hull of a ring, and the side ratio of its smallest rectangle."""
    points = [None if r is None else _array(r) for r in outer]
    return pd.DataFrame({"hull_area": [None if p is None else abs(ring_area(hull(p))) for p in points], "anisotropy": [None if p is None else shortest_over_longest(p) for p in points]}).astype(float)


@F.pandas_udf(T.ArrayType(_NUMBERS("x", "y")))
def hull_ring(points: pd.Series) -> pd.Series:
    """The convex hull of an array of points."""
    return pd.Series([[{"x": x, "y": y} for x, y in hull(_array(p)).tolist()] for p in points])
