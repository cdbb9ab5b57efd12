"""Exact overlay of polygons with notches, holes and several parts, as Arrow functions over whole batches.

A polygon is an array of rings (see ``geometry``); what the rings enclose an odd number of times is inside, so a polygon of several parts
may come as all its rings in one array. The plane is cut into slabs at every vertex and every crossing of two sides: within
a slab no sides cross, so sorting them once along its middle line and counting tells which gaps belong to either polygon. Areas are sums of such
gaps, for all pairs of a batch at once over padded arrays; outlines are the borders of the gaps, joined at vertices that lie within
``CLOSE`` of the extent of each other.

Results are polygons in parts: an array of polygons, each with its outer ring counter-clockwise and its holes clockwise. Rows: a null gives
null; polygons without area, and parts that only touch, share none and give no parts; shared sides count for neither; rings may repeat points,
be closed by their first point or not, and cross themselves; vertices on a straight side are dropped from outlines.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, pi
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = "array<array<array<struct<x:double,y:double>>>>"
#: Coordinates this close, as a part of the extent, are one.
CLOSE = 1e-10
#: Cells of the padded arrays that are worked on together, and straight pieces of a quarter of a circle.
CELLS, QUARTER = 3_000_000, 8

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_PARTS = pa.list_(pa.list_(pa.list_(_POINT)))


class Sides(NamedTuple):
    """The directed sides of a batch of polygons: (x1, y1, x2, y2) of each, and where each polygon's begin."""

    xy: np.ndarray
    first: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.xy[self.first[i] : self.first[i + 1]]


def sides(polygons: pa.Array) -> Sides:
    """The sides of each row's rings, without a loop over rows; nulls have none."""
    rings = polygons.flatten()
    points = rings.flatten()
    x, y = (points.field(k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 1))
    sizes = np.nan_to_num(np.asarray(rings.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    ends = np.cumsum(sizes)
    following = np.arange(1, len(x) + 1)
    full = sizes > 0
    following[ends[full] - 1] = (ends - sizes)[full]  # the last point of a ring joins the first
    xy = np.stack([x, y, x[following], y[following]], 1) if len(x) else np.zeros((0, 4))
    counts = np.nan_to_num(np.asarray(polygons.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    of_ring = np.append(0, ends)
    return Sides(xy, of_ring[np.append(0, np.cumsum(counts))])


def _both(a: Sides, b: Sides, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, width, 4) sides of both polygons of each row, moved to the origin, and which polygon each belongs to; padding has no height."""
    out, layer = np.zeros((len(rows), width, 4)), np.zeros((len(rows), width), np.int8)
    for k, i in enumerate(rows.tolist()):
        one, two = a.of(i), b.of(i)
        n = len(one) + len(two)
        if n:
            out[k, :n] = np.concatenate([one, two])
            out[k, n:] = out[k, 0, [0, 1, 0, 1]]
            out[k] -= out[k, :, :2].min(0)[[0, 1, 0, 1]]
        layer[k, len(one) : n] = 1
    return out, layer


def _crossings(s: np.ndarray) -> np.ndarray:
    """Heights at which two sides of a row cross inside both, NaN elsewhere; s is (rows, width, 4)."""
    x, y, dx, dy = s[..., 0], s[..., 1], s[..., 2] - s[..., 0], s[..., 3] - s[..., 1]
    i, j = np.triu_indices(s.shape[1], 1)
    apart = (np.maximum(y[:, i], y[:, i] + dy[:, i]) <= np.minimum(y[:, j], y[:, j] + dy[:, j])) | (np.maximum(y[:, j], y[:, j] + dy[:, j]) <= np.minimum(y[:, i], y[:, i] + dy[:, i]))
    with np.errstate(divide="ignore", invalid="ignore"):
        d = dx[:, i] * dy[:, j] - dx[:, j] * dy[:, i]
        t = ((x[:, j] - x[:, i]) * dy[:, j] - (y[:, j] - y[:, i]) * dx[:, j]) / d
        u = ((x[:, j] - x[:, i]) * dy[:, i] - (y[:, j] - y[:, i]) * dx[:, i]) / d
        at = y[:, i] + t * dy[:, i]
    return np.where(~apart & (d != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1), at, np.nan)


def areas(a: Sides, b: Sides) -> np.ndarray:
    """(area of a, area of b, area they share) of each row."""
    sizes = np.diff(a.first) + np.diff(b.first)
    out = np.zeros((len(sizes), 3))
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        most = max(1, CELLS // int(sizes[order[min(len(order) - 1, at + 256)]]) ** 2 // 4)
        rows = order[at : at + min(most, 257)]
        at += len(rows)
        s, layer = _both(a, b, rows, int(sizes[rows[-1]]))
        cross = np.sort(_crossings(s), 1)
        cross = cross[:, : int((~np.isnan(cross)).sum(1).max(initial=0))]
        levels = np.concatenate([s[..., 1], s[..., 3], cross], 1)
        levels = np.sort(np.where(np.isnan(levels), levels[:, :1], levels), 1)
        for k in range(len(rows)):  # one row has (levels, sides) cells
            lv = np.unique(levels[k])
            out[rows[k]] = _slab_areas(s[k], layer[k], lv)
    return out


def _line(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x of each side at the heights y: (heights, sides), infinite where the side has no such height."""
    low, high = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = s[:, 0] + (y[:, None] - s[:, 1]) * ((s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1]))
    return np.where((low < y[:, None]) & (y[:, None] < high), x, np.inf)


def _slab_areas(s: np.ndarray, layer: np.ndarray, levels: np.ndarray) -> tuple[float, float, float]:
    if len(levels) < 2:
        return 0.0, 0.0, 0.0
    x = _line(s, (levels[1:] + levels[:-1]) / 2)
    order = np.argsort(x, 1, kind="stable")
    x = np.take_along_axis(x, order, 1)
    real = np.isfinite(x)
    inside = [np.cumsum(real & (layer[order] == k), 1) % 2 > 0 for k in (0, 1)]
    gap = np.where(real[:, 1:], x[:, 1:] - np.where(real, x, 0.0)[:, :-1], 0.0) * np.diff(levels)[:, None]
    one, two = inside[0][:, :-1], inside[1][:, :-1]
    return float(gap[one].sum()), float(gap[two].sum()), float(gap[one & two].sum())


def _merged_levels(y: np.ndarray, eps: float) -> np.ndarray:
    y = np.sort(y)
    return y[np.append(True, np.diff(y) > eps)] if len(y) else y


#: What belongs to the result, from the counts of both polygons.
RULES: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "intersection": lambda a, b: (a % 2 > 0) & (b % 2 > 0),
    "union": lambda a, b: (a % 2 > 0) | (b % 2 > 0),
    "difference": lambda a, b: (a % 2 > 0) & (b % 2 == 0),
    "around": lambda a, b: (a % 2 > 0) | (b > 0),
}


def outline(a: np.ndarray, b: np.ndarray, rule: str) -> list[list[np.ndarray]]:
    """The parts of the overlay of two polygons given by their sides (n x 4); ``around`` counts the turns of b's rings."""
    s = np.concatenate([a, b])
    if not len(s):
        return []
    origin = s[:, :2].min(0)
    s = s - origin[[0, 1, 0, 1]]
    eps = CLOSE * max(float(s.max()), 1e-300)
    levels = _merged_levels(np.concatenate([s[:, 1], s[:, 3], (c := _crossings(s[None])[0])[~np.isnan(c)]]), eps)
    level = np.searchsorted(levels, s[:, [1, 3]] + eps, side="right") - 1  # each end's own level
    turn, layer = np.sign(level[:, 1] - level[:, 0]), np.repeat([0, 1], [len(a), len(b)])
    s, level, turn, layer = (v[turn != 0] for v in (s, level, turn, layer))
    if not len(s):
        return []
    bottom, top = level.min(1), level.max(1)
    slab = np.arange(len(levels) - 1)
    alive = (bottom <= slab[:, None]) & (slab[:, None] < top)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1])
    at = lambda e, k: np.where(k == level[e, 0], s[e, 0], np.where(k == level[e, 1], s[e, 2], s[e, 0] + (levels[k] - s[e, 1]) * slope[e]))
    row, side = np.nonzero(alive)
    low, high = at(side, row), at(side, row + 1)
    order = np.lexsort((high + low, row))
    row, side, low, high = row[order], side[order], low[order], high[order]
    count = []
    for k in (0, 1):
        step = np.where(layer[side] == k, -turn[side] if rule == "around" and k else 1, 0)
        total = np.cumsum(step)
        count.append(total - np.append(0, total)[np.searchsorted(row, row)])
    # sides that lie on each other count together: the last of them tells what follows
    last = np.append((row[1:] != row[:-1]) | (low[1:] + high[1:] - low[:-1] - high[:-1] > 2 * eps), True)
    row, low, high = row[last], low[last], high[last]
    inside = RULES[rule](count[0][last], count[1][last])
    before = np.append(False, inside[:-1]) & np.append(False, row[1:] == row[:-1])
    border = inside != before
    row, low, high, opens = row[border], low[border], high[border], inside[border]
    if not len(row):
        return []
    # vertices: the ends of the borders on one level, as far as they are apart
    n = len(row)
    ends_level, ends_x = np.concatenate([row, row + 1]), np.concatenate([low, high])
    order = np.lexsort((ends_x, ends_level))
    new = np.append(True, (np.diff(ends_level[order]) > 0) | (np.diff(ends_x[order]) > eps))
    vertex = np.empty(2 * n, np.int64)
    vertex[order] = np.cumsum(new) - 1
    places = np.stack([ends_x[order][new], levels[ends_level[order][new]]], 1)
    on = ends_level[order][new]
    down, up = vertex[:n], vertex[n:]
    start, end = np.where(opens, up, down), np.where(opens, down, up)
    # level borders: where just one of the slabs above and below is inside
    sign = np.where(opens, 1, -1)
    above, below = (np.cumsum(np.bincount(v, sign, len(places)).astype(np.int64))[:-1] > 0 for v in (down, up))
    flat = np.flatnonzero((above != below) & (on[1:] == on[:-1]))
    right = above[flat]
    start, end = np.concatenate([start, np.where(right, flat, flat + 1)]), np.concatenate([end, np.where(right, flat + 1, flat)])
    return _parts(_rings(start, end, places), origin, eps)


def _rings(start: np.ndarray, end: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Closed rings of directed borders with the inside on their left; where several leave a vertex, the sharpest left turn goes on."""
    start, end = start[start != end], end[start != end]
    out: dict[int, list[int]] = {}
    for e, v in enumerate(start.tolist()):
        out.setdefault(v, []).append(e)
    way = np.arctan2(*(places[end] - places[start]).T[::-1])
    end_of, way_of, free, rings = end.tolist(), way.tolist(), [True] * len(start), []
    for first in range(len(start)):
        if not free[first]:
            continue
        ring, e = [], first
        while free[e]:
            free[e] = False
            if start[e] in ring:  # back at a vertex of its own: what lies between is a ring by itself
                k = ring.index(start[e])
                rings.append(places[ring[k:]])
                ring = ring[:k]
            ring.append(int(start[e]))
            choice = [k for k in out.get(end_of[e], []) if free[k]]
            if not choice:
                break
            back = way_of[e] + pi
            e = min(choice, key=lambda k: (back - way_of[k]) % (2 * pi) or 2 * pi) if len(choice) > 1 else choice[0]
        rings.append(places[ring])
    return rings


def _straightened(ring: np.ndarray, eps: float) -> np.ndarray:
    """A ring without the points on straight sides."""
    while len(ring) > 2:
        a, c = np.roll(ring, 1, 0), np.roll(ring, -1, 0)
        base, arm = c - a, ring - a
        length = np.hypot(*base.T)
        off = np.where(length > eps, np.abs(base[:, 0] * arm[:, 1] - base[:, 1] * arm[:, 0]) / np.maximum(length, eps), np.hypot(*arm.T))
        flat = off <= 4 * eps
        flat &= ~np.roll(flat, 1) | (np.arange(len(ring)) % 2 == 1)  # of neighbours not both at once
        if not flat.any():
            break
        ring = ring[~flat]
    return ring


def _twice_area(ring: np.ndarray) -> float:
    p = ring - ring[0]
    return float((p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]).sum())


def _holds(ring: np.ndarray, p: np.ndarray) -> bool:
    (x1, y1), (x2, y2) = ring.T, np.roll(ring, -1, 0).T
    spans = (y1 > p[1]) != (y2 > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool((spans & (p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1))).sum() % 2)


def _parts(rings: list[np.ndarray], origin: np.ndarray, eps: float) -> list[list[np.ndarray]]:
    """Outer rings with their holes, moved back to their place; largest parts first."""
    rings = [r for r in (_straightened(r, eps) for r in rings) if len(r) > 2]
    size = [_twice_area(r) for r in rings]
    outer = sorted((i for i, a in enumerate(size) if a > 0), key=lambda i: (-size[i], tuple(rings[i].min(0))))
    parts = {i: [rings[i]] for i in outer}
    for i, a in enumerate(size):
        if a < 0:
            p, q = rings[i][0], rings[i][1]
            d = q - p
            probe = (p + q) / 2 + np.array([-d[1], d[0]]) * (1e-6 * min(1.0, abs(a) ** 0.5 / max(float(d @ d) ** 0.5, 1e-300)))
            home = [k for k in outer if size[k] > -a and _holds(rings[k], probe)]
            if home:
                parts[home[-1]].append(rings[i])
    turned = lambda r: np.roll(r, -int(np.lexsort((r[:, 1], r[:, 0]))[0]), 0)
    return [[turned(r) + origin for r in parts[i]] for i in outer]


def around(s: np.ndarray, distance: float, quarter: int = QUARTER) -> np.ndarray:
    """Sides of rings that run at ``distance`` outside a polygon (sides with the inside on their left), round at outer corners."""
    out = []
    d = s[:, 2:] - s[:, :2]
    length = np.hypot(*d.T)
    s, d, length = s[length > 0], d[length > 0], length[length > 0]
    off = np.stack([d[:, 1], -d[:, 0]], 1) / length[:, None] * distance
    after = {tuple(p): i for i, p in enumerate(s[:, :2].tolist())}
    for i in range(len(s)):
        p, q = s[i, :2] + off[i], s[i, 2:] + off[i]
        j = after.get(tuple(s[i, 2:].tolist()))
        out.append([*p, *q])
        if j is None:
            continue
        corner = s[i, 2:]
        turn = float(np.arctan2(off[i, 0] * off[j, 1] - off[i, 1] * off[j, 0], off[i] @ off[j]))
        if turn < 0:  # an inner corner: by the corner itself, which winds the other way
            path = [q, corner, corner + off[j]]
        else:
            begin = float(np.arctan2(off[i, 1], off[i, 0]))
            steps = max(1, ceil(turn / (pi / 2) * quarter - 1e-9))
            path = [q, *[corner + distance * np.array([np.cos(begin + turn * k / steps), np.sin(begin + turn * k / steps)]) for k in range(1, steps)], corner + off[j]]
        out += [[*u, *v] for u, v in zip(path[:-1], path[1:], strict=True)]
    return np.array(out, float).reshape(-1, 4)


def _sides_of(parts: list[list[np.ndarray]]) -> np.ndarray:
    rings = [r for part in parts for r in part]
    return np.concatenate([np.concatenate([r, np.roll(r, -1, 0)], 1) for r in rings]) if rings else np.zeros((0, 4))


def widened(s: np.ndarray, distance: float) -> list[list[np.ndarray]]:
    """The polygon and all that lies within ``distance`` of it."""
    parts = outline(s, s[:0], "union")
    if distance <= 0 or not parts:
        return parts
    # rings may share a corner, so each has its own way round
    ways = [around(np.concatenate([r, np.roll(r, -1, 0)], 1), distance) for part in parts for r in part]
    return outline(_sides_of(parts), np.concatenate(ways), "around")


def meets(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two polygons share a point; touching counts."""
    if not len(a) or not len(b):
        return False
    p, q, r, t = a[:, None, :2], a[:, None, 2:], b[None, :, :2], b[None, :, 2:]
    cross = lambda u, v, w: (v[..., 0] - u[..., 0]) * (w[..., 1] - u[..., 1]) - (v[..., 1] - u[..., 1]) * (w[..., 0] - u[..., 0])
    boxes = (np.minimum(p, q) <= np.maximum(r, t)).all(-1) & (np.minimum(r, t) <= np.maximum(p, q)).all(-1)
    if (boxes & (cross(p, q, r) * cross(p, q, t) <= 0) & (cross(r, t, p) * cross(r, t, q) <= 0)).any():
        return True
    return _holds_odd(b, a[0, :2]) or _holds_odd(a, b[0, :2])  # one within the other


def _holds_odd(s: np.ndarray, p: np.ndarray) -> bool:
    spans = (s[:, 1] > p[1]) != (s[:, 3] > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool((spans & (p[0] < s[:, 0] + (p[1] - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1]))).sum() % 2)


#: What can be wrong with a polygon.
FEW, OPEN_NUMBERS, CROSSED = "fewer than three points", "a coordinate is not a number", "sides cross or lie on each other"


def fault(rings: list[np.ndarray]) -> str | None:
    """What is wrong with a polygon, or null: a valid one has rings of three points or more that don't cross, themselves or each other."""
    if not rings or any(len(np.unique(r, axis=0)) < 3 for r in rings):
        return FEW
    if not all(np.isfinite(r).all() for r in rings):
        return OPEN_NUMBERS
    s = np.concatenate([np.concatenate([r, np.roll(r, -1, 0)], 1) for r in rings])
    s = s[(s[:, :2] != s[:, 2:]).any(1)]
    p, q = s[:, :2], s[:, 2:]
    cross = lambda u, v, w: (v[..., 0] - u[..., 0]) * (w[..., 1] - u[..., 1]) - (v[..., 1] - u[..., 1]) * (w[..., 0] - u[..., 0])
    i, j = np.triu_indices(len(s), 1)
    box = (np.minimum(p[i], q[i]) <= np.maximum(p[j], q[j])).all(1) & (np.minimum(p[j], q[j]) <= np.maximum(p[i], q[i])).all(1)
    i, j = i[box], j[box]
    c = [cross(p[i], q[i], p[j]), cross(p[i], q[i], q[j]), cross(p[j], q[j], p[i]), cross(p[j], q[j], q[i])]
    through = (c[0] * c[1] < 0) & (c[2] * c[3] < 0)
    d, e = q[i] - p[i], q[j] - p[j]
    line = (c[0] == 0) & (c[1] == 0) & (np.minimum(np.maximum(p[i], q[i]), np.maximum(p[j], q[j])) - np.maximum(np.minimum(p[i], q[i]), np.minimum(p[j], q[j])) > 0).any(1) & ((d * e).sum(1) != 0)
    return CROSSED if (through | line).any() else None


def _result(found: list[list[list[np.ndarray]] | None]) -> pa.Array:
    """Parts of each row as an Arrow array, without a Python object for each point."""
    parts = [p for row in found for p in row or []]
    rings = [r for p in parts for r in p]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    offsets = lambda sizes: pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    nested = pa.ListArray.from_arrays(offsets([len(r) for r in rings]), points)
    nested = pa.ListArray.from_arrays(offsets([len(p) for p in parts]), nested)
    mask = pa.array([row is None for row in found], pa.bool_())
    return pa.ListArray.from_arrays(offsets([len(row or []) for row in found]), nested, mask=mask).cast(_PARTS)


def _null(*columns: pa.Array) -> np.ndarray:
    return np.any([np.asarray(c.is_null()) for c in columns], 0)


def _distinct(null: np.ndarray, *each: Sides) -> tuple[list[int], np.ndarray]:
    """The rows of a batch that differ from all before them, and which of them each row equals: copies are computed once."""
    seen: dict = {}
    first, of = [], np.empty(len(null), np.int64)
    for i, n in enumerate(null.tolist()):
        of[i] = k = seen.setdefault(None if n else tuple(s.of(i).tobytes() for s in each), len(first))
        if k == len(first):
            first.append(i)
    return first, of


def _picked(s: Sides, rows: list[int]) -> Sides:
    own = [s.of(i) for i in rows]
    return Sides(np.concatenate([*own, s.xy[:0]]), np.append(0, np.cumsum([len(o) for o in own])).astype(np.int64))


def _each(compute: Callable[..., list[list[np.ndarray]]], *polygons: pa.Array) -> pa.Array:
    """The parts that ``compute`` gives for the sides of each row's polygons, once for equal rows; null where one is null."""
    null, every = _null(*polygons), [sides(p) for p in polygons]
    first, of = _distinct(null, *every)
    return _result([None if null[i] else compute(*(s.of(i) for s in every)) for i in first]).take(pa.array(of))


def shared_areas(a: Column, b: Column) -> Column:
    """struct(area_a, area_b, shared) of two polygons."""

    @F.arrow_udf("area_a double, area_b double, shared double")
    def run(one: pa.Array, two: pa.Array) -> pa.Array:
        p, q, null = sides(one), sides(two), _null(one, two)
        first, of = _distinct(null, p, q)
        found, null = areas(_picked(p, first), _picked(q, first))[of], pa.array(null)
        return pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(found.T)], ["area_a", "area_b", "shared"], mask=null)

    return run(a, b)


def area(polygon: Column) -> Column:
    """What a polygon's rings enclose an odd number of times, whatever their direction."""

    @F.arrow_udf("double")
    def run(one: pa.Array) -> pa.Array:
        p, null = sides(one), _null(one)
        first, of = _distinct(null, p)
        p = _picked(p, first)
        none = Sides(p.xy[:0], np.zeros_like(p.first))
        return pa.array(areas(p, none)[of, 0], mask=null)

    return run(polygon)


def union_all(polygons: Column) -> Column:
    """The parts of the union of an array of polygons, of any number."""

    @F.arrow_udf(PARTS)
    def run(many: pa.Array) -> pa.Array:
        every = sides(many.flatten())
        ends = np.append(0, np.cumsum(np.nan_to_num(np.asarray(many.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)))
        out = []
        for i, n in enumerate(_null(many)):
            # each polygon's own outline first: directed rings, so that what any of them covers is wound round once at least
            own = [_sides_of(outline(every.of(k), every.xy[:0], "union")) for k in range(ends[i], ends[i + 1])]
            out.append(None if n else outline(every.xy[:0], np.concatenate([*own, every.xy[:0]]), "around"))
        return _result(out)

    return run(polygons)


def touching(a: Column, b: Column) -> Column:
    """Whether two polygons share a point; a common corner is enough."""

    @F.arrow_udf("boolean")
    def run(one: pa.Array, two: pa.Array) -> pa.Array:
        p, q = sides(one), sides(two)
        return pa.array([None if n else meets(p.of(i), q.of(i)) for i, n in enumerate(_null(one, two))], pa.bool_())

    return run(a, b)


def overlay(a: Column, b: Column, rule: str) -> Column:
    """The parts of ``intersection``, ``union`` or ``difference`` of two polygons."""
    if rule not in ("intersection", "union", "difference"):
        raise ValueError(f"unknown rule {rule}")

    @F.arrow_udf(PARTS)
    def run(one: pa.Array, two: pa.Array) -> pa.Array:
        return _each(lambda p, q: outline(p, q, rule), one, two)

    return run(a, b)


def repaired(polygon: Column) -> Column:
    """The parts of what a polygon's rings enclose an odd number of times: a bow-tie gives two triangles, a ring inside a hole a part."""

    @F.arrow_udf(PARTS)
    def run(one: pa.Array) -> pa.Array:
        return _each(lambda p: outline(p, p[:0], "union"), one)

    return run(polygon)


def buffered(polygon: Column, distance: float) -> Column:
    """The parts of what lies within ``distance`` of a polygon; a quarter of a circle is ``QUARTER`` straight pieces."""

    @F.arrow_udf(PARTS)
    def run(one: pa.Array) -> pa.Array:
        return _each(lambda p: widened(p, distance), one)

    return run(polygon)


def trimmed(large: Column, small: Column, distance: float) -> Column:
    """The parts of ``large`` that are more than ``distance`` away from ``small``."""

    @F.arrow_udf(PARTS)
    def run(one: pa.Array, two: pa.Array) -> pa.Array:
        return _each(lambda p, q: outline(p, _sides_of(widened(q, distance)), "difference"), one, two)

    return run(large, small)


def faults(polygon: Column) -> Column:
    """What is wrong with a polygon; null for a valid or a null one."""

    @F.arrow_udf("string")
    def run(one: pa.Array) -> pa.Array:
        p, sizes = sides(one), one.flatten().value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(one.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        known: dict = {}
        out = []
        for i, n in enumerate(_null(one)):
            key = None if n else (p.of(i).tobytes(), sizes[ends[i] : ends[i + 1]].tobytes())  # rings count as well
            if key not in known:
                known[key] = None if n else fault([np.array([(c["x"], c["y"]) for c in r or []], float).reshape(-1, 2) for r in one[i].as_py()])
            out.append(known[key])
        return pa.array(out, pa.string())

    return run(polygon)


def rings_of(parts: Column) -> Column:
    """All rings of a polygon in parts, as one polygon for the functions above."""
    return F.flatten(parts)


def parts_area(parts: Column) -> Column:
    """The area of a polygon in parts, whose rings are directed as this module directs them."""
    ring = lambda r: F.aggregate(F.transform(r, lambda p, i: p["x"] * F.get(r, F.pmod(i + 1, F.size(r)))["y"] - p["y"] * F.get(r, F.pmod(i + 1, F.size(r)))["x"]), F.lit(0.0), lambda z, c: z + c)
    return F.aggregate(F.flatten(parts), F.lit(0.0), lambda z, r: z + ring(r) / 2)
