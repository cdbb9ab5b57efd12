"""Overlays of polygons against unit squares and fine points, and overlaps resolved in order against a plain loop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators import harmony as H
from tessella.operators import polygons as P


def _sides(*rings):
    return np.concatenate([np.concatenate([np.array(r, float), np.roll(np.array(r, float), -1, 0)], 1) for r in rings])


def _batch(*rows):
    return O.Sides(np.concatenate(rows), np.append(0, np.cumsum([len(r) for r in rows])))


def _area(parts):
    return sum(O._twice_area(r) / 2 for p in parts for r in p)


def _inside(s, points):
    spans = (s[:, 1] > points[:, 1:]) != (s[:, 3] > points[:, 1:])
    with np.errstate(all="ignore"):
        return (spans & (points[:, :1] < s[:, 0] + (points[:, 1:] - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1]))).sum(1) % 2 > 0


def _star(r, n, cx, cy, size):
    t, q = np.sort(r.uniform(0, 2 * np.pi, n)), r.uniform(0.3, 1, n) * size
    return np.stack([cx + q * np.cos(t), cy + q * np.sin(t)], 1)


def test_overlays_of_notched_shapes_with_holes_against_a_fine_raster():
    r = np.random.default_rng(1)
    grid = np.stack(np.meshgrid(*[(np.arange(300) + 0.5) / 50 - 3] * 2), -1).reshape(-1, 2)
    for k in range(30):
        a = _sides(*([_star(r, r.integers(5, 30), 0, 0, 2)] + [_star(r, 5, 0, 0, 0.3)] * (k % 2)))
        b = _sides(_star(r, r.integers(5, 30), 0.7, 0.4, 2))
        p, q = _inside(a, grid), _inside(b, grid)
        one, two, shared = O.areas(_batch(a), _batch(b))[0]
        for rule, exact, raster in (("intersection", shared, p & q), ("union", one + two - shared, p | q), ("difference", one - shared, p & ~q)):
            parts = O.outline(a, b, rule)
            assert abs(_area(parts) - exact) < 1e-9 and abs(exact - raster.mean() * 36) < 0.08
            assert not parts or (_inside(O._sides_of(parts), grid) == raster).all()


def test_overlays_of_shapes_whose_corners_and_sides_coincide():
    r = np.random.default_rng(2)
    for _ in range(200):
        a, b = (_sides(r.integers(0, 6, (r.integers(3, 8), 2))) for _ in range(2))  # they cross and touch themselves too
        one, two, shared = O.areas(_batch(a), _batch(b))[0]
        for rule, exact in (("intersection", shared), ("union", one + two - shared), ("difference", one - shared)):
            parts = O.outline(a, b, rule)
            assert abs(_area(parts) - exact) < 1e-7
            assert all(O._twice_area(p[0]) > 0 and all(O._twice_area(h) < 0 for h in p[1:]) for p in parts)


def test_areas_of_a_batch_of_unlike_sizes():
    r = np.random.default_rng(3)
    rows = [(_sides(_star(r, n, 0, 0, 2)), _sides(_star(r, 41 - n, 0.5, 0, 2))) for n in range(3, 38)] + [(np.zeros((0, 4)), _sides([(0, 0), (1, 0), (0, 1)]))]
    many = O.areas(_batch(*[a for a, _ in rows]), _batch(*[b for _, b in rows]))
    alone = np.array([O.areas(_batch(a), _batch(b))[0] for a, b in rows])
    assert np.allclose(many, alone) and many[-1].tolist() == [0.0, 0.5, 0.0]


def test_touching_nested_and_twisted_shapes():
    box = lambda x, y, s: _sides([(x, y), (x + s, y), (x + s, y + s), (x, y + s)])
    assert O.outline(box(0, 0, 1), box(1, 0, 1), "intersection") == [] and len(O.outline(box(0, 0, 1), box(1, 0, 1), "union")) == 1
    assert [len(p) for p in O.outline(box(0, 0, 1), box(1, 1, 1), "union")] == [1, 1]  # a common corner doesn't join
    assert [len(p) for p in O.outline(box(0, 0, 3), box(1, 1, 1), "difference")] == [2]
    assert _area(O.outline(box(1, 1, 1), box(0, 0, 3), "difference")) == 0
    assert O.meets(box(0, 0, 1), box(1, 1, 1)) and O.meets(box(0, 0, 9), box(1, 1, 1)) and not O.meets(box(0, 0, 1), box(1.1, 0, 1))
    bow = O.outline(_sides([(0, 0), (2, 2), (2, 0), (0, 2)]), box(0, 0, 0)[:0], "union")
    assert [_area([p]) for p in bow] == [1.0, 1.0]
    ring = O.outline(_sides([(0, 0), (9, 0), (9, 9), (0, 9)], [(1, 1), (8, 1), (8, 8), (1, 8)], [(2, 2), (7, 2), (7, 7), (2, 7)]), box(0, 0, 0)[:0], "union")
    assert sorted(_area([p]) for p in ring) == [25.0, 32.0]  # an island in a hole is a part


def test_buffers():
    corner = 16 * np.sin(np.pi / 16)  # a circle of radius 1 in 32 pieces
    box = _sides([(0, 0), (3, 0), (3, 3), (0, 3)])
    assert abs(_area(O.widened(box, 1.0)) - (9 + 12 + corner)) < 1e-9 and abs(_area(O.widened(box[:, [2, 3, 0, 1]], 0.0)) - 9) < 1e-9
    notched = _sides([(0, 0), (9, 0), (9, 4), (4, 4), (4, 9), (0, 9)], [(1, 1), (2, 1), (2, 3), (1, 3)])
    assert abs(_area(O.widened(notched, 0.25)) - (56 + 9 + 5 / 4 * corner / 16 - 1 / 16 - 0.5 * 1.5)) < 1e-9  # the hole shrinks, the inner corner counts once
    assert [len(p) for p in O.widened(notched, 1.0)] == [1]  # the hole is gone


def _ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_columns_with_nulls_and_empty_polygons(spark):
    box = lambda x, y, s: [_ring((x, y), (x + s, y), (x + s, y + s), (x, y + s))]
    rows = [(0, box(0, 0, 2), box(1, 1, 2)), (1, None, box(0, 0, 1)), (2, [], box(0, 0, 1)), (3, box(0, 0, 1), None), (4, [[]], box(0, 0, 1)), (5, box(0, 0, 1), box(1, 0, 1))]
    df = spark.createDataFrame(rows, f"i int, a {G.POLYGON}, b {G.POLYGON}")
    a, b = F.col("a"), F.col("b")
    out = {r.i: r for r in df.select("i", O.shared_areas(a, b).alias("s"), O.parts_area(O.overlay(a, b, "union")).alias("u"), O.touching(a, b).alias("t"), O.area(a).alias("area"), F.size(O.repaired(a)).alias("n"), O.faults(a).alias("f")).collect()}
    assert tuple(out[0].s) == (4.0, 4.0, 1.0) and out[0].u == 7 and out[0].t and out[0].n == 1 and out[0].f is None
    assert (out[1].s, out[1].u, out[1].t, out[1].area) == (None, None, None, None) and out[3].s is None
    assert tuple(out[2].s) == tuple(out[4].s) == (0.0, 1.0, 0.0) and out[2].u == 1 and not out[2].t and out[2].f == out[4].f == O.FEW
    assert tuple(out[5].s) == (1.0, 1.0, 0.0) and out[5].t
    wrong = [(_ring((0, 0), (2, 2), (2, 0), (0, 2)), O.CROSSED), (_ring((0, 0), (1, 0), (1, 0), (0, 0)), O.FEW), (_ring((0, 0), (1, float("nan")), (1, 1)), O.OPEN_NUMBERS), (_ring((0, 0), (1, 0), (1, 0), (1, 1), (0, 0)), None)]
    got = spark.createDataFrame([(i, [r]) for i, (r, _) in enumerate(wrong)], f"i int, a {G.POLYGON}").select("i", O.faults(a)).collect()
    assert [f for _, f in sorted(got)] == [f for _, f in wrong]
    with pytest.raises(ValueError):
        O.overlay(a, b, "both")


def _cells(spark, rows):
    return spark.createDataFrame([(i, 0, p, "x") for i, p in rows], f"entity_id bigint, z int, polygon {G.POLYGON}, area string")


def test_regions_keep_what_meets_them(spark):
    notched = [_ring((0, 0), (9, 0), (9, 4), (4, 4), (4, 9), (0, 9)), _ring((1, 1), (3, 1), (3, 3), (1, 3))]
    box = lambda x, y, s: [_ring((x, y), (x + s, y), (x + s, y + s), (x, y + s))]
    kept = lambda region: P.kept_by_regions(_cells(spark, [(1, notched)]), _cells(spark, [(5, region)])).count()
    assert [kept(r) for r in (box(6, 6, 1), box(1.5, 1.5, 1), box(4, 4, 1), box(-5, -5, 30), box(0.2, 0.2, 0.1), box(9, 0, 1), None, [])] == [0, 0, 1, 1, 1, 1, 0, 0]


def _square(x, y, s):
    return [_ring((x, y), (x + s, y), (x + s, y + s), (x, y + s))]


def test_harmonising_trims_merges_and_drops(spark):
    found = lambda rows, **how: {r.entity_id: round(r.area, 9) for r in H.harmonised(_cells(spark, rows), **how).collect()}
    assert found([(1, _square(0, 0, 3)), (2, _square(2.5, 0, 1))], min_distance=0, min_area=0) == {1: 8.5, 2: 1.0}
    assert found([(1, _square(0, 0, 3)), (2, _square(0.1, 0.1, 1))], min_distance=0, min_area=0) == {1: 9.0}
    assert found([(1, _square(0, 0, 10)), (2, _square(50, 50, 0.5)), (3, None), (4, [])], min_distance=2, min_area=1) == {1: 100.0}
    assert found([(1, _square(0, 0, 4)), (2, _square(4, 0, 3))], min_distance=1, min_area=0) == {1: round(13 - 4 * math.sin(math.pi / 16), 9), 2: 9.0}  # touching: the larger one keeps its distance, round the corner too
    assert found([], min_area=0) == {}


def _blocks(r, n):
    """Notched shapes with whole corners and many overlaps."""
    out = []
    for i in range(n):
        x, y, w, h, a, b = r.randrange(24), r.randrange(24), r.randrange(3, 9), r.randrange(3, 9), r.randrange(1, 3), r.randrange(1, 3)
        ring = [(0, 0), (w, 0), (w, b), (a, b), (a, h), (0, h)]
        out.append((i, [_ring(*[(x + u, y + v) for u, v in ring])], frozenset((x + u, y + v) for u in range(w) for v in range(h) if v < b or u < a)))
    return out


def _meet(spark, rows):
    return sorted((-r.share, r.a, r.b) for r in H.meeting(_cells(spark, [(i, p) for i, p, _ in rows])).collect())


def test_harmonising_against_a_plain_loop(spark):
    rows = _blocks(random.Random(4), 40)
    pairs, cells, polygons = _meet(spark, rows), {i: set(s) for i, _, s in rows}, [(i, p) for i, p, _ in rows]
    for a in range(40):
        for b in range(a + 1, 40):
            n, least = len(cells[a] & cells[b]), min(len(cells[a]), len(cells[b]))
            assert not n or (-round(n / least, 9), a, b) in pairs
    merged = dict(cells)
    for _, a, b in pairs:
        if a in merged and b in merged and len(merged[a] & merged[b]) > 0.5 * min(len(merged[a]), len(merged[b])):
            keeps, goes = (a, b) if len(merged[a]) > len(merged[b]) else (b, a)
            merged[keeps] = merged[keeps] | merged.pop(goes)
    assert len(merged) < 40
    area = lambda df: {r.entity_id: round(r.s) for r in df.select("entity_id", O.area(F.col("polygon")).alias("s")).collect()}
    state = H._resolved(_cells(spark, polygons).select(H.CELL), H.meeting(_cells(spark, polygons)), lambda p: H._merge(p, 0.5))
    assert area(state) == {i: len(s) for i, s in merged.items()}
    for share, a, b in sorted((-r.share, r.a, r.b) for r in H.meeting(state).collect()):
        large, small = (a, b) if len(merged[a]) > len(merged[b]) else (b, a)
        merged[large] = merged[large] - merged[small]
    got = H.harmonised(_cells(spark, polygons), min_distance=0, min_area=3).cache()
    assert area(got) == {i: len(s) for i, s in merged.items() if len(s) > 3}
    left = P.overlapping_polygons(got.select("entity_id", "z", "polygon"), got.select("entity_id", "z", "polygon")).where("id_a <> id_b").agg(F.max("area")).first()[0]
    assert (left or 0) < 1e-9


def test_greedy_merging_against_a_plain_loop(spark):
    rows = _blocks(random.Random(6), 60)
    cells = {i: s for i, _, s in rows}
    for least in (None, 6):
        free, want = set(cells), {}
        for i in sorted(cells):
            if i in free:
                taken = [j for j in sorted(free) if j != i and (n := len(cells[i] & cells[j])) and n >= (least or 0.5 * min(len(cells[i]), len(cells[j])))]
                free -= {i, *taken}
                want[i] = (bool(taken), len(cells[i].union(*[cells[j] for j in taken])))
        got = H.merged_overlaps(_cells(spark, [(i, p) for i, p, _ in rows]), least).select("entity_id", "merged", O.area(F.col("polygon")).alias("s")).collect()
        assert {r.entity_id: (r.merged, round(r.s)) for r in got} == want and any(m for m, _ in want.values())
