"""Copies of polygons and boxes: the result is that of every row, and the work doesn't grow with the square of the copies."""

import numpy as np
from pyspark.sql import functions as F

from tessella.functions import overlay as O
from tessella.operators import harmony as H
from tessella.operators import labels as L
from tessella.operators import polygons as P
from tessella.operators import space as S

POLYGON = "entity_id bigint, z int, polygon array<array<struct<x:double,y:double>>>"
BOX = "entity_id bigint, z int, minx double, miny double, maxx double, maxy double"


def _square(x, y, side=4.0):
    return [[(x, y), (x + side, y), (x + side, y + side), (x, y + side)]]


def _copies(spark, n=60):
    """Three forms in turn: two that overlap, and one apart; each entity on two planes."""
    return spark.createDataFrame([(i, z, _square(*[(0.0, 0.0), (2.0, 0.0), (50.0, 50.0)][i % 3])) for i in range(n) for z in (0, 1)], POLYGON)


def _met(monkeypatch, module, name):
    """The tables that ``name`` gives, and how many rows they had."""
    seen, old = [], getattr(module, name)

    def watched(*args, **kwargs):
        out = old(*args, **kwargs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(module, name, watched)
    return seen


def test_overlaps_of_copies(spark, monkeypatch):
    rows, seen = _copies(spark), _met(monkeypatch, P, "met_bounds")
    got = {(r.id_a, r.id_b): (r.area, r.area_a, r.area_b) for r in P.overlapping_polygons(rows, rows).collect()}
    area = {(0, 0): 32.0, (1, 1): 32.0, (2, 2): 32.0, (0, 1): 16.0, (1, 0): 16.0}
    assert got == {(a, b): (area[a % 3, b % 3], 32.0, 32.0) for a in range(60) for b in range(60) if (a % 3, b % 3) in area}
    assert sum(seen) == 10  # three forms with themselves and one pair in both directions, on two planes


def test_alignment_of_copies(spark, monkeypatch):
    rows, seen = _copies(spark), _met(monkeypatch, P, "met_bounds")
    for mode in P.MODES:
        assert sorted((r.id_a, r.id_b, r.z) for r in P.aligned(rows, rows, mode).collect()) == [(i, i, z) for i in range(3) for z in (0, 1)]
    assert seen == [10] * 4


def test_regions_of_copies(spark, monkeypatch):
    rows, seen = _copies(spark).where("z = 0"), _met(monkeypatch, P, "met_bounds")
    regions = spark.createDataFrame([(_square(5.5, 0.0, 1.0),)] * 40, "polygon array<array<struct<x:double,y:double>>>")
    assert sorted(r.entity_id for r in P.kept_by_regions(rows, regions).distinct().collect() if r.entity_id < 6) == [1, 4]
    assert sum(seen) == 1


def test_points_in_copies(spark):
    points = spark.createDataFrame([(0, "a", 1.0, 1.0, 0), (1, "b", 3.0, 1.0, 0), (2, "a", 9.0, 9.0, 0), (3, "a", 1.0, 1.0, 5)], "tx_id bigint, gene string, x double, y double, z int")
    shapes = _copies(spark).unionByName(spark.createDataFrame([(0, 0, _square(0.0, 0.0))], POLYGON))  # entity 0 twice on a plane
    seen = []

    def join(p, s):
        seen.append(P.points_in_polygons(p, s))
        return seen[-1]

    got = {(r.entity_id, r.gene): r.n for r in S.counted_inside(points, shapes, ("z", "polygon"), ("gene",), join).collect()}
    assert got == {(i, g): 2 if i == 0 else 1 for i in range(60) for g in "ab" if (i % 3, g) in ((0, "a"), (0, "b"), (1, "b"))}
    assert sorted(map(tuple, S.assigned(points, shapes, ("z", "polygon"), join).collect())) == [(0, 57), (1, 58), (2, -1), (3, -1)]
    assert [df.count() for df in seen] == [3, 3]


def test_boxes_of_copies(spark, monkeypatch):
    rows = spark.createDataFrame([(i, z, *[(0.0, 0.0, 4.0, 4.0), (2.0, 0.0, 6.0, 4.0), (50.0, 50.0, 51.0, 52.0)][i % 3]) for i in range(60) for z in (0, 1)], BOX)
    seen = _met(monkeypatch, S, "boxes_on_grid")
    got = {(r.id_a, r.id_b): r.area for r in S.overlapping_boxes(rows, rows).collect()}
    area = {(0, 0): 32.0, (1, 1): 32.0, (2, 2): 4.0, (0, 1): 16.0, (1, 0): 16.0}
    assert got == {(a, b): area[a % 3, b % 3] for a in range(60) for b in range(60) if (a % 3, b % 3) in area}
    assert sorted(map(tuple, S.aligned_boxes(rows, rows).collect())) == [(0, 0, 32.0), (1, 1, 32.0), (2, 2, 4.0)]
    assert max(seen) <= 12


def test_greedy_merging_of_copies(spark, monkeypatch):
    rows, seen = _copies(spark, 30).where("z = 0"), _met(monkeypatch, H, "met_bounds")
    got = lambda least: sorted((r.entity_id, r.merged, r.s) for r in H.merged_overlaps(rows, least).select("entity_id", "merged", O.area(F.col("polygon")).alias("s")).collect())
    assert got(8.0) == [(0, True, 24.0), (2, True, 16.0)]
    assert got(9.0) == [(0, True, 16.0), (1, True, 16.0), (2, True, 16.0)]
    assert got(17.0) == [(i, False, 16.0) for i in range(30)]  # copies that share too little with each other
    assert seen == [4] * 3 or max(seen) <= 5


def test_overlays_of_copies_are_computed_once(spark):
    import pyarrow as pa

    polygons = pa.array([[[{"x": x, "y": y} for x, y in r] for r in _square(float(i % 2), 0.0)] if i % 5 else None for i in range(50)], O._PARTS.value_type)
    calls = []

    def compute(s):
        calls.append(len(s))
        return O.outline(s, s[:0], "union")

    got = O._each(compute, polygons).to_pylist()
    assert len(calls) == 2 and [g is None for g in got] == [i % 5 == 0 for i in range(50)]
    assert all(min(p["x"] for p in g[0][0]) == i % 2 for i, g in enumerate(got) if g)
    none = spark.createDataFrame([(None,), (_square(0.0, 0.0),), ([[(0.0, 0.0), (1.0, 1.0)]],), (None,)], "polygon array<array<struct<x:double,y:double>>>").coalesce(1)
    assert [tuple(r) for r in none.select(O.area(F.col("polygon")), O.faults(F.col("polygon"))).collect()] == [(None, None), (16.0, None), (0.0, O.FEW), (None, None)]


def test_shares_do_not_depend_on_the_order_of_weights(spark):
    # the shares of labels 14 and 19 are 0.3999999995 and 0.4, a tie by 9 digits; floating sums in other orders fell on either side
    rows = [(0.01, 14), (0.01, 19), (0.05, 19), (0.03, 15), (0.05, 23)]
    from itertools import permutations

    neighbours = spark.createDataFrame([(q, i, d) for q, order in enumerate(permutations(range(5))) for i in order for d in [rows[i][0]]], "query_id bigint, ref_id bigint, distance double").coalesce(1)
    labels = spark.createDataFrame([(i, label) for i, (_, label) in enumerate(rows)], "ref_id bigint, label int")
    scores = L.weighted_votes(neighbours, labels).withColumn("score", F.round("score", 9))
    assert {r.label for r in L.best_label(scores).collect()} == {14}


def test_shares_are_plain_sums_from_the_least_weight_on(spark):
    # of query 1182 of the smallest tables; rounded to 14 digits, the shares of 18 and 21 tied by 9 digits, which they don't in the SQL
    rows = [(0.0, 18), (0.05, 21), (0.03, 21), (0.08, 19)]
    neighbours = spark.createDataFrame([(1182, i, d) for i, (d, _) in enumerate(rows)], "query_id bigint, ref_id bigint, distance double")
    labels = spark.createDataFrame([(i, label) for i, (_, label) in enumerate(rows)], "ref_id bigint, label int")
    weights = {}
    for w, label in sorted((1 - d / 0.08 + 1e-9, label) for d, label in rows):
        weights[label] = weights.get(label, 0.0) + w
    total = 0.0
    for w in sorted(weights.values()):
        total += w
    scores = L.weighted_votes(neighbours, labels)
    assert {r.label: r.score for r in scores.collect()} == {label: w / total for label, w in weights.items()}
    assert [r.label for r in L.best_label(scores.withColumn("score", F.round("score", 9))).collect()] == [21]


def test_hexagons_test_points_of_one_place_once(spark, monkeypatch):
    points = spark.createDataFrame([(1.0, 1.0, "a")] * 30 + [(1.0, 1.0, "b")] * 4 + [(1.0, 1.0, "Blank-1")], "x double, y double, gene string")
    seen = _met(monkeypatch, P, "points_in_polygons")
    hexes = P.hex_grid(spark, (0.0, 0.0, 2.0, 2.0), 10.0)
    got = P.hex_genes(points, hexes, 10.0).groupBy("gene").agg(F.max("n").alias("n")).collect()
    assert {r.gene: r.n for r in got} == {"a": 30, "b": 4} and seen[0] % 2 == 0 and seen[0] <= 8


def test_nearest_rows_of_a_block_by_brute_force():
    r = np.random.default_rng(3)
    refs = np.concatenate([r.normal(size=(200, 8)), r.integers(0, 2, (200, 8)).astype(float)]) + 1000.0  # far from the origin, and many ties
    q = np.concatenate([refs[::40], r.integers(0, 2, (10, 8)) + 1000.0])
    for k in (1, 5, 400, 500):
        at, distances = L.best_of_block(q, refs, k)
        for v, own, d in zip(q, at, distances, strict=True):
            full = np.round(((refs - v) ** 2).sum(1), 9)
            want = np.argsort(full, kind="stable")[:k]
            assert own.tolist() == want.tolist() and d.tolist() == full[want].tolist()


def test_nearest_rows_of_copies(spark, monkeypatch):
    vectors = [[0.0, 0.0], [1.0, 0.0], [5.0, 5.0]]
    reference = spark.createDataFrame([(100 + i, i % 4, vectors[i % 3]) for i in range(60)], "vec_id bigint, label int, embedding array<float>")
    queries = spark.createDataFrame([(i, 0, vectors[i % 2]) for i in range(20)], "vec_id bigint, label int, embedding array<float>")
    seen = []
    monkeypatch.setattr(L, "best_of_block", lambda q, refs, k, old=L.best_of_block: old(q, refs, k) if len(q) <= 2 and len(refs) <= 12 else seen.append(1))
    got = {}
    for r in L.nearest(queries, reference, 4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.ref_id, r.label, r.distance))
    assert got == {i: [(100 + j, j % 4, 0.0) for j in range(60) if j % 3 == i % 2][:4] for i in range(20)}
