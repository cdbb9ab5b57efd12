"""Masks to polygons and back, and filling against a test of every centre."""

import random

import numpy as np
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators import outlines as M


def _mask(spark, cells):
    return spark.createDataFrame(list(cells), "row bigint, col bigint, label string")


def test_masks_become_polygons_and_masks_again(spark):
    r = random.Random(2)
    cells = {(y, x, "noise") for y in range(-5, 12) for x in range(15) if r.random() < 0.55}
    cells |= {(y, x, "ring") for y in range(20, 27) for x in range(7) if not (2 <= y - 20 <= 4 and 2 <= x <= 4)} | {(23, 3, "ring")}  # an island in the hole
    cells |= {(y, y, "steps") for y in range(40, 44)} | {(y, x, "block") for y in range(50, 70) for x in range(30)}
    df = _mask(spark, cells)
    polygons = M.mask_polygons(df.unionByName(df).unionByName(_mask(spark, [(None, 1, "noise"), (1, 1, None)])), 5.0, 100.0, -50.0).cache()
    rows = {x.label: x for x in polygons.select("label", "polygon", O.area(F.col("polygon")).alias("area")).collect()}
    for label, x in rows.items():
        assert abs(x.area - 25 * sum(c[2] == label for c in cells)) < 1e-6
        rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in x.polygon]
        assert O.fault(rings) is None
        assert len(rings[0]) == {"noise": len(rings[0]), "ring": 4, "steps": 4, "block": 4}[label]  # no points on straight sides
    assert [len(rows[k].polygon) for k in ("ring", "steps", "block")] == [3, 4, 1]
    assert {tuple(c) for c in M.filled(polygons, 5.0, 100.0, -50.0).select("row", "col", "label").collect()} == cells


def test_filling_against_every_centre(spark):
    r = np.random.default_rng(5)
    shapes = []
    for _ in range(12):
        n = r.integers(3, 12)
        shapes.append([[{"x": float(x), "y": float(y)} for x, y in r.uniform(0, 12, (n, 2))]])  # crossing itself
    shapes += [[[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}]], [], None, [[]], [[{"x": 1.0, "y": 1.0}, {"x": 1.2, "y": 1.0}, {"x": 1.0, "y": 1.2}]]]
    df = spark.createDataFrame(list(enumerate(shapes)), f"id int, polygon {G.POLYGON}")
    want = set()
    for i, rings in enumerate(shapes):
        for row in range(-1, 14):
            for col in range(-1, 14):
                x, y, odd = col + 0.5, row + 0.5, False
                for ring in rings or []:
                    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
                        odd ^= (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])
                if odd:
                    want.add((i, row, col))
    assert {tuple(x) for x in M.filled(df).collect()} == want


def test_empty_masks(spark):
    assert M.mask_polygons(_mask(spark, [])).isEmpty() and M.filled(M.mask_polygons(_mask(spark, []))).isEmpty()
