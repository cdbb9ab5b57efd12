"""Regions of high expression against a plain computation over all points."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import overlay as O
from tessella.operators import regions as R

GENES = ["a", "b"]
SIZE = 3.0


@pytest.fixture(scope="module")
def points():
    """Few points everywhere, many of both genes in two places, and many of one gene in a third; the first one is a corner of the bounds, so that none lies on a side."""
    r = np.random.default_rng(8)
    rows = [("a", -1.0, -1.0)] + [("ab"[i % 2], *p) for i, p in enumerate(r.uniform(0, 80, (700, 2)))] + [("c", *p) for p in r.uniform(-50, 150, (50, 2))]
    for gene, x, y, n in (("a", 15, 15, 900), ("b", 15, 15, 900), ("a", 55, 60, 900), ("b", 55, 60, 900), ("a", 60, 15, 900)):
        rows += [(gene, *p) for p in r.normal((x, y), 4, (n, 2))]
    return [(g, float(x), float(y)) for g, x, y in rows] + [(None, 1.0, 1.0), ("a", None, 1.0)]


def _plain_mixture(values, k):
    """Expectation and maximisation over every value by itself, from groups of equal size."""
    values = np.sort(np.array(values, float))
    share = np.zeros((len(values), k))
    for j in range(k):
        for i in range(len(values)):  # the part of value i (which may straddle a border together with its equals) in group j
            same = np.flatnonzero(values == values[i])
            low, high = max(same[0], j * len(values) / k), min(same[-1] + 1, (j + 1) * len(values) / k)
            share[i, j] = max(0, high - low) / len(same)
    last = -math.inf
    for _ in range(100):
        mass = share.sum(0)
        mean = (share * values[:, None]).sum(0) / mass
        variance = (share * (values[:, None] - mean) ** 2).sum(0) / mass + 1e-6
        density = mass / len(values) * np.exp(-0.5 * (values[:, None] - mean) ** 2 / variance) / np.sqrt(2 * math.pi * variance)
        share = density / density.sum(1, keepdims=True)
        now = np.log(density.sum(1)).mean()
        if abs(now - last) < 1e-3:
            break
        last = now
    return mass / len(values), mean, variance


def _hexes(points):
    """Hexagon of each point of the genes: the nearest centre, which a grid without overlap allows."""
    own = [(g, x, y) for g, x, y in points if g in GENES and x is not None]
    x0, y0 = min(p[1] for p in own), min(p[2] for p in own)
    wide, tall, out = SIZE * math.sqrt(3), SIZE * 1.5, {}
    for g, x, y in own:
        row = round((y - y0) / tall)
        near = []
        for r in range(row - 1, row + 2):
            c = round((x - x0) / wide - (0.5 if r % 2 else 0))
            near += [(math.hypot(x - x0 - (k + (0.5 if r % 2 else 0)) * wide, y - y0 - r * tall), r, k) for k in (c - 1, c, c + 1)]
        _, r, k = min(near)
        out.setdefault((r, k), {"a": 0, "b": 0})[g] += 1
    return out


def test_chosen_hexes_and_regions_against_a_plain_computation(spark, points):
    df = spark.createDataFrame(points, "gene string, x double, y double")
    hexes, counts = R.hex_counts(df, GENES, SIZE)
    where = {r.hex_id: (r.row, r.col) for r in hexes.select("hex_id", "row", "col").collect()}
    got = {}
    for r in counts.collect():
        got.setdefault(where[r.hex_id], {})[r.gene] = r.n
    want = _hexes(points)
    assert got == want
    agree = {h: 0 for h in want}
    for gene in GENES:
        weight, mean, variance = _plain_mixture([c[gene] for c in want.values()], 3)
        best = {h: int(np.argmax(np.log(weight) - 0.5 * np.log(variance) - 0.5 * (c[gene] - mean) ** 2 / variance)) for h, c in want.items()}
        top = max(set(best.values()), key=lambda k: np.mean([want[h][gene] for h in want if best[h] == k]))
        for h in want:
            agree[h] += best[h] == top
    chosen = {h for h, n in agree.items() if n == 2}
    assert {where[r.hex_id] for r in R.agreed_hexes(counts, GENES, agreement=0.75).collect()} == chosen and len(chosen) > 10
    # parts by a plain walk
    parts, left = [], set(chosen)
    while left:
        part, edge = set(), {left.pop()}
        while edge:
            part |= edge
            edge = {n for r, c in edge for n in ((r, c - 1), (r, c + 1), *((r + u, c + s) for u in (-1, 1) for s in ((-1, 0) if r % 2 == 0 else (0, 1))))} & left
            left -= edge
        parts.append(part)
    parts = [p for p in parts if len(p) >= 5]
    found = R.called_regions(df, GENES, SIZE).select("region", "polygon", O.area(F.col("polygon")).alias("area")).collect()
    assert len(found) == len(parts) == 2
    x0, y0 = min(p[1] for p in points if p[0] in GENES and p[1] is not None), min(p[2] for p in points if p[0] in GENES and p[1] is not None)
    for region in found:
        ring = np.array([(p["x"], p["y"]) for p in region["polygon"][0]])
        sides = np.concatenate([ring, np.roll(ring, -1, 0)], 1)
        turn = (sides[:, 2] - sides[:, 0]) * (np.roll(sides[:, 3], -1) - sides[:, 3]) - (sides[:, 3] - sides[:, 1]) * (np.roll(sides[:, 2], -1) - sides[:, 2])
        assert (turn > 0).all()  # convex
        centres = [{h: (x0 + (h[1] + (0.5 if h[0] % 2 else 0)) * SIZE * math.sqrt(3), y0 + h[0] * SIZE * 1.5) for h in p} for p in parts]
        holds = [[O._holds(ring, np.array(c)) for c in cs.values()] for cs in centres]
        assert sorted(all(h) for h in holds) == [False, True]
        corners = [(x + SIZE * math.cos(math.pi / 6 + k * math.pi / 3), y + SIZE * math.sin(math.pi / 6 + k * math.pi / 3)) for x, y in centres[[all(h) for h in holds].index(True)].values() for k in range(6)]
        assert {(round(x, 6), round(y, 6)) for x, y in ring} <= {(round(x, 6), round(y, 6)) for x, y in corners}
        assert all(((sides[:, 2] - sides[:, 0]) * (y - sides[:, 1]) - (sides[:, 3] - sides[:, 1]) * (x - sides[:, 0]) > -1e-6).all() for x, y in corners)


def test_mixtures_of_given_and_chosen_size(spark):
    r = np.random.default_rng(3)
    values = [*r.poisson(3, 300).tolist(), *r.poisson(40, 100).tolist()]
    df = spark.createDataFrame([("two", v) for v in values] + [("one", v) for v in r.poisson(5, 300).tolist()] + [("flat", 4)] * 7, "gene string, n bigint")
    got = {}
    for x in R.mixtures(df, None).orderBy("component").collect():
        got.setdefault(x.gene, []).append(x)
    weight, mean, variance = _plain_mixture(values, 2)
    assert np.allclose([(x.weight, x["mean"], x.variance) for x in got["two"]], list(zip(weight, mean, variance, strict=True)), rtol=1e-6)
    assert [len(got[g]) for g in ("one", "flat")] == [1, 1] and abs(got["flat"][0]["mean"] - 4) < 1e-9
    assert len(R.mixtures(df.where("gene = 'flat'"), 3).collect()) == 1


def test_no_points_no_regions(spark):
    assert R.called_regions(spark.createDataFrame([], "gene string, x double, y double"), GENES).isEmpty()
    assert R.called_regions(spark.createDataFrame([("c", 1.0, 1.0)], "gene string, x double, y double"), GENES).isEmpty()


def test_hulls_that_meet_are_one_region(spark):
    ring = lambda x, y: [[{"x": float(x + u), "y": float(y + v)} for u, v in ((0, 0), (2, 0), (2, 2), (0, 2))]]
    df = spark.createDataFrame([(1, ring(0, 0)), (2, ring(1, 1)), (3, ring(9, 9)), (4, ring(11, 11))], "part bigint, polygon array<array<struct<x:double,y:double>>>")
    got = sorted((r.region, r.a) for r in R.joined_hulls(df).select("region", O.area(F.col("polygon")).alias("a")).collect())
    assert got == [(1, 7.0), (3, 4.0), (3, 4.0)]  # what only shares a corner stays in two parts
