"""Harmonising tables with copies."""

import random

from pyspark.sql import functions as F

from tessella.functions import overlay as O
from tessella.operators import harmony as H


def test_copies_are_met_once(spark, monkeypatch):
    r, shapes = random.Random(5), []
    for _ in range(8):
        x, y, w, h = r.randrange(10), r.randrange(10), r.randrange(2, 7), r.randrange(2, 7)
        ring = [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]
        shapes.append(([ring], frozenset((a, b) for a in range(x, x + w) for b in range(y, y + h))))
    ids = r.sample(range(40), 40)
    rows = [(i, 0, *shapes[k % 8]) for k, i in enumerate(ids)]
    cells = spark.createDataFrame([row[:3] for row in rows], "entity_id bigint, z int, polygon array<array<struct<x:double,y:double>>>")
    merged = {i: set(s) for i, _, _, s in rows}

    def pairs():
        share = lambda a, b: round(len(merged[a] & merged[b]) / min(len(merged[a]), len(merged[b])), 9)
        return sorted((-share(a, b), a, b) for a in merged for b in merged if a < b and merged[a] & merged[b])

    for _, a, b in pairs():
        if a in merged and b in merged and len(merged[a] & merged[b]) > 0.5 * min(len(merged[a]), len(merged[b])):
            keeps, goes = (a, b) if len(merged[a]) > len(merged[b]) else (b, a)
            merged[keeps] = merged[keeps] | merged.pop(goes)
    for _, a, b in pairs():
        large, small = (a, b) if len(merged[a]) > len(merged[b]) else (b, a)
        merged[large] = merged[large] - merged[small]
    met, plain = [], H.meeting
    monkeypatch.setattr(H, "meeting", lambda p, size=None: met.append(p.count()) or plain(p, size))
    got = H.harmonised(cells, min_distance=0.0, min_area=0.5)
    assert {x.entity_id: round(x.s) for x in got.select("entity_id", O.area(F.col("polygon")).alias("s")).collect()} == {i: len(s) for i, s in merged.items() if s}
    assert met[0] == len({s for _, s in shapes})  # 40 before


def test_copies_without_area_or_that_stay_are_kept(spark):
    square = [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 2.0}]]
    line = [[{"x": 9.0, "y": 9.0}, {"x": 11.0, "y": 9.0}, {"x": 9.0, "y": 9.0}]]
    cells = spark.createDataFrame([(1, 0, square), (2, 0, square), (3, 1, square), (4, 0, line), (5, 0, line)], "entity_id bigint, z int, polygon array<array<struct<x:double,y:double>>>")
    kept = lambda above: sorted(x.entity_id for x in H._one_of_copies(cells, above).select("entity_id").collect())
    assert kept(0.5) == [2, 3, 4, 5] and kept(1.0) == [1, 2, 3, 4, 5]
