"""Numbers, ids and the schema of segmentations."""

import datetime

import pytest
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators import segments as S


def _box(x, y, s):
    return [[{"x": float(x + u * s), "y": float(y + v * s)} for u, v in ((0, 0), (1, 0), (1, 1), (0, 1))]]


def test_numbers_and_ids(spark):
    df = spark.createDataFrame([(i * 7 % 100, str(i % 3)) for i in range(100)] + [(None, "x")], "k int, s string").repartition(6)
    got = {r.number: r.k for r in S.numbered(df, [F.col("k").asc()]).collect()}
    assert got == {0: None} | {i + 1: i for i in range(100)} and S.numbered(df.limit(0), [F.col("k").asc()]).isEmpty()
    assert S.id_prefix(datetime.datetime(2024, 2, 1, 3, 4, 5, tzinfo=datetime.UTC)) == "13211045"
    ids = sorted((r.s, r.entity_id) for r in S.with_ids(df.where("k < 5 OR k IS NULL"), "k", "13211045").collect() if r.k is not None)
    assert sorted(i for _, i in ids) == [1321104500000000000 + n for n in range(5)]
    assert S.with_ids(df, "k", "13211045").where("k IS NULL").first().entity_id is None and S.with_ids(df.unionByName(df), "k", "1").count() == 202
    drawn = S.draw_order(spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0), (4, 5.0)], "id int, v double"), "v", "id")
    assert {r.id: r.drawn for r in drawn.collect()} == {2: 0, 3: 1, 1: 2, 4: 3}


def test_flat_polygons_become_a_segmentation(spark):
    bow = [[{"x": 80.0, "y": 0.0}, {"x": 90.0, "y": 10.0}, {"x": 90.0, "y": 0.0}, {"x": 80.0, "y": 10.0}]]
    rows = [(5, _box(0, 0, 10)), (7, _box(1, 1, 3)), (6, _box(30, 0, 6)), (8, bow), (9, None), (10, _box(60, 60, 1))]
    df = spark.createDataFrame([(i, p, "x") for i, p in rows], f"entity_id bigint, polygon {G.POLYGON}, id string")
    matrix = [[2.0, 0.0, 4.0], [0.0, 2.0, -6.0], [0.0, 0.0, 1.0]]
    out = S.converted(df, "13211045", planes=3, matrix=matrix, min_distance=0, min_area=2).cache()
    got = sorted((r.id, r.entity_id % 10**10, r.z, r.level, r.type, r.parent_id, round(r.a, 9), r.b) for r in out.select("*", O.area(F.col("polygon")).alias("a"), G.bounds(F.col("polygon"))["minx"].alias("b")).collect())
    want = [(3 * z + k, k, z, (z + 1) * 1.5, "cell", None, a, b) for z in range(3) for k, (a, b) in enumerate([(25.0, -2.0), (9.0, 13.0), (12.5, 38.0)])]
    assert got == want  # 7 went into 5, 10 is too small
    plain = S.converted(df, "1", planes=1, harmonise=False)
    assert plain.count() == 5 and S.converted(df.limit(0), "1").isEmpty()


def test_tiles_and_doublets(spark):
    tiles = spark.createDataFrame([(0, 0, 0), (1, 10, 20)], "tile_id int, row int, col int")
    placed = S.placed_tiles(spark.createDataFrame([(1, _box(1, 2, 1), "a"), (9, _box(0, 0, 1), "b"), (0, None, "c")], f"tile_id int, polygon {G.POLYGON}, name string"), tiles, 0.5)
    got = {r.name: r.polygon for r in placed.collect()}
    assert set(got) == {"a", "c"} and got["c"] is None and (got["a"][0][0]["x"], got["a"][0][0]["y"]) == (10.5, 6.0)
    cells = spark.createDataFrame([(1, True, 0.9), (2, True, 0.5), (3, False, 0.9), (4, None, 0.9), (5, True, None), (6, True, float("nan"))], "cell_id int, pass_qc boolean, score double")
    assert sorted((r.cell_id, r.score, r.doublet) for r in S.doublets(cells, "score", 0.5).collect()) == [(1, 0.9, True), (2, 0.5, False), (3, None, False), (4, None, False), (5, None, False), (6, None, False)]


def test_a_matrix_without_an_inverse(spark):
    df = spark.createDataFrame([(1, _box(0, 0, 10))], f"entity_id bigint, polygon {G.POLYGON}")
    with pytest.raises(Exception):
        S.converted(df, "1", matrix=[[0.0, 0.0, 0.0]] * 3, harmonise=False)
