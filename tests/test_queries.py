"""Every registered query of the library against its SQL, and operators on small tables with known answers."""

import glob
import os

import duckdb
import pytest

from tessella.operators import cells, labels, markers, space
from tessella.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object).where(pdf.notna(), None)
    plain = lambda v: round(float(v), 6) if not isinstance(v, (str, bool, type(None))) and hasattr(v, "__float__") else v
    return sorted(str([plain(v) for v in row]) for row in pdf.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), oracle.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_points_on_a_boundary_are_outside(spark):
    points = spark.createDataFrame([(0, 0.0, 0.5, 0), (1, 0.5, 0.5, 0), (2, 0.5, 0.5, 9)], "tx_id bigint, x double, y double, z int")
    boxes = spark.createDataFrame([(1, 0, 0.0, 0.0, 1.0, 1.0), (2, 0, 0.25, 0.25, 40.0, 40.0)], "entity_id bigint, z int, minx double, miny double, maxx double, maxy double")
    joined = space.points_in_boxes(points, boxes)
    assert sorted((r.tx_id, r.entity_id) for r in joined.collect()) == [(1, 1), (1, 2)]
    assert sorted(map(tuple, space.last_assignment(points, joined).collect())) == [(0, -1), (1, 2), (2, -1)]


def test_ring_with_a_notch(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    df = spark.createDataFrame([(ring, 2.0, 2.0), (ring, 1.0, 1.0)], "ring array<struct<x:double,y:double>>, px double, py double")
    from pyspark.sql import functions as F

    out = df.select(space.inside_ring(F.col("px"), F.col("py"), F.col("ring")).alias("inside"), space.ring_sums(F.col("ring"))[0].alias("area")).collect()
    assert [(r.inside, r.area) for r in out] == [(False, 10.0), (True, 10.0)]


def test_metrics_of_the_fixture_and_of_an_empty_cell(spark):
    counts = spark.createDataFrame([("c1", "g0", False, 10.0), ("c1", "g1", False, 5.0), ("c1", "b0", True, 1.0)], "cell_id string, gene string, is_blank boolean, count double")
    spine = spark.createDataFrame([("c1", 100.0), ("c2", 0.0)], "cell_id string, volume double")
    out = {r.cell_id: (r.n_count, r.n_feature, r.n_blank, r.count_per_volume) for r in cells.qc_metrics(counts, spine).collect()}
    assert out == {"c1": (15.0, 2, 1.0, 0.15), "c2": (0.0, 0, 0.0, None)}


def test_hex_density_overrides_count(spark):
    hexes = spark.createDataFrame([(1, 100, 0.1), (2, 10, 10.0)], "q int, tz_count int, density double")
    assert {r.q: r.filtered for r in space.hex_qc(hexes, 50, 1.0).collect()} == {1: True, 2: False}
    assert {r.q: r.filtered for r in space.hex_qc(hexes, 50).collect()} == {1: False, 2: True}
    assert not any(r.filtered for r in space.hex_qc(hexes).collect())


def test_gate_keeps_equal_and_null_scores(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("A", 0.9), ("B", 0.3), ("A", 0.5), ("A", None)], "label string, score double")
    assert [r[0] for r in df.select(labels.gated(F.col("label"), F.col("score"), 0.5)).collect()] == ["A", "unknown", "A", "A"]


def test_empty_tables(spark):
    counts = spark.createDataFrame([], "cell_id string, gene string, is_blank boolean, count double")
    spine = spark.createDataFrame([], "cell_id string, volume double, cluster int")
    assert cells.library_normalised(counts).isEmpty() and cells.group_stats(counts, spine).isEmpty()
    assert markers.rank_sums(counts, spine).isEmpty()
    assert space.mask_components(spark.createDataFrame([], "row bigint, col bigint")).isEmpty()
