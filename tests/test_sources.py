"""Readers, writers, polygons and column rules on small files and tables with known answers."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.operators import cells
from tessella.operators import columns as C
from tessella.operators import labels as L
from tessella.operators import markers as M
from tessella.operators import polygons as P
from tessella.operators import quantiles as Q
from tessella.operators import rasters as T
from tessella.sources import readers, writers


def _ring(*corners):
    return [{"x": float(x), "y": float(y)} for x, y in corners]


def test_wide_counts_and_blank_rules(spark, tmp_path):
    (tmp_path / "counts.csv").write_text("cell,Actb,Blank-1,xBLANKx,Gapdh\n1,3,1,2,0\n2,0,0,0,5\n")
    long = readers.read_counts(spark, str(tmp_path / "counts.csv"))
    assert sorted(map(tuple, long.collect())) == [("1", "Actb", False, 3.0), ("1", "Blank-1", True, 1.0), ("1", "xBLANKx", True, 2.0), ("2", "Gapdh", False, 5.0)]
    native = readers.read_counts(spark, str(tmp_path / "counts.csv"), "cell", "start")
    assert {r.gene for r in native.where("is_blank").collect()} == {"Blank-1"}
    obs = spark.createDataFrame([("1", 9), ("3", 9)], "cell_id string, transcript_count int")
    assert {r.cell_id: r.transcript_count for r in readers.with_transcript_count(obs, native).collect()} == {"1": 5.0, "3": 0.0}


def test_boundaries_from_geojson_and_text(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    small = [[10, 10], [11, 10], [11, 11], [10, 10]]
    features = [
        {"type": "Feature", "properties": {"cell": 7, "z": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [[small], [square, [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]]}},
        {"type": "Feature", "properties": {"cell": 8}, "geometry": {"type": "Polygon", "coordinates": [small]}},
        {"type": "Feature", "properties": {"cell": 9}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    ]
    with gzip.open(tmp_path / "b.geojson.gz", "wt") as out:
        json.dump({"type": "FeatureCollection", "features": features}, out)
    found = readers.read_boundaries(spark, str(tmp_path / "b.geojson.gz")).select("entity_id", "z", G.area(F.col("polygon")).alias("a"))
    assert sorted(map(tuple, found.collect())) == [("7", 2, 15.0), ("8", 0, 0.5)]
    rows = readers.read_boundaries(spark, str(tmp_path / "b.geojson.gz"))
    writers.write_geometry(rows.withColumnRenamed("entity_id", "cell"), str(tmp_path / "out"))
    assert sorted(map(str, readers.read_boundaries(spark, str(tmp_path / "out")).collect())) == sorted(map(str, rows.collect()))
    writers.write_geometry(rows, str(tmp_path / "lines"), "geojson")
    line = json.loads(spark.read.text(str(tmp_path / "lines")).where("value LIKE '%\"7\"%'").first().value)
    assert line["properties"] == {"entity_id": "7", "z": 2} and line["geometry"]["coordinates"][0][0] == line["geometry"]["coordinates"][0][-1]


def test_parts_of_texts(spark):
    texts = ["POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)))", "POLYGON EMPTY", "POINT (1 2)", None]
    df = spark.createDataFrame([(t,) for t in texts], "geometry string")
    assert [r.n for r in df.select(F.size(G.parts_of_wkt(F.col("geometry"))).alias("n")).collect()] == [1, 2, 0, None, None]
    assert [r.a for r in P.largest_parts(df).select(G.area(F.col("polygon")).alias("a")).collect()] == [4.0, 15.0, None, None, None]


def test_points_on_sides_and_in_holes_are_outside(spark):
    shape = [_ring((0, 0), (6, 0), (6, 6), (3, 2), (0, 6)), _ring((1, 1), (2, 1), (2, 2), (1, 2))]
    polygons = spark.createDataFrame([(1, 0, shape), (2, 0, [_ring((0, 0), (300, 0), (300, 300), (0, 300))]), (3, 1, shape)], f"entity_id bigint, z int, polygon {G.POLYGON}")
    r = random.Random(1)
    points = [(0.5, 0.5), (0.0, 3.0), (3.0, 0.0), (1.5, 1.5), (1.0, 1.5), (3.0, 2.0), (3.0, 3.0), (6.0, 6.0), *((round(r.uniform(-1, 7), 3), round(r.uniform(-1, 7), 3)) for _ in range(300))]
    df = spark.createDataFrame([(i, x, y, 0) for i, (x, y) in enumerate(points)], "tx_id bigint, x double, y double, z int")
    got = {(p.tx_id, p.entity_id) for p in P.points_in_polygons(df, polygons).collect()}

    def brute(x, y):
        odd = False
        for ring in shape:
            for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
                if (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"]) and min(a["x"], b["x"]) <= x <= max(a["x"], b["x"]) and min(a["y"], b["y"]) <= y <= max(a["y"], b["y"]):
                    return False
                if (a["y"] > y) != (b["y"] > y) and x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                    odd = not odd
        return odd

    assert got == {(i, 1) for i, (x, y) in enumerate(points) if brute(x, y)} | {(i, 2) for i, (x, y) in enumerate(points) if x > 0 and y > 0}
    assert {i for i, e in got if e == 1 and i < 8} == {0}


def test_hulls_and_rectangles():
    points = np.array([(0, 0), (4, 0), (4, 2), (0, 2), (1, 1), (2, 0), (4, 1)], float)
    assert len(G.hull(points)) == 4 and G.ring_area(G.hull(points)) == 8 and G.shortest_over_longest(points) == 2.0
    turn = np.array([[0.6, -0.8], [0.8, 0.6]])
    assert abs(G.shortest_over_longest(points @ turn.T) - 2) < 1e-9 and G.shortest_over_longest(points[:2]) is None


def test_alignment_modes(spark):
    make = lambda rows: spark.createDataFrame([(i, 0, [_ring(*ring)]) for i, ring in rows], f"entity_id bigint, z int, polygon {G.POLYGON}")
    a = make([(1, [(0, 0), (4, 0), (4, 4), (0, 4)]), (2, [(10, 0), (12, 0), (12, 2), (10, 2)])])
    b = make([(5, [(2, 0), (8, 0), (8, 4), (2, 4)]), (6, [(10, 0), (12, 0), (12, 2), (10, 2)]), (7, [(50, 50), (51, 50), (51, 51)])])
    area = lambda mode: sorted((r.id_a, r.id_b, r.a) for r in P.aligned(a, b, mode).select("id_a", "id_b", G.area(F.col("polygon")).alias("a")).collect())
    assert area("larger") == [(1, 5, 24.0), (2, 6, 4.0)] and area("prefix1") == [(1, 5, 16.0), (2, 6, 4.0)]
    assert area("prefix2") == [(1, 5, 24.0), (2, 6, 4.0)] and area("intersection") == [(1, 5, 8.0), (2, 6, 4.0)]
    with pytest.raises(ValueError):
        P.aligned(a, b, "smaller")


def test_write_modes_and_upserts(spark, tmp_path):
    df = lambda *rows: spark.createDataFrame(list(rows), "k int, part string, v int")
    read = lambda p: sorted(((r.k, r.part, r.v) for r in spark.read.parquet(p).collect()), key=str)
    path = str(tmp_path / "t")
    writers.write(df((1, "a", 1)), path, "once")
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write(df((2, "a", 2)), path, "once")
    writers.write(df((2, "a", 2)), path, "skip")
    assert read(path) == [(1, "a", 1)]
    writers.write(df((2, "a", 2)), path)
    assert read(path) == [(2, "a", 2)]
    parts = str(tmp_path / "p")
    writers.write(df((1, "a", 1), (2, "b", 2)), parts, by=("part",))
    writers.write(df((3, "b", 3)), parts, by=("part",))
    assert read(parts) == [(1, "a", 1), (3, "b", 3)]
    up = str(tmp_path / "u")
    for rows in ([(1, "a", 1), (None, "n", 1), (2, "b", 2)], [(None, "n", 5), (2, "b", 7), (3, "c", 3)]):
        writers.upsert(df(*rows), up, ["k", "part"])
    assert read(up) == sorted([(1, "a", 1), (None, "n", 5), (2, "b", 7), (3, "c", 3)], key=str)
    assert [p.name for p in tmp_path.iterdir() if "-new-" in p.name or "-old-" in p.name] == []


def test_paths_matrices_maps_and_regions(spark, tmp_path):
    (tmp_path / "e" / "seg" / "region_0").mkdir(parents=True)
    (tmp_path / "e" / "seg" / "region_0" / "old.csv").write_text("a\n1\n")
    store = str(tmp_path)
    assert readers.region_folder(spark, store, "e", "region_0", "seg").endswith("e/seg/region_0") and readers.region_folder(spark, store, "e", "region_1", "seg").endswith("e/region_1/seg")
    with pytest.raises(FileNotFoundError):
        readers.region_folder(spark, store, "e", "region_1", "seg", must_exist=True)
    folder = f"{store}/e/seg/region_0"
    assert readers.resolve_file(spark, folder, "new.csv", "old.csv").endswith("old.csv") and readers.resolve_file(spark, folder, "x.csv", "y.csv").endswith("x.csv")
    assert [(r.a, r.region) for r in readers.read_regions(spark, f"{store}/e/seg/region_*/old.csv").collect()] == [(1, "region_0")]
    (tmp_path / "m.txt").write_text("2 0 1\n0 4 2\n\n0 0 1\n")
    m = readers.read_affine(spark, str(tmp_path / "m.txt"))
    assert m == [[2, 0, 1], [0, 4, 2], [0, 0, 1]] and C.inverse(m)[0] == [0.5, 0, -0.5]
    (tmp_path / "bad.txt").write_text("1 2\n")
    with pytest.raises(ValueError):
        readers.read_affine(spark, str(tmp_path / "bad.txt"))
    assert readers.read_affine(spark, str(tmp_path / "bad.txt"), strict=False) == [[1, 2]]
    (tmp_path / "map.json").write_text('{"A": "B"}')
    assert [tuple(r) for r in readers.read_renames(spark, str(tmp_path / "map.json")).collect()] == [("A", "B")] and readers.read_renames(spark, str(tmp_path / "no.json")).isEmpty()
    (tmp_path / "genes.txt").write_text("A\n\nB\nA\n")
    assert sorted(r.gene for r in readers.read_names(spark, str(tmp_path / "genes.txt")).collect()) == ["A", "B"]
    (tmp_path / "channels.csv").write_text('channel,frame,zPos,imageType,imageRegExp\nDAPI,"[0,1,2]","[1.5, 3]",mosaic,x\n')
    row = readers.read_channels(spark, str(tmp_path / "channels.csv")).first()
    assert row.frame == [0, 1, 2] and row.zPos == [1.5, 3] and row.pattern == "mosaic_x"
    (tmp_path / "names.csv").write_text("Name,title\nexp_region_0_lab,One\n")
    cells = spark.createDataFrame([("exp", "region_0"), ("exp", "region_1")], "experiment string, region string")
    assert [r.title for r in readers.with_names(cells, readers.naming_map(spark, str(tmp_path / "names.csv")), "lab").orderBy("region").collect()] == ["One", None]


def test_a_segmentation_by_its_specification(spark, tmp_path):
    (tmp_path / "cell_by_gene.csv").write_text("cell,Actb,blank1\nc1,2,1\n")
    (tmp_path / "cell_metadata.csv").write_text("cell,volume\nc1,5.5\nc2,1.0\n")
    spark.createDataFrame([("c1", 0, "POLYGON ((0 0, 1 0, 1 1, 0 0))")], "cell string, z int, geometry string").write.parquet(str(tmp_path / "boundaries.parquet"))
    spark.createDataFrame([(1, 0.5, 0.2, 0, "Actb")], "transcript_id bigint, x double, y double, z int, gene string").write.parquet(str(tmp_path / "transcripts.parquet"))
    out = readers.load_segmentation(spark, str(tmp_path), "polygons", {"experiment": "e", "region": "r"})
    assert out["boundaries"].count() == 1 and out["counts"].count() == 2 and out["transcripts"].columns[0] == "tx_id"
    assert sorted((r.cell_id, r["index"]) for r in out["cells"].collect()) == [("c1", "e.r.c1"), ("c2", "e.r.c2")]


def test_column_rules(spark):
    names = spark.createDataFrame([("x_UWA7648BICAN4x1", "x_CAHQ01-3"), ("x_a-b-CAH-X", "x_PUT-2-rest")], "e string, r string")
    assert names.select(C.lab_names(F.col("e"), "ucsd")[0]).first()[0] == "4x1" and names.select(C.lab_names(F.col("r"), "ucsd")[1]).first()[0] == "CAH"
    row = names.where("e LIKE '%CAH-X'").select(C.lab_names(F.col("e"), "salk")[0].alias("e"), C.lab_names(F.col("r"), "salk")[1].alias("r")).first()
    assert (row.e, row.r) == ("CAH", "PUT2")
    assert C.id_column(["x", "EntityID", "cell"]) == "cell" and C.id_column(["a", "b"], "b") == "b"
    with pytest.raises(ValueError):
        C.id_column(["a"])
    points = spark.createDataFrame([(1, "5"), (2, "7"), (3, None)], "tx_id int, cell_id string")
    assert [r.cell_id for r in C.unassigned(points, "cell_id", spark.createDataFrame([(5,)], "cell_id int")).orderBy("tx_id").collect()] == ["5", "-1", "-1"]
    assert [r[0] for r in points.orderBy("tx_id").select(C.soma_flag(points, "cell_id")).collect()] == [True, True, False]
    numbers = spark.createDataFrame([(0,), (1,), (None,)], "c int")
    assert [r[0] for r in numbers.select(C.soma_flag(numbers, "c")).collect()] == [False, True, False]
    cells = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, False)], "cell_id int, pass_qc boolean, doublet_bool boolean")
    assert [r.cell_id for r in C.passing(cells).collect()] == [2] and C.passing(cells.drop("pass_qc", "doublet_bool")).count() == 3
    found = C.confident(spark.createDataFrame([(0.125, 1.0, 0.6, 0), (1.0, 1.0, 0.5, 0), (1.0, 1.0, 0.9, 1)], "x double, y double, probability double, background int")).collect()
    assert [(r.x, r.y) for r in found] == [(0.12, 1.0)]
    channels = spark.createDataFrame([("b", 1), ("a", 2)], "channel string, n int")
    assert [r.n for r in C.channel_rows(channels, ["a", "b"]).orderBy("position").collect()] == [2, 1]
    with pytest.raises(ValueError):
        C.channel_rows(channels, ["c"])
    a, b = spark.createDataFrame([(0.125, 1.0, "p")], "x double, y double, t string"), spark.createDataFrame([(0.12, 1.0, 1), (0.121, 1.0, 2)], "x double, y double, n int")
    assert sorted(r.n for r in C.matched_coordinates(a, b).collect()) == [1, 2]
    user = C.with_user_columns(cells, spark.createDataFrame([("u", True)], "code string, pass_qc boolean"), spark.createDataFrame([("u", 2)], "code string, cell_id int"), "code", "cell_id")
    assert {r.cell_id: r.pass_qc_user for r in user.collect()} == {1: None, 2: True, 3: None}
    near = C.around_cell(spark.createDataFrame([(5.0, 5.0), (50.0, 5.0)], "x double, y double"), spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0)], "entity_id int, minx double, miny double, maxx double, maxy double"), 1)
    assert near.count() == 1


def test_order_statistics_of_whole_columns(spark):
    r = random.Random(5)
    values = [r.choice([r.gauss(0, 1), 7.0, 1e300, -1e-300]) for _ in range(500)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    plain = np.sort([v for v in values if v is not None and v == v])
    shares = [k / 499 for k in range(0, 500, 49)]
    for few in (Q.FEW, 1):  # brackets that are read out, and brackets that are cut again
        Q.FEW = few
        found = Q.places_of(df.withColumn("w", -F.col("v")), {"v": [(s, how) for s in shares for how in ("down", "up", "nearest")], "w": [(0.0, "down"), (0.3, "nearest")]})
        n, at = found["v"]
        assert n == 500 and all(at[q, how] == plain[{"down": int(q * 499), "up": min(499, int(np.ceil(q * 499))), "nearest": int(q * 499 + 0.5)}[how]] for q, how in at)
        assert found["w"] == (500, {(0.0, "down"): -plain[-1], (0.3, "nearest"): np.sort(-plain)[150]})
    Q.FEW = 1024
    assert np.allclose(Q.quantiles(df, "v", [0.0, 0.25, 0.5]), np.quantile(plain, [0.0, 0.25, 0.5])) and Q.quantiles(df.limit(0), "v", [0.5]) == [None]
    cells_ = spark.createDataFrame([(1, True, True, 5.0), (2, True, True, 3.0), (3, False, False, 4.0), (4, False, False, None), (5, True, True, None)], "cell_id int, pass_qc_pre boolean, pass_qc boolean, dapi double")
    assert {r.cell_id for r in cells.with_floor(cells_, "dapi", 0.5).where("pass_qc").collect()} == {1}
    assert cells.with_floor(cells_, "dapi", None).where("pass_qc").count() == cells.with_floor(cells_.where("pass_qc_pre"), "dapi", 0.5).where("pass_qc").count() == 3


def test_votes_samples_and_markers(spark):
    near = spark.createDataFrame([(1, 10, 0.0), (1, 11, 1.0), (1, 12, 2.0), (2, 10, 0.0)], "query_id int, ref_id int, distance double")
    labels = spark.createDataFrame([(10, "a"), (11, "b"), (12, "b")], "ref_id int, label string")
    best = {r.query_id: r.label for r in L.best_label(L.weighted_votes(near, labels), spark.createDataFrame([(1, "x"), (3, "y")], "query_id int, label string")).collect()}
    assert best == {1: "a", 2: "a", 3: "y"}
    rows = spark.createDataFrame([(i, "big" if i < 40 else "small") for i in range(45)], "id int, c string")
    assert L.sized_reference(rows, "c", "id", 10, 6).count() == 10 and L.balanced(rows, "c", "id").count() == 10
    assert L.capped_reference(rows, "id", 3, 7).count() == 7 and L.training_mask(rows, "id", 12).where("train").count() == 12
    q = spark.createDataFrame([(1, g, float(v)) for g, v in zip("abcdef", (9, 1, 8, 0, 7, 1), strict=True)] + [(2, g, float(v)) for g, v in zip("abcdef", (0, 8, 1, 9, 0, 8), strict=True)], "query_id int, gene string, value double")
    ref = spark.createDataFrame([("x", g, float(v)) for g, v in zip("abcdef", (8, 0, 9, 1, 8, 0), strict=True)] + [("y", g, float(v)) for g, v in zip("abcdef", (1, 9, 0, 8, 1, 9), strict=True)], "label string, gene string, mean double")
    votes = {r.query_id: (r.label, r.probability) for r in L.centroid_votes(q, ref, q.select("gene"), 20).collect()}
    assert votes == {1: ("x", 1.0), 2: ("y", 1.0)}
    counts = spark.createDataFrame([(i, "g1", 5.0 + i) for i in range(12)] + [(i, "g2", 1.0) for i in range(0, 24, 2)], "cell_id int, gene string, count double")
    spine = spark.createDataFrame([(i, i // 12) for i in range(24)], "cell_id int, cluster int")
    tested = M.one_against_rest(counts, spine)
    first = {r.cluster: (r.gene, r.significant) for r in tested.where("rank = 1").collect()}
    assert first[0] == ("g1", True) and M.one_against_rest(counts, spine, min_cells=13).isEmpty()
    auc = {(r.gene, r.a): r.auc for r in M.pairwise_auc(counts, spine).collect()}
    assert auc["g1", 0] == 1.0 and auc["g1", 1] == 0.0 and auc["g2", 0] == 0.5
    found = M.marker_genes(M.summarised(M.pairwise_auc(counts, spine), "auc")).collect()
    assert [(r.cluster, r.n_markers, r.genes) for r in found] == [(0, 1, ["g1"])]
    assert [r.gene for r in M.flat_top_genes(tested, 1).orderBy("position").collect()] == ["g1"] and M.joint_genes(tested, 2).count() == 2
    p = spark.createDataFrame([(0.0,), (1.959963985,), (-5.0,)], "z double").select(M.p_two_sided(F.col("z")).alias("p")).collect()
    assert np.allclose([r.p for r in p], [1.0, 0.05, 5.733e-7], rtol=1e-3)


def test_tissue_drops_small_parts_and_nests_json(spark):
    dense = [(x + 0.5, y + 0.5) for x in range(12) for y in range(12) for _ in range(4)] + [(40.5, 40.5)] * 4
    points = spark.createDataFrame(dense, "x double, y double")
    mask = T.tissue_mask(points, 1.0, 0.4, 100.0, 20.0)
    assert mask.select("component").distinct().count() == 1 and mask.where("row > 20").isEmpty() and 100 < mask.count() < 200
    core = T.tissue_mask(points, 1.0, 0.4, 100.0, 20.0, erosion=2.0)
    assert 0 < core.count() < mask.count()
    rows = spark.createDataFrame([("a", "x", 1, "s"), ("a", "y", 2, "t"), ("b", "x", 3, "u")], "e string, r string, n int, s string")
    assert {r.e: json.loads(r.json) for r in writers.nested_json(rows, ["e", "r"], ["n", "s"]).collect()}["a"] == [{"r": "x", "items": [{"n": 1, "s": "s"}]}, {"r": "y", "items": [{"n": 2, "s": "t"}]}]
    stack = spark.createDataFrame([(z, z * 10) for z in range(4)], "z bigint, v int")
    assert [(r.z, r.v) for r in T.padded_planes(stack, 1).orderBy("z").collect()] == [(0, 0), (1, 0), (2, 10), (3, 20), (4, 30), (5, 30)]
