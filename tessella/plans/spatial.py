"""Queries on polygons, hexagons, markers, votes and column rules, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators import columns as C
from tessella.operators import counts_model as K
from tessella.operators import embedding as E
from tessella.operators import harmony as H
from tessella.operators import labels as L
from tessella.operators import mapping as X
from tessella.operators import markers as M
from tessella.operators import outlines as Y
from tessella.operators import polygons as P
from tessella.operators import quantiles as Q
from tessella.operators import rasters as T
from tessella.operators import regions as Z
from tessella.operators import segments as V
from tessella.operators import space as S
from tessella.plans import roles as R
from tessella.plans.catalog import query, rounded
from tessella.sources import readers, writers
from tessella.sources.tables import shared_folder, table

# Polygons

_SIDES = "sides(ax, ay, ex, ey) AS (VALUES " + ", ".join(f"({a}, {b}, {c}, {d})" for ring in (R.OUTER, R.HOLE) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True)) + ")"
_INSIDE = f"""{_SIDES}, tested AS (SELECT tx_id, any_value(gene) AS gene, entity_id,
 count(*) FILTER ((y0 + ay > y) <> (y0 + ey > y) AND x < x0 + ax + (y - y0 - ay) * (ex - ax) / nullif(CAST(ey - ay AS DOUBLE), 0)) % 2 = 1 AS odd,
 bool_or((ex - ax) * (y - y0 - ay) = (ey - ay) * (x - x0 - ax) AND x BETWEEN x0 + least(ax, ex) AND x0 + greatest(ax, ex) AND y BETWEEN y0 + least(ay, ey) AND y0 + greatest(ay, ey)) AS touches
 FROM points p JOIN shapes s ON p.z = s.z AND x BETWEEN x0 AND x0 + 9 AND y BETWEEN y0 AND y0 + 9 CROSS JOIN sides GROUP BY tx_id, entity_id),
inside AS (SELECT tx_id, gene, entity_id FROM tested WHERE odd AND NOT touches)"""


@query(f"WITH {_INSIDE} SELECT entity_id, gene, count(*) AS n FROM inside GROUP BY ALL")
def cell_counts_polygons(spark, d):
    return S.counted_inside(R.points(spark, d), R.shapes(spark, d).select("entity_id", "z", "polygon"), ("z", "polygon"), ("gene",), P.points_in_polygons)


@query(f"WITH {_INSIDE} SELECT p.tx_id, coalesce(max(entity_id), -1) AS cell_id FROM points p LEFT JOIN inside i ON p.tx_id = i.tx_id GROUP BY p.tx_id")
def assigned_points_polygons(spark, d):
    p = R.points(spark, d)
    return S.assigned(p, R.shapes(spark, d).select("entity_id", "z", "polygon"), ("z", "polygon"), P.points_in_polygons)


@query("""SELECT entity_id, round(54 * 1.5 * (max(z) + 1), 6) AS volume, round(avg(x0) + 199 / 54, 6) AS center_x, round(avg(y0) + 198 / 54, 6) AS center_y, min(x0) AS min_x, min(y0) AS min_y, max(x0) + 9 AS max_x, max(y0) + 9 AS max_y,
round(42 / 54, 6) AS perimeter_area_ratio, round(54 / 68.5, 6) AS solidity, 1.0::DOUBLE AS anisotropy FROM shapes GROUP BY entity_id""")
def entity_metadata_polygons(spark, d):
    return rounded(P.entity_metadata(R.shapes(spark, d).select("entity_id", "z", "polygon")), 6, "volume", "center_x", "center_y", "perimeter_area_ratio", "solidity", "anisotropy")


# the corners of outlines are whole numbers, so their areas are numbers of unit squares, which SQL can count
_UNITS = """units AS (SELECT entity_id, z, x0 + i AS ux, y0 + j AS uy FROM outlines CROSS JOIN range(9) r(i) CROSS JOIN range(10) q(j) WHERE i < w AND j < h AND (j < b OR i < a) AND NOT (hole AND i = 1 AND j = 1)),
sizes AS (SELECT entity_id, CAST(count(*) AS DOUBLE) AS area FROM units GROUP BY 1)"""
_PAIRS = f"""{_UNITS}, planes AS (SELECT a.entity_id AS id_a, b.entity_id AS id_b, z, CAST(count(*) AS DOUBLE) AS area FROM units a JOIN (SELECT entity_id, z, ux + 2 AS ux, uy + 3 AS uy FROM units) b USING (z, ux, uy) GROUP BY ALL),
pairs AS (SELECT id_a, id_b, sum(planes.area) AS area, any_value(a.area) AS area_a, any_value(b.area) AS area_b FROM planes JOIN sizes a ON a.entity_id = id_a JOIN sizes b ON b.entity_id = id_b GROUP BY id_a, id_b),
first AS (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY area DESC, id_b) AS r FROM pairs), best AS (SELECT * FROM first WHERE r = 1 QUALIFY row_number() OVER (PARTITION BY id_b ORDER BY area DESC, id_a) = 1)"""


def _two(spark, d):
    """The outlines, and the same moved by (2, 3), as two segmentations."""
    one = R.outlines(spark, d).select("entity_id", "z", "polygon")
    return one, one.withColumn("polygon", G.moved(F.col("polygon"), 1.0, 0.0, 2.0, 0.0, 1.0, 3.0))


@query(f"WITH {_PAIRS} SELECT id_a, id_b, area, area_a, area_b FROM pairs")
def polygon_overlaps(spark, d):
    return rounded(P.overlapping_polygons(*_two(spark, d)), 6, "area", "area_a", "area_b")


def _aligned(spark, d, mode: str):
    found = P.aligned(*_two(spark, d), mode)
    return rounded(found.select("id_a", "id_b", "area", "z", O.area(F.col("polygon")).alias("polygon_area")), 6, "area", "polygon_area")


@query(f"WITH {_PAIRS} SELECT id_a, id_b, area, z, greatest(area_a, area_b) / 2 AS polygon_area FROM best JOIN outlines ON entity_id = CASE WHEN area_a >= area_b THEN id_a ELSE id_b END")
def aligned_larger(spark, d):
    return _aligned(spark, d, "larger")


@query(f"WITH {_PAIRS} SELECT id_a, id_b, area, z, area_a / 2 AS polygon_area FROM best JOIN outlines ON entity_id = id_a")
def aligned_first(spark, d):
    return _aligned(spark, d, "prefix1")


@query(f"WITH {_PAIRS} SELECT id_a, id_b, area, z, area_b / 2 AS polygon_area FROM best JOIN outlines ON entity_id = id_b")
def aligned_second(spark, d):
    return _aligned(spark, d, "prefix2")


@query(f"WITH {_PAIRS} SELECT best.id_a, best.id_b, best.area, z, planes.area AS polygon_area FROM best JOIN planes ON best.id_a = planes.id_a AND best.id_b = planes.id_b")
def aligned_intersection(spark, d):
    return _aligned(spark, d, "intersection")


@query(f"""WITH {_UNITS}, own AS (SELECT entity_id, z, count(*) AS n FROM units GROUP BY ALL),
met AS (SELECT entity_id, z, count(*) AS n FROM units JOIN (SELECT entity_id, z, ux + 2 AS ux, uy + 3 AS uy FROM units) USING (entity_id, z, ux, uy) GROUP BY ALL)
SELECT o.entity_id, o.z, CAST(coalesce(met.n, 0) AS DOUBLE) AS shared, CAST(2 * o.n - coalesce(met.n, 0) AS DOUBLE) AS joined, CAST(o.n - coalesce(met.n, 0) AS DOUBLE) AS rest FROM own o LEFT JOIN met ON o.entity_id = met.entity_id AND o.z = met.z""")
def polygon_overlays(spark, d):
    one, two = _two(spark, d)
    both = one.join(two.withColumnRenamed("polygon", "moved"), ["entity_id", "z"])
    of = lambda rule: F.round(O.parts_area(O.overlay(F.col("polygon"), F.col("moved"), rule)), 6)
    return both.select("entity_id", "z", of("intersection").alias("shared"), of("union").alias("joined"), of("difference").alias("rest"))


@query("SELECT entity_id, z, round(w * h + 3.0 * (w + h) + 16 * 2.25 * sin(pi() / 16), 6) AS area FROM outlines")
def buffered_boxes(spark, d):
    x, y = F.col("x0"), F.col("y0")
    boxes = R.outlines(spark, d).select("entity_id", "z", G.box(x, y, x + F.col("w"), y + F.col("h")).alias("polygon"))
    return rounded(boxes.select("entity_id", "z", O.parts_area(O.buffered(F.col("polygon"), 1.5)).alias("area")), 6, "area")


@query(f"SELECT entity_id, z, CASE WHEN hole THEN '{O.CROSSED}' END AS fault, CASE WHEN hole THEN 2 ELSE 1 END AS parts, CASE WHEN hole THEN w * h / 2.0::DOUBLE ELSE w * h END AS area FROM outlines")
def repaired_polygons(spark, d):
    corner = lambda x, y: F.struct((F.col("x0") + x).cast("double").alias("x"), (F.col("y0") + y).cast("double").alias("y"))
    none, w, h = F.lit(0), F.col("w"), F.col("h")
    twisted, plain = F.array(corner(none, none), corner(w, h), corner(w, none), corner(none, h)), F.array(corner(none, none), corner(w, none), corner(w, none), corner(w, h), corner(none, h), corner(none, none))
    rows = R.outlines(spark, d).select("entity_id", "z", F.array(F.when(F.col("hole"), twisted).otherwise(plain)).alias("polygon"))
    rows = rows.select("entity_id", "z", O.faults(F.col("polygon")).alias("fault"), O.repaired(F.col("polygon")).alias("whole"))
    return rounded(rows.select("entity_id", "z", "fault", F.size("whole").alias("parts"), O.parts_area(F.col("whole")).alias("area")), 6, "area")


@query(None)
def harmonised_outlines(spark, d):
    """Tested against a plain loop over unit squares: the order of merges and trims is no matter for SQL."""
    found = H.harmonised(R.outlines(spark, d), min_distance=0.0, min_area=4.0)
    return rounded(found.select("entity_id", "z", "area"), 6, "area")


@query(None)
def merged_outlines(spark, d):
    """Tested against a plain loop over unit squares."""
    found = H.merged_overlaps(R.outlines(spark, d), least=12.0)
    return rounded(found.select("entity_id", "z", "merged", O.area(F.col("polygon")).alias("area")), 6, "area")


@query("SELECT entity_id, z, 54.0::DOUBLE AS area, 2 AS rings FROM shapes")
def polygons_as_text(spark, d):
    read = R.shapes(spark, d).select("entity_id", "z", G.from_wkt(G.to_wkt(F.col("polygon"))).alias("polygon"))
    return read.select("entity_id", "z", F.round(G.area(F.col("polygon")), 6).alias("area"), F.size("polygon").alias("rings"))


@query("SELECT entity_id, k AS z, round(2 * x0 + 5, 6) AS min_x, round(3 * y0 - 1, 6) AS min_y, 324.0::DOUBLE AS area FROM (SELECT DISTINCT entity_id, x0, y0 FROM shapes) CROSS JOIN range(3) r(k)")
def replicated_polygons(spark, d):
    flat = R.shapes(spark, d).select("entity_id", "polygon").dropDuplicates(["entity_id"])
    m = G.measures(F.col("polygon"))
    out = P.replicated(flat, 3, (2.0, 0.0, 5.0, 0.0, 3.0, -1.0)).select("entity_id", F.col("z").cast("bigint").alias("z"), m["minx"].alias("min_x"), m["miny"].alias("min_y"), m["area"].alias("area"))
    return rounded(out, 6, "min_x", "min_y", "area")


@query("""SELECT DISTINCT entity_id FROM outlines s WHERE EXISTS (SELECT 1 FROM cells c WHERE x0 <= center_x * 5 + 1 AND center_x * 5 <= x0 + w AND y0 <= center_y * 5 + 1 AND center_y * 5 <= y0 + h
 AND (center_y * 5 <= y0 + b OR center_x * 5 <= x0 + a) AND NOT (hole AND center_x * 5 > x0 + 1 AND center_x * 5 + 1 < x0 + 2 AND center_y * 5 > y0 + 1 AND center_y * 5 + 1 < y0 + 2))""")
def shapes_in_regions(spark, d):
    x, y = F.col("center_x") * 5, F.col("center_y") * 5
    regions = R.cells(spark, d).select(G.box(x, y, x + 1, y + 1).alias("polygon"))
    return P.kept_by_regions(R.outlines(spark, d).select("entity_id", "polygon"), regions).select("entity_id").distinct()


# Hexagons, rasters and tiles

_HEXES = """b AS (SELECT min(x) - 1 AS x0, min(y) - 1 AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM points),
n AS (SELECT *, CAST(ceil((x1 - x0) / (10 * sqrt(3) * 0.5)) AS BIGINT) + 2 AS cols, CAST(ceil((y1 - y0) / 7.5) AS BIGINT) + 2 AS rows FROM b),
hexes AS (SELECT r * cols + c AS hex_id, r AS row, c AS col, x0 + (c + CASE WHEN r % 2 = 1 THEN 0.5 ELSE 0 END) * (10 * sqrt(3) * 0.5) AS cx, y0 + r * 7.5 AS cy, x0, y0, x1, y1 FROM (SELECT *, unnest(range(rows)) AS r FROM n) JOIN (SELECT unnest(range(cols)) AS c FROM n) ON true),
grid AS (SELECT * FROM hexes WHERE cx - 10 * sqrt(3) / 2 <= x1 AND cx + 10 * sqrt(3) / 2 >= x0 AND cy - 10 <= y1 AND cy + 10 >= y0)"""


def _hexes(spark, d):
    """Hexagons over the bounds of all points and one unit more, so that no point lies on a side: four numbers for the driver."""
    return P.hex_grid(spark, tuple(R.points(spark, d).agg(F.min("x") - 1, F.min("y") - 1, F.max("x") + 1, F.max("y") + 1).first()), 10.0, 0.5)


@query(f"WITH {_HEXES} SELECT hex_id, row, col, round(cx, 6) AS cx, round(cy, 6) AS cy, round(150 * sqrt(3), 6) AS area FROM grid")
def hex_grid(spark, d):
    rows = _hexes(spark, d)
    return rounded(rows.select("hex_id", "row", "col", "cx", "cy", G.area(F.col("polygon")).alias("area")), 6, "cx", "cy", "area")


@query(f"WITH {_HEXES} SELECT hex_id, gene, count(*) AS n FROM grid JOIN points ON abs(x - cx) < 5 * sqrt(3) AND abs(y - cy) + abs(x - cx) / sqrt(3) < 10 GROUP BY ALL")
def hex_gene_counts(spark, d):
    return P.hex_genes(R.points(spark, d), _hexes(spark, d), 10.0)


@query(None)
def called_regions(spark, d):
    """Tested against a plain computation: mixtures are fitted by steps."""
    genes = ["click", "purchase", "view"]
    found = Z.called_regions(R.points(spark, d), genes, size=8.0, components=2, agreement=0.6, least=3)
    return rounded(found.select("region", O.area(F.col("polygon")).alias("area"), F.size("polygon").alias("rings")), 6, "area")


_TILES = """n AS (SELECT CAST(ceil(max(y)) AS BIGINT) AS h, CAST(ceil(max(x)) AS BIGINT) AS w FROM points), rs AS (SELECT unnest(range(0, greatest(h - 32, 0) + 1, 24)) AS r FROM n UNION SELECT greatest(h - 32, 0) FROM n),
cs AS (SELECT unnest(range(0, greatest(w - 32, 0) + 1, 24)) AS c FROM n UNION SELECT greatest(w - 32, 0) FROM n), tiles AS (SELECT CAST(row_number() OVER (ORDER BY r, c) - 1 AS INTEGER) AS tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col FROM rs CROSS JOIN cs)"""


def _tiles(spark, d):
    tall, wide = R.points(spark, d).agg(F.ceil(F.max("y")), F.ceil(F.max("x"))).first()
    return S.tile_index(tall, wide, 32, 8, spark)


@query(f"WITH {_TILES}, pixels AS (SELECT DISTINCT CAST(floor(y) AS BIGINT) AS pr, CAST(floor(x) AS BIGINT) AS pc FROM points) SELECT tile_id, row, col FROM tiles WHERE EXISTS (SELECT 1 FROM pixels WHERE pr BETWEEN row AND row + 31 AND pc BETWEEN col AND col + 31)")
def tissue_tiles(spark, d):
    mask = R.points(spark, d).select(F.floor("y").alias("row"), F.floor("x").alias("col")).distinct()
    return T.selected_tiles(_tiles(spark, d), 32, "tissue_mask", mask=mask).select("tile_id", "row", "col")


@query(f"""WITH {_TILES}, pixels AS (SELECT CAST(floor(y) AS BIGINT) AS pr, CAST(floor(x) AS BIGINT) AS pc, count(*) AS n FROM points GROUP BY ALL)
SELECT pr AS row, pc AS col, round(avg(n + tile_id % 3), 6) AS value FROM pixels JOIN tiles ON pr BETWEEN row AND row + 31 AND pc BETWEEN col AND col + 31 GROUP BY ALL""")
def averaged_tiles(spark, d):
    pixels = R.points(spark, d).groupBy(F.floor("y").alias("row"), F.floor("x").alias("col")).agg(F.count("*").alias("n"))
    tiled = T.cut_tiles(pixels, _tiles(spark, d), 32).withColumn("value", F.col("n") + F.col("tile_id") % 3)
    return rounded(T.averaged_tiles(tiled), 6, "value")


@query("SELECT tx_id, z + 2 AS z FROM points UNION ALL SELECT tx_id, CAST(k AS BIGINT) FROM points, range(2) r(k) WHERE z = 0 UNION ALL SELECT tx_id, CAST(9 + k AS BIGINT) FROM points, range(2) r(k) WHERE z = 6")
def padded_planes(spark, d):
    return T.padded_planes(R.points(spark, d).select("tx_id", "z"), 2)


@query("""WITH v AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i, CAST(count(*) OVER () - 1 AS DOUBLE) AS m FROM points),
q AS (SELECT k, a.x + (b.x - a.x) * (k / 100.0 * a.m - a.i) AS q FROM range(100) r(k) JOIN v a ON a.i = floor(k / 100.0 * a.m) JOIN v b ON b.i = ceil(k / 100.0 * b.m)),
w AS (SELECT k, round(max(q) OVER last80 - min(q) OVER last80, 9) AS extent FROM q WINDOW last80 AS (ORDER BY k ROWS BETWEEN 79 PRECEDING AND CURRENT ROW)),
e AS (SELECT k FROM w WHERE k >= 79 ORDER BY extent, k LIMIT 1)
SELECT round((SELECT q FROM q WHERE q.k = greatest(0, e.k - 80)), 6) AS low, round((SELECT q FROM q WHERE q.k = e.k), 6) AS high FROM e""")
def tight_range(spark, d):
    low, high = Q.tight_range(R.points(spark, d), "x", 0.8)
    return rounded(spark.createDataFrame([(low, high)], "low double, high double"), 6, "low", "high")


# Ids, segmentations and small rules


@query("SELECT cell_id, CAST('13211045' || lpad(CAST(dense_rank() OVER (ORDER BY cell_id) - 1 AS VARCHAR), 11, '0') AS BIGINT) AS entity_id FROM cells")
def entity_ids(spark, d):
    return V.with_ids(R.cells(spark, d).select("cell_id"), "cell_id", "13211045").select("cell_id", "entity_id")


@query("SELECT tx_id, x, row_number() OVER (ORDER BY x NULLS FIRST, tx_id) - 1 AS drawn FROM points")
def draw_order(spark, d):
    return V.draw_order(R.points(spark, d).select("tx_id", "x"), "x", "tx_id")


@query("SELECT cell_id, CASE WHEN volume > 2000 THEN dapi END AS dapi, volume > 2000 AND dapi > 60 AS doublet FROM cells")
def doublet_flags(spark, d):
    cells = R.cells(spark, d).select("cell_id", "dapi", (F.col("volume") > 2000).alias("pass_qc"))
    return V.doublets(cells, "dapi", 60.0).select("cell_id", "dapi", "doublet")


@query("SELECT entity_id, z, (x0 + 20 * z) * 0.5 AS min_x, (y0 + h + 10 * z) * 0.5 AS max_y FROM outlines")
def placed_tiles(spark, d):
    rows = R.outlines(spark, d).select("entity_id", F.col("z").alias("tile_id"), "polygon")
    tiles = rows.select("tile_id", (F.col("tile_id") * 10).alias("row"), (F.col("tile_id") * 20).alias("col")).distinct()
    bounds = G.bounds(F.col("polygon"))
    return V.placed_tiles(rows, tiles, 0.5).select("entity_id", F.col("tile_id").alias("z"), bounds["minx"].alias("min_x"), bounds["maxy"].alias("max_y"))


@query("""WITH o AS (SELECT DISTINCT entity_id, x0, y0, w, h, a, b, hole, dense_rank() OVER (ORDER BY entity_id) - 1 AS n FROM outlines)
SELECT k * (SELECT count(*) FROM o) + n AS id, CAST('13211045' || lpad(CAST(n AS VARCHAR), 11, '0') AS BIGINT) AS entity_id, CAST(k AS INTEGER) AS z, (k + 1) * 1.5 AS level, 'cell' AS type,
 (w * b + a * (h - b) - CASE WHEN hole THEN 1 ELSE 0 END) / 4.0 AS area, (x0 - 4) / 2.0 AS min_x FROM o CROSS JOIN range(3) r(k)""")
def converted_outlines(spark, d):
    flat = R.outlines(spark, d).select("entity_id", "polygon").dropDuplicates(["entity_id"])
    rows = V.converted(flat, "13211045", 3, matrix=[[2.0, 0.0, 4.0], [0.0, 2.0, -6.0], [0.0, 0.0, 1.0]], harmonise=False)
    return rounded(rows.select("id", "entity_id", "z", "level", "type", O.area(F.col("polygon")).alias("area"), G.bounds(F.col("polygon"))["minx"].alias("min_x")), 6, "area", "min_x")


# Negative-binomial tests


@query(None)
def pseudobulk_tests(spark, d):
    """One cluster against another by donor; tested against a plain search for the largest likelihood."""
    cells = R.cells(spark, d).select("cell_id", "donor", F.col("cluster").cast("string").alias("cluster"))
    found = K.pseudobulk_tests(R.cell_gene(spark, d), cells, "donor", "cluster", ("0", "1"))
    return rounded(found, 4, "base_mean", "log2_fold_change", "error", "statistic", "p", "p_adj", "dispersion")


# Hierarchical mapping

# one round over all genes: the vote is the best correlation, which SQL can tell; the draws are tested against a plain walk


@query("""WITH m AS (SELECT cell_id, CAST(cluster % 2 AS VARCHAR) AS class, CAST(cluster AS VARCHAR) AS leaf FROM cells WHERE cell_id % 2 = 0), g AS (SELECT DISTINCT gene FROM cell_gene WHERE cell_id % 2 = 0),
v AS (SELECT g1.cell_id, g.gene, coalesce(c.count, 0) AS x FROM (SELECT DISTINCT cell_id FROM cell_gene) g1 CROSS JOIN g LEFT JOIN cell_gene c ON c.cell_id = g1.cell_id AND c.gene = g.gene),
a AS (SELECT class, gene, sum(x) / any_value(n) AS y FROM v JOIN m ON v.cell_id = m.cell_id JOIN (SELECT class, count(*) AS n FROM m GROUP BY 1) USING (class) GROUP BY ALL), b AS (SELECT class, leaf, gene, sum(x) / any_value(n) AS y FROM v JOIN m ON v.cell_id = m.cell_id JOIN (SELECT leaf, count(*) AS n FROM m GROUP BY 1) USING (leaf) GROUP BY ALL),
one AS (SELECT v.cell_id, class, corr(x, y) AS r FROM v JOIN a ON v.gene = a.gene GROUP BY v.cell_id, class QUALIFY row_number() OVER (PARTITION BY v.cell_id ORDER BY round(corr(x, y), 9) DESC, class) = 1),
two AS (SELECT v.cell_id, b.class, leaf, corr(x, y) AS r FROM v JOIN one ON v.cell_id = one.cell_id JOIN b ON v.gene = b.gene AND b.class = one.class GROUP BY v.cell_id, b.class, leaf QUALIFY row_number() OVER (PARTITION BY v.cell_id ORDER BY round(corr(x, y), 9) DESC, leaf) = 1)
SELECT cell_id, class AS class_name, 1.0::DOUBLE AS class_probability, leaf AS leaf_name, 1.0::DOUBLE AS leaf_probability FROM two""")
def mapped_cells(spark, d):
    values = _values(spark, d)
    members = R.cells(spark, d).where("cell_id % 2 = 0").select("cell_id", (F.col("cluster") % 2).alias("class"), F.col("cluster").alias("leaf"))
    model = X.fitted(values.where("cell_id % 2 = 0"), members, ["class", "leaf"], per_pair=100)
    return X.mapped(values, model, rounds=1, share=1.0)


# Masks and their polygons

_PARTS = """RECURSIVE cell AS (SELECT DISTINCT CAST(floor(y / 5) AS BIGINT) AS row, CAST(floor(x / 5) AS BIGINT) AS col FROM points), reach AS (SELECT row, col, row * 2147483648 + col AS component FROM cell
 UNION SELECT c.row, c.col, r.component FROM reach r JOIN cell c ON abs(c.row - r.row) + abs(c.col - r.col) = 1), part AS (SELECT row, col, min(component) AS label FROM reach GROUP BY ALL)"""


def _part_polygons(spark, d):
    mask = R.points(spark, d).select(F.floor(F.col("y") / 5).alias("row"), F.floor(F.col("x") / 5).alias("col")).distinct()
    return Y.mask_polygons(S.mask_components(mask).withColumnRenamed("component", "label"), 5.0)


@query(f"WITH {_PARTS} SELECT label, 25.0::DOUBLE * count(*) AS area, 5.0::DOUBLE * min(col) AS min_x, 5.0::DOUBLE * max(row) + 5 AS max_y FROM part GROUP BY label")
def mask_polygons(spark, d):
    bounds = G.bounds(F.col("polygon"))
    return rounded(_part_polygons(spark, d).select("label", O.area(F.col("polygon")).alias("area"), bounds["minx"].alias("min_x"), bounds["maxy"].alias("max_y")), 6, "area")


@query(f"WITH {_PARTS} SELECT label, row, col FROM part")
def filled_polygons(spark, d):
    return Y.filled(_part_polygons(spark, d), 5.0)


# Markers

_DENSE = """sizes AS (SELECT cluster, count(*) AS n1 FROM cells GROUP BY 1), genes AS (SELECT DISTINCT gene FROM cell_gene), dense AS (SELECT c.cell_id, c.cluster, genes.gene, coalesce(count, 0) AS v FROM cells c CROSS JOIN genes LEFT JOIN cell_gene g ON g.cell_id = c.cell_id AND g.gene = genes.gene)"""
_TESTED = f"""{_DENSE}, ranked AS (SELECT gene, cluster, v, rank() OVER (PARTITION BY gene ORDER BY v) + (count(*) OVER (PARTITION BY gene, v) - 1) / 2 AS midrank, count(*) OVER (PARTITION BY gene) AS n FROM dense),
ties AS (SELECT gene, sum(t * t * t - t) AS ties FROM (SELECT gene, v, CAST(count(*) AS DOUBLE) AS t FROM dense GROUP BY ALL) GROUP BY gene),
s AS (SELECT gene, cluster, sum(midrank) AS r, any_value(n) AS n FROM ranked GROUP BY ALL),
u AS (SELECT s.gene, s.cluster, r - n1 * (n1 + 1) / 2 AS u, n1, n - n1 AS n2, n, ties FROM s JOIN sizes ON s.cluster = sizes.cluster JOIN ties ON s.gene = ties.gene),
z AS (SELECT gene, cluster, u, (u - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))) AS z FROM u),
m AS (SELECT gene, sizes.cluster, avg(v) FILTER (dense.cluster = sizes.cluster) AS a, avg(v) FILTER (dense.cluster <> sizes.cluster) AS b FROM dense CROSS JOIN sizes GROUP BY ALL),
e AS (SELECT z.gene, z.cluster, u, z, 1 / (1 + 0.5 * abs(z) / sqrt(2)) AS t, log2((a + 1e-9) / (b + 1e-9)) AS lfc FROM z JOIN m ON z.gene = m.gene AND z.cluster = m.cluster),
p AS (SELECT *, t * exp(-z * z / 2 - 1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (-0.18628806 + t * (0.27886807 + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 + t * 0.17087277))))))))) AS p FROM e)"""


@query(f"""WITH {_TESTED}, k AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY p) AS k, count(*) OVER (PARTITION BY cluster) AS n FROM p),
q AS (SELECT *, least(1, min(p * n / k) OVER (PARTITION BY cluster ORDER BY k DESC)) AS p_adj FROM k)
SELECT gene, cluster, u, round(z, 6) AS z, round(p, 6) AS p, round(p_adj, 6) AS p_adj, round(lfc, 6) AS log2_fold_change, p_adj < 0.05 AND abs(lfc) > 0.05 AS significant,
 row_number() OVER (PARTITION BY cluster ORDER BY p_adj < 0.05 AND abs(lfc) > 0.05 DESC, p_adj, lfc DESC, gene) AS rank FROM q""")
def marker_tests(spark, d):
    out = M.one_against_rest(R.cell_gene(spark, d), R.cells(spark, d), min_cells=1, lfc_at=0.05, log1p=False)
    return rounded(out, 6, "z", "p", "p_adj", "log2_fold_change")


@query(f"""WITH {_TESTED}, b AS (SELECT *, least(1, p * count(*) OVER (PARTITION BY cluster)) AS p_adj FROM p), c AS (SELECT *, p_adj < 0.5 AND abs(lfc) > 0.01 AS s FROM b)
SELECT cluster, count(*) AS genes_tested, count(*) FILTER (s) AS significant_genes, count(*) FILTER (s AND lfc > 0) AS upregulated, count(*) FILTER (s AND lfc < 0) AS downregulated,
 coalesce(array_to_string((list(gene ORDER BY p_adj, lfc DESC, gene) FILTER (s AND lfc > 0))[:5], ','), '') AS top_up, coalesce(array_to_string((list(gene ORDER BY p_adj, lfc DESC, gene) FILTER (s AND lfc < 0))[:5], ','), '') AS top_down FROM c GROUP BY cluster""")
def marker_summary(spark, d):
    out = M.one_against_rest(R.cell_gene(spark, d), R.cells(spark, d), min_cells=1, correction="bonferroni", p_at=0.5, lfc_at=0.01, log1p=False)
    return M.marker_summary(out, 5).withColumns({c: F.array_join(c, ",") for c in ("top_up", "top_down")})


_AUC = f"{_DENSE}, auc AS (SELECT a.gene, a.cluster AS a, b.cluster AS b, avg(CASE WHEN a.v > b.v THEN 1.0 WHEN a.v = b.v THEN 0.5 ELSE 0.0 END) AS auc FROM dense a JOIN dense b ON a.gene = b.gene AND a.cluster <> b.cluster GROUP BY ALL)"


@query(f"WITH {_AUC} SELECT gene, a, b, round(auc, 6) AS auc FROM auc")
def pairwise_auc(spark, d):
    return rounded(M.pairwise_auc(R.cell_gene(spark, d), R.cells(spark, d)), 6, "auc")


@query(f"""WITH {_AUC}, r AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY round(auc, 9) DESC) AS rank FROM auc)
SELECT gene, a AS cluster, round(min(auc), 6) AS "min", round(avg(auc), 6) AS mean, round(median(auc), 6) AS median, round(max(auc), 6) AS "max", min(rank) AS min_rank FROM r GROUP BY ALL""")
def auc_summary(spark, d):
    pairs = M.pairwise_auc(R.cell_gene(spark, d), R.cells(spark, d)).withColumn("auc", F.round("auc", 9))
    return rounded(M.summarised(pairs, "auc"), 6, "min", "mean", "median", "max")


# Singular vectors


def _values(spark, d):
    return R.cell_gene(spark, d).select("cell_id", "gene", F.col("count").alias("value"))


@query("SELECT a.gene AS gene_a, b.gene AS gene_b, round(sum(a.count * b.count), 4) AS value FROM cell_gene a JOIN cell_gene b ON a.cell_id = b.cell_id GROUP BY ALL")
def gene_products(spark, d):
    values = _values(spark, d)
    genes = E.gene_names(values)
    name = lambda i: F.get(F.array(*map(F.lit, genes)), i)
    rows = E.gram(values, genes).select("i", F.posexplode("sums").alias("j", "value")).where("value <> 0")
    return rounded(rows.select(name(F.col("i")).alias("gene_a"), name(F.col("j")).alias("gene_b"), "value"), 4, "value")


# all components together keep the length of a cell's vector, and of its distance from the mean, which SQL can tell


@query("SELECT cell_id, round(sum(count * count), 3) AS norm FROM cell_gene GROUP BY cell_id")
def svd_norms(spark, d):
    values = _values(spark, d)
    scores = E.projected(values, E.fitted(values, None), whitened=False)
    return scores.select("cell_id", F.round(F.aggregate("scores", F.lit(0.0), lambda z, x: z + x * x), 3).alias("norm"))


@query("""WITH n AS (SELECT count(*) AS n FROM cells), m AS (SELECT gene, sum(count) / any_value(n) AS mean FROM cell_gene, n GROUP BY gene)
SELECT c.cell_id, round(sum((coalesce(count, 0) - mean) * (coalesce(count, 0) - mean)), 3) AS norm FROM cells c CROSS JOIN m LEFT JOIN cell_gene g ON g.cell_id = c.cell_id AND g.gene = m.gene GROUP BY c.cell_id""")
def pca_norms(spark, d):
    values, spine = _values(spark, d), R.cells(spark, d)
    scores = E.projected(values, E.fitted(values, None, spine, centred=True), False, spine)
    return scores.select("cell_id", F.round(F.aggregate("scores", F.lit(0.0), lambda z, x: z + x * x), 3).alias("norm"))


@query(None)
def reference_scores(spark, d):
    """All cells in the whitened space of those of three clusters; tested against NumPy."""
    values = _values(spark, d)
    model = E.fitted(values, 10, R.cells(spark, d).where("cluster > 0"))
    return E.projected(values, model).select("cell_id", F.transform("scores", lambda x: F.round(x, 6)).alias("scores"))


# Votes and references

_WEIGHTED = """w AS (SELECT query_id, label, sum(1 - coalesce(distance / nullif(far, 0), 0) + 1e-9) AS w FROM (SELECT *, max(distance) OVER (PARTITION BY query_id) AS far FROM votes) GROUP BY ALL),
share AS (SELECT query_id, label, round(w / sum(w) OVER (PARTITION BY query_id), 9) AS score FROM w)"""


def _weighted(spark, d):
    rows = R.votes(spark, d)
    labels = rows.select("ref_id", "label").distinct()
    return rounded(L.weighted_votes(rows.select("query_id", "ref_id", "distance"), labels), 9, "score")


@query(f"WITH {_WEIGHTED} SELECT query_id, label, round(score, 6) AS score FROM share")
def weighted_votes(spark, d):
    return rounded(_weighted(spark, d), 6, "score")


@query(f"WITH {_WEIGHTED}, top AS (SELECT * FROM share QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) = 1) SELECT o_orderkey AS query_id, coalesce(label, o_custkey % 25) AS label, round(score, 6) AS score FROM orders LEFT JOIN top ON o_orderkey = query_id")
def best_labels(spark, d):
    known = table(spark, d, "orders").select(F.col("o_orderkey").alias("query_id"), (F.col("o_custkey") % 25).alias("label"))
    return rounded(L.best_label(_weighted(spark, d), known), 6, "score")


@query("""WITH n AS (SELECT cell_hint % 40 AS cluster, gene AS label, count(*) AS n FROM points WHERE gene <> 'click' GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY cluster) AS c, sum(n) OVER (PARTITION BY label) AS l FROM n)
SELECT cluster, label, n, round(greatest(n / c, n / l), 6) AS share FROM s WHERE c >= 15""")
def confusion_transfer(spark, d):
    pairs = R.points(spark, d).select((F.col("cell_hint") % 40).alias("cluster"), F.when(F.col("gene") != "click", F.col("gene")).alias("label"))
    return rounded(L.confusion_transfer(pairs, 15), 6, "share")


# Columns and keyed joins


@query("SELECT cell_id, 'exp1' AS experiment, 'region_0' AS region_name, concat('exp1.region_0.', cell_id) AS index FROM cells")
def tagged_cells(spark, d):
    return C.tagged(R.cells(spark, d).select("cell_id"), {"experiment": "exp1", "region_name": "region_0"})


@query("SELECT tx_id, CASE gene WHEN 'click' THEN 'Actb' WHEN 'view' THEN 'Gapdh' ELSE gene END AS gene, 2 * x + y - 3 AS x, 0.5 * y + 1 AS y FROM points")
def renamed_points(spark, d):
    rows = C.renamed_genes(R.points(spark, d).select("tx_id", "gene", "x", "y"), {"click": "Actb", "view": "Gapdh"})
    return C.affine(rows, [[2.0, 1.0, -3.0], [0.0, 0.5, 1.0], [0.0, 0.0, 1.0]])


@query("SELECT tx_id, round(x, 6) AS x, round(y, 6) AS y FROM points")
def inverted_points(spark, d):
    m = [[2.0, 1.0, -3.0], [0.5, 4.0, 1.0], [0.0, 0.0, 1.0]]
    return rounded(C.affine(C.affine(R.points(spark, d).select("tx_id", "x", "y"), m), C.inverse(m)), 6, "x", "y")


@query("SELECT p_partkey, contains(lower(g), 'blank') AS any_case, starts_with(g, 'Blank-') AS at_start, contains(g, 'Blank-') AS inside FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Blank-' WHEN 1 THEN 'xBlank-' WHEN 2 THEN 'blank' ELSE '' END || p_brand AS g FROM part)")
def blank_rules(spark, d):
    key = F.col("p_partkey")
    g = F.concat(F.when(key % 4 == 0, "Blank-").when(key % 4 == 1, "xBlank-").when(key % 4 == 2, "blank").otherwise(""), "p_brand")
    return table(spark, d, "part").select(key, *[C.is_blank(g, rule).alias(name) for rule, name in (("any", "any_case"), ("start", "at_start"), ("inside", "inside"))])


@query("SELECT c.cell_id, donor, n, volume FROM cells c LEFT JOIN (SELECT cell_hint AS cell_id, count(*) AS n FROM points GROUP BY 1) s ON c.cell_id = s.cell_id")
def joined_signals(spark, d):
    signals = R.points(spark, d).groupBy("cell_hint").agg(F.count("*").alias("n"))
    return C.with_signals(R.cells(spark, d), signals, "cell_id", "left", "cell_hint").select("cell_id", "donor", "n", "volume")


@query("SELECT cell_id, volume * 2 AS volume, region FROM cells")
def merged_back(spark, d):
    old = R.cells(spark, d).select("cell_id", "volume", "region", F.lit(1).alias("area_old"))
    return C.merged_back(R.cells(spark, d).select("cell_id", (F.col("volume") * 2).alias("volume")), old, "cell_id")


@query("SELECT cell_id, coalesce((SELECT sum(count) FROM cell_gene g WHERE g.cell_id = c.cell_id AND gene = 'Brand#13'), 0)::DOUBLE AS value FROM cells c")
def gene_vector(spark, d):
    return C.obs_or_gene(R.cells(spark, d), R.cell_gene(spark, d), "Brand#13")


@query("SELECT cell_id, round(volume * (dapi + 1), 6) AS alpha, round((1 - volume) * (dapi + 1), 6) AS beta FROM cells")
def beta_parameters(spark, d):
    alpha, beta = C.alpha_beta(F.col("volume"), F.col("dapi") + 1)
    return rounded(R.cells(spark, d).select("cell_id", alpha.alias("alpha"), beta.alias("beta")), 6, "alpha", "beta")


@query("SELECT DISTINCT gene FROM cell_gene WHERE gene IN (SELECT p_brand FROM part WHERE p_size = 7) AND gene IN (SELECT p_brand FROM part WHERE p_size = 9)")
def shared_genes(spark, d):
    of = lambda size: table(spark, d, "part").where(F.col("p_size") == size).select(F.col("p_brand").alias("gene"))
    return C.shared_genes(R.cell_gene(spark, d), of(7), of(9))


@query("SELECT c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def stacked_tables(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), "c_mktsegment")
    return C.stacked([a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), "s_acctbal")])


# Sources and sinks


def _path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT CAST(cell_id AS VARCHAR) AS cell_id, gene, contains(lower(gene), 'blank') AS is_blank, CAST(count AS DOUBLE) AS count FROM cell_gene")
def counts_from_csv(spark, d):
    path = _path(spark, "wide") + ".csv"
    wide = R.cell_gene(spark, d).groupBy(F.col("cell_id").alias("cell")).pivot("gene").agg(F.sum("count")).fillna(0)  # genes are columns of the file
    writers.write(wide, path, "once", kind="csv")
    return readers.read_counts(spark, path)


@query("SELECT CAST(entity_id AS VARCHAR) AS entity_id, z, 54.0::DOUBLE AS area FROM shapes")
def boundaries_from_parquet(spark, d):
    path = _path(spark, "boundaries")
    writers.write_geometry(R.shapes(spark, d).select(F.col("entity_id").alias("cell"), "z", "polygon"), path)
    return readers.read_boundaries(spark, path).select("entity_id", "z", F.round(G.area(F.col("polygon")), 6).alias("area"))


@query("SELECT region, donor, CASE WHEN count(*) FILTER (cluster > 1) > 0 THEN count(*) FILTER (cluster > 1) + 1000 ELSE count(*) END AS n FROM cells GROUP BY ALL")
def upserted_table(spark, d):
    path = _path(spark, "metrics")
    of = lambda rows, more: rows.groupBy("region", "donor").agg((F.count("*") + more).alias("n"))
    cells = R.cells(spark, d)
    writers.upsert(of(cells, 0), path, ["region", "donor"])
    writers.upsert(of(cells.where("cluster > 1"), 1000), path, ["region", "donor"])
    return spark.read.parquet(path)


@query("SELECT CAST(cluster AS INTEGER) AS cluster, cell_id, volume FROM cells")
def group_files(spark, d):
    path = _path(spark, "groups")
    writers.write_groups(R.cells(spark, d).select("cluster", "cell_id", "volume"), path, "cluster")
    return spark.read.option("header", True).schema("cell_id bigint, volume double, cluster int").csv(path)


@query("SELECT p.tx_id, gene, coalesce(c, -1) AS cell_id FROM points p LEFT JOIN (SELECT tx_id, cell_hint AS c FROM points WHERE z = 3) a ON p.tx_id = a.tx_id")
def transcripts_out(spark, d):
    path, p = _path(spark, "transcripts"), R.points(spark, d)
    writers.write_transcripts(p.select("tx_id", "gene"), p.where("z = 3").select("tx_id", F.col("cell_hint").alias("cell_id")), path)
    return spark.read.option("header", True).schema("tx_id bigint, gene string, cell_id bigint").csv(path)
