"""The registered queries of the library and the SQL that checks them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators import cells as C
from tessella.operators import graphs as H
from tessella.operators import labels as L
from tessella.operators import markers as M
from tessella.operators import neighbours as N
from tessella.operators import rasters as T
from tessella.operators import space as S
from tessella.plans import roles as R
from tessella.plans import spatial  # noqa: F401 - registers its queries
from tessella.plans.catalog import ALL, Query
from tessella.plans.catalog import query as _query
from tessella.plans.catalog import rounded as _rounded
from tessella.sources.tables import table

FLAGSHIP = "cell_counts_polygons"

# Points, polygons and counts


@_query("SELECT entity_id, gene, count(*) AS n FROM points p JOIN boxes b ON p.z = b.z AND x > minx AND x < maxx AND y > miny AND y < maxy GROUP BY ALL")
def cell_counts(spark, d):
    return S.counted_inside(R.points(spark, d), R.boxes(spark, d), ("z", *S.BOUNDS), ("gene",), S.points_in_boxes)


@_query("SELECT tx_id, coalesce(max(entity_id), -1) AS cell_id FROM points p LEFT JOIN boxes b ON p.z = b.z AND x > minx AND x < maxx AND y > miny AND y < maxy GROUP BY tx_id")
def assigned_points(spark, d):
    p = R.points(spark, d)
    return S.assigned(p, R.boxes(spark, d), ("z", *S.BOUNDS), S.points_in_boxes)


_GENES = [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]


@_query("SELECT c.cell_id" + "".join(f", coalesce(sum(count) FILTER (gene = '{g}'), 0) AS \"{g[6:]}\"" for g in _GENES).replace('AS "', 'AS "b') + " FROM cells c LEFT JOIN cell_gene g ON c.cell_id = g.cell_id GROUP BY c.cell_id")
def count_matrix(spark, d):
    wide = C.count_matrix(R.cell_gene(spark, d), R.cells(spark, d), _GENES)
    return wide.select("cell_id", *[F.col(f"`{g}`").alias(f"b{g[6:]}") for g in _GENES])


@_query("SELECT entity_id, z, (maxx - minx) * (maxy - miny) AS area, 2 * (maxx - minx + maxy - miny) AS perimeter, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM boxes")
def ring_measures(spark, d):
    area, perimeter, cx, cy = S.ring_sums(S.box_ring())
    return _rounded(R.boxes(spark, d).select("entity_id", "z", area.alias("area"), perimeter.alias("perimeter"), cx.alias("cx"), cy.alias("cy")), 6, "area", "perimeter", "cx", "cy")


@_query("""WITH l AS (SELECT entity_id, z, (z + 1) * 1.5 AS level, (maxx - minx) * (maxy - miny) AS area, (minx + maxx) / 2 AS cx, minx, maxx FROM boxes),
d AS (SELECT *, level - lag(level, 1, 0) OVER (PARTITION BY entity_id ORDER BY z) AS depth FROM l)
SELECT entity_id, CAST(sum(area * depth) AS DOUBLE) AS volume, avg(cx) AS center_x, min(minx) AS min_x, max(maxx) AS max_x FROM d GROUP BY entity_id""")
def entity_metadata(spark, d):
    area, _, cx, _ = S.ring_sums(S.box_ring())
    rows = R.boxes(spark, d).select("entity_id", "z", "minx", "maxx", area.alias("area"), cx.alias("cx"), ((F.col("z") + 1) * 1.5).alias("level"))
    depth = F.col("level") - F.lag("level", 1, 0.0).over(Window.partitionBy("entity_id").orderBy("z"))
    return rows.withColumn("depth", depth).groupBy("entity_id").agg(F.sum(F.col("area") * F.col("depth")).alias("volume"), F.avg("cx").alias("center_x"), F.min("minx").alias("min_x"), F.max("maxx").alias("max_x"))


_SHIFTED = "shifted AS (SELECT entity_id, z, minx + 2 AS minx, miny + 3 AS miny, maxx + 2 AS maxx, maxy + 3 AS maxy FROM boxes)"
_OVERLAPS = f"{_SHIFTED}, pairs AS (SELECT a.entity_id AS id_a, b.entity_id AS id_b, sum((least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * (least(a.maxy, b.maxy) - greatest(a.miny, b.miny))) AS area FROM boxes a JOIN shifted b ON a.z = b.z AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy GROUP BY ALL)"


def _shifted(spark: SparkSession, d: str) -> DataFrame:
    return R.boxes(spark, d).withColumns({c: F.col(c) + (2 if c.endswith("x") else 3) for c in ("minx", "miny", "maxx", "maxy")})


@_query(f"WITH {_OVERLAPS} SELECT * FROM pairs")
def segmentation_overlaps(spark, d):
    return S.overlapping_boxes(R.boxes(spark, d), _shifted(spark, d))


@_query(f"""WITH {_OVERLAPS}, a AS (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY area DESC, id_b) AS r FROM pairs),
b AS (SELECT *, row_number() OVER (PARTITION BY id_b ORDER BY area DESC, id_a) AS r2 FROM a WHERE r = 1) SELECT id_a, id_b, area FROM b WHERE r2 = 1""")
def segmentation_alignment(spark, d):
    return S.aligned_boxes(R.boxes(spark, d), _shifted(spark, d))


@_query("SELECT DISTINCT a.entity_id AS id_a, b.entity_id AS id_b FROM boxes a JOIN boxes b ON a.z = b.z AND a.entity_id < b.entity_id AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy")
def self_overlaps(spark, d):
    return S.overlapping_boxes(R.boxes(spark, d), R.boxes(spark, d)).where("id_a < id_b").select("id_a", "id_b")


@_query("SELECT tx_id, CASE WHEN cell_hint IN (SELECT cell_id FROM cells WHERE dapi > 50) THEN cell_hint ELSE -1 END AS cell_id FROM points")
def unassigned_points(spark, d):
    keep = R.cells(spark, d).where("dapi > 50").select(F.col("cell_id").alias("cell_hint"), F.lit(True).alias("keep"))
    return R.points(spark, d).join(keep, "cell_hint", "left").select("tx_id", F.when(F.col("keep"), F.col("cell_hint")).otherwise(-1).alias("cell_id"))


@_query("SELECT entity_id, z + k AS z FROM boxes CROSS JOIN range(3) r(k)")
def replicated_planes(spark, d):
    return R.boxes(spark, d).select("entity_id", F.explode(F.sequence(F.col("z").cast("bigint"), F.col("z").cast("bigint") + 2)).alias("z"))


# Quality control and normalisation

_METRICS = """m AS (SELECT c.cell_id, volume, coalesce(sum(count) FILTER (NOT is_blank), 0) AS n_count, count(*) FILTER (NOT is_blank AND count <> 0) AS n_feature,
 coalesce(sum(count) FILTER (is_blank), 0) AS n_blank FROM cells c LEFT JOIN cell_gene g ON c.cell_id = g.cell_id GROUP BY ALL)"""


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return C.qc_metrics(R.cell_gene(spark, d), R.cells(spark, d).select("cell_id", "volume"))


@_query(f"WITH {_METRICS} SELECT *, round(n_count / volume, 6) AS count_per_volume FROM m")
def qc_metrics(spark, d):
    return _rounded(_metrics(spark, d), 6, "count_per_volume")


_PRE = "p AS (SELECT *, volume BETWEEN 500 AND 9000 AND n_count >= 100 AS pass_qc_pre FROM m)"


@_query(f"""WITH {_METRICS}, {_PRE}, q AS (SELECT quantile_cont(volume, 0.05) AS v0, quantile_cont(volume, 0.95) AS v1, quantile_cont(n_count, 0.05) AS c0, quantile_cont(n_count, 0.95) AS c1 FROM p WHERE pass_qc_pre)
SELECT cell_id, n_count, pass_qc_pre, pass_qc_pre AND volume BETWEEN v0 AND v1 AND n_count BETWEEN c0 AND c1 AS pass_qc FROM p, q""")
def filtered_cells(spark, d):
    return C.filter_cells(_metrics(spark, d), {"volume": (500, 9000), "n_count": (100, None)}, ["volume", "n_count"], 0.05, 0.95).select("cell_id", "n_count", "pass_qc_pre", "pass_qc")


@_query(f"""WITH {_METRICS}, {_PRE}, f AS (SELECT dapi, row_number() OVER (ORDER BY dapi) - 1 AS i, count(*) OVER () AS n FROM p JOIN cells c ON p.cell_id = c.cell_id WHERE NOT pass_qc_pre),
q AS (SELECT max(dapi) AS least FROM f WHERE i = floor(0.4 * (n - 1) + 0.5)) SELECT p.cell_id, pass_qc_pre, pass_qc_pre AND dapi >= coalesce(least, dapi) AS pass_qc FROM p JOIN cells c ON p.cell_id = c.cell_id CROSS JOIN q""")
def nearest_floor(spark, d):
    rows = _metrics(spark, d).join(R.cells(spark, d).select("cell_id", "dapi"), "cell_id")
    rows = rows.withColumn("pass_qc_pre", C.within({"volume": (500, 9000), "n_count": (100, None)})).withColumn("pass_qc", F.col("pass_qc_pre"))
    return C.with_floor(rows, "dapi", 0.4).select("cell_id", "pass_qc_pre", "pass_qc")


@_query("SELECT median(volume) * 3 AS volume_max, greatest(median(dapi) * 2, 90) AS dapi_max FROM cells")
def median_caps(spark, d):
    return R.cells(spark, d).agg((F.median("volume") * 3).alias("volume_max"), F.greatest(F.median("dapi") * 2, F.lit(90.0)).alias("dapi_max"))


@_query("SELECT g.cell_id, gene, round(count / volume, 6) AS value FROM cell_gene g JOIN cells c ON g.cell_id = c.cell_id")
def volume_normalised(spark, d):
    return _rounded(C.volume_normalised(R.cell_gene(spark, d), R.cells(spark, d)), 6, "value")


_LOGGED = "t AS (SELECT cell_id, sum(count) AS total FROM cell_gene GROUP BY 1), v AS (SELECT g.cell_id, gene, ln(1 + count * (SELECT median(total) FROM t) / total) AS value FROM cell_gene g JOIN t ON g.cell_id = t.cell_id)"


@_query(f"WITH {_LOGGED} SELECT cell_id, gene, round(value, 6) AS value FROM v")
def library_normalised(spark, d):
    return _rounded(C.library_normalised(R.cell_gene(spark, d)), 6, "value")


@_query(f"""WITH {_LOGGED}, n AS (SELECT count(*) AS n FROM cells), s AS (SELECT gene, sum(value) / any_value(n) AS mean, sqrt((sum(value * value) - sum(value) * sum(value) / any_value(n)) / (any_value(n) - 1)) AS sd FROM v, n GROUP BY gene)
SELECT c.cell_id, s.gene, round(least((coalesce(value, 0) - mean) / sd, 10), 4) AS z FROM cells c CROSS JOIN s LEFT JOIN v ON v.cell_id = c.cell_id AND v.gene = s.gene""")
def scaled_features(spark, d):
    return _rounded(C.scaled(C.library_normalised(R.cell_gene(spark, d)), R.cells(spark, d)), 4, "z")


@_query("WITH n AS (SELECT cluster, count(*) AS n FROM cells GROUP BY 1) SELECT c.cluster, gene, round(count(*) FILTER (count > 0) / any_value(n), 6) AS share_expressing, round(sum(count) / any_value(n), 6) AS mean FROM cell_gene g JOIN cells c ON g.cell_id = c.cell_id JOIN n ON n.cluster = c.cluster GROUP BY ALL")
def dotplot_stats(spark, d):
    return _rounded(C.group_stats(R.cell_gene(spark, d), R.cells(spark, d)), 6, "share_expressing", "mean")


@_query("WITH k AS (SELECT gene FROM cell_gene GROUP BY 1 HAVING count(*) >= 90), g AS (SELECT * FROM cell_gene WHERE gene IN (FROM k)) SELECT cell_id, gene, count FROM g WHERE cell_id IN (SELECT cell_id FROM g GROUP BY 1 HAVING count(*) >= 20)")
def supported_counts(spark, d):
    return C.min_support(R.cell_gene(spark, d), 90, 20).select("cell_id", "gene", "count")


@_query("SELECT * FROM (SELECT cell_id, region, count(*) OVER (PARTITION BY region) AS n FROM cells) WHERE n >= 15")
def large_groups(spark, d):
    return R.cells(spark, d).select("cell_id", "region").withColumn("n", F.count("*").over(Window.partitionBy("region"))).where("n >= 15")


# Bins and rasters

_BINS = "o AS (SELECT min(x) AS x0, min(y) AS y0 FROM points), bins AS (SELECT CAST(floor((y - y0) / 10) AS BIGINT) AS row, CAST(floor((x - x0) / 10) AS BIGINT) AS col, count(*) AS n FROM points, o GROUP BY ALL)"


@_query(f"WITH {_BINS} SELECT * FROM bins")
def raster_bins(spark, d):
    return S.raster_bins(R.points(spark, d), 10)


_HEX = f"""c AS (SELECT gene, (x * {math.sqrt(3) / 3!r} - y / 3) / 12 AS q, y * {2 / 3!r} / 12 AS r FROM points), f AS (SELECT gene, q, r, -q - r AS s, floor(q + 0.5) AS fq, floor(r + 0.5) AS fr, floor(-q - r + 0.5) AS fs FROM c),
e AS (SELECT *, abs(fq - q) AS dq, abs(fr - r) AS dr, abs(fs - s) AS ds FROM f), h AS (SELECT gene, CAST(CASE WHEN dq > dr AND dq > ds THEN -fr - fs ELSE fq END AS BIGINT) AS q, CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -fq - fs ELSE fr END AS BIGINT) AS r FROM e),
hexes AS (SELECT q, r, count(*) AS tz_count, count(DISTINCT gene) AS n_genes, count(*) / {1.5 * math.sqrt(3) * 144!r} AS density FROM h GROUP BY ALL)"""


@_query(f"WITH {_HEX} SELECT q, r, tz_count, n_genes, round(density, 6) AS density FROM hexes")
def hex_bins(spark, d):
    return _rounded(S.hex_bins(R.points(spark, d), 12), 6, "density")


@_query(f"WITH {_HEX} SELECT q, r, NOT (density >= 0.5) AS filtered FROM hexes")
def hex_qc(spark, d):
    return S.hex_qc(S.hex_bins(R.points(spark, d), 12), min_count=50, min_density=0.5).select("q", "r", "filtered")


_WEIGHTS = [math.exp(-0.5 * (k / 1.5) ** 2) for k in range(-6, 7)]
_KERNEL = "kernel AS (SELECT * FROM (VALUES " + ", ".join(f"({k - 6}, {w / sum(_WEIGHTS)!r}::DOUBLE)" for k, w in enumerate(_WEIGHTS)) + ") t(k, w))"
_SMOOTH = f"{_BINS}, {_KERNEL}, smooth AS (SELECT row + a.k AS row, col + b.k AS col, sum(n * a.w * b.w) AS value FROM bins, kernel a, kernel b GROUP BY ALL)"
_MASK = f"{_SMOOTH}, mask AS (SELECT row, col FROM smooth WHERE value >= 5)"


@_query(f"WITH {_SMOOTH} SELECT row, col, round(value, 6) AS value FROM smooth")
def smoothed_density(spark, d):
    return _rounded(S.smoothed(S.raster_bins(R.points(spark, d), 10), 1.5), 6, "value")


def _mask(spark: SparkSession, d: str) -> DataFrame:
    return S.smoothed(S.raster_bins(R.points(spark, d), 10), 1.5).where("value >= 5").select("row", "col")


_CROSS = "(VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) o(a, b)"


@_query(f"WITH {_MASK}, wide AS (SELECT DISTINCT row + a AS row, col + b AS col FROM mask, {_CROSS}) SELECT row, col FROM (SELECT row + a AS row, col + b AS col FROM wide, {_CROSS}) GROUP BY ALL HAVING count(*) = 5")
def closed_mask(spark, d):
    return S.closed(_mask(spark, d))


@_query(f"WITH {_MASK} SELECT row, col FROM (SELECT row + a AS row, col + b AS col FROM mask, {_CROSS}) GROUP BY ALL HAVING count(*) = 5")
def eroded_mask(spark, d):
    return S.eroded(_mask(spark, d))


@_query("""WITH RECURSIVE cell AS (SELECT DISTINCT CAST(floor(y / 5) AS BIGINT) AS row, CAST(floor(x / 5) AS BIGINT) AS col FROM points), reach AS (SELECT row, col, row * 2147483648 + col AS component FROM cell
 UNION SELECT c.row, c.col, r.component FROM reach r JOIN cell c ON abs(c.row - r.row) + abs(c.col - r.col) = 1) SELECT row, col, min(component) AS component FROM reach GROUP BY ALL""")
def mask_components(spark, d):
    p = R.points(spark, d)
    return S.mask_components(p.select(F.floor(F.col("y") / 5).alias("row"), F.floor(F.col("x") / 5).alias("col")).distinct())


@_query("""WITH n AS (SELECT CAST(ceil(max(y)) AS BIGINT) AS h, CAST(ceil(max(x)) AS BIGINT) AS w FROM points), r AS (SELECT unnest(range(0, greatest(h - 32, 0) + 1, 24)) AS r FROM n UNION SELECT greatest(h - 32, 0) FROM n),
c AS (SELECT unnest(range(0, greatest(w - 32, 0) + 1, 24)) AS c FROM n UNION SELECT greatest(w - 32, 0) FROM n) SELECT CAST(row_number() OVER (ORDER BY r, c) - 1 AS INTEGER) AS tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col FROM r CROSS JOIN c""")
def tile_index(spark, d):
    tall, wide = R.points(spark, d).agg(F.ceil(F.max("y")), F.ceil(F.max("x"))).first()
    return S.tile_index(tall, wide, 32, 8, spark).select("tile_id", "row", "col")


@_query("""WITH p AS (SELECT CAST(floor(y / 20) AS BIGINT) AS row, CAST(floor(x / 20) AS BIGINT) AS col, z, count(*) AS value FROM points GROUP BY ALL)
SELECT row, col, max(value) AS value FROM p WHERE z > (SELECT min(z) FROM p) AND z < (SELECT max(z) FROM p) GROUP BY ALL""")
def projected_planes(spark, d):
    stack = R.points(spark, d).groupBy(F.floor(F.col("y") / 20).alias("row"), F.floor(F.col("x") / 20).alias("col"), "z").agg(F.count("*").alias("value"))
    return T.projected(stack)


# Labels

_ROLES = "r AS (SELECT vec_id, cluster, CASE WHEN is_query = 0 THEN label END AS label FROM labelled)"


def _with_reference(spark: SparkSession, d: str) -> DataFrame:
    return R.labelled(spark, d).select("vec_id", "cluster", F.when(F.col("is_query") == 0, F.col("label")).alias("label"))


@_query(f"""WITH {_ROLES}, s AS (SELECT cluster, count(label) AS n_ref, count(*) - count(label) AS n_query FROM r GROUP BY 1), k AS (SELECT cluster, label, count(*) AS k FROM r WHERE label IS NOT NULL GROUP BY ALL),
t AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY k DESC, label) = 1)
SELECT s.cluster, CASE WHEN k / n_ref >= 0.17 AND n_ref >= 5 AND n_query >= 5 THEN CAST(label AS VARCHAR) ELSE 'unknown' END AS label, n_ref, n_query FROM s LEFT JOIN t ON s.cluster = t.cluster""")
def transferred_labels(spark, d):
    return L.transfer_by_proportion(_with_reference(spark, d), 0.17, 5, 5)


@_query(f"WITH {_ROLES}, n AS (SELECT cluster, label, count(*) AS n FROM r WHERE label IS NOT NULL GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS a, n / sum(n) OVER (PARTITION BY label) AS b FROM n) SELECT cluster, label, n, round(a, 6) AS by_cluster, round(b, 6) AS by_label, round(greatest(a, b), 6) AS strength FROM s")
def confusion_shares(spark, d):
    return _rounded(L.confusion(_with_reference(spark, d)), 6, "by_cluster", "by_label", "strength")


@_query("SELECT o_orderkey AS id, CASE WHEN score IS NOT NULL AND score < 0.3 THEN 'unknown' ELSE o_orderpriority END AS label FROM (SELECT *, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 100 / 100 END AS score FROM orders)")
def gated_labels(spark, d):
    key = F.col("o_orderkey")
    score = F.when(key % 5 > 0, key % 100 / 100)
    return table(spark, d, "orders").select(key.alias("id"), L.gated(F.col("o_orderpriority"), score, 0.3).alias("label"))


@_query("""WITH s AS (SELECT o_orderkey AS id, o_orderstatus AS major, o_orderpriority AS minor, o_orderkey % 100 / 100 AS a, o_orderkey % 97 / 97 AS b FROM orders), p AS (SELECT *, a > 0.4 AS x FROM s),
q AS (SELECT *, x AND count(*) FILTER (x) OVER (PARTITION BY major) >= 100 AS y FROM p), t AS (SELECT *, y AND b > 0.5 AS u FROM q) SELECT id, u AND count(*) FILTER (u) OVER (PARTITION BY minor) >= 50 AS pass FROM t""")
def hierarchical_gate(spark, d):
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(key.alias("id"), F.col("o_orderstatus").alias("major"), F.col("o_orderpriority").alias("minor"), (key % 100 / 100).alias("major_score"), (key % 97 / 97).alias("minor_score"))
    return L.hierarchical_gate(rows, [("major", 0.4, 100), ("minor", 0.5, 50)]).select("id", "pass")


_NEAR = """pairs AS (SELECT q.vec_id AS query_id, r.vec_id AS ref_id, r.label, round(list_sum(list_transform(list_zip(q.embedding, r.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), 9) AS distance
 FROM labelled q CROSS JOIN labelled r WHERE q.is_query = 1 AND r.is_query = 0), near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, ref_id) AS rank FROM pairs QUALIFY rank <= 5)"""


def _near(spark: SparkSession, d: str) -> DataFrame:
    rows = R.labelled(spark, d)
    return L.nearest(rows.where("is_query = 1"), rows.where("is_query = 0"), 5)


@_query(f"WITH {_NEAR} SELECT query_id, ref_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM near")
def nearest_neighbours(spark, d):
    return _rounded(_near(spark, d).select("query_id", "ref_id", "rank", "distance"), 6, "distance")


@_query(f"WITH {_NEAR} SELECT query_id, ref_id, label, rank, round(distance, 6) AS distance FROM near")
def indexed_neighbours(spark, d):
    """By inverted lists, of which all are looked into, so that the result is exact; the recall of fewer probes is tested."""
    rows = R.labelled(spark, d)
    index, centres = N.indexed(rows.where("is_query = 0"))
    return _rounded(N.search(rows.where("is_query = 1"), index, centres, 5, len(centres)), 6, "distance")


@_query(None)
def neighbour_communities(spark, d):
    """Communities of the graph of nearest neighbours; tested against all partitions of small graphs and planted groups."""
    rows = R.labelled(spark, d)
    index, centres = N.indexed(rows)
    edges = H.neighbour_edges(N.search(rows, index, centres, 6, 4))
    return H.communities(rows.select(F.col("vec_id").alias("id"), F.lit(0).alias("scope")), edges).select("id", "community")


@_query(f"WITH {_NEAR}, n AS (SELECT query_id, label, count(*) AS n FROM near GROUP BY ALL) SELECT query_id, label, n / sum(n) OVER (PARTITION BY query_id) AS share FROM n QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1")
def voted_labels(spark, d):
    return L.vote(_near(spark, d))


@_query("SELECT cluster, label, n FROM (SELECT cluster, label, count(*) AS n FROM labelled GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) = 1")
def majority_labels(spark, d):
    n = R.labelled(spark, d).groupBy("cluster", "label").agg(F.count("*").alias("n"))
    return M.top_each(n, "cluster", [F.desc("n"), F.col("label")], 1).drop("rank")


@_query("SELECT c_custkey, c_mktsegment FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey * 2654435761 % 4294967296, c_custkey) <= 40")
def sampled_each(spark, d):
    return L.sample_each(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey", 40)


@_query("""WITH n AS (SELECT cell_hint AS a, CAST(floor(x / 10) AS BIGINT) AS b, count(*) AS n FROM points GROUP BY ALL), s AS (SELECT *, n / (sum(n) OVER (PARTITION BY a) + sum(n) OVER (PARTITION BY b) - n) AS score FROM n),
f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) = 1) SELECT a, b, n, round(score, 6) AS score FROM f QUALIFY row_number() OVER (PARTITION BY b ORDER BY score DESC, a) = 1 AND score >= 0.001""")
def jaccard_matches(spark, d):
    pairs = R.points(spark, d).select(F.col("cell_hint").alias("a"), F.floor(F.col("x") / 10).alias("b"))
    return _rounded(L.jaccard_matches(pairs, 0.001), 6, "score")


@_query("SELECT 'shared' AS kind, gene FROM (SELECT p_brand AS gene FROM part WHERE p_size < 3 INTERSECT SELECT p_brand FROM part WHERE p_size > 48) UNION ALL SELECT 'either', gene FROM (SELECT p_brand AS gene FROM part WHERE p_size < 3 UNION SELECT p_brand FROM part WHERE p_size > 48) UNION ALL SELECT 'left only', gene FROM (SELECT p_brand AS gene FROM part WHERE p_size < 2 EXCEPT SELECT p_brand FROM part WHERE p_size > 48)")
def gene_sets(spark, d):
    genes = lambda where: table(spark, d, "part").where(where).select(F.col("p_brand").alias("gene"))
    a, b = genes("p_size < 3"), genes("p_size > 48")
    named = lambda kind, df: df.select(F.lit(kind).alias("kind"), "gene")
    return named("shared", a.intersect(b)).unionByName(named("either", a.union(b).distinct())).unionByName(named("left only", genes("p_size < 2").subtract(b)))


@_query("SELECT c_custkey AS id, 'customer' AS modality, c_mktsegment AS segment, NULL AS balance FROM customer UNION ALL SELECT s_suppkey, 'supplier', NULL, s_acctbal FROM supplier")
def joined_modalities(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("modality"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("modality"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


# Markers


@_query("""WITH sizes AS (SELECT cluster, count(*) AS n1 FROM cells GROUP BY 1), genes AS (SELECT DISTINCT gene FROM cell_gene), dense AS (SELECT c.cell_id, c.cluster, genes.gene, coalesce(count, 0) AS v FROM cells c CROSS JOIN genes LEFT JOIN cell_gene g ON g.cell_id = c.cell_id AND g.gene = genes.gene),
ranked AS (SELECT gene, cluster, v, rank() OVER (PARTITION BY gene ORDER BY v) + (count(*) OVER (PARTITION BY gene, v) - 1) / 2 AS midrank, count(*) OVER (PARTITION BY gene) AS n FROM dense),
ties AS (SELECT gene, sum(t * t * t - t) AS ties FROM (SELECT gene, v, CAST(count(*) AS DOUBLE) AS t FROM dense GROUP BY ALL) GROUP BY gene),
s AS (SELECT gene, cluster, sum(midrank) AS r, any_value(n) AS n FROM ranked GROUP BY ALL), u AS (SELECT s.gene, s.cluster, r - n1 * (n1 + 1) / 2 AS u, n1, n - n1 AS n2, n, ties FROM s JOIN sizes ON s.cluster = sizes.cluster JOIN ties ON s.gene = ties.gene)
SELECT gene, cluster, u, round((u - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM u""")
def marker_rank_sums(spark, d):
    return _rounded(M.rank_sums(R.cell_gene(spark, d), R.cells(spark, d)), 6, "z")


_PVALUES = "p AS (SELECT p_partkey AS id, p_brand AS grp, (p_partkey * 7919 % 1009 + 1) / 1010 AS p FROM part)"


@_query(f"WITH {_PVALUES}, r AS (SELECT *, p * count(*) OVER (PARTITION BY grp) / (rank() OVER (PARTITION BY grp ORDER BY p) + count(*) OVER (PARTITION BY grp, p) - 1) AS q FROM p) SELECT id, round(least(min(q) OVER (PARTITION BY grp ORDER BY p DESC RANGE UNBOUNDED PRECEDING), 1), 6) AS padj FROM r")
def adjusted_pvalues(spark, d):
    key = F.col("p_partkey")
    rows = table(spark, d, "part").select(key.alias("id"), F.col("p_brand").alias("grp"), ((key * 7919 % 1009 + 1) / 1010).alias("p"))
    return _rounded(M.bh(rows, "p", "grp", "padj").select("id", "padj"), 6, "padj")


_BULK = "bulk AS (SELECT region, cluster, gene, round(sum(count)) AS count FROM cell_gene g JOIN cells c ON g.cell_id = c.cell_id GROUP BY ALL HAVING round(sum(count)) > 0)"


@_query(f"WITH {_BULK} SELECT * FROM bulk")
def pseudobulk(spark, d):
    return M.pseudobulk(R.cell_gene(spark, d), R.cells(spark, d), "region", "cluster")


@_query(f"WITH {_BULK}, b AS (SELECT region, gene, sum(count) AS count FROM bulk GROUP BY ALL), m AS (SELECT gene, avg(ln(count)) AS g FROM b GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT region) FROM b)) SELECT region, round(exp(median(ln(count) - g)), 6) AS factor FROM b JOIN m ON b.gene = m.gene GROUP BY region")
def size_factors(spark, d):
    bulk = M.pseudobulk(R.cell_gene(spark, d), R.cells(spark, d), "region", "cluster").groupBy("region", "gene").agg(F.sum("count").alias("count"))
    return _rounded(M.size_factors(bulk, "region"), 6, "factor")


@_query("""WITH n AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY 1), genes AS (SELECT DISTINCT gene FROM cell_gene), s AS (SELECT g.gene, c.cluster, sum(count) AS s, sum(count * count) AS ss, count(*) AS k FROM cell_gene g JOIN cells c ON g.cell_id = c.cell_id GROUP BY ALL),
m AS (SELECT genes.gene, n.cluster, coalesce(s, 0) / n AS mean, (coalesce(ss, 0) - coalesce(s, 0) * coalesce(s, 0) / n) / (n - 1) AS var, coalesce(k, 0) / n AS seen FROM genes CROSS JOIN n LEFT JOIN s ON s.gene = genes.gene AND s.cluster = n.cluster)
SELECT x.gene, x.cluster AS a, y.cluster AS b, round(x.mean - y.mean, 5) AS delta_mean, round(x.seen - y.seen, 5) AS delta_detected, round((x.mean - y.mean) / sqrt((x.var + y.var) / 2), 5) AS cohen_d FROM m x JOIN m y ON x.gene = y.gene AND x.cluster <> y.cluster""")
def pairwise_markers(spark, d):
    return _rounded(M.pairwise(R.cell_gene(spark, d), R.cells(spark, d)), 5, "delta_mean", "delta_detected", "cohen_d")


@_query("SELECT cluster, gene, s AS total, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY s DESC, gene) AS rank FROM (SELECT cluster, gene, sum(count) AS s FROM cell_gene g JOIN cells c ON g.cell_id = c.cell_id GROUP BY ALL)) WHERE rank <= 5")
def top_markers(spark, d):
    s = R.cell_gene(spark, d).join(R.cells(spark, d).select("cell_id", "cluster"), "cell_id").groupBy("cluster", "gene").agg(F.sum("count").alias("total"))
    return M.top_each(s, "cluster", [F.desc("total"), F.col("gene")], 5)


@_query(f"WITH {_PVALUES} SELECT id, round(-log10(greatest(p, (SELECT min(p) FROM p WHERE p > 0))), 6) AS height, CASE WHEN p >= 0.05 THEN 'ns' WHEN id % 2 = 0 THEN 'up' ELSE 'down' END AS kind FROM p")
def volcano(spark, d):
    key = F.col("p_partkey")
    rows = table(spark, d, "part").select(key.alias("id"), ((key * 7919 % 1009 + 1) / 1010).alias("p"))
    least = rows.where("p > 0").agg(F.min("p").alias("least"))
    return rows.crossJoin(F.broadcast(least)).select("id", F.round(-F.log10(F.greatest("p", "least")), 6).alias("height"), F.when(F.col("p") >= 0.05, "ns").when(F.col("id") % 2 == 0, "up").otherwise("down").alias("kind"))


# Reports


_KEYS = ["donor", "region", "cluster", "lab", "experiment", "segmentation", "replicate"]


@_query(f"""WITH {_METRICS}, k AS (SELECT m.*, donor, region, cluster, concat('lab', m.cell_id % 3) AS lab, concat('e', CAST(center_x AS BIGINT) % 2) AS experiment, CASE WHEN dapi > 50 THEN 'nuclear' ELSE 'whole' END AS segmentation, m.cell_id % 2 AS replicate FROM m JOIN cells c ON m.cell_id = c.cell_id)
SELECT {", ".join(_KEYS)}, median(n_count) AS n_count, median(n_feature) AS n_feature, median(volume) AS volume, count(*) AS n FROM k GROUP BY {", ".join(_KEYS)}""")
def donor_medians(spark, d):
    named = {
        "lab": F.concat(F.lit("lab"), (F.col("cell_id") % 3).cast("string")), "experiment": F.concat(F.lit("e"), (F.col("center_x").cast("bigint") % 2).cast("string")),
        "segmentation": F.when(F.col("dapi") > 50, "nuclear").otherwise("whole"), "replicate": F.col("cell_id") % 2,
    }
    rows = _metrics(spark, d).join(R.cells(spark, d).drop("volume"), "cell_id").withColumns(named)
    return C.group_medians(rows, _KEYS, ["n_count", "n_feature", "volume"])


@_query("SELECT gene, n_soma, n_outside, round(n_soma / (n_soma + n_outside), 6) AS soma, round(log10(n_soma + n_outside + 1), 6) AS size FROM (SELECT gene, count(*) FILTER (cell_hint > 50) AS n_soma, count(*) FILTER (NOT cell_hint > 50) AS n_outside FROM points GROUP BY gene)")
def soma_proportions(spark, d):
    n = R.points(spark, d).groupBy("gene").agg(F.count_if(F.col("cell_hint") > 50).alias("n_soma"), F.count_if(F.col("cell_hint") <= 50).alias("n_outside"))
    total = F.col("n_soma") + F.col("n_outside")
    return n.select("gene", "n_soma", "n_outside", F.round(F.col("n_soma") / total, 6).alias("soma"), F.round(F.log10(total + 1), 6).alias("size"))


@_query("SELECT c_mktsegment AS label, count(*) AS n FROM customer GROUP BY 1")
def label_frequency(spark, d):
    return table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


@_query("SELECT round(quantile_cont(value, 0.01), 6) AS low, round(quantile_cont(value, 0.99), 6) AS high FROM events")
def color_range(spark, d):
    q = F.percentile("value", F.array(F.lit(0.01), F.lit(0.99)))
    return table(spark, d, "events").agg(q.alias("q")).select(F.round(F.col("q")[0], 6).alias("low"), F.round(F.col("q")[1], 6).alias("high"))


@_query("SELECT gene, median(x) AS x, median(y) AS y FROM points WHERE gene NOT IN ('', 'nan') GROUP BY gene")
def label_anchors(spark, d):
    return R.points(spark, d).where(~F.col("gene").isin("", "nan")).groupBy("gene").agg(F.median("x").alias("x"), F.median("y").alias("y"))


@_query("SELECT c_custkey AS id, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code, CASE c_mktsegment WHEN 'BUILDING' THEN '#ff0000' WHEN 'MACHINERY' THEN '#00ff00' ELSE '#808080' END AS color FROM customer")
def palette_codes(spark, d):
    rows = table(spark, d, "customer")
    codes = rows.select("c_mktsegment").distinct().withColumn("code", F.dense_rank().over(Window.orderBy("c_mktsegment")) - 1)
    palette = spark.createDataFrame([("BUILDING", "#ff0000"), ("MACHINERY", "#00ff00")], "c_mktsegment string, color string")
    out = rows.join(F.broadcast(palette), "c_mktsegment", "left").join(codes, "c_mktsegment")
    return out.select(F.col("c_custkey").alias("id"), "code", F.coalesce("color", F.lit("#808080")).alias("color"))


@_query("SELECT region, donor, count(*) AS n FROM cells GROUP BY ALL")
def facet_keys(spark, d):
    return R.cells(spark, d).groupBy("region", "donor").agg(F.count("*").alias("n"))


@_query("SELECT least(CAST(floor((value - lo) / (hi - lo) * 100) AS BIGINT), 99) AS bin, count(*) AS n FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1")
def feature_histogram(spark, d):
    rows = table(spark, d, "events").select("value")
    ends = rows.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    bin_ = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 100), F.lit(99))
    return rows.crossJoin(F.broadcast(ends)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


@_query("""WITH t AS (SELECT CAST(floor(y / 16) AS BIGINT) AS row, CAST(floor(x / 16) AS BIGINT) AS col, max(x + y) AS value FROM points GROUP BY ALL), e AS (SELECT min(value) AS lo, max(value) AS hi FROM t),
h AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 256) AS BIGINT), 255) AS b, count(*) AS n FROM t, e GROUP BY 1),
c AS (SELECT b, sum(n) OVER w AS n0, sum(n * b) OVER w AS s0, sum(n) OVER () AS n, sum(n * b) OVER () AS s FROM h WINDOW w AS (ORDER BY b ROWS UNBOUNDED PRECEDING)),
o AS (SELECT b FROM c WHERE n0 < n ORDER BY CAST(n0 AS DOUBLE) * (n - n0) * (s0 / n0 - (s - s0) / (n - n0)) * (s0 / n0 - (s - s0) / (n - n0)) DESC, b LIMIT 1)
SELECT row, col, round(value, 6) AS value, value > (lo + (b + 0.5) * (hi - lo) / 256) / 2 AS kept FROM t, e, o""")
def otsu_threshold(spark, d):
    tiles = T.tile_maxima(R.points(spark, d).select(F.floor(F.col("y") / 16).alias("row"), F.floor(F.col("x") / 16).alias("col"), (F.col("x") + F.col("y")).alias("value")), ["row", "col"])
    return _rounded(T.above_otsu(tiles), 6, "value")


@_query("SELECT tx_id, round(2 * x + 0.5 * y + 3, 6) AS mosaic_x, round(-0.5 * x + 2 * y - 7, 6) AS mosaic_y, round_even(z / 1.5, 0) - 1 AS z_index, (z + 1) * 1.5 AS z_level FROM points")
def affine_points(spark, d):
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return R.points(spark, d).select("tx_id", F.round(2 * x + 0.5 * y + 3, 6).alias("mosaic_x"), F.round(-0.5 * x + 2 * y - 7, 6).alias("mosaic_y"), (F.bround(z / 1.5, 0) - 1).alias("z_index"), ((z + 1) * 1.5).alias("z_level"))


@_query("SELECT c_custkey AS id, CASE WHEN contains(c_name, '1') THEN 'one' WHEN contains(c_name, '2') THEN 'two' ELSE c_name END AS donor, CASE WHEN regexp_extract(c_name, '#0*([1-9][0-9]*)', 1) = '' THEN c_name ELSE regexp_extract(c_name, '#0*([1-9][0-9]*)', 1) END AS alias FROM customer")
def name_rules(spark, d):
    name = F.col("c_name")
    found = F.regexp_extract(name, "#0*([1-9][0-9]*)", 1)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.contains(name, F.lit("1")), "one").when(F.contains(name, F.lit("2")), "two").otherwise(name).alias("donor"), F.when(found == "", name).otherwise(found).alias("alias"))


@_query("SELECT cell_id, round((volume - lo + 1e-12) / (hi - lo + 2e-12), 6) AS unit FROM cells, (SELECT min(volume) AS lo, max(volume) AS hi FROM cells)")
def unit_scaled(spark, d):
    rows = R.cells(spark, d).select("cell_id", "volume")
    ends = rows.agg(F.min("volume").alias("lo"), F.max("volume").alias("hi"))
    return rows.crossJoin(F.broadcast(ends)).select("cell_id", F.round((F.col("volume") - F.col("lo") + 1e-12) / (F.col("hi") - F.col("lo") + 2e-12), 6).alias("unit"))


@_query("SELECT gene, CAST(dense_rank() OVER (ORDER BY first) AS INTEGER) AS code FROM (SELECT gene, min(tx_id) AS first FROM points GROUP BY gene)")
def appearance_codes(spark, d):
    first = R.points(spark, d).groupBy("gene").agg(F.min("tx_id").alias("first"))
    return first.select("gene", F.dense_rank().over(Window.orderBy("first")).alias("code"))


@_query("SELECT cell_hint AS entity, tx_id AS part, x AS area FROM points QUALIFY row_number() OVER (PARTITION BY cell_hint ORDER BY x DESC, tx_id) = 1")
def largest_parts(spark, d):
    rows = R.points(spark, d).select(F.col("cell_hint").alias("entity"), F.col("tx_id").alias("part"), F.col("x").alias("area"))
    return M.top_each(rows, "entity", [F.desc("area"), F.col("part")], 1).drop("rank")


@_query("SELECT entity_id FROM (SELECT cell_hint AS entity_id, count(DISTINCT z) AS k FROM points GROUP BY 1) WHERE k >= 7")
def multi_plane_cells(spark, d):
    return R.points(spark, d).groupBy(F.col("cell_hint").alias("entity_id")).agg(F.countDistinct("z").alias("k")).where("k >= 7").select("entity_id")


@_query("SELECT region, CAST(to_json(list({'donor': donor, 'n': n} ORDER BY donor)) AS VARCHAR) AS manifest FROM (SELECT region, donor, count(*) AS n FROM cells GROUP BY ALL) GROUP BY region")
def manifest(spark, d):
    n = R.cells(spark, d).groupBy("region", "donor").agg(F.count("*").alias("n"))
    return n.groupBy("region").agg(F.to_json(F.array_sort(F.collect_list(F.struct("donor", "n")))).alias("manifest"))


@_query("SELECT donor, CASE WHEN count(*) FILTER (cluster > 1) > 0 THEN count(*) FILTER (cluster > 1) ELSE 0 - count(*) END AS n FROM cells GROUP BY donor")
def upserted_metrics(spark, d):
    rows = R.cells(spark, d)
    old = rows.groupBy("donor").agg((-F.count("*")).alias("n"))
    new = rows.where("cluster > 1").groupBy("donor").agg(F.count("*").alias("n"))
    return old.join(new, "donor", "left_anti").unionByName(new)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
