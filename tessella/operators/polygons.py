"""Joins, measures and matching of polygons (entity_id, z, polygon), as equi-joins on grid cells followed by the exact test."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators.space import BOUNDS, as_forms, boxes_on_grid, entity_forms, one_to_one, pairs_of_members
from tessella.sources.tables import cut


def bounded(polygons: DataFrame) -> DataFrame:
    """``polygons`` with the bounds of each."""
    return polygons.withColumns(G.bounds(F.col("polygon")))


def grid_size(polygons: DataFrame, share: float = 0.5) -> float:
    """A side of grid cells such that a polygon of median extent touches a few, whatever its unit; one number for the driver."""
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    middle, widest = bounded(polygons).agg(F.approx_percentile(extent, 0.5), F.max(extent)).first()
    return max(middle or 0.0, (widest or 0.0) / 64) * share or 1.0  # the widest one touches (64 / share + 1)^2 cells at most


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float | None = None) -> DataFrame:
    """Inner join of points strictly inside polygons of their plane; a point in k polygons gives k rows, one on a boundary none."""
    size = size or grid_size(polygons)
    on = points.withColumn("gx", F.floor(F.col("x") / size)).withColumn("gy", F.floor(F.col("y") / size))
    near = F.col("x").between(F.col("minx"), F.col("maxx")) & F.col("y").between(F.col("miny"), F.col("maxy"))
    met = on.join(boxes_on_grid(bounded(polygons), size), ["z", "gx", "gy"]).where(near)
    return met.where(G.inside(F.col("x"), F.col("y"), F.col("polygon"))).drop("gx", "gy", "polygon", *BOUNDS)


def entity_metadata(polygons: DataFrame, z_step: float = 1.5, least_area: float = 1e-9) -> DataFrame:
    """One row an entity: volume, mean centre, bounds, perimeter over area, solidity and anisotropy.

    The depth of a plane is the distance of its level (z + 1) * z_step from the plane below; planes under ``least_area`` are left out.
    Anisotropy is that of all the entity's points.
    """
    hulls = G.hull_measures(F.get("polygon", 0))
    rows = polygons.select("entity_id", "z", "polygon", G.measures(F.col("polygon")).alias("m"), hulls.alias("h")).where(F.col("m.area") >= least_area)
    level = (F.col("z") + 1) * z_step
    depth = level - F.coalesce(F.lag(level).over(Window.partitionBy("entity_id").orderBy("z")), F.lit(0.0))
    rows = rows.withColumn("depth", depth)
    found = rows.groupBy("entity_id").agg(
        F.sum(F.col("m.area") * F.col("depth")).alias("volume"), F.avg("m.cx").alias("center_x"), F.avg("m.cy").alias("center_y"), F.min("m.minx").alias("min_x"), F.min("m.miny").alias("min_y"),
        F.max("m.maxx").alias("max_x"), F.max("m.maxy").alias("max_y"), F.avg(F.col("m.length") / F.col("m.area")).alias("perimeter_area_ratio"), (F.sum("m.area") / F.sum("h.hull_area")).alias("solidity"),
        F.flatten(F.collect_list(F.get("polygon", 0))).alias("points"),
    )
    return found.withColumn("anisotropy", G.hull_measures("points")["anisotropy"]).drop("points")


def met_bounds(a: DataFrame, b: DataFrame, size: float | None = None) -> DataFrame:
    """(z, id_a, id_b, polygon_a, polygon_b): pairs of a plane whose bounds touch; each pair is met in one grid cell only."""
    size = size or grid_size(a)
    side = lambda df, s: boxes_on_grid(bounded(df), size).select("z", "gx", "gy", F.col("entity_id").alias(f"id_{s}"), F.col("polygon").alias(f"polygon_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in BOUNDS])
    low_x, low_y = F.greatest("minx_a", "minx_b"), F.greatest("miny_a", "miny_b")
    meet = (F.least("maxx_a", "maxx_b") >= low_x) & (F.least("maxy_a", "maxy_b") >= low_y)
    met = side(a, "a").join(side(b, "b"), ["z", "gx", "gy"]).where(meet & (F.col("gx") == F.floor(low_x / size)) & (F.col("gy") == F.floor(low_y / size)))
    return met.select("z", "id_a", "id_b", "polygon_a", "polygon_b")


def _overlaps(a: DataFrame, b: DataFrame, size: float | None) -> DataFrame:
    shared = met_bounds(a, b, size).repartition("id_a", "id_b").select("id_a", "id_b", O.shared_areas(F.col("polygon_a"), F.col("polygon_b"))["shared"].alias("area"))
    found = shared.where("area > 0").groupBy("id_a", "id_b").agg(F.sum("area").alias("area"))
    total = lambda df, s: df.groupBy(F.col("entity_id").alias(f"id_{s}")).agg(F.sum(G.area(F.col("polygon"))).alias(f"area_{s}"))
    return found.join(total(a, "a"), "id_a").join(total(b, "b"), "id_b").select("id_a", "id_b", "area", "area_a", "area_b")


def overlapping_polygons(a: DataFrame, b: DataFrame, size: float | None = None) -> DataFrame:
    """(id_a, id_b, area, area_a, area_b): pairs that share an area, over all planes; holes count for none of them.

    Entities with the same polygons on all planes are met as one and become pairs at the end, so only the result grows with the square of copies.
    Rows: null and empty polygons take no part; polygons that only touch are no pair; equal rows of one entity and plane add up.
    """
    (one, of_a), (two, of_b) = (entity_forms(df.where("entity_id IS NOT NULL"), "z", "polygon") for df in (a, b))
    return pairs_of_members(cut(_overlaps(one, two, size), "pairs"), of_a, of_b)


MODES = ("larger", "prefix1", "prefix2", "intersection")


def aligned(a: DataFrame, b: DataFrame, mode: str = "larger", size: float | None = None) -> DataFrame:
    """(id_a, id_b, area, z, polygon): matched entities of two segmentations with the geometry that ``mode`` asks for.

    ``larger`` takes the entity of the larger area (of equal ones, that of ``a``), ``prefix1`` that of ``a``, ``prefix2`` that of ``b`` and
    ``intersection`` what they share on each plane, with all rings of its parts in ``polygon``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    # of copies only the one of the least id is ever a best partner, so only those are met
    least = (entity_forms(df.where("entity_id IS NOT NULL"), "z", "polygon")[0].withColumn("entity_id", F.col("least")) for df in (a, b))
    best = cut(one_to_one(_overlaps(*least, size)), "pairs")
    one, two = (df.select(F.col("entity_id").alias(f"id_{s}"), "z", F.col("polygon").alias(f"polygon_{s}")) for df, s in ((a, "a"), (b, "b")))
    if mode == "intersection":
        both = best.join(one, "id_a").join(two, ["id_b", "z"])
        shared = O.rings_of(O.overlay(F.col("polygon_a"), F.col("polygon_b"), "intersection"))
        return both.select("id_a", "id_b", "area", "z", shared.alias("polygon")).where(F.size("polygon") > 0)
    first = F.lit(mode == "prefix1") if mode != "larger" else F.col("area_a") >= F.col("area_b")
    taken = best.where(first).join(one, "id_a").select("id_a", "id_b", "area", "z", F.col("polygon_a").alias("polygon"))
    return taken.unionByName(best.where(~first).join(two, "id_b").select("id_a", "id_b", "area", "z", F.col("polygon_b").alias("polygon")))


def kept_by_regions(shapes: DataFrame, regions: DataFrame, size: float | None = None) -> DataFrame:
    """The shapes (entity_id, polygon) that meet the union of the regions (polygon): any of them, and touching counts.

    Equal shapes are one for the test, and equal regions too.
    Rows: null and empty polygons meet nothing; a shape of several rows stays whole if one of them meets a region.
    """
    forms, members = as_forms(shapes, "polygon")
    flat = forms.select(F.col("form").alias("entity_id"), F.lit(0).alias("z"), "polygon")
    distinct = as_forms(regions.select(F.lit(0).alias("entity_id"), "polygon"), "polygon")[0]
    met = met_bounds(flat, distinct.select(F.lit(0).alias("entity_id"), F.lit(0).alias("z"), "polygon"), size)
    kept = met.where(O.touching(F.col("polygon_a"), F.col("polygon_b"))).select(F.col("id_a").alias("form")).distinct()
    return shapes.join(members.join(kept, "form").select("entity_id").distinct(), "entity_id", "left_semi")


def largest_parts(rows: DataFrame, wkt: str = "geometry") -> DataFrame:
    """``rows`` with ``polygon``: the part of the largest area of each text; of equal ones the first."""
    parts = F.transform(G.parts_of_wkt(F.col(wkt)), lambda p, i: F.struct(G.measures(p)["area"].alias("area"), (-i).alias("at"), p.alias("polygon")))
    return rows.withColumn("polygon", F.aggregate(parts, F.get(parts, 0), lambda best, p: F.when((p["area"] > best["area"]), p).otherwise(best))["polygon"])


def replicated(flat: DataFrame, planes: int, transform: tuple[float, ...] | None = None) -> DataFrame:
    """Flat polygons on every one of ``planes`` planes, in other coordinates if ``transform`` (a, b, tx, d, e, ty) is given."""
    polygon = G.moved(F.col("polygon"), *transform) if transform else F.col("polygon")
    return flat.withColumn("polygon", polygon).withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(planes - 1))))


def hex_grid(spark, bounds: tuple[float, float, float, float], size: float, overlap: float = 0.0) -> DataFrame:
    """(hex_id, row, col, cx, cy, polygon): pointy-top hexagons over the bounds, odd rows moved by half a step; only those whose bounds meet them."""
    from math import ceil, cos, pi, sin, sqrt

    if not 0 <= overlap < 1:
        raise ValueError("overlap must be in [0, 1)")
    minx, miny, maxx, maxy = bounds
    wide, tall = size * sqrt(3) * (1 - overlap), size * 1.5 * (1 - overlap)
    cols, rows = ceil((maxx - minx) / wide) + 2, ceil((maxy - miny) / tall) + 2
    n = spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"), "id")
    cx = F.lit(minx) + (F.col("col") + F.when(F.col("row") % 2 == 1, 0.5).otherwise(0.0)) * wide
    n = n.withColumn("cx", cx).withColumn("cy", F.lit(miny) + F.col("row") * tall)
    corner = lambda k: F.struct((F.col("cx") + size * cos(pi / 6 + k * pi / 3)).alias("x"), (F.col("cy") + size * sin(pi / 6 + k * pi / 3)).alias("y"))
    half = size * sqrt(3) / 2
    meets = (F.col("cx") - half <= maxx) & (F.col("cx") + half >= minx) & (F.col("cy") - size <= maxy) & (F.col("cy") + size >= miny)
    return n.where(meets).select(F.col("id").alias("hex_id"), "row", "col", "cx", "cy", F.array(F.array(*[corner(k) for k in range(6)])).alias("polygon"))


def hex_genes(points: DataFrame, hexes: DataFrame, size: float) -> DataFrame:
    """(hex_id, gene, n): points strictly inside each hexagon by gene, without blanks; hexagons that overlap share points."""
    # points of one place and gene are tested once
    flat = points.where(~F.col("gene").contains("Blank-")).groupBy("x", "y", "gene").agg(F.count("*").alias("n")).withColumn("z", F.lit(0))
    polygons = hexes.select(F.col("hex_id").alias("entity_id"), F.lit(0).alias("z"), "polygon")
    return points_in_polygons(flat, polygons, 2 * size).groupBy(F.col("entity_id").alias("hex_id"), "gene").agg(F.sum("n").alias("n"))
