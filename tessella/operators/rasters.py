"""Tiles, masks and planes as tables of pixels (row, col) and (row, col, z)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tiles_with_mask(tiles: DataFrame, mask: DataFrame, tile: int) -> DataFrame:
    """Tiles (tile_id, row, col) of side ``tile`` that hold a pixel of the mask; each tile meets the mask's pixels by the four blocks it touches."""
    block = lambda c: F.floor(F.col(c) / tile)
    at = F.explode(F.array(*[F.struct((block("row") + i).alias("br"), (block("col") + j).alias("bc")) for i in (0, 1) for j in (0, 1)]))
    spread = tiles.select("*", at.alias("at")).select(*tiles.columns, "at.br", "at.bc")
    pixels = mask.select(F.col("row").alias("pr"), F.col("col").alias("pc"), block("row").alias("br"), block("col").alias("bc"))
    inside = F.col("pr").between(F.col("row"), F.col("row") + tile - 1) & F.col("pc").between(F.col("col"), F.col("col") + tile - 1)
    hit = spread.join(pixels, ["br", "bc"]).where(inside).select("tile_id").distinct()
    return tiles.join(hit, "tile_id", "left_semi")


def bright_tiles(tiles: DataFrame, pixels: DataFrame, tile: int, threshold: float) -> DataFrame:
    """Tiles whose largest value is over ``threshold``; pixels are (row, col, value)."""
    return tiles_with_mask(tiles, pixels.where(F.col("value") > threshold), tile)


def selected_tiles(tiles: DataFrame, tile: int, how: str = "none", mask: DataFrame | None = None, pixels: DataFrame | None = None, threshold: float = 0.0) -> DataFrame:
    """Tiles by one of the filters ``none``, ``tissue_mask`` and ``otsu``."""
    if how == "none":
        return tiles
    if how == "tissue_mask":
        return tiles_with_mask(tiles, mask, tile)
    if how == "otsu":
        return bright_tiles(tiles, pixels, tile, threshold)
    raise ValueError(f"unknown filter {how}")


def tile_maxima(pixels: DataFrame, tile: list[str]) -> DataFrame:
    """(*tile, value): the largest value of each tile; null and NaN values don't count."""
    return pixels.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))).groupBy(*tile).agg(F.max("value").alias("value"))


def otsu(values: DataFrame, bins: int = 256) -> DataFrame:
    """One row (threshold): the middle of the bin, of ``bins`` equal ones from the least to the largest value, up to which and after which the values' means lie
    furthest apart, weighed by their numbers (the first of equal ones); no row where all values are equal.

    What is gathered is one row a bin.
    """
    ends = values.agg(F.min("value").cast("double").alias("low"), F.max("value").cast("double").alias("high"))
    bin_ = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
    h = values.crossJoin(F.broadcast(ends)).where("low < high").groupBy("low", "high", bin_.alias("b")).agg(F.count("*").alias("n"))
    upto, every = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    sums = h.select("low", "high", "b", F.sum("n").over(upto).alias("n0"), F.sum(F.col("n") * F.col("b")).over(upto).alias("s0"), F.sum("n").over(every).alias("n"), F.sum(F.col("n") * F.col("b")).over(every).alias("s"))
    apart = F.col("s0") / F.col("n0") - (F.col("s") - F.col("s0")) / (F.col("n") - F.col("n0"))
    between = F.col("n0").cast("double") * (F.col("n") - F.col("n0")) * apart * apart
    return sums.where("n0 < n").orderBy(F.desc(between), "b").limit(1).select((F.col("low") + (F.col("b") + 0.5) * (F.col("high") - F.col("low")) / bins).alias("threshold"))


def above_otsu(tiles: DataFrame, part: float = 0.5) -> DataFrame:
    """``tiles`` with ``kept``: whether a tile's largest value is over ``part`` of the threshold of all tiles; all are kept where they are equal."""
    found = tiles.crossJoin(F.broadcast(tiles.agg(F.count("*").alias("all")).join(otsu(tiles), F.lit(True), "left")))  # one row
    return found.withColumn("kept", F.coalesce(F.col("value") > F.col("threshold") * part, F.lit(True))).drop("threshold", "all")


def projected(stack: DataFrame) -> DataFrame:
    """(row, col, value): the largest value of every pixel over a stack (row, col, z, value) without its first and last plane."""
    ends = stack.agg(F.min("z").alias("z0"), F.max("z").alias("z1"))
    return stack.crossJoin(F.broadcast(ends)).where("z > z0 AND z < z1").groupBy("row", "col").agg(F.max("value").alias("value"))  # one row


def cut_tiles(pixels: DataFrame, tiles: DataFrame, tile: int) -> DataFrame:
    """(tile_id, tile_row, tile_col, r, c, ...): each tile's pixels (row, col, ...) by their place in it; a pixel is in every tile that covers it."""
    block = lambda c: F.floor(F.col(c) / tile)
    at = F.explode(F.array(*[F.struct((block("row") + i).alias("br"), (block("col") + j).alias("bc")) for i in (0, 1) for j in (0, 1)]))
    spread = tiles.select("tile_id", F.col("row").alias("tile_row"), F.col("col").alias("tile_col"), at.alias("at")).select("tile_id", "tile_row", "tile_col", "at.*")
    r, c = F.col("row") - F.col("tile_row"), F.col("col") - F.col("tile_col")
    met = pixels.withColumns({"br": block("row"), "bc": block("col")}).join(spread, ["br", "bc"]).where((r >= 0) & (r < tile) & (c >= 0) & (c < tile))
    return met.withColumns({"r": r, "c": c}).drop("br", "bc", "row", "col")


def averaged_tiles(pixels: DataFrame) -> DataFrame:
    """(row, col, value): tiles laid back into the whole, where they overlap by their mean; pixels are (tile_row, tile_col, r, c, value)."""
    return pixels.groupBy((F.col("tile_row") + F.col("r")).alias("row"), (F.col("tile_col") + F.col("c")).alias("col")).agg(F.avg("value").alias("value"))


def padded_planes(stack: DataFrame, k: int) -> DataFrame:
    """A stack (z, ...) with its first and last plane repeated ``k`` times on either side; planes are numbered anew from 0."""
    ends = stack.agg(F.min("z").alias("z0"), F.max("z").alias("z1"))
    rows = stack.crossJoin(F.broadcast(ends))  # one row
    at = F.col("z") - F.col("z0") + k
    before = F.when(F.col("z") == F.col("z0"), F.sequence(F.lit(0), F.lit(k - 1)) if k else F.array().cast("array<int>")).otherwise(F.array().cast("array<int>"))
    after = F.when(F.col("z") == F.col("z1"), F.sequence(at + 1, at + k) if k else F.array().cast("array<int>")).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("z", F.explode(F.concat(before.cast("array<bigint>"), F.array(at.cast("bigint")), after.cast("array<bigint>")))).drop("z0", "z1")


def collapsed_planes(stack: DataFrame, how: str = "middle") -> DataFrame:
    """(row, col, value): the plane in the middle (n // 2 of n), or the largest value of every pixel."""
    if how == "max":
        return stack.groupBy("row", "col").agg(F.max("value").alias("value"))
    planes = sorted(r["z"] for r in stack.select("z").distinct().collect())  # planes of one stack
    return stack.where(F.col("z") == planes[len(planes) // 2]).select("row", "col", "value") if planes else stack.select("row", "col", "value")


def without_small(parts: DataFrame, least: float) -> DataFrame:
    """Parts (row, col, component) of ``least`` cells or more."""
    sizes = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("component")
    return parts.join(sizes, "component", "left_semi")


def tissue_mask(points: DataFrame, bin_size: float, sigma: float, density: float, least_area: float, erosion: float = 0.0, reference: float | None = None) -> DataFrame:
    """(row, col, component) of the tissue: smoothed density per 100 units, floor, closing, parts of ``least_area`` or more, erosion.

    Erosion takes max(1, round(erosion * reference / bin_size)) steps if ``erosion`` is given.
    """
    from tessella.operators import space as S

    dense = S.smoothed(S.raster_bins(points, bin_size), sigma).where(100 * F.col("value") / bin_size**2 >= density)
    parts = without_small(S.mask_components(S.closed(dense.select("row", "col"))), least_area / bin_size**2)
    if not erosion:
        return parts
    core = S.eroded(parts.select("row", "col"), max(1, round(erosion * (reference or bin_size) / bin_size)))
    return parts.join(core, ["row", "col"], "left_semi")
