"""Numbers and ids of rows, and flat polygons brought into the schema of a segmentation.

``numbered`` gives every row its place in an order without a task that sees all rows: they are dealt by range, sorted inside their
partitions and written, and a row's number is its place in its partition after the rows of the partitions before. Rows: equal rows are numbered
in any order; nulls come first where the order is ascending; an empty table gives no rows.
"""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators.columns import inverse
from tessella.operators.harmony import harmonised
from tessella.operators.polygons import replicated
from tessella.sources.tables import cut

#: Digits of an id, of which the prefix takes eight: day of the year plus 100, and second of the day.
DIGITS = 19


def numbered(rows: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """``rows`` with ``name``: each row's place in the order, from 0. Each partition sends the number of its rows to the driver."""
    dealt = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright(name, 33), F.col(name).bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before = np.append(0, np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)])).tolist()
    return dealt.withColumn(name, F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), part.cast("int")) + inside)


def id_prefix(at: datetime.datetime) -> str:
    """The first digits of the ids that are given at a time (UTC)."""
    at = at.astimezone(datetime.UTC)
    return f"{at.timetuple().tm_yday + 100}{at.hour * 3600 + at.minute * 60 + at.second:05d}"


def with_ids(rows: DataFrame, key: str, prefix: str, name: str = "entity_id") -> DataFrame:
    """``rows`` whose column ``name`` is a new id: the prefix and the place of their ``key`` among all distinct keys, zero-padded to ``DIGITS``; null keys have none."""
    keys = numbered(rows.select(F.col(key).alias("old_key")).distinct().where("old_key IS NOT NULL"), [F.col("old_key").asc()])
    made = F.concat(F.lit(prefix), F.lpad(F.col("number").cast("string"), DIGITS - len(prefix), "0")).cast("bigint")
    kept = rows.withColumn("old_key", F.col(key)).drop(name)
    return kept.join(keys.select("old_key", made.alias(name)), "old_key", "left").drop("old_key")


def converted(flat: DataFrame, prefix: str, planes: int = 7, step: float = 1.5, matrix: list[list[float]] | None = None, harmonise: bool = True, min_distance: float = 2.0, min_area: float = 100.0, kind: str = "cell") -> DataFrame:
    """(id, polygon, entity_id, parent_id, parent_type, type, z, level) of flat polygons (entity_id, polygon) on every plane.

    Polygons are repaired, their overlaps resolved if ``harmonise``, copied to all planes at levels of ``step``, and moved by the inverse of the 3 x 3
    ``matrix`` of the way from result to source. Entities are numbered anew in the order of their old ids, rows by plane and entity.
    """
    whole = flat.select("entity_id", F.lit(0).alias("z"), O.rings_of(O.repaired(F.col("polygon"))).alias("polygon")).where(F.size("polygon") > 0)
    clean = harmonised(whole, min_distance, min_area).select("entity_id", "polygon") if harmonise else whole.select("entity_id", "polygon")
    named = cut(with_ids(clean, "entity_id", prefix), "segments")
    moves = None
    if matrix is not None:
        (a, b, tx), (d, e, ty) = inverse(matrix)[:2]
        moves = (a, b, tx, d, e, ty)
    rows = numbered(replicated(named, planes, moves), [F.col("z").asc(), F.col("entity_id").asc()], "id")
    none = F.lit(None).cast("string")
    return rows.select("id", "polygon", "entity_id", none.alias("parent_id"), none.alias("parent_type"), F.lit(kind).alias("type"), "z", ((F.col("z") + 1) * step).alias("level"))


def placed_tiles(polygons: DataFrame, tiles: DataFrame, scale: float = 1.0) -> DataFrame:
    """Polygons (tile_id, polygon, ...) of tiles in the coordinates of the whole: moved by their tile's corner (tile_id, row, col), then scaled; those of unknown tiles go."""
    corner = tiles.select("tile_id", F.col("row").cast("double").alias("tile_y"), F.col("col").cast("double").alias("tile_x"))
    point = lambda p: F.struct(((p["x"] + F.col("tile_x")) * scale).alias("x"), ((p["y"] + F.col("tile_y")) * scale).alias("y"))
    met = polygons.join(corner, "tile_id")
    return met.withColumn("polygon", F.transform("polygon", lambda ring: F.transform(ring, point)).cast(G.POLYGON)).drop("tile_x", "tile_y")


def doublets(cells: DataFrame, score: str, threshold: float) -> DataFrame:
    """``cells`` with ``doublet``: whether the score is over the threshold; cells that fail ``pass_qc`` (or have none) lose their score and are none, as are null scores."""
    passed = F.coalesce("pass_qc", F.lit(False))
    value = F.when(passed, F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")))
    return cells.withColumn(score, value).withColumn("doublet", F.coalesce(F.col(score) > threshold, F.lit(False)))


def draw_order(rows: DataFrame, value: str, key: str) -> DataFrame:
    """``rows`` with ``drawn``: the order in which points are drawn, so that large values lie on top; null values first, ties by ``key``."""
    return numbered(rows, [F.col(value).asc_nulls_first(), F.col(key).asc()], "drawn")
