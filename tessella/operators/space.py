"""Spatial joins, bins, rasters and box geometry as equi-joins on grid cells followed by the exact test."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.tables import cut, forget


BOUNDS = ("minx", "miny", "maxx", "maxy")


def grid_cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def boxes_on_grid(boxes: DataFrame, size: float) -> DataFrame:
    """One row for each grid cell that a box touches."""
    return boxes.withColumn("gx", F.explode(grid_cells(F.col("minx"), F.col("maxx"), size))).withColumn("gy", F.explode(grid_cells(F.col("miny"), F.col("maxy"), size)))


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float = 16.0) -> DataFrame:
    """Inner join of points strictly inside boxes of their plane; a point in k boxes gives k rows."""
    on_grid = points.withColumn("gx", F.floor(F.col("x") / size)).withColumn("gy", F.floor(F.col("y") / size))
    inside = (F.col("x") > F.col("minx")) & (F.col("x") < F.col("maxx")) & (F.col("y") > F.col("miny")) & (F.col("y") < F.col("maxy"))
    return on_grid.join(boxes_on_grid(boxes, size), ["z", "gx", "gy"]).where(inside).drop("gx", "gy")


#: Tasks that the partners of one form are dealt into.
DEAL = 16


def as_forms(rows: DataFrame, *what: str) -> tuple[DataFrame, DataFrame]:
    """Forms (form, ``what``, least, most) and members (entity_id, form) of rows that are equal in the columns ``what``.

    What depends on these columns alone is computed once a form; ``least`` and ``most`` are the smallest and the largest id of a form.
    """
    keyed = rows.withColumn("key", F.sha2(F.to_json(F.struct(*what)), 256))
    found = keyed.groupBy("key").agg(*[F.first(c).alias(c) for c in what], F.min("entity_id").alias("least"), F.max("entity_id").alias("most"))
    forms = cut(found.withColumn("form", F.monotonically_increasing_id()), "forms")
    return forms.drop("key"), keyed.select("entity_id", "key").join(forms.select("key", "form"), "key").select("entity_id", "form")


def entity_forms(rows: DataFrame, *what: str) -> tuple[DataFrame, DataFrame]:
    """As ``as_forms``, for entities whose rows (``what``, which begins with the plane) are the same on all planes: (entity_id, least, ``what``) with the form as entity, and members."""
    whole = rows.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct(*what))).alias("rows"))
    forms, members = as_forms(whole, "rows")
    return forms.select(F.col("form").alias("entity_id"), "least", F.explode("rows").alias("row")).select("entity_id", "least", "row.*"), members


def pairs_of_members(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """``pairs`` (id_a, id_b, ...) of forms as pairs of their members; a form of very many members is dealt into ``DEAL`` tasks."""
    one = a.select(F.col("form").alias("id_a"), F.col("entity_id").alias("member_a"))
    two = b.select(F.col("form").alias("id_b"), F.col("entity_id").alias("member_b"), F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("deal"))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = pairs.join(one, "id_a").withColumn("deal", F.pmod(F.xxhash64("member_a"), F.lit(DEAL)).cast("int")).repartition(n, "id_b", "deal")
    rest = [c for c in pairs.columns if c not in ("id_a", "id_b")]
    return left.join(two, ["id_b", "deal"]).select(F.col("member_a").alias("id_a"), F.col("member_b").alias("id_b"), *rest)


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test of a point against a ring, an array of struct(x, y) whose last point joins the first."""
    n = F.size(ring)

    def crossing(i: Column) -> Column:
        a, b = F.element_at(ring, i.cast("int")), F.element_at(ring, (i % n + 1).cast("int"))
        spans = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + crossing(i)) % 2 == 1


def ring_sums(ring: Column) -> tuple[Column, Column, Column, Column]:
    """Area, perimeter and centroid of a ring, by the shoelace sums."""
    n = F.size(ring)
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("a", "p", "x", "y")])

    def add(s: Column, i: Column) -> Column:
        a, b = F.element_at(ring, i.cast("int")), F.element_at(ring, (i % n + 1).cast("int"))
        cross = a["x"] * b["y"] - b["x"] * a["y"]
        return F.struct((s["a"] + cross).alias("a"), (s["p"] + F.hypot(b["x"] - a["x"], b["y"] - a["y"])).alias("p"), (s["x"] + (a["x"] + b["x"]) * cross).alias("x"), (s["y"] + (a["y"] + b["y"]) * cross).alias("y"))

    s = F.aggregate(F.sequence(F.lit(1), n), zero, add)
    return F.abs(s["a"]) / 2, s["p"], F.try_divide(s["x"], 3 * s["a"]), F.try_divide(s["y"], 3 * s["a"])


def box_ring(row: str = "") -> Column:
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return F.array(corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"))


def last_assignment(points: DataFrame, joined: DataFrame, none: int = -1) -> DataFrame:
    """(tx_id, cell_id): the box of the largest id that holds the point, else ``none``."""
    best = joined.groupBy("tx_id").agg(F.max("entity_id").alias("cell_id"))
    return points.select("tx_id").join(best, "tx_id", "left").withColumn("cell_id", F.coalesce("cell_id", F.lit(none).cast("bigint")))


def counted_inside(points: DataFrame, shapes: DataFrame, what: tuple[str, ...], by: tuple[str, ...], join) -> DataFrame:
    """(entity_id, ``by``, n): points inside each entity's shapes, by ``join`` (points, shapes); a point in k shapes counts k times.

    Shapes that are equal in ``what`` meet the points once.
    """
    forms, members = as_forms(shapes, *what)
    n = join(points, forms.select(F.col("form").alias("entity_id"), *what)).groupBy(F.col("entity_id").alias("form"), *by).agg(F.count("*").alias("n"))
    return members.join(n, "form").groupBy("entity_id", *by).agg(F.sum("n").alias("n"))


def assigned(points: DataFrame, shapes: DataFrame, what: tuple[str, ...], join, none: int = -1) -> DataFrame:
    """``last_assignment`` of the points by ``join`` (points, shapes); of shapes that are equal in ``what`` only the one of the largest id can hold a point."""
    last = as_forms(shapes, *what)[0].select(F.col("most").alias("entity_id"), *what)
    return last_assignment(points, join(points, last), none)


def _overlaps(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    one = boxes_on_grid(a, size).select("z", "gx", "gy", F.col("entity_id").alias("id_a"), *[F.col(c).alias(f"{c}_a") for c in BOUNDS])
    two = boxes_on_grid(b, size).select("z", "gx", "gy", F.col("entity_id").alias("id_b"), *[F.col(c).alias(f"{c}_b") for c in BOUNDS])
    low_x, low_y = F.greatest("minx_a", "minx_b"), F.greatest("miny_a", "miny_b")
    wide, tall = F.least("maxx_a", "maxx_b") - low_x, F.least("maxy_a", "maxy_b") - low_y
    both = one.join(two, ["z", "gx", "gy"]).where((wide > 0) & (tall > 0) & (F.col("gx") == F.floor(low_x / size)) & (F.col("gy") == F.floor(low_y / size)))
    return both.groupBy("id_a", "id_b").agg(F.sum(wide * tall).alias("area"))


def overlapping_boxes(a: DataFrame, b: DataFrame, size: float = 16.0) -> DataFrame:
    """(id_a, id_b, area): pairs of one plane whose boxes share an area; each pair is met in one grid cell only.

    Entities with the same boxes are met as one and become pairs at the end, so only the result grows with the square of copies.
    """
    (one, of_a), (two, of_b) = entity_forms(a, "z", *BOUNDS), entity_forms(b, "z", *BOUNDS)
    return pairs_of_members(cut(_overlaps(one, two, size), "pairs"), of_a, of_b)


def aligned_boxes(a: DataFrame, b: DataFrame, size: float = 16.0) -> DataFrame:
    """(id_a, id_b, area): ``one_to_one`` of the overlapping boxes. Of copies only the one of the least id is ever a best partner, so only those are met."""
    one, two = (entity_forms(df, "z", *BOUNDS)[0].withColumn("entity_id", F.col("least")) for df in (a, b))
    return one_to_one(_overlaps(one, two, size))


def one_to_one(pairs: DataFrame) -> DataFrame:
    """Greedy matching: the best partner of each id_a, then the best of each id_b; ties go to the smaller id."""
    first = Window.partitionBy("id_a").orderBy(F.desc("area"), "id_b")
    second = Window.partitionBy("id_b").orderBy(F.desc("area"), "id_a")
    kept = pairs.withColumn("r", F.row_number().over(first)).where("r = 1")
    return kept.withColumn("r", F.row_number().over(second)).where("r = 1").drop("r")


def raster_bins(points: DataFrame, size: float) -> DataFrame:
    """(row, col, n): counts on a grid that starts at the least x and y."""
    origin = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    on = points.crossJoin(F.broadcast(origin))
    return on.groupBy(F.floor((F.col("y") - F.col("y0")) / size).alias("row"), F.floor((F.col("x") - F.col("x0")) / size).alias("col")).agg(F.count("*").alias("n"))


def hex_of(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    """Axial (q, r) of the pointy-top hexagon of side ``size`` that holds a point, by cube rounding; ties go up."""
    q, r = (x * (math.sqrt(3) / 3) - y / 3) / size, y * (2 / 3) / size
    s = -q - r
    near = lambda v: F.floor(v + 0.5)
    dq, dr, ds = F.abs(near(q) - q), F.abs(near(r) - r), F.abs(near(s) - s)
    return F.when((dq > dr) & (dq > ds), -near(r) - near(s)).otherwise(near(q)), F.when(((dq <= dr) | (dq <= ds)) & (dr > ds), -near(q) - near(s)).otherwise(near(r))


def hex_bins(points: DataFrame, size: float) -> DataFrame:
    """(q, r, tz_count, n_genes, density): totals of each hexagon."""
    q, r = hex_of(F.col("x"), F.col("y"), size)
    area = 1.5 * math.sqrt(3) * size * size
    return points.groupBy(q.alias("q"), r.alias("r")).agg(F.count("*").alias("tz_count"), F.countDistinct("gene").alias("n_genes")).withColumn("density", F.col("tz_count") / area)


def hex_qc(hexes: DataFrame, min_count: int | None = None, min_density: float | None = None) -> DataFrame:
    """``filtered`` marks hexagons that fail; a density bound overrides a count bound; without bounds none fails."""
    passed = F.col("density") >= min_density if min_density is not None else F.col("tz_count") >= min_count if min_count is not None else F.lit(True)
    return hexes.withColumn("filtered", ~passed)


def smoothed(bins: DataFrame, sigma: float) -> DataFrame:
    """(row, col, value): Gaussian sums of the counts around every cell that they reach, zero outside."""
    radius = int(4 * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    kernel = F.array(*[F.lit(w / sum(weights)) for w in weights])
    steps = F.posexplode(kernel)
    down = bins.select("col", F.col("row").alias("r0"), "n", steps.alias("k", "w")).groupBy((F.col("r0") + F.col("k") - radius).alias("row"), "col").agg(F.sum(F.col("n") * F.col("w")).alias("n"))
    return down.select("row", F.col("col").alias("c0"), "n", steps.alias("k", "w")).groupBy("row", (F.col("c0") + F.col("k") - radius).alias("col")).agg(F.sum(F.col("n") * F.col("w")).alias("value"))


CROSS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)]


def _spread(mask: DataFrame) -> DataFrame:
    offsets = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in CROSS]))
    return mask.select("row", "col", offsets.alias("o")).select((F.col("row") + F.col("o.a")).alias("row"), (F.col("col") + F.col("o.b")).alias("col"))


def dilated(mask: DataFrame) -> DataFrame:
    return _spread(mask).distinct()


def eroded(mask: DataFrame, times: int = 1) -> DataFrame:
    """Cells whose four neighbours are all in the mask; outside is background."""
    for _ in range(times):
        mask = _spread(mask).groupBy("row", "col").agg(F.count("*").alias("k")).where("k = 5").select("row", "col")
    return mask


def closed(mask: DataFrame) -> DataFrame:
    return eroded(dilated(mask))


def linked_parts(nodes: DataFrame, near: DataFrame) -> DataFrame:
    """(id, label): connected parts of the nodes (id), named by their least id, by least labels and pointer jumping; ``near`` has (id, other) in both directions.

    A round ends in a table of the shared folder, and the table of the round before is deleted.
    """
    near, labels = cut(near, "near"), cut(nodes.select("id", F.col("id").alias("label")), "labels")
    while True:
        heard = near.join(labels.select(F.col("id").alias("other"), "label"), "other").groupBy("id").agg(F.min("label").alias("heard"))
        hop = labels.join(heard, "id", "left").select("id", "label", F.least("label", F.coalesce("heard", "label")).alias("next"))
        far = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        old = labels
        moved = cut(hop.join(far, "next", "left").select("id", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        labels = moved
        forget(old)
        if moved.where("old <> label").isEmpty():
            forget(near)
            return labels.select("id", "label")


def mask_components(mask: DataFrame) -> DataFrame:
    """(row, col, component): 4-connected parts named by their least cell."""
    key = F.col("row") * (1 << 31) + F.col("col")
    cells = cut(mask.select("row", "col", key.alias("id")), "mask")
    return cells.join(linked_parts(cells.select("id"), _pairs(cells)), "id").select("row", "col", F.col("label").alias("component"))


def _pairs(cells: DataFrame) -> DataFrame:
    offsets = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in CROSS[1:]]))
    around = cells.select("id", "row", "col", offsets.alias("o")).select("id", (F.col("row") + F.col("o.a")).alias("row"), (F.col("col") + F.col("o.b")).alias("col"))
    return around.join(cells.withColumnRenamed("id", "other"), ["row", "col"]).select("id", "other")


def tile_index(height: int, width: int, tile: int, overlap: int, spark) -> DataFrame:
    """(tile_id, row, col): upper left corners in steps of tile - overlap, with edge tiles moved inside."""
    step = tile - overlap
    places = lambda n: sorted({*range(0, max(n - tile, 0) + 1, step), max(n - tile, 0)})
    rows, cols = (spark.createDataFrame([(x,) for x in places(n)], f"{name} int") for n, name in ((height, "row"), (width, "col")))
    return rows.join(cols, F.lit(True)).withColumn("tile_id", F.row_number().over(Window.orderBy("row", "col")) - 1)
