"""Overlaps of one segmentation resolved in a stated order: merging and trimming (``harmonised``), and greedy merging (``merged_overlaps``).

Both are sequential by nature: what happens to a pair depends on what happened to its polygons before. They run in rounds of
joins instead of one by one. In ``harmonised`` a pair waits until it is the first of all open pairs of both its polygons; all such pairs
are independent and are resolved at once, so the result is that of the sequence, and a chain of overlaps of any size never comes
together in one task. In ``merged_overlaps`` a polygon waits until all smaller ids that it overlaps are decided.

The order of ``harmonised`` is by the part of the smaller polygon that a pair shares at first, largest first, then by ids; with such
an order, which is unrelated to the place, the rounds grow with the logarithm of the polygons. Every round ends in a table of the
shared folder, and the table of the round before is deleted.

Rows: (entity_id, z, polygon) with one row for each entity of a plane; planes are resolved apart; null and empty polygons take no part
and have no area, so ``harmonised`` drops them; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import overlay as O
from tessella.operators.polygons import met_bounds
from tessella.operators.space import as_forms
from tessella.sources.tables import cut, forget

KEY = ["z", "entity_id"]
CELL = [*KEY, "polygon"]


def meeting(polygons: DataFrame, size: float | None = None) -> DataFrame:
    """(z, a, b, share): pairs a < b of one plane that share a point, with the part of the smaller one that they share."""
    met = met_bounds(polygons, polygons, size).where("id_a < id_b")
    areas = O.shared_areas(F.col("polygon_a"), F.col("polygon_b"))
    met = met.select("z", F.col("id_a").alias("a"), F.col("id_b").alias("b"), areas.alias("of"), O.touching(F.col("polygon_a"), F.col("polygon_b")).alias("touch"))
    share = F.coalesce(F.try_divide(F.col("of.shared"), F.least("of.area_a", "of.area_b")), F.lit(0.0))
    return met.where(F.col("touch") | (F.col("of.shared") > 0)).select("z", "a", "b", F.round(share, 9).alias("share"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("entity_id", F.explode(F.array("a", "b")))


def _first(pairs: DataFrame) -> DataFrame:
    """The pairs that are the first of all open pairs of both their polygons."""
    order = F.struct((-F.col("share")).alias("s"), "a", "b")
    least = _ends(pairs).groupBy(*KEY).agg(F.min(order).alias("least"))
    mine = _ends(pairs).join(least, KEY).where(order == F.col("least"))
    return mine.groupBy("z", "a", "b").agg(F.count("*").alias("n")).where("n = 2").select("z", "a", "b")


def _with_polygons(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    of = lambda s: cells.select("z", F.col("entity_id").alias(s), F.col("polygon").alias(f"polygon_{s}"))
    return pairs.join(of("a"), ["z", "a"]).join(of("b"), ["z", "b"])


def _resolved(cells: DataFrame, pairs: DataFrame, resolve) -> DataFrame:
    """``cells`` after all pairs in their order; ``resolve`` gives (z, entity_id, polygon) of what changes, with a null polygon for what goes."""
    cells, pairs = cut(cells, "cells"), cut(pairs, "pairs")
    while not pairs.isEmpty():
        now = cut(_first(pairs), "now")
        changed = cut(resolve(_with_polygons(now, cells)).select(CELL), "changed")
        gone = changed.where("polygon IS NULL").select("z", F.col("entity_id").alias("gone"))
        left = pairs.join(now, ["z", "a", "b"], "left_anti")
        for end in ("a", "b"):
            left = left.join(gone.select("z", F.col("gone").alias(end)), ["z", end], "left_anti")
        old = cells, pairs
        cells = cut(cells.join(changed, KEY, "left_anti").select(CELL).unionByName(changed.where("polygon IS NOT NULL")), "cells")
        pairs = cut(left.select("z", "a", "b", "share"), "pairs")
        forget(*old, now, changed)
    forget(pairs)
    return cells


def _merge(pairs: DataFrame, above: float) -> DataFrame:
    one, two = F.col("polygon_a"), F.col("polygon_b")
    pairs = pairs.withColumn("of", O.shared_areas(one, two)).where(F.col("of.shared") > above * F.least("of.area_a", "of.area_b"))
    both = pairs.withColumn("union", O.rings_of(O.overlay(one, two, "union"))).withColumn("first", F.col("of.area_a") > F.col("of.area_b"))
    keeps, goes = F.when(F.col("first"), F.col("a")).otherwise(F.col("b")), F.when(F.col("first"), F.col("b")).otherwise(F.col("a"))
    out = F.array(F.struct(keeps.alias("entity_id"), F.col("union").alias("polygon")), F.struct(goes.alias("entity_id"), F.lit(None).cast("array<array<struct<x:double,y:double>>>").alias("polygon")))
    return both.select("z", F.explode(out).alias("c")).select("z", "c.*")


def _trim(pairs: DataFrame, distance: float) -> DataFrame:
    first = O.area(F.col("polygon_a")) > O.area(F.col("polygon_b"))
    sides = pairs.withColumn("first", first)
    pick = lambda a, b: F.when(F.col("first"), F.col(a)).otherwise(F.col(b))
    sides = sides.select("z", pick("a", "b").alias("entity_id"), pick("polygon_a", "polygon_b").alias("large"), pick("polygon_b", "polygon_a").alias("small"))
    return sides.select(*KEY, O.rings_of(O.trimmed(F.col("large"), F.col("small"), distance)).alias("polygon"))


def _one_of_copies(polygons: DataFrame, above: float) -> DataFrame:
    """``polygons`` without copies that would become one anyway.

    Copies share everything, so their pairs come before all that share less, and each goes into the one of the next id. Until then only polygons that
    lie within each other have met, whose union is the larger one; so it is no matter which of them took a copy.
    """
    forms, members = as_forms(polygons, "z", "polygon")
    of = O.shared_areas(F.col("polygon"), F.col("polygon"))
    one = (F.round(F.try_divide(of["shared"], of["area_a"]), 9) == 1) & (of["shared"] > above * of["area_a"])
    forms = cut(forms.withColumn("one", F.coalesce(one, F.lit(False))), "forms")
    apart = forms.where("NOT one").join(members, "form")
    return forms.where("one").select(F.col("most").alias("entity_id"), "z", "polygon").select(CELL).unionByName(apart.select(CELL))


def harmonised(polygons: DataFrame, min_distance: float = 2.0, min_area: float = 100.0, above: float = 0.5, size: float | None = None) -> DataFrame:
    """(entity_id, z, polygon, area) without overlaps.

    Pairs that share more than ``above`` of the smaller polygon's area become one: the larger one (of equal ones the larger id) takes the union,
    the smaller one goes. Of pairs that still meet, the larger one (as above) loses what lies within ``min_distance`` of the other.
    Polygons of ``min_area`` or less go at the end. Copies of one plane meet others once if ``above`` lets them become one; else each for itself.
    """
    cells = cut(_one_of_copies(cut(polygons.select(CELL).where(F.size("polygon") > 0), "cells"), above), "cells")
    merged = _resolved(cells, meeting(cells, size), lambda pairs: _merge(pairs, above))
    trimmed = _resolved(merged, meeting(merged, size), lambda pairs: _trim(pairs, min_distance))
    return trimmed.withColumn("area", O.area(F.col("polygon"))).where(F.col("area") > min_area).select("entity_id", "z", "polygon", "area")


def merged_overlaps(polygons: DataFrame, least: float | None = None, size: float | None = None) -> DataFrame:
    """(entity_id, z, polygon, merged): polygons of neighbouring tiles that are the same object, as their union under the smallest id.

    In the order of ids, each polygon that isn't taken yet takes all free ones that share half of the smaller area with it (or ``least``, an area). What
    only overlaps a polygon that was taken stays for itself: groups are not closed over chains.
    """
    # copies of one plane share the same with every other polygon, so they go where the one of the least id goes
    rows = polygons.select(CELL).where(F.size("polygon") > 0)
    forms, members = as_forms(rows, "z", "polygon")
    cells = cut(forms.select("z", F.col("least").alias("entity_id"), "polygon"), "cells")
    enough = F.col("of.shared") >= (F.lit(float(least)) if least is not None else F.least("of.area_a", "of.area_b") * 0.5)
    met = met_bounds(cells, cells, size).where("id_a < id_b").repartition("id_a", "id_b").withColumn("of", O.shared_areas(F.col("polygon_a"), F.col("polygon_b"))).where("of.shared > 0")
    pairs = cut(met.where(enough).select("z", "id_a", F.col("id_b").alias("entity_id")), "pairs")  # id_a is the smaller
    # state: null while open, an id once taken by it, the own id for one that takes
    state = cut(cells.select(*KEY, F.when(F.lit(False), F.col("entity_id")).alias("by")), "state")
    while True:
        known = pairs.join(state.select("z", F.col("entity_id").alias("id_a"), F.col("by").alias("by_a")), ["z", "id_a"])
        # the least taker among smaller neighbours counts once all neighbours before it are decided
        of = known.groupBy(*KEY).agg(F.min(F.when(F.col("by_a").isNull(), F.col("id_a"))).alias("open"), F.min(F.when(F.col("by_a") == F.col("id_a"), F.col("id_a"))).alias("taker"))
        sure = F.col("taker").isNotNull() & (F.col("open").isNull() | (F.col("taker") < F.col("open")))
        by = F.when(F.col("by").isNotNull(), F.col("by")).when(sure, F.col("taker")).when(F.col("open").isNull() & F.col("taker").isNull(), F.col("entity_id"))
        old = state
        state = cut(state.join(of, KEY, "left").select(*KEY, by.alias("by")), "state")
        forget(old)
        if state.where("by IS NULL").isEmpty():
            break
    # copies of less than ``least`` share too little, with each other too: each but the first stays for itself
    own = O.shared_areas(F.col("polygon"), F.col("polygon"))["shared"]
    enough_of_it = F.lit(True) if least is None else own >= float(least)
    taken = state.join(forms.select("form", "z", F.col("least").alias("entity_id"), "polygon", ((own > 0) & enough_of_it).alias("one")), KEY)
    taken = cut(taken.join(members.groupBy("form").agg(F.count("*").alias("copies")), "form"), "taken")
    others = members.join(taken.where("NOT one AND copies > 1").select("form", "z", F.col("entity_id").alias("first"), "polygon"), "form").where("entity_id <> first")
    alone = others.select("entity_id", "z", "polygon", F.lit(False).alias("merged"))
    groups = taken.groupBy("z", "by").agg(F.collect_list("polygon").alias("many"), F.sum(F.when(F.col("one"), F.col("copies")).otherwise(1)).alias("n"))
    whole = groups.where("n = 1").select("z", "by", F.get("many", 0).alias("polygon"), F.lit(False).alias("merged"))
    union = groups.where("n > 1").select("z", "by", O.rings_of(O.union_all(F.col("many"))).alias("polygon"), F.lit(True).alias("merged"))
    return whole.unionByName(union).select(F.col("by").alias("entity_id"), "z", "polygon", "merged").unionByName(alone)
