"""Regions of high expression: hexagon counts of some genes, a mixture for each gene, agreement of genes, connected parts and their hulls.

1. Points of the wanted genes are counted in a grid of hexagons over their bounds; a hexagon with any of them counts for every gene, with
   zero where it has none of that gene.
2. A gene's counts are summed up to a histogram before they are gathered, so a task of ``mixtures`` holds a gene's distinct counts, not its
   hexagons. Genes are fitted side by side: one-dimensional Gaussian mixtures by expectation and maximisation, from groups of equal
   size, with the number of components given or taken by the least BIC of one to three.
3. A hexagon speaks for a gene if the component that fits its count best is among the ``top`` ones by mean count. Hexagons where enough
   genes do are joined with their six neighbours; parts of ``least`` hexagons or more become their convex hull, and hulls that
   meet become one region. Of each row of hexagons of a part only the first and the last are corners of a hull, so only these are gathered.

Rows: points with a null gene or place don't count; ties between components go to the one of the larger mean; genes with a single
count have one component; genes without points agree with nothing but count for the share; empty input gives no regions.
"""

from __future__ import annotations

from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O
from tessella.operators import harmony as H
from tessella.operators.polygons import hex_genes, hex_grid
from tessella.operators.space import linked_parts
from tessella.sources.tables import cut

#: Least variance, and the gain of the mean log-likelihood below which a fit ends.
LEAST_VARIANCE, GAIN, STEPS = 1e-6, 1e-3, 100
MODEL = "gene string, component int, weight double, mean double, variance double"


def _log_density(values: np.ndarray, weight: np.ndarray, mean: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """(values, components)"""
    return np.log(weight) - 0.5 * (np.log(2 * pi * variance) + (values[:, None] - mean) ** 2 / variance)


def fit_mixture(values: np.ndarray, n: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(weights, means, variances, BIC) of distinct ``values`` that occur ``n`` times; components in the order of their means."""
    total = n.sum()
    components = min(components, len(values))
    order = np.argsort(values)
    values, n = values[order].astype(float), n[order].astype(float)
    # from groups of equal size in the order of values
    begin, end = np.cumsum(n) - n, np.cumsum(n)
    bounds = np.linspace(0, total, components + 1)
    share = np.clip(np.minimum(end[:, None], bounds[1:]) - np.maximum(begin[:, None], bounds[:-1]), 0, None) / n[:, None]
    before = -np.inf
    for _ in range(STEPS):
        mass = (share * n[:, None]).sum(0) + 10 * np.finfo(float).eps
        mean = (share * n[:, None] * values[:, None]).sum(0) / mass
        variance = (share * n[:, None] * (values[:, None] - mean) ** 2).sum(0) / mass + LEAST_VARIANCE
        log = _log_density(values, mass / total, mean, variance)
        top = log.max(1, keepdims=True)
        likely = top[:, 0] + np.log(np.exp(log - top).sum(1))
        share = np.exp(log - likely[:, None])
        now = float((likely * n).sum() / total)
        if abs(now - before) < GAIN:
            break
        before = now
    order = np.argsort(mean, kind="stable")
    return (mass / total)[order], mean[order], variance[order], -2 * now * total + (3 * components - 1) * np.log(total)


def mixtures(counts: DataFrame, components: int | None = 3) -> DataFrame:
    """(gene, component, weight, mean, variance) of the counts (gene, n) of each gene; without a number, that of the least BIC of 1 to 3."""

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values, times = pdf["n"].to_numpy(float), pdf["times"].to_numpy(float)
        fits = [fit_mixture(values, times, k) for k in ([components] if components else [1, 2, 3])]
        weight, mean, variance, _ = min(fits, key=lambda f: f[3])
        return pd.DataFrame({"gene": key[0], "component": range(len(mean)), "weight": weight, "mean": mean, "variance": variance})

    return counts.groupBy("gene", "n").agg(F.count("*").alias("times")).groupBy("gene").applyInPandas(fit, MODEL)


def hex_counts(points: DataFrame, genes: list[str], size: float, overlap: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The hexagons over the points (gene, x, y) of ``genes``, and (hex_id, gene, n) of each hexagon with any of them and every gene."""
    wanted = points.where(F.col("gene").isin(genes) & F.col("x").isNotNull() & F.col("y").isNotNull()).select("gene", "x", "y")
    low_x, low_y, high_x, high_y = wanted.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    bounds = (low_x, low_y, high_x, high_y) if low_x is not None else (0.0, 0.0, 0.0, 0.0)
    hexes = hex_grid(points.sparkSession, bounds, size, overlap)
    found = cut(hex_genes(wanted, hexes, size), "hexes")
    every = found.select("hex_id").distinct().withColumn("gene", F.explode(F.array(*map(F.lit, genes))))
    return hexes, every.join(found, ["hex_id", "gene"], "left").select("hex_id", "gene", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def speaking(counts: DataFrame, model: DataFrame, top: int = 1) -> DataFrame:
    """(hex_id, gene) where the best component of the count is among the ``top`` ones by the mean of the counts that fall to them."""
    log = F.log("weight") - 0.5 * (F.log(2 * pi * F.col("variance")) + (F.col("n") - F.col("mean")) ** 2 / F.col("variance"))
    # a histogram again: each distinct count of a gene is decided once
    distinct = counts.groupBy("gene", "n").agg(F.count("*").alias("times"))
    best = distinct.join(model, "gene").groupBy("gene", "n", "times").agg(F.max_by("component", F.struct(log, "component")).alias("component"))
    means = best.groupBy("gene", "component").agg((F.sum(F.col("n") * F.col("times")) / F.sum("times")).alias("of"))
    place = F.row_number().over(Window.partitionBy("gene").orderBy(F.desc("of"), F.desc("component")))
    chosen = means.withColumn("place", place).where(F.col("place") <= top).select("gene", "component")
    return counts.join(best.join(chosen, ["gene", "component"]).select("gene", "n"), ["gene", "n"], "left_semi").select("hex_id", "gene")


def agreed_hexes(counts: DataFrame, genes: list[str], components: int | None = 3, top: int = 1, agreement: float = 0.75) -> DataFrame:
    """(hex_id, share) of the hexagons that speak for ``agreement`` of the genes or more."""
    counts = cut(counts, "counts")
    said = speaking(counts, mixtures(counts, components), top).groupBy("hex_id").agg((F.count("*") / F.lit(len(genes))).alias("share"))
    return said.where(F.col("share") >= agreement)


def hex_parts(hexes: DataFrame) -> DataFrame:
    """``hexes`` (hex_id, row, col, ...) with ``part``: the least hex_id of those that are connected by common sides."""
    odd = F.pmod("row", F.lit(2))
    beside = [(0, F.lit(-1)), (0, F.lit(1)), *[(up, odd - 1) for up in (-1, 1)], *[(up, odd) for up in (-1, 1)]]  # odd rows are moved by half a step
    at = F.explode(F.array(*[F.struct((F.col("row") + up).alias("row"), (F.col("col") + side).alias("col")) for up, side in beside]))
    around = hexes.select("hex_id", at.alias("at")).select("hex_id", "at.row", "at.col")
    near = around.join(hexes.select("row", "col", F.col("hex_id").alias("other")), ["row", "col"]).select(F.col("hex_id").alias("id"), "other")
    return hexes.join(linked_parts(hexes.select(F.col("hex_id").alias("id")), near).select(F.col("id").alias("hex_id"), F.col("label").alias("part")), "hex_id")


def part_hulls(parts: DataFrame) -> DataFrame:
    """(part, n, polygon): the convex hull of each part's hexagons (part, row, col, polygon)."""
    ends = parts.groupBy("part", "row").agg(F.count("*").alias("n"), F.min_by("polygon", "col").alias("first"), F.max_by("polygon", "col").alias("last"))
    corners = F.flatten(F.collect_list(F.concat(F.get("first", 0), F.get("last", 0))))
    hulls = ends.groupBy("part").agg(F.sum("n").alias("n"), corners.alias("points"))
    return hulls.select("part", "n", F.array(G.hull_ring("points")).alias("polygon"))


def joined_hulls(hulls: DataFrame) -> DataFrame:
    """(region, polygon): hulls (part, polygon) that meet as one, in parts of their own where they don't; region is the least part."""
    flat = cut(hulls.select(F.col("part").alias("entity_id"), F.lit(0).alias("z"), "polygon"), "hulls")
    pairs = H.meeting(flat)
    near = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    labels = linked_parts(flat.select(F.col("entity_id").alias("id")), near).select(F.col("id").alias("entity_id"), F.col("label").alias("region"))
    many = flat.join(labels, "entity_id").groupBy("region").agg(F.collect_list("polygon").alias("many"))
    return many.select("region", F.explode(O.union_all(F.col("many"))).alias("polygon"))


def called_regions(points: DataFrame, genes: list[str], size: float = 50.0, overlap: float = 0.0, components: int | None = 3, top: int = 1, agreement: float = 0.75, least: int = 5) -> DataFrame:
    """(region, polygon): where the counts of ``genes`` are high together; see above."""
    hexes, counts = hex_counts(points, genes, size, overlap)
    chosen = cut(hexes.join(agreed_hexes(counts, genes, components, top, agreement), "hex_id", "left_semi"), "chosen")
    return joined_hulls(part_hulls(hex_parts(chosen)).where(F.col("n") >= least))
