"""Per-cell quality metrics, filters and normalisation over long (cell, gene, count) tables; absent pairs are zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.quantiles import places_of, quantiles, quantiles_of


def qc_metrics(counts: DataFrame, spine: DataFrame) -> DataFrame:
    """``spine`` with nCount, nFeature, nBlank and nCount per volume; cells without counts have zeros."""
    gene = ~F.col("is_blank")
    sums = counts.groupBy("cell_id").agg(
        F.sum(F.when(gene, F.col("count")).otherwise(0.0)).alias("n_count"), F.count_if(gene & (F.col("count") != 0)).alias("n_feature"), F.sum(F.when(gene, 0.0).otherwise(F.col("count"))).alias("n_blank"),
    )
    out = spine.join(sums, "cell_id", "left").fillna(0, ["n_count", "n_feature", "n_blank"])
    return out.withColumn("count_per_volume", F.try_divide("n_count", "volume"))


def within(bounds: dict[str, tuple[float | None, float | None]]) -> Column:
    """All columns inside their inclusive bounds; a missing bound doesn't limit, a null or NaN value fails."""
    out = F.lit(True)
    for name, (low, high) in bounds.items():
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        out = out & F.coalesce((value >= low if low is not None else F.lit(True)) & (value <= high if high is not None else F.lit(True)) & value.isNotNull(), F.lit(False))
    return out


def filter_cells(metrics: DataFrame, bounds: dict, quantile_columns: list[str], low: float, high: float) -> DataFrame:
    """``pass_qc_pre`` by fixed bounds; ``pass_qc`` also by the quantiles of the cells that pass them."""
    first = metrics.withColumn("pass_qc_pre", within(bounds))
    inside = F.col("pass_qc_pre")
    found = quantiles_of(first.where("pass_qc_pre"), dict.fromkeys(quantile_columns, [low, high]))
    for c, (least, most) in found.items():
        inside = inside & (F.coalesce(F.col(c).between(least, most), F.lit(False)) if least is not None else F.lit(False))
    return first.withColumn("pass_qc", inside)


def nearest_quantile(rows: DataFrame, column: str, q: float) -> DataFrame:
    """One row (value): the stored value nearest to the q-quantile's place, round(q * (n - 1)) of the sorted values; no row without values."""
    n, at = places_of(rows, {column: [(q, "nearest")]})[column]
    return rows.sparkSession.createDataFrame([(at[q, "nearest"],)] if n else [], "value double")


def with_floor(cells: DataFrame, column: str, q: float | None) -> DataFrame:
    """``cells`` whose ``pass_qc`` also asks for ``column`` at or above a floor: the q-quantile (nearest value) of the cells that fail ``pass_qc_pre``.

    Without q, or where none fails or the failing ones have no values, nothing changes; a null or NaN value doesn't reach a floor.
    """
    if q is None:
        return cells
    n, at = places_of(cells.where(~F.col("pass_qc_pre")), {column: [(q, "nearest")]})[column]
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return cells.withColumn("pass_qc", F.col("pass_qc") & F.coalesce(value >= at[q, "nearest"], F.lit(False))) if n else cells


def group_medians(cells: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(*keys, *columns, n): the median of each column and the number of cells of each group; a null key is a group, null values don't count."""
    return cells.groupBy(*keys).agg(*[F.median(c).alias(c) for c in columns], F.count("*").alias("n"))


def volume_normalised(counts: DataFrame, spine: DataFrame) -> DataFrame:
    return counts.join(spine.select("cell_id", "volume"), "cell_id").select("cell_id", "gene", (F.col("count") / F.col("volume")).alias("value"))


def library_normalised(counts: DataFrame, target: float | None = None) -> DataFrame:
    """log1p of counts scaled to ``target`` a cell; without one, to the median of the cells' totals."""
    totals = counts.groupBy("cell_id").agg(F.sum("count").alias("total"))
    goal = quantiles(totals, "total", [0.5])[0] if target is None else target
    rows = counts.join(totals.where("total > 0"), "cell_id").withColumn("goal", F.lit(goal).cast("double"))
    return rows.select("cell_id", "gene", F.log1p(F.col("count") * F.col("goal") / F.col("total")).alias("value"))


def scaled(values: DataFrame, spine: DataFrame, clip: float = 10.0) -> DataFrame:
    """z-scores of each gene over all cells of the spine, zeros included, clipped from above."""
    moments = values.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    n = spine.agg(F.count("*").cast("double").alias("n"))
    stats = moments.crossJoin(F.broadcast(n)).select("gene", (F.col("s") / F.col("n")).alias("mean"), F.sqrt((F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)).alias("sd"))
    dense = spine.select("cell_id").join(stats, F.lit(True)).join(values, ["cell_id", "gene"], "left")
    return dense.select("cell_id", "gene", F.least(F.try_divide(F.coalesce("value", F.lit(0.0)) - F.col("mean"), "sd"), F.lit(clip)).alias("z"))


def group_stats(counts: DataFrame, spine: DataFrame) -> DataFrame:
    """(cluster, gene, share_expressing, mean): zeros included through the clusters' sizes."""
    sizes = spine.groupBy("cluster").agg(F.count("*").alias("n"))
    sums = counts.join(spine.select("cell_id", "cluster"), "cell_id").groupBy("cluster", "gene").agg(F.count_if(F.col("count") > 0).alias("k"), F.sum("count").alias("s"))
    return sums.join(F.broadcast(sizes), "cluster").select("cluster", "gene", (F.col("k") / F.col("n")).alias("share_expressing"), (F.col("s") / F.col("n")).alias("mean"))


def min_support(counts: DataFrame, min_cells: int, min_genes: int) -> DataFrame:
    """Genes of ``min_cells`` cells at least, then cells of ``min_genes`` of these genes at least."""
    genes = counts.where("count > 0").groupBy("gene").agg(F.count("*").alias("n")).where(F.col("n") >= min_cells).select("gene")
    kept = counts.join(genes, "gene", "left_semi")
    some = kept.where("count > 0").groupBy("cell_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_genes).select("cell_id")
    return kept.join(some, "cell_id", "left_semi")


def count_matrix(counts: DataFrame, spine: DataFrame, genes: list[str]) -> DataFrame:
    """One row a cell of the spine and one column a gene, zeros filled in."""
    wide = counts.groupBy("cell_id").pivot("gene", genes).agg(F.sum("count"))
    return spine.select("cell_id").join(wide, "cell_id", "left").fillna(0.0, genes)
