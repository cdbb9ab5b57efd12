"""Marker statistics over long count tables whose absent pairs are zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_sums(counts: DataFrame, spine: DataFrame) -> DataFrame:
    """(gene, cluster, u, z): one cluster against the rest, with midranks, implicit zeros as one tied block, and tie correction.

    Stored values are counted by value first, so the window of a gene runs over its distinct values and not over cells.
    """
    sizes = spine.groupBy("cluster").agg(F.count("*").alias("n1"))
    total = spine.agg(F.count("*").alias("n"))
    stored = counts.where("count > 0").join(spine.select("cell_id", "cluster"), "cell_id")
    values = stored.groupBy("gene", "count").agg(F.count("*").alias("t"))
    zeros = values.groupBy("gene").agg(F.sum("t").alias("stored")).crossJoin(F.broadcast(total)).select("gene", (F.col("n") - F.col("stored")).alias("zeros"), "n")
    below = Window.partitionBy("gene").orderBy("count").rowsBetween(Window.unboundedPreceding, -1)
    ranks = values.withColumn("before", F.coalesce(F.sum("t").over(below), F.lit(0))).join(zeros, "gene").withColumn("midrank", F.col("zeros") + F.col("before") + (F.col("t") + 1) / 2)
    cube = lambda c: F.col(c).cast("double") * F.col(c) * F.col(c) - F.col(c)
    ties = ranks.groupBy("gene").agg((F.sum(cube("t")) + F.max(cube("zeros"))).alias("ties"))
    sums = stored.join(ranks.select("gene", "count", "midrank"), ["gene", "count"]).groupBy("gene", "cluster").agg(F.sum("midrank").alias("r"), F.count("*").alias("k"))
    spread = zeros.join(ties, "gene").join(F.broadcast(sizes), F.lit(True)).join(sums, ["gene", "cluster"], "left").fillna(0, ["r", "k"])
    full = F.col("r") + (F.col("n1") - F.col("k")) * (F.col("zeros") + 1) / 2
    u = full - F.col("n1") * (F.col("n1") + 1) / 2
    n2 = F.col("n") - F.col("n1")
    variance = F.col("n1") * n2 / 12 * ((F.col("n") + 1) - F.col("ties") / (F.col("n") * (F.col("n") - 1)))
    return spread.select("gene", "cluster", u.alias("u"), F.try_divide(u - F.col("n1") * n2 / 2, F.sqrt(variance)).alias("z"))


def adjusted(p: str, group: str) -> Column:
    """Benjamini-Hochberg values of the column ``p`` inside each group."""
    m = F.count(p).over(Window.partitionBy(group))
    rank = F.rank().over(Window.partitionBy(group).orderBy(p)) + F.count(p).over(Window.partitionBy(group, p)) - 1
    raised = F.col(p) * m / rank
    return F.least(raised, F.lit(1.0))


def bh(rows: DataFrame, p: str, group: str, out: str) -> DataFrame:
    """``rows`` with the step-up adjusted p-values in ``out``."""
    first = rows.withColumn(out, adjusted(p, group))
    return first.withColumn(out, F.min(out).over(Window.partitionBy(group).orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0)))


def pseudobulk(counts: DataFrame, spine: DataFrame, sample: str, group: str) -> DataFrame:
    """(sample, group, gene, count): rounded sums; pairs without counts have no row."""
    return counts.join(spine.select("cell_id", sample, group), "cell_id").groupBy(sample, group, "gene").agg(F.bround(F.sum("count")).alias("count")).where("count > 0")


def size_factors(bulk: DataFrame, sample: str) -> DataFrame:
    """(sample, factor): median ratio to the geometric means of the genes that every sample has."""
    n = bulk.select(sample).distinct().agg(F.count("*").alias("n_samples"))
    means = bulk.groupBy("gene").agg(F.avg(F.ln("count")).alias("log_mean"), F.count("*").alias("k")).crossJoin(F.broadcast(n)).where("k = n_samples").select("gene", "log_mean")
    return bulk.join(means, "gene").groupBy(sample).agg(F.exp(F.median(F.ln("count") - F.col("log_mean"))).alias("factor"))


def pairwise(counts: DataFrame, spine: DataFrame) -> DataFrame:
    """(gene, a, b, delta_mean, delta_detected, cohen_d) of each ordered pair of clusters."""
    sizes = spine.groupBy("cluster").agg(F.count("*").cast("double").alias("n"))
    genes = counts.select("gene").distinct()
    sums = counts.join(spine.select("cell_id", "cluster"), "cell_id").groupBy("gene", "cluster").agg(F.sum("count").alias("s"), F.sum(F.col("count") * F.col("count")).alias("ss"), F.count_if(F.col("count") > 0).alias("k"))
    full = genes.join(F.broadcast(sizes), F.lit(True)).join(sums, ["gene", "cluster"], "left").fillna(0, ["s", "ss", "k"])
    m = full.select("gene", "cluster", (F.col("s") / F.col("n")).alias("mean"), ((F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)).alias("var"), (F.col("k") / F.col("n")).alias("seen"))
    one, two = (m.select("gene", F.col("cluster").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("mean", "var", "seen")]) for c in ("a", "b"))
    delta = F.col("mean_a") - F.col("mean_b")
    return one.join(two, "gene").where("a <> b").select("gene", "a", "b", delta.alias("delta_mean"), (F.col("seen_a") - F.col("seen_b")).alias("delta_detected"), F.try_divide(delta, F.sqrt((F.col("var_a") + F.col("var_b")) / 2)).alias("cohen_d"))


def top_each(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, with their ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def p_two_sided(z: Column) -> Column:
    """The two-sided normal p-value of ``z``: a rational approximation of the error function's complement, relative error below 1.2e-7."""
    x = F.abs(z) / 1.4142135623730951
    t = 1 / (1 + 0.5 * x)
    #: Coefficients of the approximation, from the highest power of t down.
    terms = [0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368]
    poly = F.lit(0.0)
    for c in terms:
        poly = poly * t + c
    return t * F.exp(-x * x - 1.26551223 + t * poly)


def one_against_rest(counts: DataFrame, spine: DataFrame, min_cells: int = 10, max_cells: int | None = None, correction: str = "fdr_bh", p_at: float = 0.05, lfc_at: float = 0.5, log1p: bool = True) -> DataFrame:
    """(gene, cluster, u, z, p, p_adj, log2_fold_change, significant, rank): one cluster against the rest by rank sums.

    Clusters of fewer than ``min_cells`` cells take no part; with ``max_cells`` each keeps that many, by a hash of the ids. Fold changes are
    those of means of counts, which are taken back from log1p if ``log1p``. Order: significant first, then by adjusted p and fold change.
    """
    size = F.count("*").over(Window.partitionBy("cluster"))
    cells = spine.select("cell_id", "cluster").withColumn("n", size).where(F.col("n") >= min_cells)
    if max_cells is not None:
        cells = cells.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("cell_id"), "cell_id"))).where(F.col("r") <= max_cells)
    cells = cells.select("cell_id", "cluster")
    kept = counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    ranks = rank_sums(kept, cells)
    n = cells.groupBy("cluster").agg(F.count("*").alias("n1"))
    sums = kept.join(cells, "cell_id").groupBy("gene", "cluster").agg(F.sum("count").alias("s"))
    total = kept.groupBy("gene").agg(F.sum("count").alias("total"))
    means = ranks.join(n, "cluster").join(sums, ["gene", "cluster"], "left").join(total, "gene").crossJoin(F.broadcast(cells.agg(F.count("*").alias("n"))))
    back = (lambda m: F.expm1(m)) if log1p else (lambda m: m)
    a, b = F.coalesce("s", F.lit(0.0)) / F.col("n1"), F.try_divide(F.col("total") - F.coalesce("s", F.lit(0.0)), F.col("n") - F.col("n1"))
    lfc = F.log2((back(a) + 1e-9) / (back(b) + 1e-9))
    out = means.select("gene", "cluster", "u", "z", F.coalesce(p_two_sided(F.col("z")), F.lit(1.0)).alias("p"), lfc.alias("log2_fold_change"))
    if correction == "fdr_bh":
        out = bh(out, "p", "cluster", "p_adj")
    elif correction == "bonferroni":
        out = out.withColumn("p_adj", F.least(F.col("p") * F.count("*").over(Window.partitionBy("cluster")), F.lit(1.0)))
    else:
        out = out.withColumn("p_adj", F.col("p"))
    out = out.withColumn("significant", (F.col("p_adj") < p_at) & (F.abs("log2_fold_change") > lfc_at))
    order = Window.partitionBy("cluster").orderBy(F.desc("significant"), "p_adj", F.desc("log2_fold_change"), "gene")
    return out.withColumn("rank", F.row_number().over(order))


def marker_summary(tested: DataFrame, top: int = 10) -> DataFrame:
    """(cluster, genes_tested, significant_genes, upregulated, downregulated, top_up, top_down) of the rows of ``one_against_rest``."""
    up, down = F.col("significant") & (F.col("log2_fold_change") > 0), F.col("significant") & (F.col("log2_fold_change") < 0)
    listed = lambda c: F.transform(F.slice(F.array_sort(F.collect_list(F.when(c, F.struct("rank", "gene")))), 1, top), lambda x: x["gene"])
    return tested.groupBy("cluster").agg(
        F.count("*").alias("genes_tested"), F.count_if("significant").alias("significant_genes"), F.count_if(up).alias("upregulated"), F.count_if(down).alias("downregulated"),
        listed(up).alias("top_up"), listed(down).alias("top_down"),
    )


def pairwise_auc(counts: DataFrame, spine: DataFrame) -> DataFrame:
    """(gene, a, b, auc): the chance that a cell of a has more of the gene than one of b, ties count half; absent pairs are zeros.

    Cells are counted by value first, so a pair of clusters meets once a distinct value and gene.
    """
    sizes = spine.groupBy("cluster").agg(F.count("*").alias("n"))
    stored = counts.where("count > 0").join(spine.select("cell_id", "cluster"), "cell_id").groupBy("gene", "cluster", "count").agg(F.count("*").alias("t"))
    seen = stored.groupBy("gene", "cluster").agg(F.sum("t").alias("k"))
    groups = stored.select("gene").distinct().join(F.broadcast(sizes), F.lit(True)).join(seen, ["gene", "cluster"], "left").withColumn("zeros", F.col("n") - F.coalesce("k", F.lit(0)))
    values = stored.unionByName(groups.select("gene", "cluster", F.lit(0).cast(dict(counts.dtypes)["count"]).alias("count"), F.col("zeros").alias("t")))
    # for each value of a: cells of b below it and at it, by a running sum over the gene's values of both
    a, b = values.select("gene", F.col("cluster").alias("a"), "count", F.col("t").alias("ta")), values.select("gene", F.col("cluster").alias("b"), "count", F.col("t").alias("tb"))
    every = values.select("gene", "count").distinct().join(groups.select("gene", F.col("cluster").alias("b")), "gene").join(b, ["gene", "b", "count"], "left").fillna(0, ["tb"])
    below = F.sum("tb").over(Window.partitionBy("gene", "b").orderBy("count")) - F.col("tb")
    ranked = every.withColumn("under", below + F.col("tb") / 2)
    wins = a.join(ranked, ["gene", "count"]).where("a <> b").groupBy("gene", "a", "b").agg(F.sum(F.col("ta") * F.col("under")).alias("wins"))
    size = lambda c: sizes.select(F.col("cluster").alias(c), F.col("n").alias(f"n_{c}"))
    return wins.join(size("a"), "a").join(size("b"), "b").select("gene", "a", "b", (F.col("wins") / (F.col("n_a") * F.col("n_b"))).alias("auc"))


def summarised(pairs: DataFrame, value: str) -> DataFrame:
    """(gene, cluster, min, mean, median, max, min_rank) of a pairwise statistic over the other clusters; ``min_rank`` is the best rank in any pair."""
    rank = F.rank().over(Window.partitionBy("a", "b").orderBy(F.desc(value)))
    return pairs.withColumn("rank", rank).groupBy("gene", F.col("a").alias("cluster")).agg(
        F.min(value).alias("min"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.max(value).alias("max"), F.min("rank").alias("min_rank"),
    )


def marker_genes(auc: DataFrame, auc_at: float = 0.7, rank_at: int = 20, top: int = 10) -> DataFrame:
    """(cluster, n_markers, mean_auc, genes): the first ``top`` genes of a cluster whose mean AUC and best rank pass."""
    passed = auc.where((F.col("mean") >= auc_at) & (F.col("min_rank") <= rank_at))
    first = top_each(passed, "cluster", [F.col("min_rank"), F.desc("mean"), F.col("gene")], top)
    genes = F.transform(F.array_sort(F.collect_list(F.struct("rank", "gene"))), lambda x: x["gene"])
    return first.groupBy("cluster").agg(F.count("*").alias("n_markers"), F.bround(F.avg("mean"), 3).alias("mean_auc"), genes.alias("genes"))


def flat_top_genes(ranked: DataFrame, n: int) -> DataFrame:
    """(gene, position): the first ``n`` genes of every cluster, cluster by cluster, each gene at its first place."""
    at = F.struct("cluster", "rank")
    first = ranked.where(F.col("rank") <= n).groupBy("gene").agg(F.min(at).alias("at"))
    return first.withColumn("position", F.row_number().over(Window.orderBy("at", "gene"))).select("gene", "position")  # as many as clusters times n


def joint_genes(ranked: DataFrame, n: int) -> DataFrame:
    """(gene) among the first ``n`` of any cluster."""
    return ranked.where(F.col("rank") <= n).select("gene").distinct()


def labelled_genes(tested: DataFrame, n: int) -> DataFrame:
    """The ``n`` genes of each cluster with the largest fold change either way, for labels in a plot."""
    return top_each(tested.drop("rank"), "cluster", [F.desc(F.abs("log2_fold_change")), F.col("gene")], n)
