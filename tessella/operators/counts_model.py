"""Negative-binomial tests on pseudobulk counts, one model a gene, many genes at a time.

Counts of a unit (a sample within a group) are sums over its cells, rounded. Log means are linear in the group and, if asked for, in
covariates of the units, with the size factors as offsets. Each gene's coefficients and its own dispersion are at the maximum of the likelihood:
reweighted least squares for the coefficients and a search over the log dispersion take turns until neither moves. The Wald statistic of the
group gives p. Dispersions are not shrunk towards a trend and no count is replaced, so a gene's result depends on nothing but its counts.

What is gathered is one row a gene with its counts by unit; units are ``UNITS`` at most. Rows: units of groups other than the two compared
don't count; groups of fewer than ``least`` samples are an error, as no test is possible; genes without counts in either group have no row; a covariate of
a unit is its most frequent value among its cells (of equal ones the least), a null value is a value; ties and repeated rows add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.markers import bh, p_two_sided, pseudobulk, size_factors

UNITS = 5_000
#: Range of the log dispersion, its accuracy, and most turns.
LOW, HIGH, CLOSE, TURNS = -14.0, 6.0, 1e-7, 60


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function of positive numbers, by Stirling's series after a shift by ten."""
    shift = np.zeros_like(x)
    for k in range(10):
        shift += np.log(x + k)
    y = x + 10
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def likelihood(y: np.ndarray, mean: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Log likelihood of each row of counts (genes, units)."""
    size = 1 / alpha[:, None]
    return (log_gamma(y + size) - log_gamma(np.broadcast_to(size, y.shape)) - log_gamma(y + 1) + size * np.log(size / (size + mean)) + y * np.log(mean / (size + mean))).sum(1)


def _coefficients(y: np.ndarray, x: np.ndarray, offset: np.ndarray, alpha: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (genes, columns) of the largest likelihood at given dispersions, and the information matrices."""
    for _ in range(TURNS):
        mean = np.exp(np.clip(offset + beta @ x.T, -30, 30))
        weight = mean / (1 + alpha[:, None] * mean)
        target = np.clip(offset + beta @ x.T, -30, 30) - offset + (y - mean) / mean
        info = np.einsum("gu,ui,uj->gij", weight, x, x)
        new = np.linalg.solve(info + 1e-10 * np.eye(x.shape[1]), np.einsum("gu,ui->gi", weight * target, x)[..., None])[..., 0]
        new = np.clip(new, beta - 5, beta + 5)
        moved = np.abs(new - beta).max(initial=0)
        beta = new
        if moved < 1e-10:
            break
    return beta, info


def _dispersions(y: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The dispersion of the largest likelihood of each row at given means: a coarse grid, then golden sections."""
    grid = np.linspace(LOW, HIGH, 41)
    best = np.stack([likelihood(y, mean, np.full(len(y), np.exp(g))) for g in grid]).argmax(0)
    low, high = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, len(grid) - 1)]
    ratio = (5**0.5 - 1) / 2
    while (high - low).max(initial=0) > CLOSE:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(y, mean, np.exp(a)) > likelihood(y, mean, np.exp(b))
        low, high = np.where(left, low, a), np.where(left, b, high)
    return np.exp((low + high) / 2)


def fit(y: np.ndarray, x: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, dispersions and standard errors of the coefficients of each row of counts."""
    beta = np.zeros((len(y), x.shape[1]))
    beta[:, 0] = np.log(np.maximum((y / np.exp(offset)).mean(1), 1e-8))
    alpha = np.full(len(y), 0.1)
    for _ in range(TURNS):
        beta, info = _coefficients(y, x, offset, alpha, beta)
        new = _dispersions(y, np.exp(np.clip(offset + beta @ x.T, -30, 30)))
        done = np.abs(np.log(new) - np.log(alpha)).max(initial=0) < 1e-5
        alpha = new
        if done:
            break
    beta, info = _coefficients(y, x, offset, alpha, beta)
    error = np.sqrt(np.maximum(np.diagonal(np.linalg.inv(info + 1e-10 * np.eye(x.shape[1])), axis1=1, axis2=2), 0))
    return beta, alpha, error


def units(spine: DataFrame, sample: str, group: str, groups: tuple[str, str], covariates: list[str]) -> pd.DataFrame:
    """One row for each sample of the two groups, with its covariates; ``UNITS`` at most."""
    of = spine.where(F.col(group).cast("string").isin(*groups) & F.col(sample).isNotNull())
    common = lambda c: F.min_by(F.col(f"v.{c}"), F.struct(-F.col("n"), F.col(f"v.{c}").isNotNull(), F.col(f"v.{c}")))
    found = of.select(sample, F.col(group).cast("string").alias(group)).distinct()
    for c in covariates:
        n = of.groupBy(sample, F.col(group).cast("string").alias(group), F.struct(F.col(c).cast("string").alias(c)).alias("v")).agg(F.count("*").alias("n"))
        found = found.join(n.groupBy(sample, group).agg(common(c).alias(c)), [sample, group])
    rows = found.limit(UNITS + 1).toPandas()
    if len(rows) > UNITS:
        raise ValueError(f"more than {UNITS} samples")
    return rows.sort_values([group, sample], ignore_index=True)


def design(rows: pd.DataFrame, group: str, first: str, covariates: list[str]) -> np.ndarray:
    """Columns: one, membership of the group ``first``, and all values but the least of each covariate."""
    columns = [np.ones(len(rows)), (rows[group] == first).to_numpy(float)]
    for c in covariates:
        value = rows[c].fillna("")
        columns += [(value == v).to_numpy(float) for v in sorted(value.unique())[1:]]
    return np.stack(columns, 1)


def pseudobulk_tests(counts: DataFrame, spine: DataFrame, sample: str, group: str, groups: tuple[str, str], covariates: list[str] | None = None, least: int = 2) -> DataFrame:
    """(gene, base_mean, log2_fold_change, error, statistic, p, p_adj, dispersion) of the first of two ``groups`` against the second.

    ``counts`` are (cell_id, gene, count), ``spine`` (cell_id, sample, group, covariates).
    """
    rows = units(spine, sample, group, groups, covariates or [])
    for g in groups:
        if (rows[group] == g).sum() < least:
            raise ValueError(f"fewer than {least} samples of {g}")
    x = design(rows, group, groups[0], covariates or [])
    if np.linalg.matrix_rank(x) < x.shape[1]:
        raise ValueError("the covariates tell the groups apart, or each other")
    name = lambda a, b: F.concat_ws("\0", a, b)
    bulk = pseudobulk(counts, spine.where(F.col(group).cast("string").isin(*groups) & F.col(sample).isNotNull()), sample, group)
    bulk = bulk.select(name(F.col(sample).cast("string"), F.col(group).cast("string")).alias("unit"), "gene", F.col("count").cast("double").alias("count"))
    place = {f"{s}\0{g}": i for i, (s, g) in enumerate(zip(rows[sample].astype(str), rows[group], strict=True))}
    factor = {r["unit"]: r["factor"] for r in size_factors(bulk, "unit").collect()}  # one row a unit
    offset = np.log(np.array([factor.get(u, 1.0) for u in place]))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, parts):
            y = np.zeros((len(pdf), len(place)))
            for i, (us, ns) in enumerate(zip(pdf.units, pdf.counts, strict=True)):
                y[i, [place[u] for u in us]] = ns
            beta, alpha, error = fit(y, x, offset)
            yield pd.DataFrame({"gene": pdf.gene, "base_mean": (y / np.exp(offset)).mean(1), "log2_fold_change": beta[:, 1] / np.log(2), "error": error[:, 1] / np.log(2), "dispersion": alpha})

    pairs = F.collect_list(F.struct("unit", "count"))
    wide = bulk.groupBy("gene").agg(pairs.alias("of")).select("gene", F.col("of.unit").alias("units"), F.col("of.count").alias("counts"))
    found = wide.mapInPandas(run, "gene string, base_mean double, log2_fold_change double, error double, dispersion double")
    tested = found.withColumn("statistic", F.try_divide("log2_fold_change", "error"))
    tested = tested.withColumn("p", F.coalesce(p_two_sided(F.col("statistic")), F.lit(1.0))).withColumn("all", F.lit(0))
    return bh(tested, "p", "all", "p_adj").select("gene", "base_mean", "log2_fold_change", "error", "statistic", "p", "p_adj", "dispersion")
