"""Negative-binomial fits against a plain search for the largest likelihood."""

import math

import numpy as np
import pytest

from tessella.operators import counts_model as N


def _plain(y, x, offset, beta, alpha):
    size, total = 1 / alpha, 0.0
    for k in range(len(y)):
        mean = math.exp(offset[k] + sum(b * c for b, c in zip(beta, x[k], strict=True)))
        total += math.lgamma(y[k] + size) - math.lgamma(size) - math.lgamma(y[k] + 1) + size * math.log(size / (size + mean)) + y[k] * math.log(mean / (size + mean))
    return total


def _searched(y, x, offset):
    """Coordinate search with ever smaller steps, from several starts."""
    best = (-math.inf, None)
    for start in (0.0, 2.0):
        p, step = [start, *[0.0] * (x.shape[1] - 1), math.log(0.2)], 1.0
        now = _plain(y, x, offset, p[:-1], math.exp(p[-1]))
        while step > 1e-6:
            for i in range(len(p)):
                for d in (step, -step):
                    q = [*p]
                    q[i] += d
                    if -14 <= q[-1] <= 6 and (f := _plain(y, x, offset, q[:-1], math.exp(q[-1]))) > now:
                        p, now = q, f
                        break
                else:
                    continue
                break
            else:
                step /= 2
        best = max(best, (now, p), key=lambda b: b[0])
    return best


def test_fits_against_a_plain_search():
    r = np.random.default_rng(2)
    x = np.stack([np.ones(12), np.repeat([1.0, 0.0], 6), np.tile([0.0, 1.0], 6)], 1)
    offset = r.normal(0, 0.3, 12)
    mean = np.exp(offset + np.array([[2.0, 1.0, -0.5], [4.0, 0.0, 0.3], [1.0, -1.0, 0.0]]) @ x.T)
    y = r.negative_binomial(4, 4 / (4 + mean)).astype(float)
    beta, alpha, error = N.fit(y, x, offset)
    for g in range(3):
        f, p = _searched(y[g], x, offset)
        got = _plain(y[g], x, offset, beta[g], alpha[g])
        assert got >= f - 1e-5 and np.allclose(beta[g], p[:-1], atol=3e-3)
        h = 1e-4  # the curvature of the likelihood at the maximum gives the error, up to the expected information
        weight = np.exp(offset + x @ beta[g]) / (1 + alpha[g] * np.exp(offset + x @ beta[g]))
        assert np.allclose(error[g], np.sqrt(np.diag(np.linalg.inv((x * weight[:, None]).T @ x)))) and h
    assert np.allclose(N.log_gamma(np.array([0.01, 0.5, 3.0, 1e4])), [math.lgamma(v) for v in (0.01, 0.5, 3.0, 1e4)], atol=1e-9)


@pytest.fixture(scope="module")
def cells(spark):
    r = np.random.default_rng(5)
    spine, counts = [], []
    for i in range(160):
        sample, group = f"s{i % 8}", "ab"[i // 80] if i < 150 else "c"
        spine.append((i, sample, group, "old" if (i % 8) < 4 else "young"))
        for g in range(12):
            mean = 3 * (4 if g == 0 and group == "a" else 0.25 if g == 1 and group == "a" else 1)
            counts.append((i, f"g{g:02}", float(r.poisson(mean))))
    counts = [c for c in counts if c[2]] + [(0, "rare", 1.0)]
    return spark.createDataFrame(counts, "cell_id int, gene string, count double").repartition(3), spark.createDataFrame(spine, "cell_id int, sample string, group string, age string"), counts, spine


def test_planted_genes_and_covariates(spark, cells):
    counts, spine, plain, of = cells
    got = {r.gene: r for r in N.pseudobulk_tests(counts, spine, "sample", "group", ("a", "b"), ["age"]).collect()}
    assert set(got) == {f"g{g:02}" for g in range(12)} | {"rare"}
    assert got["g00"].p_adj < 1e-6 and got["g01"].p_adj < 1e-6 and abs(got["g00"].log2_fold_change - got["g02"].log2_fold_change - 2) < 0.4
    assert all(got[f"g{g:02}"].p_adj > 0.01 for g in range(2, 12)) and got["rare"].p > 0.2
    units = sorted({(g, s) for _, s, g, _ in of if g in "ab"})
    age = {(g, s): a for _, s, g, a in of}
    x = np.array([[1.0, g == "a", age[g, s] == "young"] for g, s in units], float)
    y = np.zeros(len(units))
    where = {i: (g, s) for i, s, g, _ in of}
    for i, gene, n in plain:
        if gene == "g00" and where[i] in units:
            y[units.index(where[i])] += n
    factors = np.array([1.0] * len(units))
    genes = [f"g{g:02}" for g in range(12)]
    total = np.zeros((12, len(units)))
    for i, gene, n in plain:
        if gene in genes and where[i] in units:
            total[genes.index(gene), units.index(where[i])] += n
    factors = np.exp(np.median(np.log(total) - np.log(total).mean(1)[:, None], 0))
    f, p = _searched(y, x, np.log(factors))
    assert abs(got["g00"].log2_fold_change - p[1] / math.log(2)) < 5e-3 and abs(got["g00"].statistic - got["g00"].log2_fold_change / got["g00"].error) < 1e-9


def test_designs_without_a_test(cells):
    counts, spine, *_ = cells
    with pytest.raises(ValueError, match="fewer than 9"):
        N.pseudobulk_tests(counts, spine, "sample", "group", ("a", "b"), least=9)
    with pytest.raises(ValueError, match="covariates"):
        N.pseudobulk_tests(counts, spine.withColumn("same", spine["group"]), "sample", "group", ("a", "b"), ["same"])
