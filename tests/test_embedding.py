"""Singular vectors and principal components against NumPy on the dense table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import embedding as E


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(4)
    x = r.poisson(np.outer(r.uniform(0.2, 3, 60), r.uniform(0.1, 2, 8))).astype(float)
    x[x.sum(1) == 0, 0] = 1
    x[5] = 0  # a cell without counts
    rows = [(c, f"g{g}", float(v)) for (c, g), v in np.ndenumerate(x) if v]
    rows[0:1] = [(rows[0][0], rows[0][1], rows[0][2] - 0.5), (rows[0][0], rows[0][1], 0.5)]  # a row in two pieces
    rows += [(None, "g1", 3.0), (7, None, 2.0), (7, "g1", None)]
    return x, spark.createDataFrame(rows, "cell_id int, gene string, value double").repartition(5), spark.createDataFrame([(c, "x") for c in range(60)] + [(None, "y")], "cell_id int, gene string")


def _scores(df):
    return {r.cell_id: np.array(r.scores) for r in df.collect()}


def test_singular_vectors_against_numpy(table):
    x, values, spine = table
    model = E.fitted(values, 5)
    u, s, v = np.linalg.svd(x[[c for c in range(60) if c != 5]], full_matrices=False)
    assert model.cells == 59 and np.allclose(model.singular_values, s[:5]) and np.allclose(np.abs(model.components @ v[:5].T), np.eye(5), atol=1e-8)
    assert all(c[np.argmax(np.round(np.abs(c), 9))] > 0 for c in model.components)
    got = _scores(E.projected(values, model))
    assert set(got) == set(range(60)) - {5} and np.allclose(np.stack([got[c] for c in sorted(got)]), np.delete(x, 5, 0) @ model.components.T / s[:5])
    assert np.allclose(np.sum(np.square(list(got.values())), 0), 1)  # whitened
    plain = _scores(E.projected(values, model, whitened=False, spine=spine))
    assert len(plain) == 60 and not plain[5].any() and np.allclose(plain[9], x[9] @ model.components.T)


def test_principal_components_against_numpy(table):
    x, values, spine = table
    model = E.fitted(values, 4, spine, centred=True)
    s = np.linalg.svd(x - x.mean(0), compute_uv=False)
    assert model.cells == 60 and np.allclose(model.singular_values, s[:4]) and np.allclose(E.explained_variance(model), s[:4] ** 2 / 59)
    got = _scores(E.projected(values, model, False, spine))
    assert np.allclose(np.stack([got[c] for c in range(60)]), (x - x.mean(0)) @ model.components.T)


def test_query_cells_in_the_space_of_a_reference(table):
    x, values, spine = table
    model = E.fitted(values, 100, spine.where("cell_id < 30"))
    assert len(model.singular_values) == 7  # fewer than genes
    got = _scores(E.projected(values.where("cell_id >= 30").unionByName(values.limit(1).select(F.lit(31).alias("cell_id"), F.lit("new").alias("gene"), F.lit(9.0).alias("value"))), model))
    assert np.allclose(got[31], x[31] @ model.components.T / model.singular_values)


def test_degenerate_tables(spark, monkeypatch):
    make = lambda *rows: spark.createDataFrame(list(rows), "cell_id int, gene string, value double")
    for rows in ([], [(1, "a", 2.0)], [(1, "a", 0.0), (2, "b", 0.0)]):
        model = E.fitted(make(*rows))
        assert len(model.singular_values) == 0 and all(r.scores == [] for r in E.projected(make(*rows), model).collect())
    alike = E.fitted(make(*[(c, g, 1.0) for c in range(5) for g in "abc"]), 3)
    assert np.allclose(alike.singular_values, [15**0.5]) and np.allclose(alike.components, 3**-0.5)
    monkeypatch.setattr(E, "GENES", 2)
    with pytest.raises(ValueError):
        E.fitted(make(*[(c, g, 1.0) for c in range(5) for g in "abc"]))
    monkeypatch.setattr(E, "BLOCK", 2)
    monkeypatch.setattr(E, "GENES", 5)
    assert np.allclose(E.fitted(make(*[(c, g, 1.0) for c in range(5) for g in "abc"]), 3).singular_values, [15**0.5])
