"""The index of inverted lists against all distances."""

import numpy as np
import pytest

from tessella.operators import labels as L
from tessella.operators import neighbours as N


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(6)
    middle = r.normal(0, 1, (30, 12))
    x = middle[r.integers(0, 30, 3_000)] + r.normal(0, 0.35, (3_000, 12))
    return x, spark.createDataFrame([(i, int(i % 7), [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, label int, embedding array<double>").cache()


def test_recall_of_all_queries(vectors, monkeypatch):
    x, df = vectors
    monkeypatch.setattr(N, "PER_LIST", 75)
    monkeypatch.setattr(N, "BLOCK", 64)  # lists of several blocks
    queries, reference = df.where("vec_id % 20 = 0"), df.where("vec_id % 20 <> 0")
    index, found = N.indexed(reference)
    assert len(found) == 2850 // 75 and index.count() == 2850
    exact = L.nearest(queries, reference, 10)
    near = N.search(queries, index, found, 10, probes=6).cache()
    assert N.recall(near, exact) >= 0.9
    assert {(r.query_id, r["rank"]) for r in near.collect()} == {(q, k) for q in range(0, 3_000, 20) for k in range(1, 11)}
    every = N.search(queries, index, found, 10, probes=len(found)).collect()
    rows = [(r.query_id, r["rank"], r.ref_id, r.label) for r in every]
    want = []
    for q in range(0, 3_000, 20):
        d = np.round(((x - x[q]) ** 2).sum(1), 9)
        best = [i for i in np.lexsort((np.arange(len(x)), d)).tolist() if i % 20][:10]
        want += [(q, k + 1, i, i % 7) for k, i in enumerate(best)]
    assert sorted(rows) == sorted(want)  # every list: exact
    assert all(abs(r.distance - ((x[r.query_id] - x[r.ref_id]) ** 2).sum()) < 1e-8 for r in every)


def test_odd_and_empty_rows(spark, vectors):
    _, df = vectors
    odd = spark.createDataFrame([(1, 0, None), (2, 0, [1.0, None]), (3, 0, [float("nan"), 1.0]), (4, 1, [0.0, 0.0]), (4, 1, [0.0, 0.0]), (None, 1, [0.0, 0.0]), (5, 2, [1.0, 1.0])], "vec_id bigint, label int, embedding array<double>")
    index, found = N.indexed(odd)
    assert sorted((r.query_id, r["rank"], r.ref_id) for r in N.search(odd.where("vec_id = 5 OR vec_id < 4"), index, found, 2).collect()) == [(5, 1, 5), (5, 2, 4)]
    index, found = N.indexed(df.limit(0))
    assert N.search(df, index, found, 3).isEmpty() and N.recall(df.limit(0).selectExpr("vec_id AS query_id", "vec_id AS ref_id"), df.limit(0).selectExpr("vec_id AS query_id", "vec_id AS ref_id")) is None


def test_every_list_is_met_in_blocks(vectors, monkeypatch):
    x, df = vectors
    monkeypatch.setattr(N, "PER_LIST", 75)
    monkeypatch.setattr(N, "BLOCK", 64)  # several blocks a side
    copies = df.where("vec_id < 900").unionByName(df.where("vec_id < 300").selectExpr("vec_id + 5000 AS vec_id", "label + 1 AS label", "embedding"))
    index, found = N.indexed(copies.where("vec_id % 2 = 0"))
    monkeypatch.setattr(N, "in_lists", None)  # a query was sent to each list, which grows with the lists
    got = N.search(copies.where("vec_id % 2 = 1 OR vec_id >= 5000"), index, found, 4, len(found)).collect()
    rows = {i: (x[i % 5000], i % 5000 % 7 + i // 5000) for i in [*range(900), *range(5000, 5300)]}
    refs = [i for i in sorted(rows) if i % 2 == 0]
    want = []
    for q in (i for i in rows if i % 2 == 1 or i >= 5000):
        d = np.round(((np.stack([rows[i][0] for i in refs]) - rows[q][0]) ** 2).sum(1), 9)
        want += [(q, n + 1, refs[i], rows[refs[i]][1]) for n, i in enumerate(np.argsort(d, kind="stable")[:4])]
    assert len(found) > 5 and sorted((r.query_id, r["rank"], r.ref_id, r.label) for r in got) == sorted(want)


def test_best_pairs_of_ties_copies_and_few_rows():
    r = np.random.default_rng(8)
    for n, m, k in ((600, 900, 5), (3, 2, 5), (1, 1, 1), (300, 40, 3)):
        q, refs = r.integers(0, 3, (n, 3)).astype(float), r.integers(0, 3, (m, 3)).astype(float)  # mostly ties
        rows, at, d = L.best_pairs(q, refs, k)
        every = ((q[:, None] - refs[None]) ** 2).sum(2)
        best = np.argsort(every, axis=1, kind="stable")[:, :k]
        assert rows.tolist() == np.repeat(np.arange(n), best.shape[1]).tolist()
        assert at.tolist() == best.ravel().tolist() and d.tolist() == np.take_along_axis(every, best, 1).ravel().tolist()
