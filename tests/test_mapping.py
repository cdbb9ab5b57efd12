"""Hierarchical mapping against a plain walk down the taxonomy."""

import numpy as np
import pytest

from tessella.operators import mapping as M

TREE = {"x": ["x1", "x2", "x3"], "y": ["y1", "y2"], "z": ["z1"]}


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(9)
    level = {c: r.gamma(1, 3, 20) for c in TREE}
    leaf = {k: level[c] * r.uniform(0.5, 1.5, 20) + (r.uniform(0, 1, 20) < 0.2) * 8 for c, ks in TREE.items() for k in ks}
    cells = [(i, c, k, r.poisson(leaf[k]).astype(float)) for i, (c, k) in enumerate([(c, k) for c, ks in TREE.items() for k in ks] * 12)]
    rows = [(i, f"g{g:02}", float(v)) for i, *_, x in cells for g, v in enumerate(x) if v]
    rows += [(0, "unknown", 5.0), (0, None, 5.0), (1, "g00", None), (900, "unknown", 1.0)]
    rows[0:1] = [(rows[0][0], rows[0][1], rows[0][2] - 1), (rows[0][0], rows[0][1], 1.0)]
    values = spark.createDataFrame(rows, "cell_id int, gene string, value double").repartition(4)
    members = spark.createDataFrame([(i, c, k) for i, c, k, _ in cells if i // 6 % 2] + [(901, None, "y")], "cell_id int, class string, leaf string")
    return cells, values, members


def test_against_a_plain_walk(data):
    cells, values, members = data
    known = values.where("gene <> 'unknown'")
    model = M.fitted(known.where("floor(cell_id / 6) % 2 = 1"), members, ["class", "leaf"], per_pair=4)
    reference = [c for c in cells if c[0] // 6 % 2]
    assert model.genes == [f"g{g:02}" for g in range(20)] and set(model.nodes) == {(), ("x",), ("y",), ("z",)}
    got = {r.cell_id: r for r in M.mapped(values, model, rounds=20, share=0.7, seed=3).collect()}
    assert set(got) == {i for i, *_ in cells} | {900}
    right = 0
    for i, c, k, x in cells:
        path = ()
        for depth, level in enumerate(("class", "leaf")):
            children = sorted({r[depth + 1] for r in reference if r[1 : depth + 1] == path})
            means = [np.mean([r[3] for r in reference if r[1 : depth + 1] == path and r[depth + 1] == child], 0) for child in children]
            name, p = children[0], 1.0
            if len(children) > 1:
                markers = set()
                for a in range(len(means)):
                    for b in range(a):
                        markers |= set(sorted(range(20), key=lambda g: (-round(abs(means[a][g] - means[b][g]), 9), g))[:4])
                markers = sorted(markers)
                number, won = sorted(model.nodes).index(path), [0] * len(children)
                draw = np.random.default_rng([3, number])
                for _ in range(20):
                    some = [markers[j] for j in sorted(draw.permutation(len(markers))[: round(0.7 * len(markers))])]
                    won[int(np.argmax([round(float(np.corrcoef(x[some], m[some])[0, 1]), 9) for m in means]))] += 1
                name, p = children[int(np.argmax(won))], max(won) / 20
            assert (got[i][f"{level}_name"], got[i][f"{level}_probability"]) == (name, p), (i, level)
            path = (*path, name)
        right += path == (c, k)
    assert right > 0.8 * len(cells)
    assert (got[900].class_name, got[900].class_probability, got[900].leaf_name, got[900].leaf_probability) == (None, 0.0, None, 0.0)


def test_small_blocks_and_empty_tables(data, monkeypatch):
    cells, values, members = data
    model = M.fitted(values, members, ["class", "leaf"])
    whole = {tuple(r) for r in M.mapped(values, model, 5).collect()}
    monkeypatch.setattr(M, "BLOCK", 7)
    assert {tuple(r) for r in M.mapped(values.repartition(1), model, 5).collect()} == whole
    assert M.mapped(values.limit(0), model).isEmpty()
    none = M.fitted(values.limit(0), members.limit(0), ["class", "leaf"])
    assert all(r.class_name is None for r in M.mapped(values, none, 2).collect())
    monkeypatch.setattr(M, "NUMBERS", 3)
    with pytest.raises(ValueError):
        M.fitted(values, members, ["class", "leaf"])
