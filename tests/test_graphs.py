"""Communities against all partitions of small graphs and against planted ones."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import graphs as G


def _frames(spark, edges, nodes):
    return spark.createDataFrame([(n, None) for n in nodes], "id bigint, scope string"), spark.createDataFrame([(a, b, float(w)) for a, b, w in edges], "a bigint, b bigint, w double")


def _plain(edges, label, resolution=1.0):
    total = 2 * sum(w for *_, w in edges)
    k, inner = {}, 0.0
    for a, b, w in edges:
        for n in (a, b):
            k[label[n]] = k.get(label[n], 0) + w
        inner += 2 * w if label[a] == label[b] else 0
    return inner / total - resolution * sum((x / total) ** 2 for x in k.values())


def _partitions(nodes):
    if not nodes:
        yield []
        return
    for rest in _partitions(nodes[1:]):
        for i in range(len(rest)):
            yield [*rest[:i], [nodes[0], *rest[i]], *rest[i + 1 :]]
        yield [[nodes[0]], *rest]


def _found(spark, edges, nodes, resolution=1.0):
    return {r.id: r.community for r in G.communities(*_frames(spark, edges, nodes), resolution).collect()}


def test_small_graphs_against_all_partitions(spark):
    r = random.Random(3)
    for _ in range(2):
        nodes = list(range(7))
        edges = [(a, b, r.choice([1, 1, 2])) for a, b in itertools.combinations(nodes, 2) if r.random() < (0.8 if a // 4 == b // 4 else 0.2)] + [(0, 0, 1)]
        best = max(_plain(edges, {n: i for i, p in enumerate(parts) for n in p}) for parts in _partitions(nodes))
        got = _found(spark, edges, nodes)
        assert _plain(edges, got) >= best - 0.03 and all(c == min(n for n in got if got[n] == c) for c in got.values())
        labels = spark.createDataFrame(list(got.items()), "id bigint, community bigint")
        assert abs(G.modularity(*_frames(spark, edges, nodes), labels).first()["modularity"] - _plain(edges, got)) < 1e-12


@pytest.fixture(scope="module")
def planted():
    """Four groups of thirty in two halves that hang together more closely, and a node without edges; edges in any order and direction."""
    r = random.Random(7)
    edges = [(a, b, 1) for a, b in itertools.combinations(range(120), 2) if r.random() < (0.5 if a // 30 == b // 30 else 0.08 if a // 60 == b // 60 else 0.005)]
    return [(b, a, w) if r.random() < 0.5 else (a, b, w) for a, b, w in r.sample(edges, len(edges))], list(range(121))


def test_planted_groups(spark, planted):
    edges, nodes = planted
    got = _found(spark, edges, nodes)
    assert got == {n: n // 30 * 30 for n in nodes}
    assert abs(_plain(edges, got) - _plain(edges, {n: n // 30 for n in nodes})) < 1e-12


def test_clusters_in_rounds_and_in_scopes(spark, planted):
    edges, nodes = planted
    n, e = _frames(spark, edges, nodes)
    got = {r.id: (r.round1, r.round2) for r in G.clusters_in_rounds(n.select("id"), e, [0.3, 1.0], least=50).collect()}
    assert all(len({got[k][0] for k in range(h, h + 60)}) == 1 for h in (0, 60)) and len({got[k][0] for k in range(120)}) == 2
    assert all(len({got[k][1] for k in range(h, h + 30)}) == 1 for h in range(0, 120, 30)) and len({got[k][1] for k in range(120)}) == 4
    assert all(two.startswith(one + ".") for k, (one, two) in got.items() if k < 120) and got[120] == ("2", "2")  # too small to be divided
    scopes = n.select("id", F.when(F.col("id") < 45, "x").when(F.col("id") < 120, "y").alias("scope"))  # a border through a group
    apart = {r.id: r.community for r in G.communities(scopes, e).collect()}
    assert apart == {k: 45 if 45 <= k < 60 else k // 30 * 30 for k in nodes}


def test_graphs_without_edges_and_odd_rows(spark):
    n, e = _frames(spark, [], [1, 2])
    assert {r.id: r.community for r in G.communities(n, e).collect()} == {1: 1, 2: 2}
    assert G.communities(n.limit(0), e).isEmpty()
    odd = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0), (None, 1, 1.0), (1, 9, 1.0), (1, 2, None), (1, 2, -3.0), (2, 2, 0.5)], "a bigint, b bigint, w double")
    assert {r.id: r.community for r in G.communities(n.unionByName(n), odd).collect()} == {1: 1, 2: 1}
    near = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 3)], "query_id bigint, ref_id bigint")
    assert sorted(map(tuple, G.neighbour_edges(near).collect())) == [(1, 2, 1.0), (2, 3, 1.0)]


def test_a_round_of_joining_is_two_tables_and_one_of_moves_is_one(spark, monkeypatch):
    names, real = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df, name: (names.append(name), real(df, name))[1])
    monkeypatch.setattr(G, "_modularity", None)  # a round sums it up while it writes its table
    edges = [(a, b, 1) for h in (0, 3) for a, b in itertools.combinations(range(h, h + 3), 2)] + [(2, 3, 1)]
    assert _found(spark, edges, list(range(7))) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3, 6: 6}
    rounds = names.count("moves")
    assert set(names) == {"graph", "nodes", "links", "moves", "labels", "moved"} and rounds > 1
    assert names.count("links") == rounds and names.count("labels") <= 1 + rounds // G.TOGETHER


def test_rounds_of_joining_do_not_grow_with_a_hub(spark, monkeypatch):
    names, real = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df, name: (names.append(name), real(df, name))[1])
    hubs = {0: range(2, 32), 1: range(32, 62)}  # a hub with thirty leaves each, which joined it one a round
    edges = [(hub, leaf, 1) for hub, leaves in hubs.items() for leaf in leaves] + [(0, 1, 1)]
    assert _found(spark, edges, list(range(62))) == {n: hub for hub, leaves in hubs.items() for n in (hub, *leaves)}
    assert names.count("moves") <= 6


def test_what_joins_a_pair_in_a_round_is_bounded_and_gains(spark):
    # 9 and 10 are best for each other; 1 to 4 follow 9, the largest gain first, and add half of the pair's weight at most
    links = [(9, 10, 9.0, 10.0, 10.0), (1, 9, 4.0, 6.0, 10.0), (2, 9, 3.0, 4.0, 10.0), (3, 9, 2.0, 3.0, 10.0), (4, 9, 0.02, 1.0, 10.0)]
    df = spark.createDataFrame([(a, b, w, ka, kb, 100.0) for a, b, w, ka, kb in links], "a bigint, b bigint, w double, k_a double, k_b double, total double")
    got = {r.community: (r.into, r.k) for r in spark.sql(G.MOVES, links=df, resolution=1.0, digits=G.DIGITS, grown=G.GROWN).collect()}
    assert got == {n: (9, 30.0) for n in (9, 10, 1, 2)}


def test_levels_of_joining_lead_to_the_same_groups(spark, planted, monkeypatch):
    monkeypatch.setattr(G, "TOGETHER", 1)  # a level each round
    edges, nodes = planted
    assert _found(spark, edges, nodes) == {n: n // 30 * 30 for n in nodes}
