"""Components of few edges: fewer shuffles, the same result."""

import random

from tessella.llm import components as C


def test_few_edges_stay_where_they_lie(spark, monkeypatch):
    r = random.Random(2)
    edges = spark.createDataFrame([(r.randrange(150), r.randrange(150)) for _ in range(110)] + [(300, i) for i in range(301, 340)], "u bigint, v bigint")
    plan = C._small_star(C._large_star(edges, 149), 149)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6  # more than twice as many before
    few = sorted(map(tuple, C.components(edges).collect()))
    monkeypatch.setattr(C, "FEW", 0)
    more = C._small_star(C._large_star(edges, 149), 149)._jdf.queryExecution().executedPlan().toString()
    assert more.count("Exchange hashpartitioning") > 6
    assert sorted(map(tuple, C.components(edges).collect())) == few


def test_few_edges_are_few_files(spark, monkeypatch):
    r, files = random.Random(3), []
    rows = [(r.randrange(4000), r.randrange(4000)) for _ in range(3000)]
    edges = spark.createDataFrame(rows, "u bigint, v bigint")
    plain, before = C.cut, {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def counted(df, name):
        out = plain(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(C, "cut", counted)
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few = sorted(map(tuple, C.components(edges).collect()))
        assert max(files[1:]) <= C.FILES < files[0]  # 40 in every round before
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    root = {x: x for e in rows for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in rows:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    assert few == sorted({(x, top(x)) for e in rows if e[0] != e[1] for x in e})
