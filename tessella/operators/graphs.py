"""Clusters of a weighted graph by modularity, all scopes of a table at once, and clusters within clusters.

A scope is a part of the graph that is clustered by itself: edges between scopes count for nothing, and the total weight is the scope's own.
So clustering inside every cluster of a former round is one run, not a loop over clusters.

1. Joining. Every node begins as a community. The gain of joining two communities depends on the edges between them and on both weights alone,
   so pairs that are the best of both their communities are independent and join at once. Communities whose best is one of such a pair join it too, the
   largest gain first, as long as they add no more than ``GROWN`` of the pair's weight and each would gain if all before it had joined; else a community that is the
   best of many takes one a round, and the rounds grow with the rows. Then communities that joined are one node, and so on until no pair gains.
2. Moving. From the coarsest level to the nodes themselves, a level every ``TOGETHER`` rounds of joining, nodes of the level move to the neighbouring
   community of the largest gain, half of them (by a hash) in a round. Such moves may hinder each other, so a round counts only if the
   modularity grows. A coarser level ends with the first round that adds less than ``LEAST``, as the next level goes on; the nodes
   themselves after ``TRIES`` rounds without growth.

Every step is a join and a sum by keys; a hub's edges are summed up before they meet. Rounds end in tables of the shared folder, and former ones
are deleted. A round of moves is one table, the choices of all nodes; what it is worth is summed up while it is written. Rows: edges with null ends or a weight that isn't positive count for nothing; repeated edges add up; an edge in both directions
counts twice; loops count for their node; nodes without edges are clusters of their own; ties go to the smaller community; the
result is the same for the same rows in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessella.sources.tables import cut, forget

#: Rounds of moves without growth before the end, decimals to which gains are compared, and rounds of joining that labels follow at once.
TRIES, DIGITS, TOGETHER = 4, 12, 8

#: What may join a pair in a round, as a part of the pair's weight, and the growth of the modularity below which a level coarser than the nodes ends.
GROWN, LEAST = 0.5, 1e-3

#: (community, into, k): the communities that join in a round, and the weight of what they make.
MOVES = """
WITH pairs AS (
  SELECT a, b, k_a, k_b, w, total, round(w / total - CAST({resolution} AS DOUBLE) * k_a * k_b / (total * total), {digits}) AS gain FROM {links}
), best AS (
  SELECT end, min(struct(-gain AS g, a, b, k_a, k_b, w, total)) AS best FROM (SELECT *, explode(array(a, b)) AS end FROM pairs WHERE gain > 0) GROUP BY end
), heads AS (
  SELECT best.a, best.b, first(best.k_a) AS k_a, first(best.k_b) AS k_b FROM best GROUP BY best.a, best.b HAVING count(*) = 2
), ends AS (
  SELECT a, b, k_a + k_b AS head_k, explode(array(a, b)) AS end FROM heads
), members AS (
  SELECT h.a AS into, h.head_k, best.end AS community, CASE WHEN best.end = best.a THEN best.k_a ELSE best.k_b END AS k, best.w, best.total,
    h.a = best.a AND h.b = best.b AS head, best.g
  FROM best JOIN ends h ON h.end = CASE WHEN best.end = best.a THEN best.b ELSE best.a END
), placed AS (
  SELECT *, sum(CASE WHEN head THEN 0D ELSE k END) OVER (PARTITION BY into ORDER BY head DESC, g, community ROWS UNBOUNDED PRECEDING) AS added FROM members
), taken AS (
  SELECT *, head OR (added <= CAST({grown} AS DOUBLE) * head_k AND w > CAST({resolution} AS DOUBLE) * k * (head_k + added - k) / total) AS joins FROM placed
)
SELECT community, into, k FROM (SELECT community, into, joins, head_k + sum(CASE WHEN joins AND NOT head THEN k ELSE 0D END) OVER (PARTITION BY into) AS k FROM taken) WHERE joins
"""

#: The links of the communities after their moves.
LINKS = """
WITH moved AS (
  SELECT struct(coalesce(x.into, a) AS c, coalesce(x.k, k_a) AS k) AS x, struct(coalesce(y.into, b) AS c, coalesce(y.k, k_b) AS k) AS y, w, total
  FROM {links} LEFT JOIN {moves} x ON x.community = a LEFT JOIN {moves} y ON y.community = b
), summed AS (
  SELECT least(x, y) AS x, greatest(x, y) AS y, total, sum(w) AS w FROM moved WHERE x.c <> y.c GROUP BY least(x, y), greatest(x, y), total
)
SELECT x.c AS a, y.c AS b, w, x.k AS k_a, y.k AS k_b, total FROM summed
"""

#: See ``_choices``. Ends are dealt by id, so both sums by id need one exchange; no edge into the own community is worth what leaving it saves.
CHOICES = """
WITH sums AS (
  SELECT own AS community, sum(k) AS sum FROM {state} GROUP BY own
), ends AS (
  SELECT /*+ REPARTITION(id) */ e.a AS id, s.own AS community, e.w FROM {both} e JOIN {state} s ON s.id = e.b WHERE e.a <> e.b
), worths AS (
  SELECT s.*, t.community, o.sum AS own_sum, t.w,
    round(t.w - CAST({resolution} AS DOUBLE) * k * CASE WHEN t.community = own THEN c.sum - k ELSE c.sum END / total, {digits}) AS worth
  FROM (SELECT id, community, sum(w) AS w FROM ends GROUP BY id, community) t
  JOIN sums c ON c.community = t.community JOIN (SELECT id, k, total, own FROM {state}) s ON s.id = t.id JOIN sums o ON o.community = s.own
), found AS (
  SELECT id, k, total, own, own_sum, max_by(struct(community, worth), struct(worth, -community AS c)) AS best,
    max(CASE WHEN community = own THEN worth END) AS stays, max(CASE WHEN community = own THEN w END) AS inner_w
  FROM worths GROUP BY id, k, total, own, own_sum
)
SELECT id, k, total, own,
  CASE WHEN best.worth > coalesce(stays, round(-CAST({resolution} AS DOUBLE) * k * (own_sum - k) / total, {digits})) THEN best.community END AS into,
  coalesce(inner_w, 0D) - CAST({resolution} AS DOUBLE) * k * own_sum / total AS part
FROM found
"""


def neighbour_edges(near: DataFrame) -> DataFrame:
    """(a, b, w) of rows (query_id, ref_id): one edge for each pair of neighbours, of weight 1 whether one or both name the other."""
    ends = near.where("query_id <> ref_id").select(F.least("query_id", "ref_id").alias("a"), F.greatest("query_id", "ref_id").alias("b"))
    return ends.distinct().withColumn("w", F.lit(1.0))


def _both_ways(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions; a loop once, with twice its weight, as it adds to its node's weight."""
    loops, others = edges.where("a = b").select("a", "b", (2 * F.col("w")).alias("w")), edges.where("a <> b")
    return loops.unionByName(others.select("a", "b", "w")).unionByName(others.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).groupBy("a", "b").agg(F.sum("w").alias("w"))


def _clean(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, scope, k, total) with their weight and that of their scope, and edges (a, b, w) in both directions within scopes."""
    nodes = nodes.where("id IS NOT NULL").select("id", "scope").dropDuplicates(["id"])
    scope = lambda s: nodes.select(F.col("id").alias(s), F.col("scope").alias(f"scope_{s}"))
    inside = edges.where("w > 0").select("a", "b", F.col("w").cast("double").alias("w")).join(scope("a"), "a").join(scope("b"), "b").where(F.col("scope_a").eqNullSafe(F.col("scope_b")))
    both = cut(_both_ways(inside.select("a", "b", "w")), "graph")
    weight = nodes.join(both.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k")), "id", "left").fillna(0.0, ["k"])
    totals = weight.groupBy("scope").agg(F.sum("k").alias("total"))
    return cut(weight.alias("n").join(totals.alias("t"), F.col("n.scope").eqNullSafe(F.col("t.scope"))).select("id", "n.scope", "k", "total"), "nodes"), both


def modularity(nodes: DataFrame, edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(scope, modularity) of the communities (id, community) of nodes (id, scope); null for a scope without edges."""
    nodes, both = _clean(nodes, edges)
    out = _modularity(nodes, both, labels, resolution)
    return out.select("scope", "modularity")


def _modularity(nodes: DataFrame, both: DataFrame, labels: DataFrame, resolution: float) -> DataFrame:
    of = labels.select("id", "community")
    ends = both.join(of.select(F.col("id").alias("a"), F.col("community").alias("ca")), "a").join(of.select(F.col("id").alias("b"), F.col("community").alias("cb")), "b")
    inner = ends.where("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.sum("w").alias("inner"))
    sums = nodes.join(of, "id").groupBy("community").agg(F.sum("k").alias("k"), F.first("total").alias("total"), F.min("scope").alias("scope"))
    each = sums.join(inner, "community", "left").withColumn("q", F.try_divide(F.coalesce("inner", F.lit(0.0)), "total") - resolution * F.pow(F.try_divide("k", "total"), F.lit(2)))
    return each.groupBy("scope").agg(F.sum("q").alias("modularity"), F.sum(F.col("q") * F.col("total")).alias("weighed"))


def _seen(df: DataFrame, name: str, what: Column) -> tuple[DataFrame, float | None]:
    """``df`` cut, and the aggregate ``what`` of its rows, taken while they are written."""
    found = Observation()
    return cut(df.observe(found, what.alias("seen")), name), found.get["seen"]


def _followed(labels: DataFrame, moves: list[DataFrame]) -> DataFrame:
    """(id, community) after ``moves``, one round after the other."""
    out = labels
    for some in moves:
        out = out.join(some.select("community", "into"), "community", "left").selectExpr("id", "coalesce(into, community) AS community")
    out = cut(out, "labels")
    forget(*moves)
    return out


def _ends(links: DataFrame) -> DataFrame:
    """(id, k, total) of the communities that ``links`` name."""
    return links.selectExpr("a AS id", "k_a AS k", "total").unionByName(links.selectExpr("b AS id", "k_b AS k", "total")).dropDuplicates(["id"])


def _joined(nodes: DataFrame, both: DataFrame, resolution: float) -> list[tuple[DataFrame, DataFrame]]:
    """The levels of step 1, from the nodes on: links between the communities of a level, and (id, community), which of the next level each becomes.

    A link (a, b, w) of two communities, a below b, has their weights with it, so that a round is two tables: its moves and the next links. A community is
    named by one of its nodes; one without links neither joins nor moves any more, so levels leave it out.
    """
    levels, waiting, sql = [], [], nodes.sparkSession.sql
    first = "SELECT a, b, w, x.k AS k_a, y.k AS k_b, x.total FROM {both} JOIN {nodes} x ON x.id = a JOIN {nodes} y ON y.id = b WHERE a < b"
    links = level = cut(sql(first, both=both, nodes=nodes), "links")
    while True:
        moves, n = _seen(sql(MOVES, links=links, resolution=resolution, digits=DIGITS, grown=GROWN), "moves", F.count("*"))
        if n:
            waiting.append(moves)
            old, links = links, cut(sql(LINKS, links=links, moves=moves), "links")
            forget(old if old is not level else None)
        else:
            forget(moves)
        if len(waiting) == TOGETHER or not n and (waiting or not levels):
            levels.append((level, _followed(_ends(level).selectExpr("id", "id AS community"), waiting)))
            level, waiting = links, []
        if not n:
            forget(links if all(links is not kept for kept, _ in levels) else None)
            return levels


def _choices(state: DataFrame, both: DataFrame, resolution: float) -> DataFrame:
    """``state`` (id, k, total, own) of linked nodes with ``into``, the community that a node had better move to, and ``part``, its part of the modularity."""
    return state.sparkSession.sql(CHOICES, state=state, both=both, resolution=resolution, digits=DIGITS)


def _moved(links: DataFrame, own: DataFrame, resolution: float, tries: int, least: float) -> DataFrame:
    """(id, own) of the linked ids after step 2 on one level, from ``own`` (id, own) on."""
    both = links.select("a", "b", "w").unionByName(links.selectExpr("b AS a", "a AS b", "w"))

    def judged(state: DataFrame) -> tuple[DataFrame, float]:
        """The choices of all nodes in ``state``, and what its modularity is worth; loops and nodes without other edges add the same to any state."""
        out, worth = _seen(_choices(state, both, resolution), "moved", F.sum("part"))
        return out, round(worth or 0.0, 9)

    state, best = judged(_ends(links).join(own, "id").select("id", "k", "total", "own"))
    number, failed = 0, 0
    while failed < tries:
        turn = f"pmod(xxhash64(id, {number // 2}), 2) = {number % 2}"
        new, now = judged(state.selectExpr("id", "k", "total", f"CASE WHEN {turn} THEN coalesce(into, own) ELSE own END AS own"))
        number, failed = number + 1, 0 if now > best + least else failed + 1
        forget(state if now > best else new)
        best, state = (now, new) if now > best else (best, state)
    return state


def communities(nodes: DataFrame, edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(id, scope, community) of nodes (id, scope) and edges (a, b, w); a community is named by its least node."""
    nodes, both = _clean(nodes, edges)
    weight = nodes.agg(F.sum("k")).first()[0] or 0.0
    state = None
    for level, (links, labels) in reversed([*enumerate(_joined(nodes, both, resolution))]):
        own = labels.selectExpr("id", "community AS own")
        if state is not None:
            own = labels.join(state.selectExpr("id AS community", "own"), "community", "left").selectExpr("id", "coalesce(own, community) AS own")
        coarse = state
        state = _moved(links, own, resolution, 1 if level else TRIES, LEAST * weight if level else 0.0)
        forget(coarse, links, labels)
    names = state.groupBy("own").agg(F.min("id").alias("name"))
    named = state.join(names, "own").select("id", "name")
    return nodes.select("id", "scope").join(named, "id", "left").select("id", "scope", F.coalesce("name", "id").alias("community"))


def numbered(found: DataFrame) -> DataFrame:
    """``found`` (id, scope, community) with ``label``: within each scope from 0 on, the largest community first, then the one of the least name."""
    sizes = found.groupBy("scope", "community").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("scope").orderBy(F.desc("n"), "community")) - 1
    named = sizes.withColumn("label", place.cast("string")).select(F.col("scope").alias("of"), F.col("community").alias("name"), "label", F.col("n").alias("size"))
    return found.join(named, F.col("scope").eqNullSafe(F.col("of")) & (F.col("community") == F.col("name"))).select("id", "scope", "community", "label", "size")


def clusters_in_rounds(nodes: DataFrame, edges: DataFrame, resolutions: list[float], least: int = 50) -> DataFrame:
    """(id, round1, round2, ...): labels of each round, such as 3, 3.0, 3.0.1; nodes are (id) or (id, scope).

    A round clusters every cluster of the round before by itself. A cluster of fewer than ``least`` nodes isn't divided again: its nodes keep their label.
    """
    state = nodes.select("id", (F.col("scope").cast("string") if "scope" in nodes.columns else F.lit(None).cast("string")).alias("scope")).dropDuplicates(["id"])
    parent = F.col("scope")
    state = cut(state.select("id", parent.alias("label"), F.lit(True).alias("open")), "rounds")
    for i, resolution in enumerate(resolutions, 1):
        open_ = state.where("open")
        found = numbered(communities(open_.select("id", F.col("label").alias("scope")), edges, resolution)).select("id", F.concat_ws(".", "scope", "label").alias("new"), "size")
        label = F.coalesce("new", "label")
        old = state
        state = cut(state.join(found, "id", "left").withColumn(f"round{i}", label).select("id", *[f"round{k}" for k in range(1, i + 1)], label.alias("label"), (F.coalesce("size", F.lit(0)) >= least).alias("open")), "rounds")
        forget(old)
    return state.drop("label", "open")
