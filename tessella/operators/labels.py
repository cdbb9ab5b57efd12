"""Label transfer between clusters, gates on scores, matching and sampling with explicit orders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.tables import cut


def transfer_by_proportion(rows: DataFrame, min_share: float, min_reference: int, min_query: int) -> DataFrame:
    """(cluster, label): the most frequent reference label of a cluster, or unknown below the three bounds."""
    sizes = rows.groupBy("cluster").agg(F.count("label").alias("n_ref"), F.count_if(F.col("label").isNull()).alias("n_query"))
    counts = rows.where("label IS NOT NULL").groupBy("cluster", "label").agg(F.count("*").alias("k"))
    top = counts.withColumn("i", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("k"), "label"))).where("i = 1")
    both = sizes.join(top, "cluster", "left")
    good = (F.col("k") / F.col("n_ref") >= min_share) & (F.col("n_ref") >= min_reference) & (F.col("n_query") >= min_query)
    return both.select("cluster", F.when(good, F.col("label").cast("string")).otherwise("unknown").alias("label"), "n_ref", "n_query")


def confusion(rows: DataFrame) -> DataFrame:
    """(cluster, label, n, by_cluster, by_label, strength): shares of a pair in its row and its column, and the larger of both."""
    n = rows.where("label IS NOT NULL").groupBy("cluster", "label").agg(F.count("*").alias("n"))
    shares = n.withColumn("by_cluster", F.col("n") / F.sum("n").over(Window.partitionBy("cluster"))).withColumn("by_label", F.col("n") / F.sum("n").over(Window.partitionBy("label")))
    return shares.withColumn("strength", F.greatest("by_cluster", "by_label"))


def gated(label: Column, score: Column, least: float) -> Column:
    """``unknown`` where the score is known and below ``least``."""
    return F.when(score.isNotNull() & (score < least), "unknown").otherwise(label)


def hierarchical_gate(rows: DataFrame, levels: list[tuple[str, float, int]]) -> DataFrame:
    """``pass``: at each level (name, least score, least count) the score exceeds its bound, the level above passes and so do enough cells of the label."""
    above = F.lit(True)
    out = rows
    for name, score, count in levels:
        out = out.withColumn(f"_{name}", above & F.coalesce(F.col(f"{name}_score") > score, F.lit(False)))
        out = out.withColumn(f"_{name}", F.col(f"_{name}") & (F.count_if(F.col(f"_{name}")).over(Window.partitionBy(name)) >= count))
        above = F.col(f"_{name}")
    return out.withColumn("pass", above).drop(*[f"_{name}" for name, *_ in levels])


#: Queries of a block that are met at once, reference rows of which the nearest alone sets a bound, and pairs that are measured at once.
STEP, GROUP, MEASURED = 256, 32, 65_536


def best_pairs(q: np.ndarray, refs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in ``q``, places in ``refs``, distances): the ``k`` nearest rows of ``refs`` of each query in turn, by squared distance to 9 digits, ties to the earlier row.

    A matrix product leaves the few rows that may be among them; only those are measured one by one. The bound is the ``k``-th least of the
    least products of groups of rows, as each of those groups has a row within it.
    """
    middle = refs.mean(0)
    b = refs - middle
    rough_r = (b**2).sum(1)
    width = max(1, min(GROUP, len(refs) // (4 * k)))
    starts, least = np.arange(0, len(refs), width), min(k, len(refs)) - 1
    out = []
    for first in range(0, len(q), STEP):
        some = q[first : first + STEP]
        a = some - middle
        rough = (-2 * a) @ b.T
        rough += rough_r
        # what the product may be off, and the rounding, on either side
        slack = 4e-9 + 1e-14 * b.shape[1] * ((a**2).sum(1) + rough_r.max())
        bound = np.partition(np.minimum.reduceat(rough, starts, axis=1), least, axis=1)[:, least] + slack
        rows, at = np.nonzero(~(rough > bound[:, None]))
        d = np.concatenate([np.round(((refs[at[i : i + MEASURED]] - some[rows[i : i + MEASURED]]) ** 2).sum(1), 9) for i in range(0, len(at), MEASURED)])
        order = np.lexsort((at, d, rows))
        rows, at, d = rows[order], at[order], d[order]
        near = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        out.append((rows[near] + first, at[near], d[near]))
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def best_of_block(q: np.ndarray, refs: np.ndarray, k: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """``best_pairs`` as a list for each query."""
    rows, at, distances = best_pairs(q, refs, k)
    ends = np.searchsorted(rows, np.arange(1, len(q)))
    return np.split(at, ends), np.split(distances, ends)


def nearest(queries: DataFrame, reference: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """(query_id, ref_id, label, distance, rank): exact nearest neighbours by squared distance, ties to the smaller id.

    Blocks of about ``block`` queries meet blocks of as many reference rows, each pair in a task of its own that keeps the best ``k`` of its
    queries; what is left is ranked by a window that Spark limits before the shuffle. Queries with the same vector are one until the end, and of
    reference rows with the same vector only the ``k`` of the least ids are met, as no other can be among the nearest.
    """
    vector = F.sha2(F.to_json(F.struct(F.transform("embedding", lambda x: x.cast("double")).alias("v"))), 256)
    same = queries.select(F.col("vec_id").cast("bigint").alias("query_id"), vector.alias("key")).distinct()
    first = same.groupBy("key").agg(F.min("query_id").alias("first"))
    members = same.join(first, "key").select("query_id", "first")
    queries = queries.join(first, (F.col("vec_id") == F.col("first")) & vector.eqNullSafe(F.col("key")), "left_semi")
    least = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    reference = cut(reference.select("vec_id", "label", "embedding", vector.alias("key")).withColumn("least", least).where(F.col("least") <= k).drop("least", "key"), "reference")
    n_q, n_r = (max(1, -(-df.count() // block)) for df in (queries, reference))
    rows = lambda df, side, own, n, other, m: df.select(
        F.lit(side).alias("side"), F.col("vec_id").cast("bigint").alias("id"), (F.col("label").cast("string") if side else F.lit("")).alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("v"),
        F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other),
    )
    both = rows(queries, 0, "qb", n_q, "rb", n_r).unionByName(rows(reference, 1, "rb", n_r, "qb", n_q))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, r = pdf[pdf.side == 0], pdf[pdf.side == 1].sort_values("id", kind="stable")
        out = []
        if len(q) and len(r):
            ids, labels = r.id.to_numpy(), r.label.to_numpy(object)
            for i, at, d in zip(q.id, *best_of_block(np.stack(q.v), np.stack(r.v), k), strict=True):
                out += zip([i] * len(at), ids[at], labels[at], d, strict=True)
        return pd.DataFrame(out, columns=["query_id", "ref_id", "label", "distance"])

    # pairs of blocks are few bytes and much work, so their number is that of the pairs
    found = both.repartition(min(2 * n_q * n_r, 4096), "qb", "rb").groupBy("qb", "rb").applyInPandas(run, "query_id bigint, ref_id bigint, label string, distance double")
    found = found.withColumn("label", F.col("label").cast(dict(reference.dtypes)["label"]))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "ref_id"))).where(F.col("rank") <= k)
    return members.join(found.withColumnRenamed("query_id", "first"), "first").select("query_id", "ref_id", "label", "distance", "rank")


def vote(neighbours: DataFrame) -> DataFrame:
    """(query_id, label, share): the label with most of a query's neighbours, ties to the smaller label."""
    n = neighbours.groupBy("query_id", "label").agg(F.count("*").alias("n"))
    total = Window.partitionBy("query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("n"), "label")
    return n.withColumn("share", F.col("n") / F.sum("n").over(total)).withColumn("i", F.row_number().over(best)).where("i = 1").select("query_id", "label", "share")


def hash_order(key: Column) -> Column:
    """A fixed order that looks random and that any engine can compute."""
    return key * 2654435761 % 4294967296


def sample_each(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """``most`` rows of each group at most, by hash order."""
    order = Window.partitionBy(group).orderBy(hash_order(F.col(key)), key)
    return rows.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= most).drop("_i")


def jaccard_matches(pairs: DataFrame, least: float) -> DataFrame:
    """(a, b, n, score): mutual best pairs of two assignments by n / (sum a + sum b - n) over their common points."""
    n = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    score = F.col("n") / (F.sum("n").over(Window.partitionBy("a")) + F.sum("n").over(Window.partitionBy("b")) - F.col("n"))
    out = n.withColumn("score", score).withColumn("i", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "b"))).where("i = 1")
    return out.withColumn("i", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("score"), "a"))).where((F.col("i") == 1) & (F.col("score") >= least)).drop("i")


def best_label(scores: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """(query_id, label, score): the label of the largest score of each row of (query_id, label, score), of equal ones the first by name.

    With ``fallback`` (query_id, label), rows without any score keep their label there.
    """
    best = scores.where("score IS NOT NULL").groupBy("query_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "label")).alias("best")).select("query_id", "best.label", (-F.col("best.s")).alias("score"))
    if fallback is None:
        return best
    rest = fallback.select("query_id", F.col("label").alias("known"))
    return rest.join(best, "query_id", "full").select("query_id", F.coalesce("label", "known").alias("label"), "score")


def weighted_votes(neighbours: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """(query_id, label, score): shares of the neighbours' weights by label; rows are (query_id, ref_id, distance), a label is (ref_id, label).

    A neighbour's weight is 1 - distance / distance of the farthest of its query, as a share of all; equal distances weigh the same.
    Weights are added from the least on, so that shares, which aren't rounded, don't depend on the order of rows.
    """
    rows = neighbours
    if k is not None:
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "ref_id"))).where(F.col("r") <= k).drop("r")
    farthest = F.max("distance").over(Window.partitionBy("query_id"))
    rows = rows.withColumn("w", 1 - F.coalesce(F.try_divide(F.col("distance"), farthest), F.lit(0.0)) + 1e-9)
    added = lambda values, w=lambda x: x: F.aggregate(F.array_sort(values), F.lit(None).cast("double"), lambda z, x: F.coalesce(z + w(x), z, w(x)))
    votes = rows.join(labels, "ref_id").groupBy("query_id", "label").agg(added(F.collect_list("w")).alias("w"))
    votes = votes.groupBy("query_id").agg(F.collect_list(F.struct("w", "label")).alias("votes"))
    each = votes.select("query_id", added(F.col("votes"), lambda x: x["w"]).alias("total"), F.explode("votes").alias("vote"))
    return each.select("query_id", "vote.label", (F.col("vote.w") / F.col("total")).alias("score"))


def without_small(rows: DataFrame, cluster: str, least: int) -> DataFrame:
    """Rows of clusters with ``least`` rows or more; the sizes are joined back, so a large cluster is never gathered."""
    sizes = rows.groupBy(cluster).agg(F.count("*").alias("size")).where(F.col("size") >= least).select(cluster)
    return rows.join(sizes, cluster, "left_semi")


def sized_reference(reference: DataFrame, cluster: str, key: str, most: int = 3000, least: int = 0, seed: int = 13) -> DataFrame:
    """A reference without clusters under ``least`` cells, and with ``most`` cells a cluster at most, by a seeded hash; 0 sets no bound."""
    rows = without_small(reference, cluster, least) if least > 0 else reference
    if most <= 0:
        return rows
    return rows.withColumn("r", F.row_number().over(Window.partitionBy(cluster).orderBy(F.xxhash64(key, F.lit(seed)), key))).where(F.col("r") <= most).drop("r")


def capped_reference(reference: DataFrame, key: str, n_query: int, least: int, seed: int = 13) -> DataFrame:
    """min(all, max(n_query, least)) rows of a reference, by a seeded hash."""
    return reference.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(max(n_query, least))


def balanced(rows: DataFrame, group: str, key: str, seed: int = 13) -> DataFrame:
    """As many rows of each group as the smallest has, by a seeded hash."""
    n = rows.groupBy(group).agg(F.count("*").alias("n")).agg(F.min("n").alias("least"))
    at = F.row_number().over(Window.partitionBy(group).orderBy(F.xxhash64(key, F.lit(seed)), key))
    return rows.withColumn("at", at).crossJoin(F.broadcast(n)).where("at <= least").drop("at", "least")


def training_mask(rows: DataFrame, key: str, n: int, seed: int = 13) -> DataFrame:
    """``rows`` with ``train``: true for ``n`` of them at most, by a seeded hash."""
    chosen = rows.select(key).distinct().orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n).withColumn("train", F.lit(True))
    return rows.join(chosen, key, "left").fillna(False, ["train"])


def confusion_transfer(pairs: DataFrame, least: int = 0) -> DataFrame:
    """(cluster, label, n, share): of a contingency table of (cluster, label), the larger of row and column share; null labels don't count.

    Clusters with fewer than ``least`` labelled rows are left out.
    """
    n = pairs.where("label IS NOT NULL").groupBy("cluster", "label").agg(F.count("*").alias("n"))
    n = n.withColumn("in_cluster", F.sum("n").over(Window.partitionBy("cluster"))).withColumn("in_label", F.sum("n").over(Window.partitionBy("label")))
    return n.where(F.col("in_cluster") >= least).select("cluster", "label", "n", F.greatest(F.col("n") / F.col("in_cluster"), F.col("n") / F.col("in_label")).alias("share"))


def centroid_votes(queries: DataFrame, reference: DataFrame, markers: DataFrame, rounds: int, share: float = 0.9, seed: int = 13) -> DataFrame:
    """(query_id, label, probability): hierarchical mapping's vote at one level.

    In each round a hashed ``share`` of the marker genes is drawn; the label whose centroid correlates best with the query over them gets its
    vote, of equal ones the first by name. ``queries`` are (query_id, gene, value), ``reference`` (label, gene, mean); absent values are zeros.
    """
    drawn = markers.select("gene").distinct().select("gene", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    drawn = drawn.where(F.pmod(F.xxhash64("gene", "round", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))
    size = drawn.groupBy("round").agg(F.count("*").alias("m"))
    moments = lambda df, key, v: df.join(drawn, "gene").groupBy(key, "round").agg(F.sum(v).alias(f"s_{key}"), F.sum(F.col(v) * F.col(v)).alias(f"ss_{key}"))
    products = queries.join(drawn, "gene").join(reference, "gene").groupBy("query_id", "label", "round").agg(F.sum(F.col("value") * F.col("mean")).alias("xy"))
    rows = products.join(moments(queries, "query_id", "value"), ["query_id", "round"]).join(moments(reference, "label", "mean"), ["label", "round"]).join(F.broadcast(size), "round")
    cov = F.col("xy") - F.col("s_query_id") * F.col("s_label") / F.col("m")
    var = lambda k: F.col(f"ss_{k}") - F.col(f"s_{k}") * F.col(f"s_{k}") / F.col("m")
    r = F.round(F.try_divide(cov, F.sqrt(F.greatest(var("query_id") * var("label"), F.lit(0.0)))), 9)
    won = rows.withColumn("score", r).where("score IS NOT NULL").groupBy("query_id", "round").agg(F.min(F.struct((-F.col("score")).alias("s"), "label")).alias("best"))
    votes = won.groupBy("query_id", F.col("best.label").alias("label")).agg(F.count("*").alias("votes"))
    return votes.select("query_id", "label", (F.col("votes") / F.sum("votes").over(Window.partitionBy("query_id"))).alias("probability"))
