"""An index of inverted lists for nearest neighbours: every row of the reference lies in the list of its nearest centre.

Centres are fitted by k-means on a sample of ``SAMPLE`` rows at most (those with the least hash of their ids), about one for
each ``PER_LIST`` rows and ``CENTRES`` at most, so they may be broadcast. A query looks into the lists of its ``probes`` nearest centres. Lists are cut
into blocks of about ``BLOCK`` rows, and a list's queries too, so that a list of any size is many bounded tasks. The result is exact within the lists looked
into; with as many probes as centres it is exact altogether, as ``labels.nearest`` is, and lists are then packed into blocks, so that a query is sent
to each block instead of each list. ``recall`` measures the rest.

Rows: (vec_id, label, embedding) as for ``labels.nearest``; vectors that are null or hold a null or a number that isn't finite take no part; ties go to
the smaller id; repeated rows are rows; an empty reference gives no neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.labels import best_of_block, best_pairs
from tessella.sources.tables import cut

SAMPLE, CENTRES, PER_LIST, BLOCK = 20_000, 1_024, 400, 4_096
STEPS, SEED = 15, 13

#: Rows of a block where every list is looked into, at most, and the blocks of a side below that.
WIDE, SIDE = 16_384, 8


def usable(vectors: DataFrame) -> DataFrame:
    """The rows with whole vectors, as doubles."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    return rows.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double")))


def _nearest_centres(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    d = (vectors**2).sum(1)[:, None] - 2 * vectors @ centres.T + (centres**2).sum(1)
    return np.argsort(d, 1, kind="stable")[:, :n]


def centres(reference: DataFrame, sample: int = SAMPLE, most: int = CENTRES) -> np.ndarray:
    """(centres, dimensions) by k-means on a bounded sample; without rows there are none."""
    rows = usable(reference).select("vec_id", "embedding")
    n = rows.count()
    some = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(sample).toPandas()  # bounded by ``sample``
    if not len(some):
        return np.zeros((0, 0))
    x = np.stack(some.embedding)
    k = min(most, max(1, n // PER_LIST), len(x))
    r = np.random.default_rng(SEED)
    found = x[r.choice(len(x), k, replace=False)]
    for _ in range(STEPS):
        own = _nearest_centres(x, found, 1)[:, 0]
        size = np.bincount(own, minlength=k)
        sums = np.zeros_like(found)
        np.add.at(sums, own, x)
        new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], x[r.integers(0, len(x), k)])  # an empty list begins anew
        if np.allclose(new, found):
            break
        found = new
    return found


def in_lists(vectors: DataFrame, found: np.ndarray, probes: int = 1) -> DataFrame:
    """``vectors`` with ``list``: the nearest centre of each row, or a row for each of the ``probes`` nearest ones."""
    shared = vectors.sparkSession.sparkContext.broadcast(found)  # ``CENTRES`` vectors at most

    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in parts:
            yield pd.Series(list(_nearest_centres(np.stack(v), shared.value, probes).astype(np.int32))) if len(v) else pd.Series([], dtype=object)

    return usable(vectors).withColumn("list", F.explode(run("embedding")))


def indexed(reference: DataFrame, found: np.ndarray | None = None) -> tuple[DataFrame, np.ndarray]:
    """The reference with its lists, written once for many searches, and the centres."""
    found = centres(reference) if found is None else found
    return cut(in_lists(reference.select("vec_id", "label", "embedding"), found), "index") if len(found) else usable(reference).limit(0).withColumn("list", F.lit(0)), found


def search(queries: DataFrame, index: DataFrame, found: np.ndarray, k: int, probes: int = 8) -> DataFrame:
    """(query_id, ref_id, label, distance, rank): the ``k`` nearest rows of the lists looked into, by squared distance."""
    if 0 < len(found) <= probes:
        return _search_all(queries, index, k)
    label = index.schema["label"].dataType.simpleString()
    asked = in_lists(queries.select("vec_id", "embedding"), found, max(1, min(probes, len(found)))) if len(found) else usable(queries.select("vec_id", "embedding")).limit(0).withColumn("list", F.lit(0))
    blocks = lambda df: df.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rb, qb = blocks(index).withColumnRenamed("blocks", "rbs"), blocks(asked).withColumnRenamed("blocks", "qbs")
    sizes = F.broadcast(rb.join(qb, "list"))  # one row a centre
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kinds = lambda df, side: df.select("list", F.lit(side).alias("side"), F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("v"), F.col("rb"), F.col("qb"), (F.col("label").cast("string") if side else F.lit(None).cast("string")).alias("label"))
    right = index.join(sizes, "list").withColumn("rb", block("rbs")).withColumn("qb", every("qbs"))
    left = asked.join(sizes, "list").withColumn("qb", block("qbs")).withColumn("rb", every("rbs"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, r = pdf[pdf.side == 0], pdf[pdf.side == 1].sort_values("id", kind="stable")
        out = []
        if len(q) and len(r):
            ids, labels = r.id.to_numpy(), r.label.to_numpy(object)
            for i, at, d in zip(q.id, *best_of_block(np.stack(q.v), np.stack(r.v), k), strict=True):
                out += zip([i] * len(at), ids[at], labels[at], d, strict=True)
        return pd.DataFrame(out, columns=["query_id", "ref_id", "label", "distance"])

    near = kinds(left, 0).unionByName(kinds(right, 1)).groupBy("list", "rb", "qb").applyInPandas(run, "query_id bigint, ref_id bigint, label string, distance double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "ref_id"))
    return near.withColumn("label", F.col("label").cast(label)).withColumn("rank", place).where(F.col("rank") <= k)


def _search_all(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """``search`` in every list. Lists lie one after another in blocks of ``WIDE`` rows at most, and each pair of blocks is a task that keeps the best ``k`` of its queries.

    Queries with the same vector are one until the end, and of reference rows with the same vector only the ``k`` of the least ids are met.
    """
    label = index.schema["label"].dataType.simpleString()
    same = Window.partitionBy("embedding")
    asked = usable(queries.select("vec_id", "embedding")).withColumn("vec_id", F.col("vec_id").cast("bigint"))
    asked = cut(asked.withColumn("first", F.min("vec_id").over(same)).withColumn("place", F.row_number().over(same.orderBy("vec_id"))), "asked")
    met = cut(index.withColumn("place", F.row_number().over(same.orderBy("vec_id", "label"))).where(F.col("place") <= k).drop("place"), "met")
    once = asked.where("place = 1")

    def blocks(n: int) -> int:
        return max(1, -(-n // max(BLOCK, min(WIDE, -(-n // SIDE)))))

    n_q = blocks(once.count())
    sizes = sorted(met.groupBy("list").count().collect())  # one row a centre
    n_r, before, starts = blocks(sum(r["count"] for r in sizes)), 0, []
    for r in sizes:
        starts.append((r["list"], before, r["count"]))
        before += r["count"]
    # a list begins where those before it end, and its rows are dealt by hash along its own stretch
    place = F.broadcast(queries.sparkSession.createDataFrame(starts, "list int, start bigint, size bigint"))
    block = ((F.col("start") + F.pmod(F.xxhash64("vec_id"), "size")) * n_r / F.lit(max(1, before))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = met.join(place, "list").select(F.lit(1).alias("side"), F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("v"), block.alias("rb"), every(n_q).alias("qb"))
    left = once.select(F.lit(0).alias("side"), F.col("first").alias("id"), F.lit(None).cast("string").alias("label"), F.col("embedding").alias("v"), every(n_r).alias("rb"), F.pmod(F.xxhash64("first"), F.lit(n_q)).cast("int").alias("qb"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, r = pdf[pdf.side == 0], pdf[pdf.side == 1].sort_values("id", kind="stable")
        if not (len(q) and len(r)):
            return pd.DataFrame({"first": [], "ref_id": [], "label": [], "distance": []})
        rows, at, d = best_pairs(np.stack(q.v), np.stack(r.v), k)
        return pd.DataFrame({"first": q.id.to_numpy()[rows], "ref_id": r.id.to_numpy()[at], "label": r.label.to_numpy(object)[at], "distance": d})

    near = left.unionByName(right).repartition(min(2 * n_q * n_r, 4096), "qb", "rb").groupBy("qb", "rb").applyInPandas(run, "first bigint, ref_id bigint, label string, distance double")
    order = F.row_number().over(Window.partitionBy("first").orderBy("distance", "ref_id"))
    near = near.withColumn("rank", order).where(F.col("rank") <= k).drop("rank")
    found = asked.select(F.col("vec_id").alias("query_id"), "first").join(near, "first").drop("first")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "ref_id"))
    return found.withColumn("label", F.col("label").cast(label)).withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "ref_id", "label", "distance", "rank")


def recall(near: DataFrame, exact: DataFrame) -> float | None:
    """The part of the exact neighbours (query_id, ref_id) that ``near`` has; null without any."""
    hit = exact.select("query_id", "ref_id").distinct().join(near.select("query_id", "ref_id", F.lit(1).alias("hit")).distinct(), ["query_id", "ref_id"], "left")
    return hit.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
