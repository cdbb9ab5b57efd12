"""Exact top-k search over sparse or dense integer vectors by MaxScore, block by block.

Every component of a vector is a term, its value the weight in the term's posting. Contributions are shifted by the least
contribution of the term in the block, so that all are at least 0; a query's terms are sorted by the largest shifted
contribution, and the longest prefix whose sum cannot reach the k-th best score so far is non-essential. Essential postings are
traversed for all vectors; the others are probed, largest first, only for vectors that can still compete.

Rows: vectors that are null or hold a null or non-finite component take no part; a repeated candidate counts as often as it occurs, a
repeated query once; a shorter vector counts as padded with zeros; an empty table gives no rows. Ties go to the smaller id. Components are kept as 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import mod20, pick, table

K = 20
#: Vectors that meet in one task: at most about so many candidates and queries, whatever the size of the tables.
CANDIDATES, QUERIES = 8192, 1024
#: Vectors scored in full before the first threshold, and terms probed at once.
SEED, PROBE = 256, 8


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """(id, v array<bigint>): floor(scale * component) of each usable vector."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = pick(vectors, id_col, vec_col).where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(~bad)
    v = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return usable.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def _packed(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """One row per block of about ``rows`` vectors: ids and components as bytes."""
    blocks = max(1, -(-vectors.count() // rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, pdf.v))
        m = np.zeros((len(pdf), width), dtype=np.int64)
        for i, v in enumerate(pdf.v):
            m[i, : len(v)] = v
        small = np.int16 if m.size and np.abs(m).max() < 2**15 else np.int64
        return pd.DataFrame({name: [pdf[name].iloc[0]], "ids": [pdf.id.to_numpy(np.int64).tobytes()], "width": [width], "wide": [small is np.int64], "data": [m.astype(small).tobytes()]})

    keyed = vectors.withColumn(name, F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    return keyed.groupBy(name).applyInPandas(pack, f"{name} int, ids binary, width int, wide boolean, data binary"), blocks


def _unpacked(row: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], np.int64 if row["wide"] else np.int16).astype(np.int64).reshape(len(ids), row["width"])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of each query's best k candidates of one block."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))
    reach = float((np.abs(q).max(0, initial=0).astype(float) * np.abs(c).max(0, initial=0)).sum())
    kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64
    # queries see the same postings; term-major, so that a term's weights lie together
    postings = np.ascontiguousarray(c.T.astype(kind))
    high, low = postings.max(1, initial=0) if not len(c) else postings.max(1), postings.min(1, initial=0) if not len(c) else postings.min(1)
    rows = q.astype(kind)
    for i in range(len(q)):
        query, own = rows[i], np.flatnonzero(c_ids == q_ids[i])
        most, least = np.maximum(query * high, query * low), np.minimum(query * high, query * low)
        seeds = np.setdiff1d(np.arange(min(SEED, len(c_ids))), own)
        best_ids, best = _best(c_ids[seeds], query @ postings[:, seeds], k)
        floor = best[-1] if len(best) == k else None
        order = np.argsort(least - most, kind="stable")  # largest shifted contribution first
        rest = np.append(np.cumsum((most)[order][::-1])[::-1], 0)  # rest[j]: the most that terms j.. can add
        # non-essential: a suffix of the order whose shifted contributions alone cannot reach the threshold
        shifted = np.append(np.cumsum((most - least)[order][::-1])[::-1], 0)
        cut = len(order) if floor is None else int(np.argmax(shifted + least.sum() < floor)) if (shifted + least.sum() < floor).any() else 0
        essential = order[:cut]
        alive = np.arange(SEED, len(c_ids)) if len(c_ids) > SEED else np.zeros(0, int)
        partial = query[essential] @ postings[essential, SEED:] if len(alive) else np.zeros(0, kind)
        at = cut
        while len(alive):
            if floor is not None:
                keep = partial + rest[at] >= floor
                alive, partial = alive[keep], partial[keep]
            if at >= len(order):
                break
            some = order[at : at + PROBE]
            partial = partial + query[some] @ postings[some[:, None], alive]
            at += len(some)
        mine = np.isin(alive, own, invert=True)
        yield int(q_ids[i]), *_best(np.concatenate([best_ids, c_ids[alive[mine]]]), np.concatenate([best, partial[mine]]), k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products with the candidates of other ids.

    Both inputs are (id, v). A candidate that is repeated as a whole counts as often as it occurs, of which ``k`` are enough; a repeated query is one.
    Blocks of queries meet blocks of candidates; each pair of blocks is one bounded task, and its best ``k`` a query are merged by a
    ranked window, which Spark limits before the shuffle.
    """
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int")))
    candidates = candidates.groupBy("id", "v").agg(F.count("*").alias("copies")).withColumn("copy", copies).select("id", "v")
    left, n_left = _packed(queries.distinct(), QUERIES, "query_block")
    right, n_right = _packed(candidates, CANDIDATES, "block")
    columns = ["query_block", "block", "side", "ids", "width", "wide", "data"]
    sides = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))).withColumn("side", F.lit(0)).select(*columns)
    sides = sides.unionByName(right.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))).withColumn("side", F.lit(1)).select(*columns))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(pdf) == 2:
            q, c = (_unpacked(row) for _, row in pdf.sort_values("side").iterrows())
            for query, ids, scores in search_block(*q, *c, k):
                out["query_id"] += [query] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += np.rint(scores).astype(np.int64).tolist() if scores.dtype != np.int64 else scores.tolist()
        return pd.DataFrame(out).astype("int64")

    found = sides.groupBy("query_block", "block").applyInPandas(score, "query_id bigint, vec_id bigint, score bigint")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all embeddings for each embedding whose id is divisible by 20."""
    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where(mod20("id")), vectors, K)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
