"""Target-distribution importance resampling by a ring of running CRC states.

Features are all runs of one to ``LONGEST`` consecutive words, joined by single spaces. They are never built as strings: one scan of a
document keeps the running zlib states of the last ``LONGEST`` starts, extends each by a space and the next word, and begins a new one
(``ring_buckets``); every state is the CRC of one feature, and its remainder is the feature's bucket. Two passes over the texts:

1. Bucket counts of the documents and of the target, summed inside each task before the shuffle. A bucket's gain is the smoothed log
   ratio of both distributions in thousandths. There are ``BUCKETS`` gains, whatever the input's size, so they may be broadcast.
2. A document's weight is the sum of its features' gains. A Gumbel variable, fixed by a hash of seed and doc_id, is added, and
   of the documents with ``LEAST`` words or more the stated share with the highest scores is drawn, each as likely as its weight asks.

Ranks cover all of the sample without one task that sees it all: the narrow scores are dealt by range, sorted inside their
partitions and written, and a row's rank is its place in its partition after the rows of the partitions before.

Rows: a null text has no words; a document without words has weight 0; ties go to the smaller doc_id (none comes last), then to more
features; rows that are repeated as a whole are drawn one by one; a null doc_id counts as no digits; texts of any length are read whole;
other columns are not read; an empty target gives every feature the gain of its rarity; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import cut, forget, pick, table
from tessella.llm.words import batches

LONGEST, BUCKETS, LEAST, SHARE, SEED = 3, 10_000, 20, 5, 42

#: Bytes that belong to words stay (A-Z as small letters), all others separate; beyond ASCII every byte is part of a word.
_FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def ring_buckets(text: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each run of one to ``longest`` words, in the order of their last words."""
    ring: list[int] = []  # states of the last starts, the newest first
    out: list[int] = []
    for w in text:
        after = b" " + w
        ring = [crc32(w), *[crc32(after, state) for state in ring[: longest - 1]]]
        out += ring
    return np.array(out, np.uint32) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of all rows; buckets without any are left out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in parts:
            for some in batches(pdf):
                for t in some["_text"]:
                    total += np.bincount(ring_buckets(words(t), longest, buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": found, "n": total[found]})

    return docs.select(F.coalesce("text", F.lit("")).alias("_text")).mapInPandas(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's smoothed log ratio of target and raw counts, in thousandths, rounded down."""
    all_raw, all_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    ratios = ((float(target.get(b, 0) + 1) * float(all_raw)) / (float(raw.get(b, 0) + 1) * float(all_target)) for b in range(buckets))
    return np.array([floor(1000 * log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, by_bucket: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(by_bucket)  # as many numbers as buckets

    @F.pandas_udf("n_words bigint, n_features bigint, weight bigint")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        gain = shared.value
        for texts in parts:
            out = []
            for t in texts:
                w = words(t)
                found = ring_buckets(w, longest, len(gain))
                out.append((len(w), len(found), int(gain[found].sum())))
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), run(F.coalesce("text", F.lit(""))).alias("w"))
    return rows.select("doc_id", "w.n_words", "w.n_features", "w.weight")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variable in thousandths, rounded down, fixed by seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def ranked(rows: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``rows`` with each row's place, from 1, in the order; equal rows in any order.

    The one number that each partition sends to the driver is its count of rows.
    """
    place = F.monotonically_increasing_id()  # partition and place in it
    dealt = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(rank, place), "ranked")
    part, inside = F.shiftright(rank, 33), F.col(rank).bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before = np.append(0, np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)])).tolist()
    return dealt.withColumn(rank, F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), part.cast("int")) + inside + 1)


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null for what is not drawn."""
    docs, target = pick(docs, "doc_id", "text"), pick(target, "text")
    raw, wanted = ({r["bucket"]: r["n"] for r in bucket_counts(t).collect()} for t in (docs, target))
    noisy = F.col("weight") + gumbel(F.col("doc_id"), seed)
    scored = cut(weigh(docs, gains(raw, wanted)).withColumn("score", noisy.cast("bigint")), "scores")
    may = F.col("n_words") >= least
    n = scored.where(may).count()
    placed = ranked(scored, [F.when(may, 0).otherwise(1).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc()])
    forget(scored)
    return placed.withColumn("rank", F.when(F.col("rank") <= share * n // 100, F.col("rank")))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document against the benchmark's distribution."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
