"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, and a Gumbel top-k sample.

Each text is a bag of words, marks and pairs of neighbours, hashed into ``BUCKETS`` buckets. The raw model counts all documents;
the target model counts the documents of good quality in a bounded sample of the labelled rows (``SAMPLE`` rows, by a hash of
their ids). A document's log importance weight is the sum of log(target / raw) over its bag, not divided by its length. A Gumbel
variable of scale 1, fixed by a hash of doc_id and text, is added to each weight, and the k largest sums are kept: a sample of k
documents without replacement, each drawn in proportion to its importance weight among those left. k is ``share`` of all documents
(rounded); where no share is given it is the part of good rows among all labelled ones, one label an id.

Rows: a null text is empty; an empty text has weight 0; ties at the k-th key go to the smaller doc_id (none comes first), then to
the smaller row hash; rows that repeat as a whole are one draw and kept alike, so the sample may exceed k by copies of its last
row; without labels of both classes every document is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import KEYS, cut, fresh, keyed, pick, table
from tessella.llm.words import Memo, batches, hold, mix, number, starts

BUCKETS, SAMPLE, SEED = 1 << 16, 20_000, 17
PIECES = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_numbers = Memo(number)


def _bag(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts' words and pairs in a row, the first place of each text, and the texts' numbers of words."""
    words = [PIECES.findall(t.lower()) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    h = np.fromiter((_numbers[w] for text in words for w in text), np.uint64, int(n.sum()))
    with np.errstate(over="ignore"):
        pair = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) else h
    ones, twos = (h % np.uint64(BUCKETS)).astype(np.int64), (pair % np.uint64(BUCKETS)).astype(np.int64)
    both = np.full(2 * len(h), BUCKETS, np.int64)  # the bucket after the last takes what is not a pair
    both[0::2] = ones
    if len(h):
        both[1:-1:2] = twos
        ends = np.cumsum(n)[n > 0] - 1
        both[2 * ends + 1] = BUCKETS
    return both, starts(2 * n), n


def _texts(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"), *more)


def counts(docs: DataFrame) -> DataFrame:
    """(bucket, n_good, n_all) over all rows; column ``good`` marks the target's rows."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("importance", _numbers.clear)
        total = np.zeros((2, BUCKETS + 1), np.int64)
        for pdf in parts:
            for some in batches(pdf):
                both, first, n = _bag(some["_text"].tolist())
                total[1] += np.bincount(both, minlength=BUCKETS + 1)
                good = np.repeat(some["good"].to_numpy(bool), 2 * n)
                total[0] += np.bincount(both[good], minlength=BUCKETS + 1)
        _numbers.clear()
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "n_good": total[0, :-1], "n_all": total[1, :-1]})

    found = _texts(docs, "good").mapInPandas(run, "bucket int, n_good bigint, n_all bigint")
    return found.groupBy("bucket").agg(F.sum("n_good").alias("n_good"), F.sum("n_all").alias("n_all"))


def log_ratios(model: pd.DataFrame) -> np.ndarray:
    """log(target / raw) of each bucket, both smoothed by one count spread like the raw text; 0 for what is not a pair."""
    m = model.sort_values("bucket")
    good, raw = m.n_good.to_numpy(float), m.n_all.to_numpy(float)
    if not good.sum() or not raw.sum():
        return np.zeros(BUCKETS + 1)
    raw = (raw + 0.01) / (raw.sum() + 0.01 * BUCKETS)
    prior = 50.0 * BUCKETS / 1000
    good = (good + prior * raw) / (good.sum() + prior)
    return np.append(np.log(good / raw), 0.0)


def weigh(docs: DataFrame, ratios: np.ndarray, into: str = "weight") -> DataFrame:
    """``docs`` with a column ``into``: struct(n_words, log_weight) of each text. Only texts go to the workers, and only numbers come back."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # BUCKETS numbers

    @F.pandas_udf("n_words bigint, log_weight double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hold("importance", _numbers.clear)
        for texts in parts:
            out = [(np.zeros(0, np.int64), np.zeros(0))]
            for some in batches(texts.to_frame("_text")):
                both, first, n = _bag(some["_text"].tolist())
                w = np.append(shared.value[both], 0.0)
                out.append((n, np.where(n > 0, np.add.reduceat(w, np.minimum(first, len(w) - 1)), 0.0)))
            n, total = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pd.DataFrame({"n_words": n, "log_weight": np.round(total, 9)})
        _numbers.clear()

    return docs.withColumn(into, run(F.coalesce("text", F.lit(""))))


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, quality) of ``sample`` labelled ids at most: those with the least hash, one row an id."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample)


def good_share(labels: DataFrame) -> float:
    """The part of good ids among all labelled ones; 1 where a class is missing."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n, good = known.agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
    return good / n if 0 < good < n else 1.0


def kth_largest(keys: DataFrame, k: int, key: str = "key", bins: int = 1024, few: int = 2048) -> float | None:
    """The k-th largest key, by counting bins and narrowing to the one that holds it; no sort of all rows."""
    low, high, n = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if k <= 0 or not n:
        return None
    if k >= n:
        return low
    while True:
        inside = keys.where((F.col(key) >= low) & (F.col(key) <= high))
        size = inside.count()
        if size <= few or low == high:
            return inside.orderBy(F.desc(key)).offset(k - 1).limit(1).first()[key]
        step = (high - low) / bins
        rows = inside.groupBy(F.least(F.floor((F.col(key) - low) / step), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        for r in sorted(rows.collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]


def gumbel(seed: int = SEED) -> Column:
    """A standard Gumbel variable of the row keys."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*KEYS, F.lit(seed)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(-F.log(uniform))


def top_k(rows: DataFrame, k: int, key: str = "gumbel_key") -> Column:
    """The condition that holds for the ``k`` rows of ``rows`` (key, doc_id and row keys) with the largest keys; ties as stated above."""
    least = kth_largest(rows, k, key)
    if least is None:
        return F.lit(False)
    above = rows.where(F.col(key) > least).count()
    row = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", *KEYS)
    tied = rows.where(F.col(key) == least).groupBy("doc_id", *KEYS).agg(F.count("*").alias("n")).orderBy(row)
    total, places = 0, []
    for r in tied.toLocalIterator():  # stops at the k-th row
        places.append((r["doc_id"], r[KEYS[0]], r[KEYS[1]]))
        total += r["n"]
        if above + total >= k:
            break
    doc_id, k1, k2 = places[-1]
    last = F.struct(F.lit(doc_id is not None).alias("named"), F.lit(doc_id).cast("bigint").alias("doc_id"), F.lit(k1).alias(KEYS[0]), F.lit(k2).alias(KEYS[1]))
    return (F.col(key) > least) | ((F.col(key) == least) & (row <= last))


def sampled(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED, carried: list[str] | None = None) -> DataFrame:
    """The ``carried`` columns of ``docs`` (all by default) and, last, ``importance``: struct(n_words, log_weight, gumbel_key, kept, row_k1, row_k2)."""
    few = sampled_labels(labels).where("quality = 1").select("doc_id")
    texts = pick(docs, "doc_id", "text").join(F.broadcast(few.withColumn("good", F.lit(True))), "doc_id", "left")  # SAMPLE rows at most
    model = counts(texts.withColumn("good", F.coalesce("good", F.lit(False)))).toPandas()
    weight, own = fresh(docs, "weight"), fresh(docs, "row")
    rows = keyed(docs.select("doc_id", "text", F.struct(*(carried or docs.columns)).alias(own)))
    weighed = cut(weigh(rows, log_ratios(model), weight).withColumn("gumbel_key", F.round(F.col(f"{weight}.log_weight") + gumbel(seed), 9)).drop("text"), "weights")
    share = good_share(labels) if share is None else share
    n = weighed.count()
    k = min(n, round(share * n))
    kept = F.lit(True) if k >= n else top_k(weighed.select("doc_id", *KEYS, "gumbel_key"), k)
    found = F.struct(f"{weight}.n_words", f"{weight}.log_weight", "gumbel_key", kept.alias("kept"), *KEYS)
    name = fresh(docs, "importance")
    return weighed.select(f"{own}.*", found.alias(name))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, log_weight, gumbel_key, kept): ``kept`` marks the Gumbel top-k sample."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return sampled(docs, labels, share, seed, ["doc_id"]).select("doc_id", "importance.n_words", "importance.log_weight", "importance.gumbel_key", "importance.kept")


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, key and decision of every document; the sample is the rows with ``kept``."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
