"""MinHash near-duplicates: universal hash minima with banding, signature verification, exact confirmation and components.

1. Each text becomes a set of 5-word shingles (64-bit hashes) and, in bands of some rows, minima of multiplicative 32-bit hashes.
   Texts of equal sets form one class at once, by a partial aggregation over a 128-bit hash of the set, so a group of exact
   copies of any size costs one row.
2. A band of minima that several classes share links all of them to the bucket's least class (a star, not all pairs). The
   components of these candidate links, by large-star and small-star, are clusters: two classes that share a band are always in
   one cluster. Bands and rows follow the threshold (``shape``): two sets at the threshold share none with probability ``MISS``
   at most (36 bands of 7 rows at 0.85, 35 of 5 at 0.80).
3. The classes of a cluster meet with their full sets. Pairs whose signatures agree far less than the threshold asks for (six
   standard deviations) are left out; the others are confirmed by their exact intersection. A cluster beyond ``MEMBERS`` classes is
   taken apart into its buckets where that is less work (``groups``), so a chain of unlike texts is never compared as a whole. A group
   beyond ``MEMBERS`` classes or ``SHINGLES`` shingles is dealt into blocks, and each pair of blocks is a task of its own, so no task
   holds more than two blocks and no pair is lost. A task puts out a spanning forest of its links only.
4. The components of the confirmed links are the result. A class is known by a number of its own, not by a doc_id, which other
   texts may share; the component's name and the row that is kept are its least doc_id and, where that has several texts or
   there is none, the least row key.

Rows: null and empty texts have an empty set and link with nothing; a text of fewer words than a shingle is one shingle; long
texts are read whole; repeated rows are copies; rows with a null doc_id link like others, never name a component, and are kept only
where all rows of the component have none; different texts of one doc_id are judged apart; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log, log1p

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import KEYS, PART, busy, cut, joined_apart, keyed, pick, table
from tessella.llm.components import components
from tessella.llm.words import Memo, batches, hold, number, windows

WIDTH, PERCENT = 5, 85
#: Pairs at the threshold that share no band, at most, and hash functions that bands and rows may take together.
MISS, HASHES, SEED = 1e-6, 256, 5
MEMBERS, SHINGLES = 1_000, 500_000

_numbers = Memo(number)


@lru_cache
def shape(percent: int) -> tuple[int, int]:
    """(bands, rows) for a threshold: the most rows whose bands, enough for ``MISS``, stay within ``HASHES``; one row otherwise."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    if percent == 100:  # equal sets are one class already
        return 1, 1
    found = [(ceil(log(MISS) / log1p(-((percent / 100) ** rows))), rows) for rows in range(1, 65)]
    return max((f for f in found if f[0] * f[1] <= HASHES), key=lambda f: f[1], default=found[0])


@lru_cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of ``n`` hash functions."""
    a = np.random.default_rng(SEED).integers(1, 2**31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return a, np.random.default_rng(SEED + 1).integers(0, 2**32, n).astype(np.uint32)


def shingles(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = [t.encode().lower().split() for t in texts]  # of bytes: A-Z only, and the six ASCII blanks
    n = [len(w) for w in words]
    flat = np.fromiter((_numbers[w] for text in words for w in text), np.uint64, sum(n))
    every = windows(flat, width)
    out, at = [], 0
    for k in n:
        own = every[at : at + k - width + 1] if k >= width else windows(flat[at : at + k], k) if k else every[:0]
        out.append(np.unique(own))
        at += k
    return out


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """The signature of each set, which must not be empty: its least value under each of ``n`` hash functions."""
    a, b = _functions(n)
    out = np.empty((len(sets), n), np.uint32)
    sizes = np.array([len(s) for s in sets])
    for some in np.array_split(np.arange(len(sets)), max(1, int(sizes.sum()) // 50_000)):
        if len(some):
            x = (np.concatenate([sets[i] for i in some]) >> np.uint64(29)).astype(np.uint32)
            first = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            for j in range(n):
                out[some, j] = np.minimum.reduceat(x * a[j] + b[j], first)
    return out


def bands(signatures: np.ndarray, n: int) -> np.ndarray:
    """One number for each of the ``n`` bands of a signature."""
    rows = signatures.reshape(len(signatures), n, -1).astype(np.uint64)
    keys = np.zeros(rows.shape[:2], np.uint64) + np.arange(1, n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows.shape[2]):
            keys = (keys ^ rows[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _texts(docs: DataFrame, *more: str) -> DataFrame:
    return keyed(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), *KEYS, F.coalesce("text", F.lit("")).alias("_text"), *more)


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row_k1, row_k2, n_shingles, h1, h2, bands) of every row; ``bands`` is empty for an empty set."""
    n, rows = shape(percent)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("near_duplicates", _numbers.clear)
        for pdf in parts:
            for some in batches(pdf):
                sets = shingles(some["_text"].tolist())
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [[]] * len(sets)
                for i, k in zip(full, bands(minima([sets[i] for i in full], n * rows), n) if full else [], strict=True):
                    keys[i] = k
                h1, h2 = zip(*map(_set_hash, sets), strict=True)
                yield some[["doc_id", *KEYS]].assign(n_shingles=[len(s) for s in sets], h1=h1, h2=h2, bands=keys)
        _numbers.clear()

    return _texts(docs).mapInPandas(run, f"doc_id bigint, {KEYS[0]} bigint, {KEYS[1]} bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>")


def clusters(classes: DataFrame) -> DataFrame:
    """(class, cluster): the classes that share a band with another, by component of the stars of all buckets."""
    keys = classes.select("class", F.explode("bands").alias("band"))
    counted = keys.groupBy("band").agg(F.min("class").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    hot = counted.where(F.col("rows") * PART > classes.count()).select(F.col("band").alias("busy_key"))
    stars = joined_apart(keys, counted.select("band", "least"), ["band"], hot, F.col("class")).where("class <> least")
    return components(stars.select(F.col("class").alias("u"), F.col("least").alias("v"))).select(F.col("node").alias("class"), F.col("component").alias("cluster"))


def groups(classes: DataFrame, clustered: DataFrame) -> DataFrame:
    """(class, cluster, size, weight): the groups whose classes are compared, one or several for each class of a cluster.

    A cluster of up to ``MEMBERS`` classes is one group. A larger one may be a chain of unlike texts, so it is taken apart again into
    its buckets, of which those with the same classes count once, if their squares sum up to less than that of the whole.
    """
    members = clustered.join(classes.select("class", "n_shingles", "bands"), "class")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    hot = sizes.where(F.col("size") * PART > clustered.count()).select(F.col("cluster").alias("busy_key"))
    members = cut(joined_apart(members, sizes, ["cluster"], hot, F.col("class")), "members")
    large = members.where(F.col("size") > MEMBERS).select("class", "n_shingles", "cluster", "size", F.explode("bands").alias("band"))
    alike = large.groupBy("cluster", "size", "band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("who"))
    alike = alike.where("n > 1").groupBy("cluster", "size", "n", "w", "who").agg(F.min("band").alias("band"))
    apart = alike.groupBy("cluster", "size").agg(F.sum(F.col("n") * F.col("n")).alias("cost")).where("cost < size * size").select("cluster")
    buckets = alike.join(apart, "cluster").select("band", F.col("n").alias("bn"), "w")
    whole = members.join(apart, "cluster", "left_anti").select("class", "cluster", "size", "weight")
    few = busy(large, "band", classes.count())
    some = joined_apart(large.select("band", "class"), buckets, ["band"], few, F.col("class")).select("class", F.xxhash64("band").alias("cluster"), F.col("bn").alias("size"), F.col("w").alias("weight"))
    return whole.unionByName(some)


def _linked(a: list[np.ndarray], b: list[np.ndarray], same: bool, percent: int) -> np.ndarray:
    """Pairs (i of a, j of b) whose exact similarity reaches the threshold; i < j where both are the same list."""
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    hashes = max(64, np.prod(shape(percent)))
    sa, sb = minima(a, hashes).astype(np.uint8), minima(b, hashes).astype(np.uint8)
    agree = np.zeros((len(a), len(b)), np.int16)
    for j in range(sa.shape[1]):
        agree += sa[:, j, None] == sb[None, :, j]
    p, n = percent / 100, sa.shape[1]
    maybe = agree >= p * n - 6 * np.sqrt(n * p * (1 - p))
    if same:
        maybe &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    i, j = np.nonzero(maybe)
    if len(i) <= 4 * (len(a) + len(b)):
        inter = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    else:  # exact counts of common shingles as products of incidence matrices, some thousand columns at a time
        all_, place = np.unique(np.concatenate(a + b), return_inverse=True)
        row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([na, nb]))
        more = np.bincount(place, minlength=len(all_)) > 1
        column = np.cumsum(more) - 1
        keep = more[place]
        row, place = row[keep], column[place[keep]]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        counts = np.zeros((len(a), len(b)), np.float32)
        for low in range(0, int(more.sum()), 2048):
            lo, hi = np.searchsorted(place, [low, low + 2048])
            m = np.zeros((len(a) + len(b), 2048), np.float32)
            m[row[lo:hi], place[lo:hi] - low] = 1
            counts += m[: len(a)] @ m[len(a) :].T
        inter = np.rint(counts[i, j]).astype(np.int64)
    hit = 100 * inter >= percent * (na[i] + nb[j] - inter)
    return np.stack([i[hit], j[hit]], 1)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Of the pairs of 0..n-1, some that connect the same nodes without circles."""
    root = list(range(n))
    out = []
    for x, y in pairs.tolist():
        u, v = x, y
        while root[u] != u:
            root[u] = root[root[u]]
            u = root[u]
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((x, y))
    return out


def confirmed(docs: DataFrame, classes: DataFrame, clustered: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v): links between classes that connect the same classes as all links do, each confirmed on full sets."""
    blocks = F.greatest(F.ceil(F.col("size") / MEMBERS), F.ceil(F.col("weight") / SHINGLES)).cast("int")
    dealt = groups(classes, clustered).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.groupBy("class").agg(F.collect_set(F.struct("cluster", "block", "blocks")).alias("groups"))  # as many as bands at most
    members = dealt.join(classes.select("class", "h1", "h2", *[f"best.{k}" for k in KEYS]), "class")
    texts = _texts(docs).join(members, [*KEYS])

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("near_duplicates", _numbers.clear)
        done: set[int] = set()  # of repeated rows one goes on
        for pdf in parts:
            pdf = pdf[~pdf["class"].isin(done)].drop_duplicates("class")
            done.update(pdf["class"].tolist())
            for some in batches(pdf):
                own = shingles(some["_text"].tolist())
                right = [_set_hash(s) == h for s, h in zip(own, zip(some["h1"], some["h2"], strict=True), strict=True)]
                out = some[["class", "groups"]].assign(shingles=[s.tobytes() for s in own])
                yield out[right]
        _numbers.clear()

    found = texts.mapInPandas(sets, "class bigint, groups array<struct<cluster:bigint,block:int,blocks:int>>, shingles binary")
    found = found.select("class", "shingles", F.explode("groups").alias("of")).select("class", "shingles", "of.*")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = found.withColumn("other", other).select("class", "cluster", "block", "shingles", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("class").sort_values("class")
        one, two = pdf[pdf.block == pdf.x], pdf[pdf.block == pdf.y]
        same = int(pdf.x.iloc[0]) == int(pdf.y.iloc[0])
        load = lambda p: [np.frombuffer(s, np.uint64) for s in p.shingles]
        if len(one) and len(two):
            a, b = load(one), load(two)
            pairs = _linked(a, b, same, percent) + ([0, 0] if same else [0, len(a)])
            ids = one["class"].tolist() + ([] if same else two["class"].tolist())
            out = [(ids[i], ids[j]) for i, j in _forest(pairs, len(ids))]
        else:
            out = []
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return dealt.groupBy("cluster", "x", "y").applyInPandas(link, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, *more: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, *more) of every row: kept is the least row of its component; ``more`` may name ``KEYS``."""
    docs = pick(docs, "doc_id", "text")
    rows = cut(signatures(docs, percent), "signatures")
    n = rows.count()
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *KEYS)
    classes = rows.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min(row).alias("best"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = cut(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    clustered = cut(clusters(classes), "clusters")
    links = cut(confirmed(docs, classes, clustered, percent), "links")
    linked = components(links).select(F.col("node").alias("class"), "component").join(classes.select("class", "h1", "h2", "best"), "class")
    of = lambda c: [F.col(f"{c}.{k}").alias(f"least_{k}") for k in ("doc_id", *KEYS)]
    least = linked.groupBy("component").agg(F.min("best").alias("least")).select("component", *of("least"))
    found = joined_apart(linked.select("h1", "h2", "class", "component"), least, ["component"], busy(linked, "component", n), F.col("class")).drop("class", "component")
    alone = classes.join(found, ["h1", "h2"], "left_anti").select("h1", "h2", *of("best"))
    every = rows.select("doc_id", *KEYS, "n_shingles", "h1", "h2")
    out = joined_apart(every, found.unionByName(alone), ["h1", "h2"], busy(every, "h1", n), F.col(KEYS[0]), "left")
    kept = (F.col("n_shingles") == 0) | ((F.col(f"least_{KEYS[0]}") == F.col(KEYS[0])) & (F.col(f"least_{KEYS[1]}") == F.col(KEYS[1])))
    component = F.when(F.col("n_shingles") > 0, F.col("least_doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), *more)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document; here ``kept`` marks all rows of the doc_id that names the component (none, if no row has one)."""
    return near_duplicates(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
