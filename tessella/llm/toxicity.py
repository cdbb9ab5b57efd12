"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on posterior labels.

Features of a text are its words and their first 3 to 6 letters, each by how dense it is, and words also by presence. Voters of
either sign: lexicon entries and beginnings that are denser in toxic labelled texts vote for 1, those denser in clean ones for 0,
pattern voters (``PATTERNS``) look at capitals, exclamations, masked and stretched words and polite forms. Each abstains elsewhere.

The label model is P(class) times a tree of the voters, P(vote | vote of its parent in the tree, class): accuracies and
correlations are its parameters. The tree joins the voters that tell most about each other within the classes, so voters that say
the same count once. It is fitted by expectation maximisation over labelled and unlabelled rows; a label is no vote and fixes
nothing: it is a prior of its row that tells the class with probability ``TRUST``, and starts the first round. The posterior of each
row, not its label, trains a logistic classifier on the features, whose weights score every text.

The sample has ``SAMPLE`` labelled and ``UNLABELLED`` other rows at most, by a hash of their ids, only such whose crc32(doc_id)
mod 3 is not 1; labels, lang, source and doc_id are not inputs of a score. Rows: labels other than 0 and 1 count as none; a null
doc_id is not held out; a null or empty text gets the score of a text without features; rows that repeat are scored alike; with no
labels of both classes every score is the share of label 1 (0 without labels); an empty table gives no rows; whole texts are
read, however long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import cut, pick, table
from tessella.llm.words import Memo, batches

SAMPLE, UNLABELLED, FEATURES, CLEAN_FEATURES, VOTERS, THRESHOLD, SEED = 12_000, 12_000, 400, 40, 120, 0.7, 29
#: How often a label tells the class (else it says nothing), the rounds of the label model, those in which its tree is drawn, and rows that a smoothed share counts as.
TRUST, ROUNDS, DRAWN, SMOOTH = 0.9, 8, (0, 3), 5.0
#: Features whose sums a task keeps before it hands them on.
PARTIAL = 300_000
WORD = re.compile(r"[^\W\d_]+")
#: Occurrences a word that count as half of full density, and those that a text of any length starts with.
HALF, FLOOR = 0.003, 1.0


def names_of(word: str) -> list[str]:
    """A word's features: itself by presence, itself and its beginnings by density."""
    return [f"w:{word}", f"d:{word}", *[f"{n}:{word[:n]}" for n in range(3, 7) if len(word) >= n]]


def _value(name: str, count: float, n: int) -> float:
    return 1.0 if name[0] == "w" else count / (count + FLOOR + HALF * n)


MASKED, STRETCHED, POLITE = re.compile(r"[^\W\d_][*@#$]+[^\W\d_]"), re.compile(r"([^\W\d_])\1{3}"), re.compile(r"\b(?:please|thanks?|sorry|welcome)\b", re.I)


def _styles(text: str, n: int) -> list[float]:
    """Share of capitals, exclamations a word, and whether there are masked words, stretched words, polite forms."""
    loud = [sum(map(str.isupper, text)) / max(1, len(text)), min(1.0, text.count("!") / max(1, n))]
    return [*loud, *(float(p.search(text) is not None) for p in (MASKED, STRETCHED, POLITE))]


#: Votes of the pattern voters, of the rows' styles: where each says 1, and where it says 0.
PATTERNS = [
    (lambda s: s[:, 0] > 0.5, None),
    (lambda s: s[:, 1] > 0.3, None),
    (lambda s: s[:, 2] > 0, None),
    (lambda s: s[:, 3] > 0, None),
    (None, lambda s: s[:, 4] > 0),
    (None, lambda s: (s[:, 0] < 0.1) & (s[:, 1] == 0)),
]


def counted(text: str) -> tuple[dict[str, int], int]:
    words = WORD.findall(text.lower())
    found: Counter = Counter()
    for w, c in Counter(words).items():
        for f in names_of(w):
            found[f] += c
    return found, len(words)


@dataclass
class Classifier:
    """Weights of features and the intercept."""

    weights: dict[str, float]
    intercept: float

    def scorer(self) -> Memo:
        """For a word, its features that have a weight; most words have none."""
        return Memo(lambda w: tuple(f for f in names_of(w) if f in self.weights) or None)

    def score(self, text: str, known: Memo) -> float:
        words = WORD.findall(text.lower())
        hits = Counter(filter(None, map(known.__getitem__, words)))
        found: Counter = Counter()
        for features, c in hits.items():
            for f in features:
                found[f] += c
        z = self.intercept + sum(self.weights[f] * _value(f, c, len(words)) for f, c in found.items())
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))


def tree_of(votes: np.ndarray, p: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """(voter, parent) from the root on (its parent is -1): the tree of most mutual information of the voters given the class."""
    m, eye = votes.shape[1], np.eye(3, dtype=np.float32)
    seen = eye[votes + 1].reshape(len(votes), 3 * m)
    told = np.zeros((m, m))
    for weight in (p * rows, (1 - p) * rows):
        n = weight.sum() + SMOOTH
        pairs = (seen * weight[:, None].astype(np.float32)).T @ seen / n
        alone = pairs.diagonal()
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(pairs > 0, pairs * np.log(pairs / np.outer(alone, alone)), 0)
        told += n * gain.reshape(m, 3, m, 3).sum((1, 3))
    np.fill_diagonal(told, -np.inf)
    order, best, parent = [(0, -1)], told[0].copy(), np.zeros(m, np.int64)
    best[0] = -np.inf
    for _ in range(m - 1):
        j = int(best.argmax())
        order.append((j, int(parent[j])))
        closer = (told[j] > best) & (best > -np.inf)
        parent[closer], best[closer] = j, told[j][closer]
        best[j] = -np.inf
    return order


def tables_of(votes: np.ndarray, p: np.ndarray, rows: np.ndarray, tree: list[tuple[int, int]]) -> np.ndarray:
    """log P(vote | parent's vote, class) as [class, voter, parent's vote + 1, vote + 1]; shares are smoothed towards the voter's own."""
    out = np.zeros((2, votes.shape[1], 3, 3))
    for y, weight in enumerate(((1 - p) * rows, p * rows)):
        for j, up in tree:
            own = (np.bincount(votes[:, j] + 1, weight, 3) + 0.5) / (weight.sum() + 1.5)
            pairs = np.bincount(3 * (votes[:, up] + 1) + votes[:, j] + 1, weight, 9).reshape(3, 3) if up >= 0 else np.zeros((3, 3))
            out[y, j] = np.log((pairs + SMOOTH * own) / (pairs.sum(1, keepdims=True) + SMOOTH)) if up >= 0 else np.log(own)
    return out


def log_odds(votes: np.ndarray, tree: list[tuple[int, int]], tables: np.ndarray) -> np.ndarray:
    """What the votes of each row say for class 1 against class 0; a voter that abstains says nothing."""
    lead = tables[1] - tables[0]
    lead[..., 1] = 0
    return sum((lead[j][votes[:, up] + 1 if up >= 0 else 1, votes[:, j] + 1] for j, up in tree), np.zeros(len(votes)))


def posterior(votes: np.ndarray, labels: np.ndarray, apart: int = 0, rounds: int = ROUNDS) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """P(label 1) of each row, the tree and its tables, of votes (rows x voters; 1, -1 or 0 for none) and labels (1, 0, -1 for none).

    The last ``apart`` voters follow from the others' votes; they depend on the class alone, outside of the tree.
    """
    inside = votes.shape[1] - apart
    votes = votes.astype(np.int64)
    share = float(np.clip(labels[labels >= 0].mean(), 0.01, 0.99))
    prior = np.where(labels < 0, share, TRUST * (labels == 1) + (1 - TRUST) * share)
    prior = np.log(prior / (1 - prior))
    p, tree, tables = 1 / (1 + np.exp(-prior)), [], np.zeros(0)
    for t in range(rounds):
        rows = (labels >= 0).astype(float) if t == 0 else np.ones(len(labels))
        if t in DRAWN:
            tree = tree_of(votes[:, :inside], p, rows) + [(j, -1) for j in range(inside, votes.shape[1])]
        tables = tables_of(votes, p, rows, tree)
        p = 1 / (1 + np.exp(-np.clip(prior + log_odds(votes, tree, tables), -30, 30)))
    return p, tree, tables


def _train(chosen: list[tuple[str, float]], i: np.ndarray, j: np.ndarray, x: np.ndarray, styles: np.ndarray, labels: np.ndarray) -> Classifier:
    """From the chosen features with how well they tell, the places and values of the rows' features, and the rows' styles and labels (-1: none)."""
    known = labels[labels >= 0]
    share = float(known.mean()) if len(known) else 0.0
    if not 0 < share < 1:
        return Classifier({}, float(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -30, 30)))
    # lexicon voters: entries vote for their class at presence or high density, if they are right on most labelled rows, and abstain otherwise
    votes_at = x >= 0.4
    of_class = [np.bincount(j[votes_at & (labels[i] == y)], minlength=len(chosen)) for y in (0, 1)]
    right = [of_class[int(tell > 0)][k] > of_class[int(tell <= 0)][k] for k, (_, tell) in enumerate(chosen)]
    lexicon = [k for k, (_, tell) in enumerate(chosen) if abs(tell) > 3 and right[k]]
    lexicon = sorted(lexicon, key=lambda k: -abs(chosen[k][1]))[: VOTERS - len(PATTERNS) - 1]
    votes = np.zeros((len(labels), len(lexicon) + len(PATTERNS) + 1), np.int8)
    of, sign = np.full(len(chosen), -1), np.sign([tell for _, tell in chosen]).astype(np.int8)
    of[lexicon] = np.arange(len(lexicon))
    voter = of[j]
    has = voter >= 0
    votes[i[has], voter[has]] = np.where(votes_at[has], sign[j[has]], 0)
    for k, (yes, no) in enumerate(PATTERNS, len(lexicon)):
        votes[:, k] = (yes(styles) if yes else 0 * styles[:, 0]) * 1 - (no(styles) if no else 0 * styles[:, 0]) * 1
    votes[:, -1] = np.where((votes[:, : len(lexicon)] == 1).any(1), 0, -1)
    p = posterior(votes, labels, apart=1)[0]

    # the classifier reads what is denser in toxic texts; features that are denser in clean ones only vote
    reads = sign[j] > 0
    i, j, x = i[reads], j[reads], x[reads]
    df = np.maximum(1, np.bincount(j, minlength=len(chosen)))  # features of few rows decay faster
    w, b = np.zeros(len(chosen)), float(np.log(share / (1 - share)))
    m1, m2, c1, c2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, 401):  # full-batch Adam with weight decay
        z = np.bincount(i, x * w[j], len(labels)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - p
        g, gb = np.bincount(j, x * error[i], len(chosen)) + (0.0005 + 4.0 / df) * w, error.sum()
        m1, m2, c1, c2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g, 0.9 * c1 + 0.1 * gb, 0.99 * c2 + 0.01 * gb * gb
        rate = 0.1 * (1 - t / 420)
        w -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        b -= rate * (c1 / (1 - 0.9**t)) / (np.sqrt(c2 / (1 - 0.99**t)) + 1e-8)
    return Classifier({f: float(v) for f, v in zip([f for f, _ in chosen], w, strict=True) if abs(v) > 0.02}, b)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def telling(sample: DataFrame) -> list[tuple[str, float]]:
    """Features whose means differ most between labels, in units of the difference's error: ``FEATURES`` that are higher in toxic
    texts and ``CLEAN_FEATURES`` that are clearly higher in clean ones; summed up in tasks."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[float]] = {}
        for pdf in parts:
            for text, y in zip(pdf["_text"], pdf["toxic"], strict=True):
                found, n = counted(text)
                for f, c in found.items():
                    s = sums.get(f)
                    if s is None:
                        s = sums[f] = [0.0, 0.0, 0]
                    s[y] += _value(f, c, n)
                    s[2] += 1
            if len(sums) > PARTIAL:
                yield _partial(sums)
                sums = {}
        yield _partial(sums)

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return []
    sums = sample.mapInPandas(run, "name string, a0 double, a1 double, k bigint").groupBy("name").agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1"), F.sum("k").alias("k"))
    tell = (F.col("a1") / n1 - F.col("a0") / n0) / F.sqrt((F.col("a1") + 1) / n1**2 + (F.col("a0") + 1) / n0**2)
    every = sums.where("k >= 6").select("name", F.round(tell, 9).alias("tell"))
    toxic = every.where("tell > 0").orderBy(F.desc("tell"), "name").limit(FEATURES)
    clean = every.where("tell < -3").orderBy("tell", "name").limit(CLEAN_FEATURES)
    return [(r["name"], r["tell"]) for r in cut(toxic.unionByName(clean), "telling").orderBy(F.desc("tell"), "name").collect()]


def _partial(sums: dict[str, list[float]]) -> pd.DataFrame:
    return pd.DataFrame({"name": list(sums), **{c: [s[i] for s in sums.values()] for i, c in enumerate(("a0", "a1", "k"))}}).astype({"name": "object", "a0": "float64", "a1": "float64", "k": "int64"})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> Classifier:
    """Train on ``sample`` labelled and ``unlabelled`` other rows at most. The driver takes the values of their chosen features, no texts."""
    by = F.xxhash64("doc_id", F.lit(SEED))
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    others = pick(docs, "doc_id").where("doc_id IS NOT NULL").where(~held_out()).distinct().join(known, "doc_id", "left_anti")
    ids = known.orderBy(by, "doc_id").limit(sample).unionByName(others.orderBy(by, "doc_id").limit(unlabelled).withColumn("toxic", F.lit(-1)))
    texts = cut(pick(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("_text"), "toxic"), "sample")
    chosen = telling(texts.where("toxic >= 0"))
    if not chosen:
        texts = texts.where("toxic >= 0")
    at = {f: i for i, (f, _) in enumerate(chosen)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for text, y in zip(pdf["_text"], pdf["toxic"], strict=True):
                found, n = counted(text)
                mine = sorted(at[f] for f in found.keys() & at.keys())
                out.append((mine, [_value(chosen[k][0], found[chosen[k][0]], n) for k in mine], _styles(text, n), int(y)))
            yield pd.DataFrame(out, columns=["places", "values", "styles", "toxic"])

    rows = texts.mapInPandas(run, "places array<int>, values array<double>, styles array<double>, toxic int").toPandas()
    sizes = np.array([len(p) for p in rows.places], np.int64)
    joined = lambda c, kind: np.concatenate([np.zeros(0, kind), *map(np.asarray, rows[c])]).astype(kind)
    styles = np.array([list(s) for s in rows.styles]).reshape(len(rows), 5)
    return _train(chosen, np.repeat(np.arange(len(rows)), sizes), joined("places", np.int64), joined("values", float), styles, rows.toxic.to_numpy(np.int64))


def score(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value.scorer()
        for pdf in parts:
            for some in batches(pdf):
                yield pd.DataFrame({"doc_id": some["doc_id"], "held_out": some["held_out"], "score": [round(shared.value.score(t, known), 9) for t in some["_text"]]})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("_text"))
    scored = rows.mapInPandas(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
