"""Hierarchical mapping of cells onto a taxonomy: markers of every node, a bootstrapped vote at each, and descent into the child that wins.

The reference's means by node are sums over its cells that Spark aggregates; what is left is a model of ``NUMBERS`` numbers at most, one for each
type and gene, however many cells there are, so it may go to every task. At a node with several children the markers are, for each pair of
children, the ``per_pair`` genes whose means differ most. A cell's vote in a round goes to the child whose means correlate best with it over a drawn
``share`` of the node's markers; the child with most votes wins, its probability is its share of the rounds, and the cell goes on from there. Draws
depend on the node and the round only, so all cells of a node see the same and results don't depend on how rows are dealt.

Rows: absent pairs of cell and gene are zeros, null values too, repeated pairs add up; genes that the model lacks count for nothing; ties between
genes and between children go to the first by name; a node with one child has probability 1; a cell that is constant over the markers of a
node gets null from there on, with probability 0; cells without rows have none; leaves without reference cells are not in the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of a model at most, and cells that are mapped together.
NUMBERS, BLOCK = 20_000_000, 1_024


@dataclass
class Node:
    """Children of a node by name, their means over the node's markers, and where these stand among the model's genes."""

    children: list[str]
    means: np.ndarray
    markers: np.ndarray


@dataclass
class Taxonomy:
    levels: list[str]
    genes: list[str]
    nodes: dict[tuple[str, ...], Node] = field(default_factory=dict)


def _markers(means: np.ndarray, per_pair: int) -> np.ndarray:
    """Places of the genes that tell any two of the children apart; genes are in the order of their names."""
    chosen: set[int] = set()
    for a in range(len(means)):
        for b in range(a):
            differ = np.abs(means[a] - means[b])
            best = np.argsort(-np.round(differ, 9), kind="stable")[:per_pair]
            chosen |= set(best[differ[best] > 0].tolist())
    return np.array(sorted(chosen), np.int64)


def fitted(values: DataFrame, members: DataFrame, levels: list[str], per_pair: int = 10) -> Taxonomy:
    """A model of reference values (cell_id, gene, value) and members (cell_id, *levels), the levels from the root to the leaves."""
    known = members.select("cell_id", *[F.col(c).cast("string").alias(c) for c in levels]).dropna().dropDuplicates(["cell_id"])
    sizes = known.groupBy(*levels).agg(F.count("*").alias("n"))
    sums = values.where("gene IS NOT NULL AND value IS NOT NULL").join(known, "cell_id").groupBy(*levels, "gene").agg(F.sum(F.col("value").cast("double")).alias("s"))
    if sums.limit(NUMBERS + 1).count() > NUMBERS:
        raise ValueError(f"more than {NUMBERS} numbers of types and genes")
    size, total = sizes.toPandas(), sums.toPandas()  # one row a type, and one a type and gene
    out = Taxonomy(levels, sorted(total.gene.unique()))
    place = {g: i for i, g in enumerate(out.genes)}
    for depth, level in enumerate(levels):
        above = levels[:depth]
        for path, group in size.groupby(above, sort=True) if above else [((), size)]:
            path = path if isinstance(path, tuple) else (path,)
            children = sorted(group[level].unique())
            inside = total
            for name, value in zip(above, path, strict=True):
                inside = inside[inside[name] == value]
            means = np.zeros((len(children), len(out.genes)))
            at = inside[level].map({c: i for i, c in enumerate(children)}).to_numpy(np.int64), inside.gene.map(place).to_numpy(np.int64)
            np.add.at(means, at, inside.s.to_numpy(float))
            means /= group.groupby(level).n.sum().reindex(children).to_numpy(float)[:, None]
            markers = _markers(means, per_pair)
            out.nodes[path] = Node(children, means[:, markers], markers)
    return out


def _draws(number: int, markers: int, rounds: int, share: float, seed: int) -> Iterator[np.ndarray]:
    """The markers of each round of a node."""
    r = np.random.default_rng([seed, number])
    for _ in range(rounds):
        yield np.sort(r.permutation(markers)[: max(1, round(share * markers))])


def _standard(x: np.ndarray) -> np.ndarray:
    """Rows of mean 0 and length 1; constant ones are NaN."""
    x = x - x.mean(1, keepdims=True)
    length = np.sqrt((x**2).sum(1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(length > 1e-12, x / length, np.nan)


def votes(x: np.ndarray, node: Node, number: int, rounds: int, share: float, seed: int) -> np.ndarray:
    """(cells, children): how many rounds each child wins; x are the cells' values over the node's markers."""
    out = np.zeros((len(x), len(node.children)), np.int64)
    for some in _draws(number, len(node.markers), rounds, share, seed):
        r = np.round(_standard(x[:, some]) @ np.nan_to_num(_standard(node.means[:, some])).T, 9)
        best = np.where(np.isnan(r), -np.inf, r).argmax(1)
        able = ~np.isnan(r).any(1)
        np.add.at(out, (np.flatnonzero(able), best[able]), 1)
    return out


def _mapped(x: np.ndarray, model: Taxonomy, rounds: int, share: float, seed: int) -> list[tuple[list[str | None], list[float]]]:
    """Names and probabilities of each cell at every level; x is (cells, genes of the model)."""
    out: list[tuple[list[str | None], list[float]]] = [([], []) for _ in x]
    number = {path: i for i, path in enumerate(sorted(model.nodes))}
    for _ in model.levels:
        at: dict[tuple, list[int]] = {}
        for i, (names, _p) in enumerate(out):
            at.setdefault(tuple(names), []).append(i)
        for path, cells in at.items():
            node = model.nodes.get(path)
            if node is None:
                won = [(None, 0.0)] * len(cells)
            elif len(node.children) == 1:
                won = [(node.children[0], 1.0)] * len(cells)
            elif not len(node.markers):
                won = [(None, 0.0)] * len(cells)
            else:
                n = votes(x[np.ix_(cells, node.markers)], node, number[path], rounds, share, seed)
                won = [(node.children[int(v.argmax())], float(v.max() / rounds)) if v.any() else (None, 0.0) for v in n]
            for i, (name, p) in zip(cells, won, strict=True):
                out[i][0].append(name)
                out[i][1].append(p)
    return out


def mapped(values: DataFrame, model: Taxonomy, rounds: int = 100, share: float = 0.9, seed: int = 13) -> DataFrame:
    """(cell_id, {level}_name, {level}_probability, ...) of every cell of ``values`` (cell_id, gene, value)."""
    shared = values.sparkSession.sparkContext.broadcast(model)  # ``NUMBERS`` numbers at most
    kind = values.schema["cell_id"].dataType.simpleString()
    columns = [f"{level}_{what}" for level in model.levels for what in ("name", "probability")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, rest = shared.value, None
        place = {g: i for i, g in enumerate(model.genes)}

        def done(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
            ids = pdf.cell_id.to_numpy()
            cell = np.cumsum(np.append(False, ids[1:] != ids[:-1]))
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            gene = pdf.gene.map(place).fillna(-1).to_numpy(np.int64)
            value = np.where(gene < 0, 0.0, pdf.value.fillna(0.0).to_numpy(float))
            for low in range(0, len(first), BLOCK):
                a, b = np.searchsorted(cell, [low, low + BLOCK])
                x = np.zeros((min(BLOCK, len(first) - low), max(1, len(model.genes))))
                np.add.at(x, (cell[a:b] - low, np.maximum(gene[a:b], 0)), value[a:b])
                found = _mapped(x, model, rounds, share, seed)
                rows = [(i, *[v for pair in zip(names, p, strict=True) for v in pair]) for i, (names, p) in zip(ids[first[low : low + BLOCK]].tolist(), found, strict=True)]
                yield pd.DataFrame(rows, columns=["cell_id", *columns])

        for pdf in parts:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            going = pdf.cell_id == pdf.cell_id.iloc[-1]  # the last cell may go on in the next batch
            rest, now = pdf[going], pdf[~going]
            if len(now):
                yield from done(now)
        if rest is not None and len(rest):
            yield from done(rest)

    dealt = values.where("cell_id IS NOT NULL").select("cell_id", "gene", F.col("value").cast("double").alias("value")).repartition("cell_id").sortWithinPartitions("cell_id")
    schema = ", ".join([f"cell_id {kind}", *[f"{c} {'string' if c.endswith('_name') else 'double'}" for c in columns]])
    return dealt.mapInPandas(run, schema)
