"""Singular vectors and principal components of long sparse tables (cell_id, gene, value), and the cells in their space.

The table is never made dense as a whole. Each task adds up the products of its cells' gene vectors, a block of cells at a time; the sums are
gene by gene, so their eigenvectors, which are the right singular vectors of the table, are found on the driver from a matrix of
``GENES`` by ``GENES`` numbers at most, whatever the number of cells. Cells are projected by a join with the loadings, which are as small,
and a sum by cell.

Truncated singular vectors are not centred; principal components are, over all cells of the spine, zeros included. The sign of a component is
such that its largest loading (the first of equal ones) is positive. Components of no variance are left out.

Rows: null cells and genes are left out, null values are zeros; repeated rows of a cell and gene add up; genes that the model doesn't know
count for nothing; cells of the spine without counts are zeros, and without a spine they have no row; an empty table gives a model without components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Genes that a model takes at most, and cells of a block.
GENES, BLOCK = 5_000, 512


@dataclass(frozen=True)
class Model:
    """Right singular vectors (components, genes) of the cells it was fitted on; ``offset`` is what a cell of zeros is projected to, negated."""

    genes: list[str]
    components: np.ndarray
    singular_values: np.ndarray
    offset: np.ndarray
    cells: int


def _usable(values: DataFrame) -> DataFrame:
    return values.where(F.col("cell_id").isNotNull() & F.col("gene").isNotNull() & F.col("value").isNotNull()).select("cell_id", "gene", F.col("value").cast("double").alias("value"))


def gene_names(values: DataFrame) -> list[str]:
    """The distinct genes, sorted; at most ``GENES``, so choose variable ones before."""
    names = [r["gene"] for r in _usable(values).select("gene").distinct().limit(GENES + 1).collect()]
    if len(names) > GENES:
        raise ValueError(f"more than {GENES} genes")
    return sorted(names)


def gram(values: DataFrame, genes: list[str]) -> DataFrame:
    """(i, sums): for each gene, the sums over all cells of its products with every gene, in the order of ``genes``."""
    place = {g: i for i, g in enumerate(genes)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rest = np.zeros((len(genes), len(genes))), None

        def add(pdf: pd.DataFrame) -> None:
            cell = np.cumsum(np.append(False, pdf.cell_id.to_numpy()[1:] != pdf.cell_id.to_numpy()[:-1]))
            gene, value = pdf.gene.map(place).to_numpy(), pdf.value.to_numpy()
            for low in range(0, int(cell[-1]) + 1, BLOCK):
                a, b = np.searchsorted(cell, [low, low + BLOCK])
                m = np.zeros((int(cell[b - 1]) - low + 1, len(genes)))
                np.add.at(m, (cell[a:b] - low, gene[a:b]), value[a:b])
                total[:] += m.T @ m

        for pdf in parts:
            pdf = pdf[pdf.gene.isin(place)]
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            going = pdf.cell_id == pdf.cell_id.iloc[-1]  # the last cell may go on in the next batch
            rest, now = pdf[going], pdf[~going]
            if len(now):
                add(now)
        if rest is not None and len(rest):
            add(rest)
        if total.any():
            yield pd.DataFrame({"i": range(len(genes)), "sums": list(total)})

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf.i[:1], "sums": [np.sum(np.stack(pdf.sums.tolist()), 0)]})

    dealt = _usable(values).repartition("cell_id").sortWithinPartitions("cell_id")
    return dealt.mapInPandas(run, "i int, sums array<double>").groupBy("i").applyInPandas(together, "i int, sums array<double>")


def _eigen(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues that are not zero, largest first, and their vectors as rows with the stated sign."""
    value, vector = np.linalg.eigh(matrix)
    value, vector = value[::-1], vector[:, ::-1].T
    keep = value > max(float(value.max(initial=0.0)), 0.0) * len(matrix) * np.finfo(float).eps * 8
    value, vector = value[keep][:most], vector[keep][:most]
    size = np.round(np.abs(vector), 9)
    largest = vector[np.arange(len(vector)), size.argmax(1)] if len(vector) else np.zeros(0)
    return value, vector * np.sign(largest)[:, None]


def fitted(values: DataFrame, components: int | None = 100, spine: DataFrame | None = None, centred: bool = False) -> Model:
    """A model of the cells in ``values``, or of all of ``spine`` (cell_id) where cells may have no counts; ``centred`` gives principal components.

    There are as many components as asked for, but fewer than cells and than genes; without a number, all that are not zero.
    """
    spine = _usable(values).select("cell_id") if spine is None else spine.where("cell_id IS NOT NULL").select("cell_id")
    values, n = values.join(spine.distinct(), "cell_id", "left_semi"), spine.distinct().count()
    genes = gene_names(values)
    matrix = np.zeros((len(genes), len(genes)))
    for r in gram(values, genes).collect():  # genes by genes
        matrix[r["i"]] = r["sums"]
    mean = np.zeros(len(genes))
    if centred and n:
        sums = {r["gene"]: r["s"] for r in _usable(values).groupBy("gene").agg(F.sum("value").alias("s")).collect()}
        mean = np.array([sums[g] for g in genes]) / n
        matrix = matrix - n * np.outer(mean, mean)
    value, vector = _eigen(matrix, len(genes) if components is None else max(0, min(components, n - 1, len(genes) - 1)))
    return Model(genes, vector, np.sqrt(value), vector @ mean, n)


def explained_variance(model: Model) -> list[float]:
    """The variance along each component of a centred model."""
    return (model.singular_values**2 / max(model.cells - 1, 1)).tolist()


def projected(values: DataFrame, model: Model, whitened: bool = True, spine: DataFrame | None = None) -> DataFrame:
    """(cell_id, scores): each cell's coordinates; ``whitened`` divides them by the singular values, so that they are of one size."""
    k = len(model.singular_values)
    scale = 1 / model.singular_values if whitened else np.ones(k)
    spark = values.sparkSession
    loadings = spark.createDataFrame(list(zip(model.genes, (model.components * scale[:, None]).T.tolist(), strict=True)), "gene string, loading array<double>")
    sums = [F.sum(F.col("value") * F.get("loading", i)).alias(f"s{i}") for i in range(k)]
    offset = F.array(*[F.lit(float(x)) for x in model.offset * scale]).cast("array<double>")
    met = _usable(values).join(F.broadcast(loadings), "gene", "left").groupBy("cell_id")  # GENES rows at most
    found = met.agg(*sums) if sums else met.agg(F.count("*").alias("n")).drop("n")
    if spine is not None:
        found = spine.where("cell_id IS NOT NULL").select("cell_id").distinct().join(found, "cell_id", "left")
    raw = F.array(*[F.coalesce(F.col(f"s{i}"), F.lit(0.0)) for i in range(k)]).cast("array<double>")
    return found.select("cell_id", F.zip_with(raw, offset, lambda a, b: a - b).alias("scores"))
