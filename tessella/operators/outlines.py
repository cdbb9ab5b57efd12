"""Polygons of masks and masks of polygons.

A mask is a table of cells (row, col) with a label; cell (r, c) covers the square from (c, r) to (c + 1, r + 1), in units of ``size`` from an origin.
Its outline is made of the cell sides that have the label on one side only; they are found by joins. What is gathered is the
outline of one label, never its cells, as that outline is one value in the end. A label's rings that only touch at a corner stay apart, holes are rings of
their own, and filling the outline gives the cells back.

Filling is by lines: a cell belongs to a polygon if its centre is inside (even-odd over all rings); each line is cut at its crossings, so a
polygon gives runs of cells, which are spread by Spark. Rows: null cells or labels count for nothing; repeated cells count once; null and empty
polygons have no cells; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.functions import overlay as O

#: Neighbour of a side (row, col), and the side from one corner to another with the cell on its left, as (x, y) from the cell's own corner.
SIDES = [((-1, 0), (0, 0), (1, 0)), ((0, 1), (1, 0), (1, 1)), ((1, 0), (1, 1), (0, 1)), ((0, -1), (0, 1), (0, 0))]


def borders(mask: DataFrame) -> DataFrame:
    """(label, x1, y1, x2, y2) of the cell sides between a label and what is not it; the label lies on the left."""
    cells = mask.select("label", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col")).dropna().distinct()
    side = F.explode(F.array(*[F.struct((F.col("row") + r).alias("row"), (F.col("col") + c).alias("col"), *[(F.col(axis) + v).alias(name) for (x, y), k in ((a, 1), (b, 2)) for axis, v, name in (("col", x, f"x{k}"), ("row", y, f"y{k}"))]) for (r, c), a, b in SIDES]))
    return cells.select("label", side.alias("s")).select("label", "s.*").join(cells, ["label", "row", "col"], "left_anti").select("label", "x1", "y1", "x2", "y2")


def mask_polygons(mask: DataFrame, size: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """(label, polygon): the outline of each label of the mask (row, col, label), outer rings counter-clockwise and holes clockwise."""
    label = mask.schema["label"].dataType.simpleString()

    def trace(pdf: pd.DataFrame) -> pd.DataFrame:
        ends = pdf[["x1", "y1", "x2", "y2"]].to_numpy(np.int64)
        places, of = np.unique(ends.reshape(-1, 2), axis=0, return_inverse=True)
        of = of.reshape(-1, 2)
        parts = O._parts(O._rings(of[:, 0], of[:, 1], places.astype(float)), np.zeros(2), 1e-9)
        rings = [[{"x": x0 + size * x, "y": y0 + size * y} for x, y in ring.tolist()] for part in parts for ring in part]
        return pd.DataFrame({"label": pdf.label[:1], "polygon": [rings]})

    return borders(mask).groupBy("label").applyInPandas(trace, f"label {label}, polygon {G.POLYGON}")


def _runs(s: np.ndarray, size: float, x0: float, y0: float) -> np.ndarray:
    """(row, first col, last col) of the runs of cells whose centres are inside a polygon of sides ``s``."""
    s = (s - np.array([x0, y0, x0, y0])) / size - 0.5  # centres at whole numbers
    s = s[s[:, 1] != s[:, 3]]
    if not len(s):
        return np.zeros((0, 3), np.int64)
    low, high = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    first, last = np.ceil(low).astype(np.int64), np.ceil(high).astype(np.int64)  # lines from low on and before high
    n = last - first
    side = np.repeat(np.arange(len(s)), n)
    row = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    x = s[side, 0] + (row - s[side, 1]) * (s[side, 2] - s[side, 0]) / (s[side, 3] - s[side, 1])
    order = np.lexsort((x, row))
    row, x = row[order][::2], x[order].reshape(-1, 2)  # crossings come in pairs on every line
    runs = np.stack([row, np.ceil(x[:, 0]).astype(np.int64), np.ceil(x[:, 1]).astype(np.int64) - 1], 1)
    return runs[runs[:, 1] <= runs[:, 2]]


def filled(polygons: DataFrame, size: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """The columns of ``polygons`` but for ``polygon``, with row and col of every cell whose centre is inside; a centre on a lower or left side counts."""
    kind = pa.list_(pa.struct([("row", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))

    @F.arrow_udf("array<struct<row:bigint,first:bigint,last:bigint>>")
    def run(one: pa.Array) -> pa.Array:
        p = O.sides(one)
        found = [_runs(p.of(i), size, x0, y0) for i in range(len(one))]
        rows = np.concatenate([*found, np.zeros((0, 3), np.int64)])
        runs = pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(rows.T)], ["row", "first", "last"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)), runs).cast(kind)

    others = [c for c in polygons.columns if c != "polygon"]
    spread = polygons.select(*others, F.explode(run(F.col("polygon"))).alias("run"))
    return spread.select(*others, F.col("run.row").alias("row"), F.explode(F.sequence(F.col("run.first"), F.col("run.last"))).alias("col"))
