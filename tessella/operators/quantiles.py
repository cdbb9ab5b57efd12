"""Exact order statistics of whole columns without a sort or a buffer of all values, for any number of columns and places at once.

The columns are written once as a narrow table. Approximate percentiles, one aggregation for all columns, give a bracket around each place;
one pass counts the values between and on the ends of all brackets, which settles the place of each; a bracket of ``FEW`` values or less is then
read out, and a larger one is cut into ``PARTS`` again. So two passes over the narrow table are the rule, and what goes to the driver is
bounded by the places asked for, not by the rows.

Rows: nulls and NaN don't count; infinities are values; ties are values of their own; a column without values has no statistics; an
empty table has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.sources.tables import cut, forget

#: Values of a bracket that are read out, parts of a larger one, and accuracy of the first brackets.
FEW, PARTS, ACCURACY = 1024, 1024, 10_000


def _ranks(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of doubles."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits, bits)


def _between(low: float, high: float) -> list[float]:
    """Up to ``PARTS`` doubles between two others, evenly spaced among all doubles."""
    a, b = (int(v) for v in _ranks(np.array([low, high], float)))
    steps = sorted({a + (b - a) * k // PARTS for k in range(1, PARTS)} - {a, b})
    ranks = np.array(steps, np.int64)
    return np.where(ranks < 0, np.int64(-(2**63)) - ranks, ranks).view(float).tolist()


def _counted(rows: DataFrame, ends: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """How many values of each column lie before, on, and after each of its ends, in turn."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {c: np.zeros(2 * len(e) + 1, np.int64) for c, e in ends.items()}
        for pdf in parts:
            for c, e in ends.items():
                v = pdf[c].to_numpy(float)
                v = v[~np.isnan(v)]
                place = np.searchsorted(e, v, "left")
                total[c] += np.bincount(place + np.searchsorted(e, v, "right"), minlength=len(total[c]))
        for i, t in enumerate(total.values()):
            yield pd.DataFrame({"i": i, "bin": np.flatnonzero(t), "n": t[t > 0]})

    found = rows.select(*ends).mapInPandas(run, "i int, bin bigint, n bigint").groupBy("i", "bin").agg(F.sum("n").alias("n")).collect()
    out = [np.zeros(2 * len(e) + 1, np.int64) for e in ends.values()]
    for r in found:
        out[r["i"]][r["bin"]] = r["n"]
    return dict(zip(ends, out, strict=True))


def _read(rows: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> dict[str, list[np.ndarray]]:
    """The sorted values strictly inside each bracket; all brackets are small."""

    order = {c: np.array(sorted(some)) for c, some in brackets.items()}  # disjoint

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for i, (c, ends) in enumerate(order.items()):
                v = pdf[c].to_numpy(float)
                k = np.searchsorted(ends[:, 0], v, "left") - 1
                inside = (k >= 0) & (v < ends[k, 1])
                yield pd.DataFrame({"i": i, "k": k[inside], "v": v[inside]})

    found = rows.select(*brackets).mapInPandas(run, "i int, k bigint, v double").toPandas()
    at = {c: {tuple(e): k for k, e in enumerate(ends.tolist())} for c, ends in order.items()}
    return {c: [np.sort(found.v[(found.i == i) & (found.k == at[c][b])].to_numpy()) for b in some] for i, (c, some) in enumerate(brackets.items())}


def places_of(rows: DataFrame, wanted: dict[str, list[tuple[float, str]]]) -> dict[str, tuple[int, dict[tuple[float, str], float]]]:
    """Of each column, the number of values and the values at places q * (n - 1), rounded ``down``, ``up`` or to the ``nearest`` place."""
    columns = {f"c{i}": name for i, name in enumerate(wanted)}
    narrow = cut(rows.select(*[F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias(c) for c, name in columns.items()]), "narrow")
    probes = {c: sorted({min(1.0, max(0.0, q + d / ACCURACY)) for q, _ in wanted[name] for d in (-2, 2)}) for c, name in columns.items()}
    guess = narrow.agg(*[x for c in columns for x in (F.count(c).alias(f"{c}_n"), F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"), F.percentile_approx(c, probes[c], ACCURACY).alias(f"{c}_at"))]).first()
    out, places, ends = {}, {}, {}
    for c, name in columns.items():
        n = guess[f"{c}_n"]
        out[name] = n, {}
        if n:
            exact = {"down": floor, "up": ceil, "nearest": lambda x: int(x + 0.5)}
            places[c] = {(q, how): min(n - 1, exact[how](q * (n - 1))) for q, how in wanted[name]}
            ends[c] = np.unique(np.array([guess[f"{c}_low"], *guess[f"{c}_at"], guess[f"{c}_high"]], float))
    while places:
        counts, more, small = _counted(narrow, {c: ends[c] for c in places}), {}, {}
        for c, asked in places.items():
            before = np.cumsum(counts[c]) - counts[c]
            for key, k in asked.items():
                bin_ = int(np.searchsorted(before, k, "right")) - 1
                while not counts[c][bin_]:
                    bin_ -= 1
                if bin_ % 2:
                    out[columns[c]][1][key] = float(ends[c][bin_ // 2])
                else:
                    bracket = float(ends[c][bin_ // 2 - 1]), float(ends[c][bin_ // 2])
                    (small if counts[c][bin_] <= FEW else more).setdefault(c, {}).setdefault(bracket, []).append((key, k - int(before[bin_])))
        if small:
            for c, values in _read(narrow, {c: list(b) for c, b in small.items()}).items():
                for found, asked in zip(values, small[c].values(), strict=True):
                    for key, k in asked:
                        out[columns[c]][1][key] = float(found[k])
        places = {c: {key: places[c][key] for asked in b.values() for key, _ in asked} for c, b in more.items()}
        ends = {c: np.unique(np.concatenate([ends[c], *[np.array(_between(*bracket)) for bracket in b]])) for c, b in more.items()}
    forget(narrow)
    return out


def quantiles_of(rows: DataFrame, shares: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Quantiles of each column by linear interpolation; null for a column without values."""
    found = places_of(rows, {c: [(q, how) for q in qs for how in ("down", "up")] for c, qs in shares.items()})
    out = {}
    for c, qs in shares.items():
        n, at = found[c]
        part = lambda q, n=n: q * (n - 1) - floor(q * (n - 1))
        out[c] = [at[q, "down"] + (at[q, "up"] - at[q, "down"]) * part(q) if n else None for q in qs]
    return out


def quantiles(rows: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    return quantiles_of(rows, {column: shares})[column]


def tight_range(rows: DataFrame, column: str, portion: float) -> tuple[float | None, float | None]:
    """The range of values for a colour scale: the window of ``portion`` of the percentiles with the smallest extent, first of equal ones.

    Its right end is the percentile q at which the window ends, its left end that of max(0, q - portion).
    """
    finite = rows.where(~F.col(column).isin(float("inf"), float("-inf")))
    shares, width = [i / 100 for i in range(100)], int(portion * 100)
    values = quantiles(finite, column, [*shares, *[max(0.0, s - portion) for s in shares[width - 1 :]]])
    if values[0] is None:
        return None, None
    right = min(range(width - 1, 100), key=lambda i: (round(max(values[i - width + 1 : i + 1]) - min(values[i - width + 1 : i + 1]), 12), i))
    return values[100 + right - width + 1], values[right]
