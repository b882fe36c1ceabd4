"""Additive attributions of boosted trees in log-odds, and reasons per row.

A leaf contributes to a coalition of features its value times, per feature on its path, either
"the row satisfies the path" (feature known) or the share of training rows that do (unknown). The Shapley value of that
product game for feature j is

    value * (satisfied_j - share_j) * integral over t in (0, 1) of the product over i != j of (share_i * (1 - t) + satisfied_i * t),

as the weight of a coalition of k among m features is the integral of t^k (1 - t)^(m - k - 1). The integrand has degree
m - 1, so Gauss-Legendre quadrature with m / 2 points gives it exactly, for a path of any length and in m * m / 2 steps.
Leaves with equally many features on their paths are computed together, for a batch of rows at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskweave.models.boosting import Booster
from riskweave.models.trees import Matrix
from riskweave.session import ship_package

CELLS = 1_000_000  # numbers (rows or patterns x leaves x features on a path) handled at once
ROWS = 50_000  # rows that share the work that is done once for a pattern, at least; twice as many at most
CELL_ROWS = 8  # rows to a cell, at least, of leaves that are looked up together
BLOCK = 8_192  # rows looked up at a time


@dataclass
class Leaves:
    """Leaves with the same number of features on their paths; a row satisfies the path on a feature when low < x <= high."""

    features: np.ndarray  # all of (leaves, features on the path)
    low: np.ndarray
    high: np.ndarray
    missing: np.ndarray   # whether a missing value satisfies the path
    share: np.ndarray
    value: np.ndarray     # (leaves,)


def read_leaves(model: Booster) -> tuple[list[Leaves], float]:
    """Leaves of all trees by number of features on the path, and the expected log-odds. Size depends on the model only."""
    n, by_size, base = model.nodes, {}, model.base
    for root in model.start.tolist():
        stack = [(root, {}, 1.0)]
        while stack:
            at, bounds, reached = stack.pop()
            if n["feature"][at] < 0:
                value = float(n["value"][at])
                base += reached * value
                if bounds:
                    by_size.setdefault(len(bounds), []).append((sorted(bounds), [bounds[f] for f in sorted(bounds)], value))
                continue
            f, cut, rows = int(n["feature"][at]), float(n["threshold"][at]), int(n["rows"][at])
            low, high, missing, share = bounds.get(f, (-np.inf, np.inf, True, 1.0))
            to_left = bool(n["missing_left"][at])
            for child, lo, hi, lost in ((int(model.left[at]), low, min(high, cut), to_left), (int(model.right[at]), max(low, cut), high, not to_left)):
                part = int(n["rows"][child]) / rows
                stack.append((child, {**bounds, f: (lo, hi, missing and lost, share * part)}, reached * part))
    out = []
    for leaves in by_size.values():
        column = lambda k: np.array([[b[k] for b in bounds] for _, bounds, _ in leaves])
        out.append(Leaves(np.array([f for f, _, _ in leaves]), column(0), column(1), column(2), column(3), np.array([v for _, _, v in leaves])))
    return out, base


def _contributions(ok: np.ndarray, group: Leaves, chosen: slice) -> np.ndarray:
    """Contributions of features, given which of them satisfy the paths, both as (rows, leaves, features on the path)."""
    share, value = group.share[chosen], group.value[chosen]
    points, weights = np.polynomial.legendre.leggauss(-(-share.shape[1] // 2))
    total = np.zeros(ok.shape)
    for t, w in zip((points + 1) / 2, weights / 2):
        factor = share * (1 - t) + ok * t
        total += w * factor.prod(axis=2, keepdims=True) / factor
    return total * (ok - share) * value[:, None]


class _Codes:
    """Rows by the place of each feature's value between the bounds of all paths, a missing value behind the last place."""

    def __init__(self, x: np.ndarray, leaves: Sequence[Leaves]):
        self.ends, self.of = [], []
        for f in range(x.shape[1]):
            ends = np.unique(np.concatenate([side[g.features == f] for g in leaves for side in (g.low, g.high)] + [[-np.inf, np.inf]]))
            # A value in (ends[i], ends[i + 1]] has place i; nothing else is asked of it.
            self.of.append(np.where(np.isnan(x[:, f]), len(ends) - 1, np.searchsorted(ends, x[:, f], side="left") - 1))
            self.ends.append({end: i for i, end in enumerate(ends.tolist())})

    def satisfying(self, f: int, low: float, high: float, missing: bool) -> tuple[int, int, bool]:
        """The places of the feature that satisfy that part of a path: from, up to, and whether the last one does."""
        return self.ends[f][low], self.ends[f][high], missing


class _Bundle:
    """Leaves whose paths are looked up together: the cells are what combinations of their features' values can satisfy."""

    def __init__(self):
        self.leaves: list[int] = []
        self.marks: dict[int, list[int]] = {}  # by feature: for each place of a value, the leaves it satisfies, as bits
        self.states: dict[int, int] = {}

    def took(self, leaf: int, parts: dict[int, tuple[int, int, bool]], places: Sequence[dict], most: int) -> bool:
        """Adds a leaf unless there would be more than `most` cells."""
        marks, bit, cells = {}, 1 << len(self.leaves), math.prod(n for f, n in self.states.items() if f not in parts)
        for f, (low, high, missing) in parts.items():
            marks[f] = own = self.marks[f].copy() if f in self.marks else [0] * len(places[f])
            for at in range(low, high):
                own[at] |= bit
            # The last place is that of missing values; no range ends behind it.
            if missing:
                own[-1] |= bit
            cells *= len(set(own))
        if self.leaves and cells > most:
            return False
        self.leaves.append(leaf)
        self.marks |= marks
        self.states |= {f: len(set(own)) for f, own in marks.items()}
        return True

    def table(self, names: np.ndarray, tables: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """For each feature its places' steps in the cells, and contributions as (feature, cell), from tables as (leaf, feature on the path, pattern)."""
        shape, steps, found, step = [*self.states.values()], [], {}, math.prod(self.states.values())
        for at, (f, own) in enumerate(self.marks.items()):
            state = {mark: i for i, mark in enumerate(dict.fromkeys(own))}
            step //= len(state)
            steps.append((f, np.array([state[mark] * step for mark in own])))
            found[f] = at, [*state], [-1 if k == at else 1 for k in range(len(shape))]
        out = np.zeros((len(shape), *shape))
        for bit, leaf in enumerate(self.leaves):
            place, path = 0, names[leaf].tolist()
            for k, f in enumerate(path):
                at, own, axis = found[f]
                place = place + np.array([(mark >> bit & 1) << k for mark in own]).reshape(axis)
            for k, f in enumerate(path):
                out[found[f][0]] += tables[leaf, k].take(place)
        return steps, out.reshape(len(shape), -1)


def attribute(x: np.ndarray, leaves: Sequence[Leaves]) -> np.ndarray:
    """Contribution of each feature to each row's log-odds; NaN is a missing value.

    A leaf's contributions depend only on which of its features satisfy the path. Where there are fewer such patterns than
    rows, they are computed once for each pattern and looked up. Neighbouring leaves share most of their paths, so they are
    added up in one table and looked up together.
    """
    out = np.zeros(x.shape[::-1])
    codes = _Codes(x, leaves)
    for group in leaves:
        count, size = group.features.shape
        if 1 << size > len(x):
            step = max(1, CELLS // (len(x) * size)) if len(x) else count
            for lo in range(0, count, step):
                chosen = slice(lo, lo + step)
                value = x[:, group.features[chosen]]
                ok = np.where(np.isnan(value), group.missing[chosen], (value > group.low[chosen]) & (value <= group.high[chosen])).astype(float)
                found = _contributions(ok, group, chosen)
                for i, k in np.ndindex(found.shape[1:]):
                    out[group.features[lo + i, k]] += found[:, i, k]
            continue
        patterns = ((np.arange(1 << size)[:, None] >> np.arange(size)) & 1).astype(float)[:, None, :]
        step = max(1, CELLS // (patterns.size))
        for lo in range(0, count, step):
            names = group.features[lo : lo + step]
            tables = np.ascontiguousarray(_contributions(np.broadcast_to(patterns, (1 << size, len(names), size)), group, slice(lo, lo + step)).transpose(1, 2, 0))
            paths = zip(names.tolist(), group.low[lo : lo + step].tolist(), group.high[lo : lo + step].tolist(), group.missing[lo : lo + step].tolist())
            bundles = [_Bundle()]
            for i, path in enumerate(paths):
                parts = {part[0]: codes.satisfying(*part) for part in zip(*path)}
                if not bundles[-1].took(i, parts, codes.ends, len(x) // CELL_ROWS):
                    bundles.append(_Bundle())
                    bundles[-1].took(i, parts, codes.ends, 0)
            bundles = [bundle.table(names, tables) for bundle in bundles]
            # What a block of rows needs stays in the cache. Places are within the tables; "clip" spares a copy that guards against others.
            for start in range(0, len(x), BLOCK):
                rows = slice(start, start + BLOCK)
                of, to = [c[rows] for c in codes.of], out[:, rows]
                for steps, table in bundles:
                    place = sum(values.take(of[f], mode="clip") for f, values in steps)
                    for (f, _), values in zip(steps, table):
                        to[f] += values.take(place, mode="clip")
    return out.T


def attribution_udf(leaves: list[Leaves]):
    """Vectorised function from a row's feature values to its attributions, both arrays in layout order."""
    @F.pandas_udf("array<double>")
    def run(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = []
        for part in values:
            held += part.tolist()
            # No few rows are left for the end, which would take the same work for a pattern.
            while len(held) >= 2 * ROWS:
                yield pd.Series(list(attribute(np.array(held[:ROWS], dtype=float), leaves)))
                held = held[ROWS:]
        if held:
            yield pd.Series(list(attribute(np.array(held, dtype=float), leaves)))
    return run


def attributions(model: Booster, matrix: Matrix, df: DataFrame, id_col: str = "trans_num") -> DataFrame:
    """(id, base_value, one column per feature): log-odds contributions that add up to the row's margin."""
    ship_package(df.sparkSession)
    leaves, base = read_leaves(model)
    explained = df.select(id_col, attribution_udf(leaves)(matrix.vector()).alias("_a"))
    return explained.select(id_col, F.lit(base).alias("base_value"),
                            *[F.get("_a", F.lit(i)).alias(c) for i, c in enumerate(matrix.columns)])


def global_importance(attributed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per feature, from one aggregate row."""
    one = attributed.agg(*[F.avg(F.abs(c)).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "mean_abs_attribution").orderBy(F.desc("mean_abs_attribution"), "feature")


# The words of the response.
TOWARDS, AWAY = "pushes_towards_fraud", "pushes_towards_legit"


def top_reasons(names: Sequence[str], values: Sequence[Column], parts: Column, top: int) -> Column:
    """The `top` features by absolute attribution, with their value as text and their direction."""
    entry = lambda i: F.struct(
        (-F.abs(F.get(parts, F.lit(i)))).alias("order"), F.lit(i).alias("position"), F.lit(names[i]).alias("feature"),
        values[i].cast("string").alias("value"), F.get(parts, F.lit(i)).alias("attribution"),
        F.when(F.get(parts, F.lit(i)) > 0, TOWARDS).otherwise(AWAY).alias("impact"))
    best = F.slice(F.array_sort(F.array(*[entry(i) for i in range(len(names))])), 1, top)
    return F.transform(best, lambda e: F.struct(*[e[n].alias(n) for n in ("feature", "value", "attribution", "impact")]))


def reasons(model: Booster, matrix: Matrix, df: DataFrame, top: int = 6, id_col: str = "trans_num") -> DataFrame:
    """(id, reasons) per row."""
    ship_package(df.sparkSession)
    leaves, _ = read_leaves(model)
    rows = df.withColumn("_a", attribution_udf(leaves)(matrix.vector()))
    return rows.select(id_col, top_reasons(matrix.columns, [F.col(c) for c in matrix.columns], F.col("_a"), top).alias("reasons"))
