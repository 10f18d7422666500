"""Sparse rule ensembles: tree paths as rules, weighted by lasso logistic regression."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: One condition: (feature, at_most, cut); at_most true means value <= cut, else value > cut.
Condition = tuple[int, bool, float]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class RuleEnsemble:
    names: list[str]
    intercept: float = 0.0
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * holds(rule, x)
        return _sigmoid(total)

    def compiled(self, stats: Column) -> Column:
        """The score as one column expression over a struct with the fields ``names``."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            fits = F.lit(True)
            for feature, at_most, cut in rule:
                value = stats[self.names[feature]]
                fits = fits & (value <= cut if at_most else value > cut)
            total = total + F.when(fits, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, at_most, cut in rule:
        out &= (x[:, feature] <= cut) if at_most else (x[:, feature] > cut)
    return out


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[float, int, float] | None:
    best = None
    for j, points in enumerate(cuts):
        if not len(points):
            continue
        slot = np.searchsorted(points, x[:, j], side="left")  # value <= points[k] iff slot <= k
        size = len(points) + 1
        gs, hs, ns = (np.cumsum(np.bincount(slot, w, size))[:-1] for w in (g, h, np.ones(len(g))))
        ok = (ns >= least) & (len(g) - ns >= least)
        gain = np.where(ok, gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1), -np.inf)
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), j, float(points[k]))
    return best


def _grow(x, g, h, cuts, depth, least, path, rows, paths, out) -> None:
    """Grow one node; every node but the root adds its path as a rule."""
    if path:
        paths.append(path)
    split = _best_split(x[rows], g[rows], h[rows], cuts, least) if depth and len(rows) >= 2 * least else None
    if split is None:
        out[rows] = -g[rows].sum() / (h[rows].sum() + 1)
        return
    _, j, cut = split
    low = x[rows, j] <= cut
    # Halfway to the next value, so that values just beyond those seen stay on their side.
    cut = float((cut + x[rows, j][~low].min()) / 2)
    _grow(x, g, h, cuts, depth - 1, least, (*path, (j, True, cut)), rows[low], paths, out)
    _grow(x, g, h, cuts, depth - 1, least, (*path, (j, False, cut)), rows[~low], paths, out)


def tree_paths(x: np.ndarray, y: np.ndarray, *, trees: int = 24, depth: int = 3, rate: float = 0.3, bins: int = 48) -> list[tuple[Condition, ...]]:
    """Paths of gradient-boosted trees, without repeats, in the order found."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    # Rare junk lies beyond the usual quantiles, so its own values also offer cuts.
    for j in range(x.shape[1]):
        cuts[j] = np.unique(np.concatenate([cuts[j], np.quantile(x[y == y.min(), j], np.linspace(0, 1, 17)[:-1], method="lower")]))
        cuts[j] = cuts[j][cuts[j] < x[:, j].max()]
    f, paths = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), []
    for _ in range(trees):
        p = _sigmoid(f)
        out = np.zeros(len(y))
        _grow(x, p - y, p * (1 - p), cuts, depth, max(3, len(y) // 500), (), np.arange(len(y)), paths, out)
        f += rate * out
    return list(dict.fromkeys(paths))


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, *, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient; the intercept is not penalised."""
    design = np.hstack([np.ones((len(z), 1)), z])
    lipschitz = 0.25 * np.linalg.norm(design, 2) ** 2 / len(y) + 1e-9
    w = v = np.zeros(design.shape[1])
    t = 1.0
    for _ in range(steps):
        step = v - design.T @ (_sigmoid(design @ v) - y) / len(y) / lipschitz
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / lipschitz, 0)
        new[0] = step[0]
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    return float(w[0]), w[1:]


def fit(names: list[str], x: np.ndarray, y: np.ndarray, *, penalties: tuple[float, ...] = (0.01, 0.003, 0.001, 0.0003)) -> RuleEnsemble:
    """Fit on ``x`` (rows by features) and 0/1 labels; the penalty is picked on every fifth row.

    With fewer than ten rows of either class, or statistics that no cut tells apart,
    there is nothing to split on, and the model is the smoothed share of ones.
    """
    ones = int(y.sum())
    flat = RuleEnsemble(names, float(np.log((ones + 1) / (len(y) - ones + 1))))
    if min(ones, len(y) - ones) < 10:
        return flat
    held = np.arange(len(y)) % 5 == 4
    rules = tree_paths(x[~held], y[~held])
    if not rules:
        return flat
    z = np.stack([holds(r, x) for r in rules], 1).astype(float)
    # Rules that hold on the same rows are one column.
    _, first = np.unique(z, axis=1, return_index=True)
    first = np.sort(first)
    rules, z = [rules[i] for i in first], z[:, first]
    losses = []
    for penalty in penalties:
        b, w = lasso_logistic(z[~held], y[~held], penalty)
        p = np.clip(_sigmoid(b + z[held] @ w), 1e-6, 1 - 1e-6)
        losses.append(-np.mean(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)))
    b, w = lasso_logistic(z, y, penalties[int(np.argmin(losses))])
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleEnsemble(names, b, [rules[i] for i in used], [float(w[i]) for i in used])
