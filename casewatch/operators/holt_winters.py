"""Additive Holt-Winters (trend and weekly season), one-step fitted values per drug.

A series is one row per calendar day, so a group handed to Python is bounded by the
observed period. Groups of different drugs run in parallel.

Fitting: the weights are those of a fixed grid with the least squared one-step error, start states come
from the first two seasons. Errors are compared to six digits and equal ones by the weights, so the choice does not
depend on the order of additions. All weights are folded together, one day at a time, as array operations.

Refining (optional): for given weights the one-step errors are an affine function of the initial level,
trend and season, so the best initial states are a least-squares solution. Only the three weights are
searched, on the grid that is then narrowed around its best point.
"""

import numpy as np
import pandas as pd

from casewatch import config
from casewatch.session import spread

FITTED_SCHEMA = "drug string, date date, count bigint, fitted double"
FIT_ROUNDS = 6
GRID = (0.01, 0.1, 0.3, 0.6, 0.9), (0.0, 0.05, 0.2), (0.0, 0.05, 0.2, 0.5)
ERROR_DIGITS = 6


def _fold(y, alpha, beta, gamma, level, trend, season):
    """Fitted values and errors of the recursion, for arrays of any common trailing shape."""
    m = len(season)
    season = list(season)
    fitted = np.empty((len(y),) + np.shape(level))
    for t, value in enumerate(y):
        s = season[t % m]
        base = level + trend
        fitted[t] = base + s
        new_level = alpha * (value - s) + (1 - alpha) * base
        trend = beta * (new_level - level) + (1 - beta) * trend
        season[t % m] = gamma * (value - base) + (1 - gamma) * s
        level = new_level
    return fitted


def heuristic_start(y, m=config.SEASON):
    """Level, trend and season from the first two seasons."""
    first, second = np.mean(y[:m]), np.mean(y[m : 2 * m])
    return first, (second - first) / m, [v - first for v in y[:m]]


def fixed_fit(y, alpha, beta, gamma, m=config.SEASON):
    """Fitted values with given weights and the start taken from the first two seasons."""
    y = np.asarray(y, dtype=float)
    level, trend, season = heuristic_start(y, m)
    return _fold(y, alpha, beta, gamma, level, trend, season)


def grid(axes=GRID):
    """Rows of (alpha, beta, gamma) with beta <= alpha and gamma <= 1 - alpha."""
    points = np.array(np.meshgrid(*axes, indexing="ij")).reshape(3, -1).T
    return points[(points[:, 1] <= points[:, 0]) & (points[:, 2] <= 1 - points[:, 0])]


def grid_fit(y, m=config.SEASON, axes=GRID):
    """Weights of the grid with the least squared error, ties to the smaller weights, and their fitted values."""
    y = np.asarray(y, dtype=float)
    weights = grid(axes)
    level, trend, season = heuristic_start(y, m)
    zero = np.zeros(len(weights))
    fitted = _fold(y, *weights.T, zero + level, zero + trend, [zero + s for s in season])
    errors = y[:, None] - fitted
    told = np.round(np.einsum("ng,ng->g", errors, errors), ERROR_DIGITS)
    best = np.lexsort((weights[:, 2], weights[:, 1], weights[:, 0], told))[0]
    return weights[best], fitted[:, best]


def _profile(y, weights, m):
    """Best errors for each (alpha, beta, gamma) row: (squared errors, start states)."""
    n, g, k = len(y), len(weights), m + 1
    a, b, c = (weights[:, i][:, None] for i in range(3))
    # Column 0 folds the data with a zero start; the others fold unit starts without data.
    # The level column is not needed: it is the sum of the season columns.
    level = np.zeros((g, k + 1))
    trend = np.zeros((g, k + 1))
    trend[:, 1] = 1.0
    season = [np.zeros((g, k + 1)) for _ in range(m)]
    for i in range(m):
        season[i][:, 2 + i] = 1.0
    values = np.zeros((n, 1, k + 1))
    values[:, 0, 0] = y
    folded = _fold(values, a, b, c, level, trend, season)
    target = y[:, None] - folded[:, :, 0]
    basis = folded[:, :, 1:].transpose(1, 0, 2)
    gram = basis.transpose(0, 2, 1) @ basis
    right = np.einsum("gnk,ng->gk", basis, target)
    ridge = 1e-10 * np.trace(gram, axis1=1, axis2=2)[:, None, None] * np.eye(k)
    start = np.linalg.solve(gram + ridge, right[..., None])[..., 0]
    errors = target.T - np.einsum("gnk,gk->gn", basis, start)
    return np.einsum("gn,gn->g", errors, errors), start, y[None, :] - errors


def _admissible(points):
    """Weights with 0 <= beta <= alpha <= 1 and 0 <= gamma <= 1 - alpha."""
    a = np.clip(points[:, 0], 1e-4, 1.0)
    b = np.clip(points[:, 1], 0.0, a)
    c = np.clip(points[:, 2], 0.0, 1 - a)
    return np.unique(np.round(np.stack([a, b, c], axis=1), 10), axis=0)


def _box(centre, step):
    offsets = np.array(np.meshgrid(*[(-1.0, 0.0, 1.0)] * 3, indexing="ij")).reshape(3, -1).T
    return _admissible(centre + offsets * step)


def estimated_fit(y, m=config.SEASON, rounds=FIT_ROUNDS):
    """Fitted values minimising the squared one-step error over weights and start states; never worse than grid_fit()."""
    y = np.asarray(y, dtype=float)
    points = _admissible(np.array(np.meshgrid(*GRID, indexing="ij")).reshape(3, -1).T)
    best, best_fit = grid_fit(y, m)
    best_sse = float(((y - best_fit) ** 2).sum())
    if not np.isfinite(best_sse):
        raise ValueError("no finite fit")
    step = np.array([0.15, 0.08, 0.1])
    for turn in range(rounds + 1):
        sse, _, fit = _profile(y, points, m)
        i = int(np.argmin(np.where(np.isfinite(sse), sse, np.inf)))
        if np.isfinite(sse[i]) and sse[i] < best_sse:
            best, best_sse, best_fit = points[i], sse[i], fit[i]
        points = _box(best, step)
        step = step / 2
    return best_fit


def _per_drug(fit, min_length):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", kind="stable")
        y = pdf["count"].to_numpy(dtype=float)
        fitted = None
        if len(y) >= min_length and y.min() < y.max():
            try:
                fitted = fit(y)
            except (np.linalg.LinAlgError, ValueError):
                fitted = None  # the caller falls back to the trailing mean
        return pdf.assign(fitted=np.nan if fitted is None else fitted)[["drug", "date", "count", "fitted"]]

    return run


def holt_winters(series, weights=None, min_length=config.MIN_SERIES_LENGTH, m=config.SEASON, refine=False):
    """Add `fitted` to (drug, date, count); null for a short or constant series.

    weights: (alpha, beta, gamma) for fixed weights, or None to take them from the grid; refine searches
    weights and start states further.
    """
    if weights is not None:
        fit = lambda y: fixed_fit(y, *weights, m)
    elif refine:
        fit = lambda y: estimated_fit(y, m)
    else:
        fit = lambda y: grid_fit(y, m)[1]
    return (
        spread(series.select("drug", "date", "count"), "drug")
        .groupBy("drug")
        .applyInPandas(_per_drug(fit, min_length), FITTED_SCHEMA)
    )
