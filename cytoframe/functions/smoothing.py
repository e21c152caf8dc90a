"""Locally weighted regression of a profile, per group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def lowess(x: np.ndarray, y: np.ndarray, frac: float, robust: int = 3) -> np.ndarray:
    """Cleveland's (1979) local linear fit with tricube weights and bisquare robustness steps, at every sorted x."""
    n = len(x)
    k = min(max(int(frac * n + 1e-10), 2), n)
    fit, weight = y.astype(float).copy(), np.ones(n)
    # the k nearest points are a run of x; points that are no nearer than its end have no weight
    first = np.zeros(n, int)
    for i in range(n):
        lo = first[i - 1] if i else 0
        while lo + k < n and x[i] - x[lo] > x[lo + k] - x[i]:
            lo += 1
        first[i] = lo
    reach = np.maximum(x - x[first], x[first + k - 1] - x)
    low, high = np.searchsorted(x, x - reach, "left"), np.searchsorted(x, x + reach, "right")
    for step in range(robust + 1):
        for i in range(n):
            own = slice(low[i], high[i])
            xs, ys, h = x[own], y[own], reach[i]
            d = np.abs(xs - x[i])
            w = weight[own] * (np.clip(1 - (d / h) ** 3, 0, None) ** 3 if h > 0 else (d == 0))
            s = w.sum()
            if s <= 0:
                continue
            mx, my = (w * xs).sum() / s, (w * ys).sum() / s
            var = (w * (xs - mx) ** 2).sum()
            fit[i] = my + ((w * (xs - mx) * (ys - my)).sum() / var * (x[i] - mx) if var > 1e-12 else 0)
        if step == robust:
            break
        r = np.abs(y - fit)
        m = np.median(r)
        if m <= 0:
            break
        weight = np.clip(1 - (r / (6 * m)) ** 2, 0, None) ** 2
    return fit


def smooth(profile: DataFrame, group: str, x: str, y: str, frac: float = 0.02) -> DataFrame:
    """(group, x, y, smoothed); rows without y are dropped, frac <= 0 returns the values as they are."""
    kinds = dict(profile.dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(x)
        values = rows[y].to_numpy(float)
        return rows.assign(smoothed=lowess(rows[x].to_numpy(float), values, frac) if frac > 0 else values)

    known = profile.select(group, x, y).where(f"{y} IS NOT NULL")
    return known.groupBy(group).applyInPandas(run, f"`{group}` {kinds[group]}, `{x}` {kinds[x]}, `{y}` {kinds[y]}, smoothed double")
