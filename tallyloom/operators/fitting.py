"""Fitting the purchase and spend models: candidates are data, likelihood sums run as Spark jobs.

Customers with the same (frequency, recency, age) collapse to one weighted row. Each round sends a few
parameter sets to the tasks, gets one likelihood sum per set back, and takes a Newton step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import PENALTIES
from ..functions.special import np_lgamma
from ..session import materialize, spread

FLOOR = 1e-9


def bgnbd_ll(th: np.ndarray, x, t, T) -> np.ndarray:
    """Log-likelihood matrix (candidates x rows) of the purchase model; th columns are r, alpha, a, b."""
    r, al, a, b = (th[:, i:i + 1] for i in range(4))
    # frequencies and days are few: what depends on one of them alone is worked out once for each value
    (few, at), (ends, at_t), (ages, at_T) = (np.unique(c, return_inverse=True) for c in (x, t, T))
    a1 = np_lgamma(r + few) - np_lgamma(r) + r * np.log(al)
    a2 = np_lgamma(a + b) + np_lgamma(b + few) - np_lgamma(b) - np_lgamma(a + b + few)
    a3 = -(r + x) * np.take(np.log(al + ages), at_T, axis=1)
    dropped = np.take(np.log(a) - np.log(b + np.maximum(few, 1) - 1), at, axis=1)
    a4 = np.where(x > 0, dropped - (r + x) * np.take(np.log(al + ends), at_t, axis=1), -np.inf)
    top = np.maximum(a3, a4)
    return np.take(a1 + a2, at, axis=1) + top + np.log(np.exp(a3 - top) + np.exp(a4 - top))


def gamma_gamma_ll(th: np.ndarray, x, m, _unused) -> np.ndarray:
    p, q, v = (th[:, i:i + 1] for i in range(3))
    few, at = np.unique(x, return_inverse=True)
    known = np_lgamma(p * few + q) - np_lgamma(p * few) - np_lgamma(q) + q * np.log(v)
    return np.take(known, at, axis=1) + (p * x - 1) * np.log(m) + p * x * np.log(x) - (p * x + q) * np.log(x * m + v)


def likelihood_sums(table: DataFrame, ll, candidates: np.ndarray) -> np.ndarray:
    """Weighted likelihood sum per candidate; every task returns one partial sum per candidate."""
    def part(batches):
        total = np.zeros(len(candidates))
        for pdf in batches:
            for a in range(0, len(pdf), 4096):
                p = pdf.iloc[a:a + 4096]
                total += ll(candidates, p["c1"].to_numpy(), p["c2"].to_numpy(), p["c3"].to_numpy()) @ p["w"].to_numpy(float)
        yield pd.DataFrame({"i": np.arange(len(candidates)), "s": total})

    rows = table.mapInPandas(part, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # one row per candidate
    out = np.zeros(len(candidates))
    for row in rows:
        out[row["i"]] = row["s"]
    return out


@dataclass
class Fit:
    """A point in log space with what is known about it."""
    at: np.ndarray
    penalty: float
    value: float = float("inf")
    gradient: float = float("inf")  # largest component that a bound does not hold back
    bounds: tuple[int, ...] = ()    # parameters that a bound holds
    rounds: int = 0
    converged: bool = False

    @property
    def params(self) -> np.ndarray:
        return np.exp(self.at)


STEP = 1e-3                                  # of the differences, in log space
LENGTHS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001, 2.0, 4.0)
LOG_BOUNDS = (np.log(FLOOR), np.log(1e9))


def stencil(at: np.ndarray) -> np.ndarray:
    """The point, its neighbours along each axis, and along each diagonal of two axes."""
    k, eye = len(at), np.eye(len(at)) * STEP
    points = [at] + [at + s * eye[i] for i in range(k) for s in (1, -1)]
    points += [at + s * eye[i] + u * eye[j] for i in range(k) for j in range(i) for s in (1, -1) for u in (1, -1)]
    return np.array(points)


def slopes(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature from the values at a stencil."""
    up, down = values[1:2 * k + 1:2], values[2:2 * k + 1:2]
    curve = np.diag((up - 2 * values[0] + down) / STEP ** 2)
    n = 2 * k + 1
    for i in range(k):
        for j in range(i):
            pp, pm, mp, mm = values[n:n + 4]
            curve[i, j] = curve[j, i] = (pp - pm - mp + mm) / (4 * STEP ** 2)
            n += 4
    return (up - down) / (2 * STEP), curve


def minimise(table: DataFrame, ll, start: list[float], penalties=(0.0,), tol: float = 1e-6, max_rounds: int = 40) -> list[Fit]:
    """Minimise -mean(LL) + penalty * sum(param^2) for several penalties at once by Newton steps in the parameters' logarithms.

    A round is two jobs: the sums at a stencil around each point give gradient and curvature, the sums along the step pick its length. Only the sums reach the
    driver. A fit has converged when no component of the gradient that points into the allowed range is larger than ``tol``.
    """
    n = table.agg(F.sum("w")).first()[0]
    fits = [Fit(np.log(np.array(start, float)), p) for p in penalties]

    def objective(live: list[Fit], grids: list[np.ndarray]) -> list[np.ndarray]:
        th = np.exp(np.clip(np.vstack(grids), *LOG_BOUNDS))
        sums, out, a = -likelihood_sums(table, ll, th) / n, [], 0
        for fit, grid in zip(live, grids):
            v = sums[a:a + len(grid)] + fit.penalty * (th[a:a + len(grid)] ** 2).sum(1)
            out.append(np.where(np.isfinite(v), v, np.inf))
            a += len(grid)
        return out

    for _ in range(max_rounds):
        live = [f for f in fits if not f.converged]
        if not live:
            break
        steps = []
        for fit, values in zip(live, objective(live, [stencil(f.at) for f in live])):
            gradient, curve = slopes(values, len(fit.at))
            held = ((fit.at <= LOG_BOUNDS[0] + STEP) & (gradient > 0)) | ((fit.at >= LOG_BOUNDS[1] - STEP) & (gradient < 0))
            fit.value, fit.bounds, fit.rounds = float(values[0]), tuple(np.flatnonzero(held)), fit.rounds + 1
            fit.gradient = float(np.abs(np.where(held, 0, gradient)).max(initial=0))
            fit.converged = fit.gradient <= tol
            # uphill curvature is turned over, and no step is longer than a factor of e squared
            free, step = np.flatnonzero(~held), np.zeros(len(fit.at))
            size, axes = np.linalg.eigh(curve[np.ix_(free, free)])
            step[free] = -axes @ ((axes.T @ gradient[free]) / np.maximum(np.abs(size), 1e-8))
            steps.append(step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12)))
        moving = [(f, s) for f, s in zip(live, steps) if not f.converged]
        if not moving:
            break
        grids = [np.clip(f.at + np.outer([0.0, *LENGTHS], s), *LOG_BOUNDS) for f, s in moving]
        for (fit, _s), grid, values in zip(moving, grids, objective([f for f, _s in moving], grids)):
            fit.at = grid[int(np.argmin(values))]
    return fits


def purchase_table(summary: DataFrame) -> DataFrame:
    """Training rows in weeks, equal histories collapsed to a weight; written once for all rounds."""
    t = summary.groupBy(F.col("frequency").alias("c1"), (F.col("recency") / 7.0).alias("c2"), (F.col("T") / 7.0).alias("c3")).agg(F.count("*").alias("w"))
    return spread(materialize(t, "purchase-histories"), "spread-purchase-histories")


def spend_table(repeat_buyers: DataFrame) -> DataFrame:
    t = repeat_buyers.groupBy(F.col("frequency").alias("c1"), F.col("monetary_value").alias("c2"), F.lit(0.0).alias("c3")).agg(F.count("*").alias("w"))
    return spread(materialize(t, "spend-histories"), "spread-spend-histories")


PURCHASE_NAMES, PURCHASE_START = ("r", "alpha", "a", "b"), [1.0, 10.0, 1.0, 2.0]
SPEND_NAMES = ("p", "q", "v")


def named(fit: Fit, names: tuple[str, ...]) -> dict:
    return dict(zip(names, fit.params.tolist()))


def fit_purchases(summary: DataFrame, penalty: float = 0.0, tol: float = 1e-6) -> tuple[dict, Fit]:
    fit = minimise(purchase_table(summary), bgnbd_ll, PURCHASE_START, [penalty], tol)[0]
    return named(fit, PURCHASE_NAMES), fit


def penalty_sweep(summary: DataFrame, penalties=PENALTIES, tol: float = 1e-6) -> DataFrame:
    """Parameters per penalty; the smallest penalty whose drop-out parameters are both above 0.01 is chosen, else 1.0.

    ``at_bound`` names the parameters that run into a bound of the search; ``converged`` tells whether the gradient vanished for all others.
    """
    rows = []
    for f in minimise(purchase_table(summary), bgnbd_ll, PURCHASE_START, list(penalties), tol):
        r, al, a, b = f.params.tolist()
        rows.append((float(f.penalty), r, al, a, b, a / (a + b), f.value, a > 0.01 and b > 0.01, f.converged, f.rounds, ",".join(PURCHASE_NAMES[i] for i in f.bounds)))
    t = summary.sparkSession.createDataFrame(rows, "coef double, r double, alpha double, a double, b double, dropout_share double, objective double, usable boolean, converged boolean, rounds int, at_bound string")
    best = t.agg(F.coalesce(F.min(F.when(F.col("usable"), F.col("coef"))), F.lit(1.0)).alias("c")).scalar()
    return t.withColumn("chosen", F.col("coef") == best)


def fit_spend(repeat_buyers: DataFrame, tol: float = 1e-6) -> tuple[dict, Fit]:
    mean = repeat_buyers.agg(F.avg("monetary_value")).first()[0]
    fit = minimise(spend_table(repeat_buyers), gamma_gamma_ll, [2.0, 4.0, mean], [0.0], tol)[0]
    return named(fit, SPEND_NAMES), fit


def log_likelihood(summary: DataFrame, p: dict) -> DataFrame:
    """Log-likelihood per customer for fixed parameters, as column expressions."""
    from ..functions.special import lgamma

    x, t, T = F.col("frequency"), F.col("recency") / 7.0, F.col("T") / 7.0
    r, al, a, b = (F.lit(float(p[k])) for k in ("r", "alpha", "a", "b"))
    a1 = lgamma(r + x) - lgamma(r) + r * F.log(al)
    a2 = lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x)
    a3 = -(r + x) * F.log(al + T)
    a4 = F.log(a) - F.log(b + F.greatest(x, F.lit(1.0)) - 1) - (r + x) * F.log(al + t)
    top = F.greatest(a3, a4)
    return summary.select("customer_id", (a1 + a2 + F.when(x > 0, top + F.log(F.exp(a3 - top) + F.exp(a4 - top))).otherwise(a3)).alias("ll"))
