"""Special functions as Spark column expressions and as small array helpers used inside tasks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

# fixed values: the widely published Lanczos coefficients for g = 7, n = 9
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012,
    9.9843695780195716e-6, 1.5056327351493116e-7,
)


def lgamma(x: Column) -> Column:
    """Log-gamma for x > 0; small x goes through lgamma(x+1) - ln(x) to keep precision."""
    z = x.cast("double")
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:]):
        series = series + F.lit(c) / (z + float(i + 1))
    t = z + (LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(series) - F.log(z)


def np_lgamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    s = np.full_like(x, LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:]):
        s = s + c / (x + i + 1)
    t = x + LANCZOS_G + 0.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * np.log(t) - t + np.log(s) - np.log(x)


def np_hyp2f1(a, b, c, z, terms: int = 1_000_000) -> np.ndarray:
    """2F1(a,b;c;z) for |z|<1 by its power series, until no row changes any more; an error if ``terms`` are not enough for that."""
    term = np.ones_like(np.asarray(c * z, dtype=float))
    total = term.copy()
    for k in range(terms):
        term = term * ((a + k) * (b + k) / ((c + k) * (k + 1.0)) * z)
        total = total + term
        if not np.any(np.abs(term) > 1e-17 * np.abs(total)):
            return total
    raise ArithmeticError(f"the series has not settled after {terms} terms: z is too close to 1")


def hyp2f1_series(a: float, b: float, c: Column, z: Column) -> Column:
    """2F1 per row; callers pass the transformed, fast-shrinking form.

    Arrow batches on purpose: the same series as an array expression runs term by term in the
    interpreter of higher-order functions, which is two orders of magnitude slower per row.
    """
    @F.pandas_udf(DoubleType())
    def series(cs: pd.Series, zs: pd.Series) -> pd.Series:
        return pd.Series(np_hyp2f1(a, b, cs.to_numpy(float), zs.to_numpy(float)))

    return series(c, z)


def gamma_quantile(p: float, shape: float, scale: float) -> float:
    """Quantile of a gamma law by bisection on the incomplete gamma series; one number, not per row."""
    def cdf(x: float) -> float:
        term = total = 1.0 / shape
        k = 0
        while abs(term) > 1e-17 * abs(total) and k < 10_000:
            k += 1
            term *= x / (shape + k)
            total += term
        return total * math.exp(-x + shape * math.log(x) - math.lgamma(shape)) if x > 0 else 0.0

    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2 * scale
