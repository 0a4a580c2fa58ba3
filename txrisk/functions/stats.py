"""Statistics used on aggregated rows: normal quantile, Student t, sample size."""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quadrature points per unit of the transformed tail, and its ends.
STEPS, LOW, HIGH = 32, -4, 7


def z_values(confidence: float, power: float) -> tuple[float, float]:
    """Two-sided normal quantile of the confidence and one-sided one of the power."""
    normal = NormalDist()
    return normal.inv_cdf(1 - (1 - confidence) / 2), abs(normal.inv_cdf(1 - power))


def required_n(p1: Column, p2: Column, confidence: float = 0.95, power: float = 0.8) -> Column:
    """Rows needed to tell the rates ``p1`` and ``p2`` apart; null if they are equal."""
    z_alpha, z_beta = z_values(confidence, power)
    effect = p1 - p2
    size = F.lit(2 * (z_alpha + z_beta) ** 2) * (p1 * (1 - p1)) / (effect * effect)
    return F.when(effect != 0, F.floor(size).try_cast("bigint") + 1)


def kolmogorov_p(distance: Column) -> Column:
    """P(sup |B| > distance) for a Brownian bridge, from the series that converges fast on either side of 1."""

    terms = F.sequence(F.lit(1), F.lit(12))

    def series(term) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda total, i: total + term(i))

    square = distance * distance
    odd = series(lambda i: F.exp(-F.lit(math.pi**2 / 8) * (2 * i - 1) * (2 * i - 1) / square))
    signs = series(lambda i: F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * i * i * square))
    near = 1 - F.lit(math.sqrt(2 * math.pi)) / distance * odd
    p = F.when(distance <= 0, 1.0).when(distance < 1, near).otherwise(2 * signs)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def _log_half_step(a: float) -> float:
    """log(gamma(a + 1/2) / gamma(a)): a few steps of the recurrence, then the asymptotic series."""
    steps = 0.0
    while a < 20:
        steps += math.log(a / (a + 0.5))
        a += 1
    r = 1 / a
    series = r / 8 - r**3 / 192 + r**5 / 640 - 17 * r**7 / 14336 + 31 * r**9 / 18432
    return steps + 0.5 * math.log(a) - series


def student_t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom.

    With ``t = sqrt(df) * sinh(w)`` the tail is an integral of ``cosh(w) ** -df``,
    summed by double exponential quadrature; the same way for every ``df``.
    """
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    if t == 0:
        return 1.0
    start = math.asinh(abs(t) / math.sqrt(df))
    slope = math.tanh(start)
    width = 1 / (df * slope + math.sqrt(df))
    at_start = 0.5 * math.log1p(t * t / df)  # log(cosh(start))
    total = 0.0
    for i in range(LOW * STEPS, HIGH * STEPS):
        u = i / STEPS
        x = math.exp(u - math.exp(-u))
        w = x * width
        if w > 300:
            growth = start + w - math.log(2) - at_start
        else:  # log(cosh(start + w) / cosh(start)), exact for small w too
            growth = math.log1p(2 * math.sinh(w / 2) ** 2 + slope * math.sinh(w))
        if df * growth < 745:
            total += math.exp(-df * growth) * x * (1 + math.exp(-u))
    scale = 2 * math.exp(_log_half_step(df / 2) - df * at_start) / math.sqrt(math.pi)
    return min(1.0, scale * total * width / STEPS)


def _two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([student_t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


def two_sided_p(t: Column, df: Column) -> Column:
    """``student_t_two_sided`` as a column, for rows that are already aggregated."""
    # Shipped with the query, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    udf = F.pandas_udf(_two_sided_p, T.DoubleType())
    return udf(t.cast("double"), df.cast("double"))
