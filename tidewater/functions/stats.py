"""Distribution tails for p-values (FN-18).

p-values are computed on a handful of already aggregated rows (one per
feature or variant), never per input row.  The Kolmogorov series is a SQL
expression; the normal, Student t and chi-square tails are small pandas
UDFs (Arrow batches) because Spark SQL has no erf / incomplete beta /
incomplete gamma.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Below it the Kolmogorov tail is summed as 1 - theta series, above it as the alternating series; on its
#: side of the switch each series is exact in double precision after ``KS_TERMS`` terms.
KS_SWITCH = 1.2
KS_TERMS = 6


def ks_asymptotic_p(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided two-sample KS p-value, Kolmogorov limit with effective n."""
    en = n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double")
    lam = F.sqrt(en) * d
    terms = range(1, KS_TERMS + 1)
    tail = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in terms), F.lit(0.0))
    body = sum((F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8.0) / (lam * lam)) for k in terms), F.lit(0.0))
    near = F.lit(1.0) - F.lit(math.sqrt(2.0 * math.pi)) / lam * body
    p = F.when(lam < KS_SWITCH, near).otherwise(tail)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))


# ---- scalar helpers (numpy / math, run inside pandas UDFs) -----------------
def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularized incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def gammaincc_reg(a: float, x: float) -> float:
    """Upper regularized incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return 1.0 - total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def t_two_sided_scalar(t: float, df: float) -> float:
    if t is None or df is None or np.isnan(t) or df <= 0:
        return float("nan")
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


def chi2_sf_scalar(x: float, df: float) -> float:
    if x is None or df is None or np.isnan(x) or df <= 0:
        return float("nan")
    return gammaincc_reg(df / 2.0, x / 2.0)


@F.pandas_udf(DoubleType())
def _normal_two_sided(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: math.erfc(v / math.sqrt(2.0)) if pd.notna(v) else float("nan"))


@F.pandas_udf(DoubleType())
def _t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_scalar(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def _chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf_scalar(a, b) for a, b in zip(x, df)], dtype="float64")


def normal_two_sided(z: Column) -> Column:
    return F.nanvl(_normal_two_sided(z.cast("double")), F.lit(None).cast("double"))


def student_t_two_sided(t: Column, df: Column) -> Column:
    return F.nanvl(_t_two_sided(t.cast("double"), df.cast("double")), F.lit(None).cast("double"))


def chi2_sf(x: Column, df: Column) -> Column:
    return F.nanvl(_chi2_sf(x.cast("double"), df.cast("double")), F.lit(None).cast("double"))
