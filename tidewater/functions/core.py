"""Scalar helpers built only from Spark SQL expressions (FN-01..19)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """FN-16: num / den with a zero or null denominator -> ``default``."""
    q = F.try_divide(num, den)
    return q if default is None else F.coalesce(q, F.lit(default))


def round_to(c: Column, digits: int) -> Column:
    """FN-07: round(x * 10^d) / 10^d - the rounding of the scaled double, as numpy and DuckDB do
    (Spark's ``round`` rounds the decimal string instead, which differs on exact ties)."""
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def sig_round(c: Column, digits: int = 12, max_decimals: int = 9) -> Column:
    """Round a double to ``digits`` significant digits but at most ``max_decimals`` decimals.

    Used to compare results across engines: sums of doubles differ in their last bits
    between engines and runs; a fixed number of decimals does not absorb that for large
    magnitudes, a fixed number of significant digits does not for small ones.  The value is
    scaled by a power of ten, rounded and scaled back, the same arithmetic on both sides.
    0, null, NaN and infinities pass through.
    """
    k = F.least(F.lit(max_decimals), F.lit(digits - 1) - F.floor(F.log10(F.abs(c))))
    factor = F.pow(F.lit(10.0), k)
    special = c.isNull() | F.isnan(c) | (c == 0) | (F.abs(c) == F.lit(float("inf")))
    return F.when(special, c).otherwise(F.round(c * factor) / factor)


def sig_round_sql(x: str, digits: int = 12, max_decimals: int = 9) -> str:
    """The same rounding in DuckDB SQL."""
    f = f"pow(10.0, least({max_decimals}, {digits - 1} - floor(log10(abs({x})))))"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 OR isinf({x}) THEN {x} ELSE round({x} * {f}) / {f} END"


def cents(c: Column) -> Column:
    """Money as whole cents (BIGINT)."""
    return F.round(c * F.lit(100.0)).cast("long")


def money_sum(c: Column) -> Column:
    """Sum of money rounded to cents, computed exactly in integer cents.

    Integer sums do not depend on the order rows are added in, so the result
    is the same on every run and partitioning (a double sum is not).
    """
    return F.sum(cents(c)) / F.lit(100.0)


def money_avg(c: Column) -> Column:
    """Mean of money rounded to cents (half away from zero), from the exact cent sum."""
    return F.round(F.sum(cents(c)) / F.count(c)) / F.lit(100.0)


def cut_labels(c: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """PRJ-12: ``pd.cut`` semantics, right-closed (a, b]; outside -> null.

    Returns the label, or the bin index (0-based) when ``labels`` is None.
    """
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    expr = None
    for i in range(len(edges) - 1):
        cond = (c > F.lit(edges[i])) & (c <= F.lit(edges[i + 1]))
        val = F.lit(labels[i]) if labels is not None else F.lit(i)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def width_bin(c: Column, lo: Column, hi: Column, n: int) -> Column:
    """FN-15: equal-width bin 0..n-1 on [lo, hi], last bin closed (``np.histogram``)."""
    return F.least(F.width_bucket(c, lo, hi, F.lit(n)), F.lit(n)) - F.lit(1)


def digitize(c: Column, edges: Column) -> Column:
    """FN-14: number of edges <= c (``np.digitize`` with increasing edges)."""
    return F.size(F.filter(edges, lambda e: c >= e))


def md5_bucket(c: Column, n: int = 100) -> Column:
    """FN-19: engine-neutral stable bucket from the first 8 hex digits of md5."""
    return F.pmod(F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def md5_bucket_sql(expr: str, n: int = 100) -> str:
    """The same bucket in DuckDB SQL."""
    return f"(CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) % {n})"


def whole_days(a: Column, b: Column) -> Column:
    """FN-04: whole days from a to b (truncated like ``timedelta.days`` for b >= a)."""
    return F.timestamp_diff("DAY", a, b)


def frac_days(a: Column, b: Column) -> Column:
    """FN-04: fractional days from a to b."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / F.lit(86400e6)


def glue(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row.

    Union plus a global aggregate: no cross join, the result is one row.
    """
    cols: list[str] = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for c in cols])


def scalar_struct(one_row: DataFrame) -> Column:
    """The single row of a one-row frame as a scalar-subquery struct column.

    Spark runs the subquery once and inlines its value; no join is planned.
    """
    return one_row.select(F.struct(*[F.col(c) for c in one_row.columns])).scalar()


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) to every row."""
    s = scalar_struct(one_row)
    return df.select("*", *[s[c].alias(c) for c in one_row.columns])
