"""Percentiles and PSI over a look-back from one row per day (AGG-14, AGG-27, DFT-01, STR-09).

Each day leaves, per group and feature, its counts, sums and a mergeable quantile sketch (KLL).  A report over any
range of days merges those rows and never reads the data again.  A KLL sketch of size ``k`` is off in
rank by at most about ``RANK_ERROR / k ** 0.9`` of the values (99 percent confidence, for each quantile), also after merging, and exact
while a day range has fewer values than ``k``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import safe_div
from tidewater.operators.profile import long_form

K = 4_096
RANK_ERROR = 2.446  # fixed value: two-sided bound of the sketch at 99 percent


def rank_error(k: int) -> float:
    """Largest share of values by which a quantile's rank is off."""
    return RANK_ERROR / k ** 0.9021


def _columns(k: int) -> list[Column]:
    v = F.col("value")
    return [F.count(F.lit(1)).alias("rows"), F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"),
            F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")]


def daily_sketches(df: DataFrame, columns: Sequence[str], day: str | Column, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row per day, group and feature: ``ds, <by>, feature, rows, n, total, squares, low, high, sketch``.

    Tasks fold their rows to sketches before the shuffle.  Null values count as rows only.
    """
    d = F.col(day) if isinstance(day, str) else day
    keys = ["ds", *by]
    long = long_form(df.withColumn("ds", F.to_date(d)), columns, keys)
    return long.groupBy(*keys, "feature").agg(*_columns(k))


def streamed_sketches(events: DataFrame, columns: Sequence[str], ts: str = "event_time", by: Sequence[str] = (), delay: str = "1 hour", k: int = K) -> DataFrame:
    """STR-09: the rows of ``daily_sketches`` from a stream, each when the watermark closes its day (append mode)."""
    e = events.withWatermark(ts, delay).select(ts, *by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("_x"))
    e = e.select(ts, *by, "_x.feature", "_x.value")
    out = e.groupBy(F.window(ts, "1 day").alias("w"), *by, "feature").agg(*_columns(k))
    return out.select(F.to_date("w.start").alias("ds"), *by, "feature", "rows", "n", "total", "squares", "low", "high", "sketch")


def over_days(daily: DataFrame, first: str, last: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows of the days ``first`` to ``last`` merged per group and feature.

    A group has one row a day; their sketches are merged in the order of the days.
    """
    days = daily.where(F.col("ds").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    g = days.groupBy(*by, "feature").agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "total", "squares")], F.min("low").alias("low"), F.max("high").alias("high"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("ds", "sketch")))), lambda s: s["sketch"]).alias("_s"))
    merged = F.aggregate(F.slice("_s", 2, F.greatest(F.size("_s") - 1, F.lit(0))), F.get("_s", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b))
    return g.withColumn("sketch", F.when(F.col("n") > 0, merged)).drop("_s")


def percentiles(merged: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Counts, mean, deviation and percentiles (values that occur, no interpolation) of merged rows; null without values."""
    names = list(names or [f"p{round(100 * p)}" for p in probs])
    mean = safe_div(F.col("total"), F.col("n"), None)
    spread = F.col("squares") - F.col("total") * mean
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("n") - 1)))
    q = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(n) for p, n in zip(probs, names)]
    keep = [c for c in merged.columns if c not in ("total", "squares", "sketch")]
    return merged.select(*keep, mean.alias("mean"), std.alias("std"), *q)


def psi(reference: DataFrame, current: DataFrame, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """DFT-01 from two merged day ranges, one row per feature: bins (a, b] between the distinct quantiles of the reference; an
    empty share counts as ``floor``.  Null where one side has no values.

    Spark reads ranks from a sketch at constants only, so the edges (features x bins numbers) are fetched first.
    """
    r = reference.select("feature", F.col("n").alias("n_ref"), F.col("sketch").alias("_r"))
    c = current.select("feature", F.col("n").alias("n_cur"), F.col("sketch").alias("_c"))
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = r.where("n_ref > 0").select("feature", F.array_distinct(F.kll_sketch_get_quantile_double("_r", probs)).alias("edges")).collect()
    j = r.join(c, "feature")
    some = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    shares, n_bins = {}, F.lit(None).cast("int")
    for sketch in ("_r", "_c"):
        ranks = F.lit(None).cast("array<double>")
        for row in found:
            edges = F.array(*[F.lit(float(e)) for e in row["edges"]])
            ranks = F.when(F.col("feature") == row["feature"], F.kll_sketch_get_rank_double(sketch, edges)).otherwise(ranks)
        shares[sketch] = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
    for row in found:
        n_bins = F.when(F.col("feature") == row["feature"], F.lit(len(row["edges"]) + 1)).otherwise(n_bins)
    j = j.where(some).select("feature", "n_ref", "n_cur", n_bins.alias("bins"), shares["_r"].alias("_e"), shares["_c"].alias("_a")).unionByName(
        j.where(~some).select("feature", "n_ref", "n_cur"), allowMissingColumns=True)
    kept = lambda a, i: F.when(F.element_at(a, i + 1) <= F.element_at(a, i), F.lit(floor)).otherwise(F.element_at(a, i + 1) - F.element_at(a, i))
    terms = F.transform(F.sequence(F.lit(1), F.col("bins")), lambda i: (kept(F.col("_a"), i) - kept(F.col("_e"), i)) * F.ln(
        kept(F.col("_a"), i) / kept(F.col("_e"), i)))
    return j.select("feature", "n_ref", "n_cur", "bins", F.aggregate(terms, F.lit(0.0), lambda x, y: x + y).alias("psi"))
