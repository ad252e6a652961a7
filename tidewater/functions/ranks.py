"""Order statistics without a global sort in one task.

Rows are first folded to distinct (group, value) rows with counts (map-side combine), then dealt over
range partitions of (group, value), each partition an interval of the order.  That table is written
once to the checkpoint folder.  Totals per (group, partition), a small table, give each
partition's offset, and the ordered window runs inside (group, partition).  There is one path for all
sizes: no window holds more than a partition's values, a heavy value is one row, and a group of any size
is spread over as many partitions as it needs.  Counts are integers, so results do not depend on the number of
partitions.

``exact_quantiles`` picks the values at the two ranks around ``q * (n - 1)`` and interpolates linearly,
which is ``numpy.percentile`` / DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize, shuffle_partitions


def value_counts(
    df: DataFrame, value: str | Column, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Distinct (group, value) rows with ``_n`` and summed measures; null values dropped."""
    v = F.col(value) if isinstance(value, str) else value
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(c).alias(name) for name, c in (measures or {}).items()]
    return df.where(v.isNotNull()).groupBy(*[F.col(c) for c in by], v.alias("_v")).agg(*aggs)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other; the right side's keys are dropped."""
    r = right.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in right.columns])
    j = left.join(r, [left[c].eqNullSafe(r[f"_k_{c}"]) for c in on], how)
    return j.drop(*[f"_k_{c}" for c in on])


def cumulative(
    vc: DataFrame, measures: Sequence[str], by: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Add ``<m>_cum`` (inclusive running sum in ``_v`` order within ``by``) for each measure.

    Also adds ``<m>_tot`` (group total).  ``vc`` must have one row per (by, _v), as made by ``value_counts``.
    """
    return cumulative_with_offsets(vc, measures, by, partitions)[0]


def cumulative_with_offsets(
    vc: DataFrame, measures: Sequence[str], by: Sequence[str] = (), partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``cumulative`` plus the small table per (group, range): by, _part, _o_<m> before it, _t_<m> in it, <m>_tot."""
    by = list(by)
    n = partitions or shuffle_partitions(vc.sparkSession)
    dealt = vc.repartitionByRange(n, *by, "_v").withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "ranks")
    tot = dealt.groupBy(*by, "_part").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    whole = Window.partitionBy(*by)
    prev = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        *by,
        "_part",
        *[F.col(f"_t_{m}") for m in measures],
        *[F.coalesce(F.sum(f"_t_{m}").over(prev), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_t_{m}").over(whole).alias(f"{m}_tot") for m in measures],
    )
    j = join_null_safe(dealt, off.drop(*[f"_t_{m}" for m in measures]), [*by, "_part"])
    run = Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = j.select(
        *vc.columns,
        "_part",
        *[(F.sum(m).over(run) + F.col(f"_o_{m}")).alias(f"{m}_cum") for m in measures],
        *[f"{m}_tot" for m in measures],
    )
    return cum, off


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per group with one column per probability (linear interpolation).

    Groups with no non-null value are absent.
    """
    return quantiles_from_counts(value_counts(df, value, list(by)), "_n", probs, by, names, partitions)


def quantiles_from_counts(
    vc: DataFrame,
    count_col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Exact quantiles from pre-aggregated (by, _v, count) rows (weighted by ``count_col``); zero counts are ignored."""
    by = list(by)
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    vc = vc.select(*by, "_v", F.col(count_col).alias("_n")).where(F.col("_n") > 0)
    cum, off = cumulative_with_offsets(vc, ["_n"], by, partitions)
    # ranks around q * (n - 1) that fall into each range: from the small table alone
    hits = off.select(*by, "_part", "_o__n", "_t__n", "_n_tot", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_qi", "_q"))
    pos = F.col("_q") * (F.col("_n_tot") - 1)
    hits = hits.select(*by, "_part", "_o__n", "_t__n", "_qi", (pos - F.floor(pos)).alias("_frac"),
                       F.explode(F.array_distinct(F.array(F.floor(pos).cast("long"), F.ceil(pos).cast("long")))).alias("_r"))
    hits = hits.where((F.col("_r") >= F.col("_o__n")) & (F.col("_r") < F.col("_o__n") + F.col("_t__n"))).drop("_o__n", "_t__n")
    found = join_null_safe(cum.select(*by, "_part", "_v", "_n", "_n_cum"), hits, [*by, "_part"]).where(
        (F.col("_r") >= F.col("_n_cum") - F.col("_n")) & (F.col("_r") < F.col("_n_cum")))
    per_q = found.groupBy(*by, "_qi").agg(
        F.min_by("_v", "_r").alias("_lo"), F.max_by("_v", "_r").alias("_hi"), F.first("_frac").alias("_frac"))
    per_q = per_q.select(*by, "_qi", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("_val"))
    if by:
        wide = per_q.groupBy(*by)
        return wide.agg(*[F.max(F.when(F.col("_qi") == i, F.col("_val"))).alias(nm) for i, nm in enumerate(names)])
    one = per_q.agg(F.count(F.lit(1)).alias("_c"), *[F.max(F.when(F.col("_qi") == i, F.col("_val"))).alias(nm) for i, nm in enumerate(names)])
    return one.where("_c > 0").drop("_c")


def quantile_edges(df: DataFrame, value: str | Column, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles as one array column ``edges`` per group."""
    names = [f"_e{i}" for i in range(len(probs))]
    q = exact_quantiles(df, value, probs, by, names)
    return q.select(*by, F.array(*[F.col(n).cast("double") for n in names]).alias("edges"))
