"""Splits, samples, normalisation and training pairs (TOP-04..08, NRM-01..04, SET-01..02).

Splits never sort the whole table into one partition:

* random and stratified splits use a stable hash of a key (md5 prefix,
  engine-neutral) instead of a row shuffle;
* the temporal split by row position uses running counts over the distinct times
  (``cumulative``), so almost every row is routed by a comparison.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import md5_bucket, safe_div, with_scalars
from tidewater.functions.ranks import cumulative, join_null_safe, value_counts
from tidewater.operators.sequence import running_totals


def hash_split(df: DataFrame, key: str, fractions: Mapping[str, float], salt: str = "split") -> DataFrame:
    """TOP-04: split label from a stable 10000-bucket hash of the key and cumulative fractions."""
    b = md5_bucket(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")), 10000)
    expr, acc = None, 0
    items = list(fractions.items())
    for i, (name, frac) in enumerate(items):
        acc += int(round(frac * 10000))
        cond = b < F.lit(acc) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("split", expr)


def stratified_split(df: DataFrame, key: str, label: str, train_frac: float = 0.8, salt: str = "strat",
                     min_rows: int | None = None) -> DataFrame:
    """TOP-05: per class, the floor(train_frac * n_class) rows with the smallest hash go to train.

    The position of a row within its class comes from running counts over
    (class, hash) values (``cumulative``), not from a per-class window, so a
    class holding most rows is still spread over many tasks.  A null label is a class of its own.
    ``min_rows``: fail on a table with fewer rows.
    """
    if min_rows is not None and df.count() < min_rows:
        raise ValueError(f"fewer than {min_rows} rows")
    h = F.xxhash64(F.col(key).cast("string"), F.lit(salt))
    d = df.withColumn("_h", h).withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    cum = cumulative(value_counts(d, "_h", [label]), ["_n"], [label]).select(
        F.col(label), F.col("_v").alias("_h"), F.col("_n").alias("_same"), "_n_cum", "_n_tot")
    j = join_null_safe(d, cum, [label, "_h"])
    n_train = F.floor(F.col("_n_tot") * F.lit(train_frac))
    before = F.col("_n_cum") - F.col("_same")
    # rows that share a hash (a repeated key) and lie across the cut are placed by the hash of the row
    across = (before < n_train) & (F.col("_n_cum") > n_train)
    clear = j.where(~across).withColumn("split", F.when(F.col("_n_cum") <= n_train, "train").otherwise("test"))
    cut = running_totals(j.where(across), [label], ["_tie"], {"_place": F.lit(1)}, inclusive=True)
    cut = cut.withColumn("split", F.when(before + F.col("_place") <= n_train, "train").otherwise("test"))
    return clear.unionByName(cut.drop("_place")).drop("_h", "_tie", "_same", "_n_cum", "_n_tot")


def temporal_split(df: DataFrame, ts: str, order: Sequence[str], fractions: Sequence[float] = (0.7, 0.15, 0.15),
                   names: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """TOP-06: rows sorted by ``order`` (whose first column is ``ts``) and cut at positions int(n*0.7), int(n*0.85).

    Exact without a global sort: running counts over the distinct times give each time's position
    range.  Only the rows of times that straddle a cut (at most one per cut) are placed by the other
    columns too, again by running counts, and only rows equal in all of ``order`` by a window.  Rows
    without a time come last.
    """
    cuts, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        cuts.append(acc)
    first = F.struct(F.col(ts).isNull().alias("none"), F.col(ts).alias("at"))
    d = df.withColumn("_t", first)
    n = df.agg(F.count(F.lit(1)).alias("_rows_total"))
    cum = cumulative(value_counts(d, "_t"), ["_n"]).select(F.col("_v").alias("_t"), (F.col("_n_cum") - F.col("_n")).alias("_start"),
                                                         F.col("_n_cum").alias("_end"))
    j = with_scalars(join_null_safe(d, cum, ["_t"]), n)
    pos = [F.floor(F.col("_rows_total") * F.lit(c)).cast("long") for c in cuts]
    straddle = reduce(lambda a, b: a | b, [(F.col("_start") < p) & (F.col("_end") > p) for p in pos])
    j = j.withColumn("_straddle", straddle)
    rest = F.struct(*[x for c in order if c != ts for x in (F.col(c).isNull().alias(f"none_{c}"), F.col(c))] or [F.lit(0).alias("none")])
    fine = j.where("_straddle").withColumn("_r", rest)
    within = cumulative(value_counts(fine, "_r", ["_t"]), ["_n"], ["_t"]).select(
        "_t", F.col("_v").alias("_r"), (F.col("_n_cum") - F.col("_n")).alias("_before"))
    w = Window.partitionBy("_t", "_r").orderBy(F.lit(0))
    fine = join_null_safe(fine, within, ["_t", "_r"]).withColumn(
        "_pos", F.col("_start") + F.col("_before") + F.row_number().over(w) - 1).drop("_r", "_before")
    u = fine.unionByName(j.where(~F.col("_straddle")).withColumn("_pos", F.col("_start")))
    label = None
    for name, p in zip(names, pos):
        label = F.when(F.col("_pos") < p, F.lit(name)) if label is None else label.when(F.col("_pos") < p, F.lit(name))
    return u.withColumn("split", label.otherwise(F.lit(names[-1]))).select(*df.columns, "split")


def split_summary(df: DataFrame, ts: str, label: str | None = None) -> DataFrame:
    """TOP-06: rows, share, time range and label mean (CTR) per split."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")]
    if label:
        aggs.append(F.avg(F.col(label).cast("double")).alias("ctr"))
    g = df.groupBy("split").agg(*aggs)
    w = Window.partitionBy(F.lit(0))
    return g.withColumn("share", F.col("rows") / F.sum("rows").over(w))


def leak_check(df: DataFrame, ts: str, order: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """TOP-07: each split starts after the previous ends; ties are reported (H9), not raised."""
    rank = F.create_map(*[x for i, s in enumerate(order) for x in (F.lit(s), F.lit(i))])
    g = df.groupBy("split").agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")).withColumn(
        "_o", rank[F.col("split")]
    )
    w = Window.partitionBy(F.lit(0)).orderBy("_o")
    return g.withColumn("prev_max_ts", F.lag("max_ts").over(w)).select(
        "split", "min_ts", "max_ts", "prev_max_ts",
        F.coalesce(F.col("prev_max_ts") < F.col("min_ts"), F.lit(True)).alias("no_overlap"),
        F.coalesce(F.col("prev_max_ts") == F.col("min_ts"), F.lit(False)).alias("boundary_tie"),
    )


def hash_sample(df: DataFrame, key: str, percent: int, salt: str = "sample") -> DataFrame:
    """TOP-08: stable sample: rows whose key falls in the first ``percent`` of 100 buckets."""
    return df.where(md5_bucket(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")), 100) < F.lit(percent))


def zscore_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NRM-01: one-row table of mean and sample std per column (fitted on training rows)."""
    return train.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"))])


def zscore_apply(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NRM-01/02: (x - mean) / std; std 0 or null -> 0. Stats are a one-row scalar subquery."""
    j = with_scalars(df, stats)
    for c in columns:
        z = safe_div(F.col(c) - F.col(f"{c}__mean"), F.col(f"{c}__std"), 0.0)
        j = j.withColumn(c, F.when(F.col(c).isNull(), None).otherwise(z))
    return j.drop(*[x for c in columns for x in (f"{c}__mean", f"{c}__std")])


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NRM-03: (x - min) / (max - min), constant column -> 0."""
    st = df.agg(*[x for c in columns for x in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"))])
    j = with_scalars(df, st)
    for c in columns:
        j = j.withColumn(c, safe_div(F.col(c) - F.col(f"{c}__lo"), F.col(f"{c}__hi") - F.col(f"{c}__lo"), 0.0))
    return j.drop(*[x for c in columns for x in (f"{c}__lo", f"{c}__hi")])


def training_pairs(positives: DataFrame, items: DataFrame, user: str, item: str, ts: str | None = None,
                   salt: str = "neg") -> DataFrame:
    """SET-02: label 1 for every positive, and one negative for each: an item the user has no positive with.

    Each positive (its n-th occurrence counted) hashes a number below the user's count of unseen catalogue
    items; the item of that rank among the unseen ones is its negative.  With the user's seen ranks
    ``s1 < s2 < ...`` that is the rank plus the number of ``si - (i - 1)`` not above it, a running
    count per user over both kinds of rows (``running_totals``, so hot users are split).  Nothing is
    drawn twice or dropped; a user who has every item has no negative (``saturated_users``).
    """
    cat = items.select(F.col(item)).where(F.col(item).isNotNull()).distinct()
    ranked = cumulative(value_counts(cat, item), ["_n"]).select(F.col("_v").alias(item), (F.col("_n_cum") - 1).alias("_rank"))
    size = cat.agg(F.count(F.lit(1)).alias("_size"))
    pos = positives.select(user, item, *([ts] if ts else []))
    at = F.col(ts) if ts else F.lit(0)
    pos = running_totals(pos.withColumn("_at", at), [user, item], ["_at"], {"_nth": F.lit(1)})
    seen = pos.select(user, item).distinct().join(ranked, item).select(user, "_rank")
    seen = running_totals(seen, [user], ["_rank"], {"_i": F.lit(1)})
    counts = seen.groupBy(user).agg(F.count(F.lit(1)).alias("_seen"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (user, item, "_nth")], F.lit(salt))
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    picks = with_scalars(join_null_safe(pos, counts, [user], "left"), size).withColumn(
        "_free", F.col("_size") - F.coalesce("_seen", F.lit(0))).where("_free > 0")
    picks = picks.select(user, *([ts] if ts else []), F.pmod(h, F.col("_free")).alias("_place"), F.lit(0).alias("_step"), F.lit(1).alias("_kind"))
    steps = seen.select(user, *([F.lit(None).cast(positives.schema[ts].dataType).alias(ts)] if ts else []),
                        (F.col("_rank") - F.col("_i")).alias("_place"), F.lit(1).alias("_step"), F.lit(0).alias("_kind"))
    both = running_totals(picks.unionByName(steps), [user], ["_place", "_kind"], {"_skip": F.col("_step")})
    neg = both.where("_kind = 1").withColumn("_rank", F.col("_place") + F.col("_skip")).join(ranked, "_rank")
    neg = neg.select(user, item, *([ts] if ts else []))
    return pos.select(*neg.columns).withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0)))


def saturated_users(positives: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """SET-02: users with a positive on every catalogue item, for whom no negative exists."""
    cat = items.select(item).where(F.col(item).isNotNull()).distinct()
    seen = positives.select(user, item).join(cat, item, "left_semi").distinct().groupBy(user).agg(F.count(F.lit(1)).alias("seen"))
    size = cat.agg(F.count(F.lit(1)).alias("_size"))
    return with_scalars(seen, size).where("seen >= _size").select(user, "seen")
