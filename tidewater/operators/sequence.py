"""Per-key ordered computations that survive hot keys (WIN-01..10, JN-11/12).

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task.  When one key holds a third of a 100 TB table that task never
finishes.  The helpers below keep window semantics exact while bounding the
rows of any window partition:

* ``split_hot`` counts rows per key (combined map-side).  Rows of keys with at most ``max_rows`` rows take
  a plain window.  If there are larger keys, their rows, and only they, are dealt over range partitions
  of (key, order, hash of the row) and written to the checkpoint folder: each partition holds a consecutive
  chunk of a key, even where all its times are equal.
* ``lookback_columns`` evaluates windows that look back at most ``L`` rows (lag, rolling means): each
  chunk receives the last ``L`` rows before it as context rows, which are dropped afterwards.
* ``running_totals`` evaluates unbounded-preceding sums: chunk-local running
  sums plus the totals of all earlier chunks of the key (a small table).

Null keys are a key like any other.  Rows that agree in all order columns are in the order of their hash on
hot keys and in any order otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewater.functions.core import frac_days, whole_days
from tidewater.functions.ranks import join_null_safe
from tidewater.session import materialize, shuffle_partitions

DEFAULT_MAX_ROWS = 2_000_000


def _order_cols(order: Sequence[str | Column], desc: bool = False) -> list[Column]:
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return [c.desc() for c in cols] if desc else [c.asc() for c in cols]


def _is_time(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              max_rows: int | None = DEFAULT_MAX_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with ``_chunk`` and ``_tie``; None where there are none)."""
    if not max_rows:
        return df, None
    keys = list(keys)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > max_rows).select(*keys)
    if hot.isEmpty():
        return df, None
    rows = join_null_safe(df, hot, keys, "left_semi").withColumn("_tie", F.xxhash64(*df.columns))
    rows = rows.repartitionByRange(shuffle_partitions(df.sparkSession), *keys, *order, "_tie")
    return join_null_safe(df, hot, keys, "left_anti"), materialize(rows.withColumn("_chunk", F.spark_partition_id()), "hot-keys")


def lookback_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Add the columns ``build(window)`` returns, where ``window`` is the key's
    ordered window; valid for expressions that look back at most ``lookback`` rows."""
    keys, full = list(keys), [*order, "_tie"]
    rest, hot = split_hot(df, keys, order, max_rows)
    out = rest.select("*", *[v.alias(k) for k, v in build(Window.partitionBy(*keys).orderBy(*_order_cols(order))).items()])
    if hot is None:
        return out
    chunk = Window.partitionBy(*keys, "_chunk")
    tail = hot.withColumn("_rn", F.row_number().over(chunk.orderBy(*_order_cols(full, desc=True)))).where(F.col("_rn") <= lookback).drop("_rn")
    along = Window.partitionBy(*keys).orderBy("_chunk", *_order_cols(full))
    row = F.struct(*df.columns, "_tie")
    before = tail.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_chunk").alias("_at"),
                         F.row_number().over(chunk.orderBy(*_order_cols(full))).alias("_first"),
                         F.array_compact(F.array(*[F.lag(row, i).over(along) for i in range(1, lookback + 1)])).alias("_rows"))
    context = before.where("_first = 1").select("_at", F.explode("_rows").alias("_row")).select("_row.*", F.col("_at").alias("_chunk"))
    both = hot.withColumn("_ctx", F.lit(False)).unionByName(context.withColumn("_ctx", F.lit(True)))
    cols = build(chunk.orderBy(*_order_cols(full)))
    done = both.select("*", *[v.alias(k) for k, v in cols.items()]).where(~F.col("_ctx")).drop("_ctx", "_chunk", "_tie")
    return out.unionByName(done)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Column],
    inclusive: bool = False,
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Add for each measure the sum over the key's earlier rows (``inclusive``: and this row)."""
    keys, end = list(keys), 0 if inclusive else -1
    rest, hot = split_hot(df, keys, order, max_rows)

    def before(w: WindowSpec, m: Column) -> Column:
        return F.coalesce(F.sum(m).over(w.rowsBetween(Window.unboundedPreceding, end)), F.lit(0))

    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    out = rest.select("*", *[before(w, m).alias(n) for n, m in measures.items()])
    if hot is None:
        return out
    tot = hot.groupBy(*keys, "_chunk").agg(*[F.sum(m).alias(f"_t_{n}") for n, m in measures.items()])
    prev = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, "_chunk", *[F.coalesce(F.sum(f"_t_{n}").over(prev), F.lit(0)).alias(f"_o_{n}") for n in measures])
    c = join_null_safe(hot, off, [*keys, "_chunk"])
    w = Window.partitionBy(*keys, "_chunk").orderBy(*_order_cols([*order, "_tie"]))
    done = c.select(*df.columns, *[(before(w, m) + F.col(f"_o_{n}")).alias(n) for n, m in measures.items()])
    return out.unionByName(done)


# ---------------------------------------------------------------------------
# WIN operators
# ---------------------------------------------------------------------------
def previous_value(df, keys, order, column, alias, default=0.0, max_rows=DEFAULT_MAX_ROWS):
    """WIN-01: value of the previous row of the key; first row -> default."""
    return lookback_columns(
        df, keys, order, 1, lambda w: {alias: F.coalesce(F.lag(column).over(w), F.lit(default))}, max_rows
    )


def sequence_features(df, keys, order, ts, amount, max_rows=DEFAULT_MAX_ROWS) -> DataFrame:
    """WIN-01..04 together (one window pass):

    prev_amount (first -> 0), days_since_prev (fractional days, first -> 999),
    rolling_amount_3 (mean of the last 3 rows, min 1), gap_days (whole days, first -> null).
    """

    def build(w):
        prev_ts = F.lag(ts).over(w)
        return {
            "prev_amount": F.coalesce(F.lag(amount).over(w), F.lit(0.0)),
            "days_since_prev": F.coalesce(frac_days(prev_ts, F.col(ts)), F.lit(999.0)),
            "rolling_amount_3": F.avg(amount).over(w.rowsBetween(-2, 0)),
            "gap_days": whole_days(prev_ts, F.col(ts)),
        }

    return lookback_columns(df, keys, order, 2, build, max_rows)


def last_n_flag(df, keys, order, n, alias="is_recent", max_rows=DEFAULT_MAX_ROWS) -> DataFrame:
    """WIN-05: 1 for the last ``n`` rows of each key (by order), else 0; every row once, equal rows too.

    A row is among the last ``n`` if fewer than ``n`` rows of its key come before it from the end.
    """
    back = df.select("*", *[F.struct(F.col(o).isNull().alias("none"), F.col(o).alias("at")).alias(f"_o{i}") for i, o in enumerate(order)])
    keys = list(keys)
    rest, hot = split_hot(back, keys, [f"_o{i}" for i in range(len(order))], max_rows)
    down = [F.col(f"_o{i}").desc() for i in range(len(order))]
    out = rest.withColumn(alias, (F.row_number().over(Window.partitionBy(*keys).orderBy(*down)) <= n).cast("int"))
    if hot is not None:
        tot = hot.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_t"))
        later = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
        off = tot.select(*keys, "_chunk", F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_o"))
        w = Window.partitionBy(*keys, "_chunk").orderBy(*down, F.col("_tie").desc())
        done = join_null_safe(hot, off, [*keys, "_chunk"]).withColumn(alias, (F.row_number().over(w) + F.col("_o") <= n).cast("int"))
        out = out.unionByName(done.select(*out.columns))
    return out.select(*df.columns, alias)


def top_k_per_group(df, keys, order, k, rank_col="rank") -> DataFrame:
    """WIN-06: the first ``k`` rows of each group by ``order`` (descending score first).

    Spark plans ``row_number() <= k`` with a partial WindowGroupLimit before
    the exchange, i.e. a map-side top-k: a hot group ships at most k rows per
    map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def consecutive_alerts(history: DataFrame, keys, order, flag, run=3, max_col=None, max_threshold=0.5):
    """WIN-07: alert when the last ``run`` checks all flagged, or a max above the threshold.

    Operates on a check history (one row per key and check), small by nature.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(-(run - 1), 0)
    flagged = F.min(F.col(flag).cast("int")).over(w)
    n = F.count(F.lit(1)).over(w)
    cond = (flagged == 1) & (n == run)
    if max_col is not None:
        cond = cond | (F.col(max_col) > F.lit(max_threshold))
    return history.withColumn("alert", cond)


def metric_trend(history: DataFrame, keys, x: str, y: str) -> DataFrame:
    """WIN-08: least-squares slope, r2 and t statistic per key; p from FN-18."""
    from tidewater.functions.stats import student_t_two_sided

    keys = list(keys)
    xn = F.unix_micros(F.col(x).cast("timestamp")) / F.lit(86400e6) if _is_time(history, x) else F.col(x)
    g = history.groupBy(*keys).agg(
        F.regr_slope(F.col(y), xn).alias("slope"),
        F.regr_r2(F.col(y), xn).alias("r2"),
        F.regr_count(F.col(y), xn).alias("n"),
    )
    df_ = F.col("n") - 2
    t = F.col("slope") / F.abs(F.col("slope")) * F.sqrt(F.col("r2") * df_ / (F.lit(1.0) - F.col("r2")))
    g = g.withColumn("t_stat", F.when((df_ > 0) & (F.col("r2") < 1), t))
    exact = (df_ > 0) & (F.col("r2") >= 1) & (F.col("slope") != 0)  # all points on one line
    g = g.withColumn("p_value", F.when(exact, F.lit(0.0)).otherwise(student_t_two_sided(F.col("t_stat"), df_)))
    return g.withColumn("trending", (F.col("slope") > 0.01) & (F.col("p_value") < 0.05))


def previous_period_compare(daily: DataFrame, day: str, metrics: Sequence[str], keys: Sequence[str] = ()):
    """WIN-09: each day against the previous day present (gap-free: previous row)."""
    keys = list(keys)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(day)
    out = daily.withColumn("previous_date", F.lag(day).over(w))
    for m in metrics:
        out = out.withColumn(f"prev_{m}", F.lag(m).over(w)).withColumn(f"{m}_change", F.col(m) - F.col(f"prev_{m}"))
    return out


def peak_hour_and_weekend_share(df: DataFrame, user: str, ts: str) -> DataFrame:
    """WIN-10: per user the modal hour (lowest on ties) and the weekend share; both null for users without a time."""
    from tidewater.operators.aggregates import mode_by

    h = df.select(user, F.hour(ts).alias("hour"), (F.weekday(ts) >= 5).cast("double").alias("_we"))
    peak = mode_by(h, [user], "hour", "peak_hour")
    share = h.groupBy(user).agg(F.avg("_we").alias("weekend_share"))
    return join_null_safe(share, peak, [user], "left").select(user, "peak_hour", "weekend_share")


def earlier_pair_count(df, keys, order, alias="prior_interactions", mode="history", max_rows=DEFAULT_MAX_ROWS):
    """JN-11: interactions of the same (user, item) before this row.

    mode='reference': group size - 1, clipped at 0 (the reference's value, counts later rows too).
    mode='history': rows strictly earlier by ``order`` (no look-ahead).
    """
    keys = list(keys)
    if mode == "reference":
        c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        return df.join(c, keys, "left").withColumn(alias, F.greatest(F.col("_c") - 1, F.lit(0))).drop("_c")
    return running_totals(df, keys, order, {alias: F.lit(1)}, inclusive=False, max_rows=max_rows)


def point_in_time_features(
    df, user: str, order: Sequence[str], click: str, dwell: str, prefix="user_hist", max_rows=DEFAULT_MAX_ROWS
) -> DataFrame:
    """JN-12: per row, the user's earlier interactions only: count, clicks, CTR, mean dwell."""
    r = running_totals(
        df,
        [user],
        order,
        {f"{prefix}_count": F.lit(1), f"{prefix}_clicks": F.col(click), f"_{prefix}_dwell": F.col(dwell)},
        inclusive=False,
        max_rows=max_rows,
    )
    n = F.col(f"{prefix}_count")
    return (
        r.withColumn(f"{prefix}_ctr", F.when(n > 0, F.col(f"{prefix}_clicks") / n))
        .withColumn(f"{prefix}_avg_dwell", F.when(n > 0, F.col(f"_{prefix}_dwell") / n))
        .drop(f"_{prefix}_dwell")
    )


def as_of_join(facts: DataFrame, snapshots: DataFrame, keys: Sequence[str], ts: str, snap_ts: str,
               max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """JN-12: for each fact row, the latest snapshot of its key taken at or before the row.

    Facts and snapshots are put on one time line per key (snapshots first at equal times); the number of the
    latest snapshot up to a row is a running count (``running_totals``: hot keys are split), and that number is an
    equi-join.  No pair of fact and earlier snapshot is formed.  Of snapshots at the same time the last by value counts.
    """
    keys = list(keys)
    snap_cols = [c for c in snapshots.columns if c not in keys and c != snap_ts]
    s = snapshots.where(F.col(snap_ts).isNotNull()).groupBy(*keys, snap_ts).agg(F.max(F.struct(*snap_cols)).alias("_snap"))
    kind = facts.schema[ts].dataType
    line = facts.select(*[F.col(k) for k in keys], F.col(ts).alias("_at"), F.lit(0).alias("_is"), F.struct(*facts.columns).alias("_f"),
                        F.lit(None).cast(s.schema["_snap"].dataType).alias("_snap"))
    line = line.unionByName(s.select(*keys, F.col(snap_ts).cast(kind).alias("_at"), F.lit(1).alias("_is"),
                                     F.lit(None).cast(line.schema["_f"].dataType).alias("_f"), "_snap"))
    line = line.withColumn("_last", -F.col("_is"))
    n = running_totals(line, keys, ["_at", "_last"], {"_n": F.col("_is")}, inclusive=True, max_rows=max_rows)
    taken = n.where("_is = 1").select(*keys, "_n", "_snap")
    f = n.where("_is = 0").select(*keys, "_n", "_f")
    j = join_null_safe(f, taken, [*keys, "_n"], "left")
    return j.select("_f.*", *[F.col(f"_snap.{c}").alias(c) for c in snap_cols])
