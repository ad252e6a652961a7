"""Row-level cleaning and derived columns (projections, filters, repairs).

All operators are ``DataFrame -> DataFrame`` and stay inside built-in
expressions, so they fuse into one whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidewater.functions.core import cut_labels, glue, safe_div

# Fixed values that must equal the reference's rules.
EMAIL_CONTAINS_PATTERN = "@.*\\."
EMAIL_PLACEHOLDER_DOMAIN = "@placeholder.com"
# Time-of-day labels: [5,12) morning, [12,17) afternoon, [17,22) evening, else night.
TIME_OF_DAY = (("morning", 5, 12), ("afternoon", 12, 17), ("evening", 17, 22))


def _cols(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def dedup_keep_first(
    df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """PRJ-01: one row per key, the first (or last) by ``order_by``.

    Expressed as an aggregate (``min_by`` over the whole row) instead of a
    ``row_number`` window: the aggregate is combined map-side, so a key that
    holds a large share of the rows never lands whole in one task.  The rest
    of the row breaks ties, so the pick is deterministic.
    """
    keys = _cols(keys)
    order_by = _cols(order_by)
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order_by + [c for c in others if c not in order_by]])
    payload = F.struct(*[F.col(c) for c in others])
    pick = F.min_by if keep == "first" else F.max_by
    out = df.groupBy(*keys).agg(pick(payload, ordering).alias("_row"))
    return out.select(*[F.col(k) for k in keys], "_row.*").select(*df.columns)


def drop_null_keys(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """PRJ-02."""
    return df.dropna(subset=list(subset))


def abs_negative(df: DataFrame, column: str) -> DataFrame:
    """PRJ-03: negative values replaced by their absolute value."""
    return df.withColumn(column, F.abs(F.col(column)))


def repair_amount(df: DataFrame, amount: str = "total_amount", price: str = "price", qty: str = "quantity") -> DataFrame:
    """PRJ-04: negative or missing amount recomputed as price * quantity."""
    a = F.col(amount)
    return df.withColumn(amount, F.when(a.isNull() | (a < 0), F.col(price) * F.col(qty)).otherwise(a))


def fix_emails(df: DataFrame, email: str = "email", id_col: str = "customer_id") -> DataFrame:
    """PRJ-05: e-mails not containing ``@.*\\.`` (null included) get a placeholder."""
    ok = F.coalesce(F.col(email).rlike(EMAIL_CONTAINS_PATTERN), F.lit(False))
    fixed = F.concat(F.lower(F.col(id_col).cast("string")), F.lit(EMAIL_PLACEHOLDER_DOMAIN))
    return df.withColumn(email, F.when(ok, F.col(email)).otherwise(fixed))


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """PRJ-06 / FN-09: clip to [lo, hi]; null stays null."""
    out = c
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    if hi is not None:
        out = F.least(F.lit(hi), out)
    return F.when(c.isNotNull(), out)


def clip_column(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    return df.withColumn(column, clip(F.col(column), lo, hi).cast(df.schema[column].dataType))


def parse_timestamp(df: DataFrame, column: str, fmt: str | None = None, alias: str | None = None) -> DataFrame:
    """PRJ-07: string to timestamp; unparsable -> null."""
    parsed = F.try_to_timestamp(F.col(column), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(column))
    return df.withColumn(alias or column, parsed)


def range_filter(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """PRJ-08: keep rows whose columns satisfy (lo, hi, lo_inclusive, hi_inclusive)."""
    cond = F.lit(True)
    for col, rule in rules.items():
        lo, hi = rule[0], rule[1]
        lo_inc = rule[2] if len(rule) > 2 else True
        hi_inc = rule[3] if len(rule) > 3 else True
        c = F.col(col)
        if lo is not None:
            cond = cond & ((c >= lo) if lo_inc else (c > lo))
        if hi is not None:
            cond = cond & ((c <= hi) if hi_inc else (c < hi))
    return df.where(cond)


def fill_numeric(df: DataFrame, value: float | Mapping[str, object] = 0) -> DataFrame:
    """PRJ-09: constant for every numeric column, or a per-column map.

    Only numeric columns are touched by a constant (H18): dates and labels stay null.
    """
    if isinstance(value, Mapping):
        return df.fillna(dict(value))
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(value, subset=numeric)


def weekday0(c: Column) -> Column:
    """Weekday with Monday = 0 (FN-03)."""
    return F.weekday(c)


def derive_order_fields(df: DataFrame, ts: str = "order_ts", price: str = "price", qty: str = "quantity") -> DataFrame:
    """PRJ-10: amount, date, hour, weekday (Mon=0)."""
    return df.select(
        "*",
        (F.col(price) * F.col(qty)).alias("amount"),
        F.to_date(ts).alias("order_date"),
        F.hour(ts).alias("hour"),
        weekday0(F.col(ts)).alias("day_of_week"),
    )


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """PRJ-11: calendar parts and business-time flags."""
    t = F.col(ts)
    hour = F.hour(t)
    wd = weekday0(t)
    return df.select(
        "*",
        hour.alias("hour"),
        wd.alias("day_of_week"),
        F.dayofmonth(t).alias("day_of_month"),
        F.month(t).alias("month"),
        F.quarter(t).alias("quarter"),
        (wd >= 5).cast("int").alias("is_weekend"),
        ((hour >= 9) & (hour < 17)).cast("int").alias("is_business_hours"),
        (hour < 12).cast("int").alias("is_morning"),
        (hour >= 18).cast("int").alias("is_evening"),
    )


def bin_column(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], alias: str) -> DataFrame:
    """PRJ-12: fixed-edge (a, b] bins with labels; outside -> null."""
    return df.withColumn(alias, cut_labels(F.col(column), edges, labels))


def interaction_features(df: DataFrame, price="price", qty="quantity", avg_price="avg_price", weekend="is_weekend"):
    """PRJ-13: ratio and interaction features."""
    eps = 1e-9
    return df.select(
        "*",
        (F.col(price) / (F.col(qty) + F.lit(eps))).alias("price_per_unit"),
        (F.col(price) / (F.col(avg_price) + F.lit(eps))).alias("price_vs_avg"),
        (F.col(weekend) * F.col(price)).alias("weekend_price"),
    )


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """PRJ-14: one indicator column per known value."""
    pre = prefix or column
    return df.select("*", *[(F.col(column) == F.lit(v)).cast("int").alias(f"{pre}_{v}") for v in values])


def one_hot_long(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """PRJ-14 with discovered values, as (key, value, 1) rows: no list of values is needed, however many there are."""
    return df.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("value"), F.lit(1).alias("flag")).distinct()


def log1p_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_log") -> DataFrame:
    """PRJ-15."""
    return df.select("*", *[F.log1p(F.col(c)).alias(f"{c}{suffix}") for c in columns])


def derived_ratios(df: DataFrame) -> DataFrame:
    """PRJ-16: age_days/365 and income/(age+1), only when the inputs exist."""
    out = df
    if "age_days" in df.columns:
        out = out.withColumn("age_years", F.col("age_days") / F.lit(365.0))
    if "income" in df.columns and "age" in df.columns:
        out = out.withColumn("income_per_age", F.col("income") / (F.col("age") + F.lit(1)))
    return out


def time_of_day(c: Column) -> Column:
    """PRJ-17 label from the hour."""
    h = F.hour(c)
    expr = None
    for label, lo, hi in TIME_OF_DAY:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("night"))


def select_feature_columns(df: DataFrame, prefixes: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """PRJ-18: columns by prefix (in prefix order) then the rest, minus excluded ones."""
    keep = [c for c in df.columns if c not in exclude]
    ordered: list[str] = []
    for p in prefixes:
        ordered += [c for c in keep if c.startswith(p) and c not in ordered]
    ordered += [c for c in keep if c not in ordered]
    return df.select(*ordered)


def threshold_label(c: Column, threshold: float) -> Column:
    """PRJ-19: 1 when c >= threshold."""
    return (c >= F.lit(threshold)).cast("int")


def recent_rows(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """PRJ-20: rows newer than as_of - days (explicit as_of, never now())."""
    cut = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(ts) >= cut)


def cleaning_report(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """PRJ-21: initial, final, removed, removed percent as one row."""
    b = before.agg(F.count(F.lit(1)).alias("initial_count"))
    a = after.agg(F.count(F.lit(1)).alias("final_count"))
    return glue(b, a).select(
        F.lit(table).alias("table_name"),
        "initial_count",
        "final_count",
        (F.col("initial_count") - F.col("final_count")).alias("removed_count"),
        F.round(safe_div(F.col("initial_count") - F.col("final_count"), F.col("initial_count")) * 100, 2).alias(
            "removed_pct"
        ),
    )


def scale_and_summarize(df: DataFrame, column: str, factor: float) -> DataFrame:
    """PRJ-22: multiply by a constant, then count/sum/avg/min/max of the result."""
    scaled = F.col(column) * F.lit(factor)
    return df.agg(
        F.count(scaled).alias("count"),
        F.sum(scaled).alias("sum"),
        F.avg(scaled).alias("mean"),
        F.min(scaled).alias("min"),
        F.max(scaled).alias("max"),
    )


def multi_hot(df: DataFrame, array_col: str, values: Sequence[str], prefix: str = "tag") -> DataFrame:
    """PRJ-23: one indicator per known value of an array column."""
    return df.select("*", *[F.array_contains(F.col(array_col), v).cast("int").alias(f"{prefix}_{v}") for v in values])


def target_encode(
    train: DataFrame, apply_to: DataFrame, category: str, target: str, alias: str | None = None
) -> DataFrame:
    """PRJ-23: mean target per category from training rows, joined to any table.

    The encoding table has one row per category; the join is left so unseen
    categories get null.  Spark decides broadcast vs shuffle from its size.
    """
    enc = train.groupBy(category).agg(F.avg(F.col(target)).alias(alias or f"{category}_te"))
    return apply_to.join(enc, category, "left")
