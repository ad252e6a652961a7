"""Column profiles and long (unpivoted) forms (AGG-13, AGG-14).

Statistics of many columns are computed in a fixed number of jobs: the
numeric columns are unpivoted to (feature, value) rows once and grouped by
feature, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidewater.functions.ranks import exact_quantiles


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids..., feature, value) rows; values cast to double."""
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), "feature", "value")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, quartiles: bool = True) -> DataFrame:
    """AGG-14: per column type, mean, std, min, max, null count (+ median, q25, q75).

    One aggregate over the long form gives all moments; quartiles are exact.
    """
    cols = list(columns or numeric_columns(df))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    long = long_form(df, cols)
    stats = long.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.count(F.lit(1)).alias("rows"),
    )
    type_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    stats = stats.withColumn("dtype", type_map[F.col("feature")])
    if not quartiles:
        return stats
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"], ["q25", "median", "q75"])
    return stats.join(q, "feature", "left")


# The name rules that sort feature columns into groups.
FEATURE_NAME_RULES = {
    "rfm": ("rfm", "recency", "frequency", "monetary"),
    "temporal": ("days", "date", "time"),
    "behavioral": ("category", "items", "cancel"),
    "value": ("revenue", "value", "clv"),
}


def feature_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-13: count, mean, std, min, exact quartiles and max of each numeric column, one row per column."""
    long = long_form(df, columns)
    stats = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"], ["p25", "p50", "p75"])
    return stats.join(q, "feature", "left")


def feature_summary(df: DataFrame, segment_col: str | None = None) -> DataFrame:
    """AGG-13: rows, columns, column counts by name rule and segment counts, as long rows."""
    counts = {
        k: sum(1 for c in df.columns if any(t in c.lower() for t in v)) for k, v in FEATURE_NAME_RULES.items()
    }
    head = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows").alias("metric"), F.col("value"))
    spark = df.sparkSession
    fixed = spark.createDataFrame(
        [("columns", len(df.columns))] + [(f"columns_{k}", v) for k, v in counts.items()], "metric string, value long"
    )
    out = head.unionByName(fixed)
    if segment_col:
        seg = df.groupBy(segment_col).agg(F.count(F.lit(1)).alias("value"))
        out = out.unionByName(seg.select(F.concat(F.lit("segment_"), F.col(segment_col)).alias("metric"), "value"))
    return out
