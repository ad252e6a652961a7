"""Scans and sinks (SRC-01..13).

Tables are directories partitioned by day (``ds`` or ``year/month/day``).
Readers filter on the partition column un-wrapped, so Spark prunes
directories before listing files; writers use dynamic partition overwrite,
so a rerun of a day replaces exactly that day (idempotent reruns).  Nothing
is collected except partition values and counts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sources.publish import read_latest, write_predictions, write_snapshot  # noqa: F401


# ---------------------------------------------------------------------------
# readers
# ---------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: StructType | str, date_columns: Sequence[str] = (),
             date_format: str | None = None) -> DataFrame:
    """SRC-01: CSV with a header row and an explicit schema; named columns parsed to timestamps."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    for c in date_columns:
        parsed = F.try_to_timestamp(F.col(c), F.lit(date_format)) if date_format else F.try_to_timestamp(F.col(c))
        df = df.withColumn(c, parsed)
    return df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-02: a file or a directory of parquet parts; optional column pruning."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-08 (read back): JSON lines with an explicit (nested) schema."""
    return spark.read.schema(schema).json(path)


def read_day_range(spark: SparkSession, path: str, start: str, end: str, partition: str = "ds",
                   require_rows: bool = True) -> DataFrame:
    """SRC-03: the days between start and end (both included) of a day-partitioned table.

    The predicate is on the partition column itself, so only those
    directories are listed.  With ``require_rows`` an empty range raises
    (checked with ``limit(1)``, one small job).
    """
    df = spark.read.parquet(path).where(
        (F.col(partition) >= F.lit(start).cast("date")) & (F.col(partition) <= F.lit(end).cast("date"))
    )
    if require_rows and not df.limit(1).take(1):
        raise FileNotFoundError(f"no data in {path} between {start} and {end}")
    return df


def last_n_days(spark: SparkSession, path: str, ds: str, n_days: int = 7, partition: str = "ds") -> DataFrame:
    """SRC-03: the n days ending at ds."""
    end = date.fromisoformat(ds)
    start = date.fromordinal(end.toordinal() - (n_days - 1))
    return read_day_range(spark, path, start.isoformat(), end.isoformat(), partition)


# ---------------------------------------------------------------------------
# writers
# ---------------------------------------------------------------------------
def with_day_parts(df: DataFrame, ts: str) -> DataFrame:
    """year / month / day partition columns from a timestamp (SRC-04)."""
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts)).withColumn("day", F.dayofmonth(ts))


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet",
                      compression: str = "snappy") -> None:
    """SRC-04 / SRC-05: partitioned write; reruns replace only the partitions present in ``df``.

    ``partitionOverwriteMode=dynamic`` is set on the write itself, so other
    days of the table are never touched.  Rows are rebalanced by the
    partition columns first: each task writes few files per partition, and a large partition is split
    over tasks (and files) of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SRC-05: parquet with snappy compression."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """SRC-08: append-only JSON-lines log (nested columns kept)."""
    df.write.mode("append").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """SRC-09: a (small) report frame saved as JSON (one file)."""
    report.repartition(1).write.mode("overwrite").json(path)


def partition_values(spark: SparkSession, base: str, partition: str) -> list[str]:
    """Values of the leading partition column of a path-based table, from its folders alone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{partition}="))


# ---------------------------------------------------------------------------
# retention and late data
# ---------------------------------------------------------------------------
def expired_partition_dirs(spark: SparkSession, base: str, run_date: str, keep_days: int = 30, partition: str = "ds") -> list[str]:
    """SRC-11: partition values strictly older than run_date - keep_days, from the folders alone; values that are no dates stay."""
    cut = date.fromisoformat(run_date) - timedelta(days=keep_days)
    dated = [v for v in partition_values(spark, base, partition) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v)]
    return [v for v in dated if date.fromisoformat(v) < cut]


def drop_expired(spark: SparkSession, base: str, run_date: str, keep_days: int = 30, partition: str = "ds") -> list[str]:
    """SRC-11: delete the expired day folders of a path-based table; returns their values."""
    gone = expired_partition_dirs(spark, base, run_date, keep_days, partition)
    drop_partition_dirs(spark, base, gone, partition)
    return gone


def expired_partitions(df: DataFrame, run_date: str, keep_days: int = 30, partition: str = "ds") -> DataFrame:
    """SRC-11: partition values strictly older than run_date - keep_days, of a table without day folders."""
    cut = F.date_sub(F.lit(run_date).cast("date"), keep_days)
    return df.select(F.col(partition).cast("date").alias(partition)).distinct().where(F.col(partition) < cut)


def retained(df: DataFrame, run_date: str, keep_days: int = 30, partition: str = "ds") -> DataFrame:
    """SRC-11: the rows a retention pass keeps (partition filter)."""
    return df.where(F.col(partition).cast("date") >= F.date_sub(F.lit(run_date).cast("date"), keep_days))


def drop_partition_dirs(spark: SparkSession, base: str, values: Sequence[str], partition: str = "ds") -> int:
    """SRC-11: delete expired partition directories of a path-based table (Hadoop FileSystem)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/{partition}={v}")
        fs = p.getFileSystem(conf)
        if fs.exists(p) and fs.delete(p, True):
            dropped += 1
    return dropped


def day_fingerprints(df: DataFrame, day: Column, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """SRC-12: per day a fingerprint: row count plus sums (default: sum of a 64-bit row hash)."""
    m = measures or {"row_hash_sum": F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)"))}
    return df.groupBy(day.alias("ds")).agg(F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in m.items()])


def changed_days(raw: DataFrame, processed: DataFrame, run_date: str, lookback_days: int = 3) -> DataFrame:
    """SRC-12 / STR-08: days in the look-back window whose raw fingerprint differs from the processed one
    (or that were never processed).  The result lists the days to recompute."""
    cut = F.date_sub(F.lit(run_date).cast("date"), lookback_days)
    r = raw.where((F.col("ds") >= cut) & (F.col("ds") <= F.lit(run_date).cast("date")))
    p = processed.select(*[F.col(c).alias(f"p_{c}") if c != "ds" else F.col(c) for c in processed.columns])
    j = r.join(p, "ds", "left")
    diff = F.lit(False)
    for c in raw.columns:
        if c != "ds":
            diff = diff | ~F.col(c).eqNullSafe(F.col(f"p_{c}"))
    return j.where(diff).select("ds", "rows", "p_rows")


def daily_export(df: DataFrame, ts: str, day: str) -> DataFrame:
    """SRC-13: one day of activity (then written with ``write_partitioned``)."""
    return df.where(F.to_date(F.col(ts)) == F.lit(day).cast("date"))
