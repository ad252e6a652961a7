"""Tables that change by publishing: data first, then one manifest file that makes it current (SRC-06, SRC-07).

A run writes its files under a folder of its own, ``data/run=<id>``, which no reader looks at.  Then a numbered manifest
file names, for each key (a version, a day), the folder that is current from now on.  It is written under another
name and renamed, so it is there whole or not at all; a number that exists already is never replaced (a
writer that lost the race takes the next one).  Readers fold the manifests by number: the last entry of a key counts.  A crash
between data and manifest leaves the old state; runs that are no longer current stay, which is the archive.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Published:
    """A published table under ``base``; entries are dictionaries with ``key``, ``run``, ``path`` (relative to ``data``) and ``info``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ---- manifests -----------------------------------------------------------------------------
    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest/{name}")

    def _numbers(self) -> list[int]:
        folder = self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("_"))

    def history(self) -> list[dict]:
        """All entries, oldest first."""
        numbers = self._numbers()
        if not numbers:
            return []
        rows = self.spark.read.schema("number bigint, entries array<struct<key:string,run:string,path:string,info:string>>").json(
            [f"{self.base}/manifest/{n:012d}.json" for n in numbers]).orderBy("number").collect()
        return [{"number": r["number"], **e.asDict(), "info": json.loads(e["info"])} for r in rows for e in r["entries"]]

    def current(self) -> dict[str, dict]:
        """The last entry of each key that has data."""
        last = {e["key"]: e for e in self.history()}
        return {k: e for k, e in last.items() if e["path"] is not None}

    def commit(self, entries: Sequence[dict]) -> int:
        """Make entries current, all at once; returns the number of the manifest."""
        fs = self._path("x").getFileSystem(self._conf)
        while True:
            number = max(self._numbers(), default=0) + 1
            rows = [{**e, "info": json.dumps(e.get("info", {}))} for e in entries]
            text = json.dumps({"number": number, "entries": rows})
            draft, final = self._path(f"_{uuid.uuid4().hex}.json"), self._path(f"{number:012d}.json")
            out = fs.create(draft, False)
            out.write(bytearray(text.encode()))
            out.close()
            if not fs.exists(final) and fs.rename(draft, final):
                return number
            fs.delete(draft, False)

    # ---- data ----------------------------------------------------------------------------------
    def write(self, df: DataFrame, partition: str | None = None, folder: str = "") -> tuple[str, str]:
        """Files of a new run, not current yet; returns the run's id and its folder below ``data``."""
        run = uuid.uuid4().hex
        path = f"{folder}run={run}"
        w = df.write.mode("errorifexists")
        (w.partitionBy(partition) if partition else w).parquet(f"{self.base}/data/{path}")
        return run, path

    def publish(self, df: DataFrame, key: str, folder: str = "", **info) -> int:
        """Write a frame and make it what ``key`` holds."""
        run, path = self.write(df, folder=folder)
        return self.commit([{"key": key, "run": run, "path": path, "info": info}])

    def publish_partitions(self, df: DataFrame, partition: str, keys: Sequence[str], info: dict[str, dict] | None = None) -> int:
        """Write a frame by ``partition`` and make it what each of ``keys`` (values of the partition) holds; a key without rows is emptied."""
        run, path = self.write(df, partition)
        folder = self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/data/{path}")
        names = {s.getPath().getName() for s in folder.getFileSystem(self._conf).listStatus(folder) if s.isDirectory()}
        return self.commit([{"key": k, "run": run, "path": f"{path}/{partition}={k}" if f"{partition}={k}" in names else None,
                             "info": (info or {}).get(k, {})} for k in keys])

    def read(self, keys: Sequence[str] | None = None, schema: StructType | None = None) -> DataFrame:
        """What is current, of all keys or of some; the run's column is dropped.  Nothing published: needs ``schema``."""
        entries = self.current()
        return self._read([e for k, e in entries.items() if keys is None or k in keys], schema)

    def read_all_runs(self, schema: StructType | None = None) -> DataFrame:
        """Everything that was ever published, with its ``run``."""
        return self._read([e for e in self.history() if e["path"] is not None], schema, keep_run=True)

    def _read(self, entries: list[dict], schema: StructType | None, keep_run: bool = False) -> DataFrame:
        if not entries:
            if schema is None:
                raise FileNotFoundError(f"nothing published under {self.base}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.base}/data")
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(*sorted({f"{self.base}/data/{e['path']}" for e in entries}))
        return df if keep_run or "run" not in df.columns else df.drop("run")


def write_snapshot(df: DataFrame, base: str, version: str, profile: DataFrame | None = None) -> None:
    """SRC-06: immutable versioned snapshot plus its column profile; a version that is published already is an error.

    The newest version is the one published last, whatever its name.
    """
    table = Published(df.sparkSession, base)
    if version in {e["key"] for e in table.history()}:
        raise FileExistsError(f"version {version} already exists under {base}")
    if profile is not None:
        profile.write.mode("overwrite").parquet(f"{base}/profile/version={version}")
    table.publish(df, version, folder=f"version={version}/")


def read_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    """SRC-06: a published version, with its ``version`` column."""
    return Published(spark, base).read([version]).withColumn("version", F.lit(version))


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """SRC-06: the version published last, with its ``version`` column."""
    history = Published(spark, base).history()
    if not history:
        raise FileNotFoundError(f"nothing published under {base}")
    return read_version(spark, base, history[-1]["key"])


def write_predictions(pred: DataFrame, base: str, ds: str, run_ts: str) -> None:
    """SRC-07: the predictions of a day, stamped with the run time.

    The dated sink (``read_predictions``) holds the last run of each day; the archive (``read_archive``) holds every run
    once, where a rerun with the same stamp takes the place of the earlier one.
    """
    out = pred.withColumn("ds", F.lit(ds).cast("date")).withColumn("run_ts", F.lit(run_ts))
    Published(pred.sparkSession, base).publish(out, ds, run_ts=run_ts)


def read_predictions(spark: SparkSession, base: str, days: Sequence[str] | None = None) -> DataFrame:
    """SRC-07, dated sink: the last run of every day (or of some days)."""
    return Published(spark, base).read(days)


def read_archive(spark: SparkSession, base: str) -> DataFrame:
    """SRC-07, archive: all runs of all days; of runs with one day and stamp the last."""
    table = Published(spark, base)
    last = {(e["key"], e["info"].get("run_ts")): e for e in table.history()}
    return table._read(list(last.values()), None)
