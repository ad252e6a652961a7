"""Daily summaries and their trailing roll-ups kept up by dependency (STR-10, SRC-12, STR-08).

The summary of a day depends on the day's rows, the roll-up of a day on the summaries of its last ``days`` days.  Every summary is
published with the fingerprint of the rows it was made from.  A refresh compares the fingerprints of the look-back
window, makes the summaries of the days that differ (reading those days only), and makes the roll-ups of those days
and of the days that look back on them.  Nothing else is read or written; a refresh without changes
writes nothing, and one that is repeated after a crash ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.sources.files import day_fingerprints
from tidewater.sources.publish import Published


@dataclass
class Refreshed:
    """Days whose summaries and roll-ups a refresh has written."""

    summaries: list[str]
    rollups: list[str]


def trailing(daily: DataFrame, measures: list[str], days: int) -> DataFrame:
    """Per day the sums of the measures over the last ``days`` calendar days and how many of those days have a summary.

    One row a day comes in, so the single ordered window is as long as the calendar.
    """
    w = Window.orderBy(F.unix_date("ds")).rangeBetween(1 - days, 0)
    return daily.select("ds", *[F.sum(m).over(w).alias(f"{m}_{days}d") for m in measures], F.count(F.lit(1)).over(w).alias(f"days_{days}d"))


class DailyTables:
    """Summaries and roll-ups of a raw table with a ``ds`` date column, published under ``base``."""

    def __init__(self, spark: SparkSession, base: str, summarise: Callable[[DataFrame], DataFrame], measures: list[str], days: int = 7):
        self.summaries, self.rollups = Published(spark, f"{base}/summary"), Published(spark, f"{base}/rollup")
        self.summarise, self.measures, self.days = summarise, measures, days

    def refresh(self, raw: DataFrame, run_date: str, lookback_days: int | None = None) -> Refreshed:
        """Bring both tables up to the raw rows of the days up to ``run_date`` (of the last ``lookback_days`` before it, or all)."""
        end = date.fromisoformat(run_date)
        start = end - timedelta(days=lookback_days) if lookback_days is not None else date.min
        window = raw.where(F.col("ds") <= F.lit(end)) if lookback_days is None else raw.where(F.col("ds").between(F.lit(start), F.lit(end)))
        rows = day_fingerprints(window, F.col("ds")).collect()  # one row a day
        now = {str(r["ds"]): f"{r['rows']}:{r['row_hash_sum']}" for r in rows if r["ds"] is not None}
        known = {k: e["info"]["rows"] for k, e in self.summaries.current().items() if str(start) <= k <= run_date}
        changed = sorted(d for d in now.keys() | known.keys() if now.get(d) != known.get(d))
        if changed:
            some = raw.where(F.col("ds").isin([date.fromisoformat(d) for d in changed]))
            self.summaries.publish_partitions(self.summarise(some), "ds", changed, {d: {"rows": now.get(d)} for d in changed})
        return Refreshed(changed, self._rollups())

    def _rollups(self) -> list[str]:
        """Roll-ups whose summaries are other runs than those they were made from."""
        summaries, made = self.summaries.current(), {k: e["info"]["from"] for k, e in self.rollups.current().items()}

        def sources(day: str) -> list[str]:
            last = date.fromisoformat(day)
            back = [str(last - timedelta(days=k)) for k in range(self.days)]
            return sorted(f"{d}:{summaries[d]['run']}" for d in back if d in summaries)

        wanted = {d: sources(d) for d in summaries}
        stale = sorted(d for d in wanted.keys() | made.keys() if wanted.get(d) != made.get(d))
        if not stale:
            return []
        needed = {str(date.fromisoformat(d) - timedelta(days=k)) for d in stale for k in range(self.days)} & summaries.keys()
        if needed:
            daily = self.summaries.read(sorted(needed)).withColumn("ds", F.col("ds").cast("date"))
            out = trailing(daily, self.measures, self.days).where(F.col("ds").isin([date.fromisoformat(d) for d in stale]))
            self.rollups.publish_partitions(out, "ds", stale, {d: {"from": wanted.get(d)} for d in stale})
        else:
            self.rollups.commit([{"key": d, "run": "", "path": None, "info": {"from": None}} for d in stale])
        return stale

    def read(self) -> tuple[DataFrame, DataFrame]:
        """Current (summaries, roll-ups)."""
        return self.summaries.read(), self.rollups.read()
