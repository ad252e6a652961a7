"""Item activity over several horizons from one ring of hourly counts per item (STR-05, AGG-25 as a stream).

An event is counted once, in its hour: views, likes and an HLL sketch of the users.  When the watermark closes an
hour, the item's row goes to a stateful processor that keeps the hours of the last week and emits the item's
activity at every full hour at which it changes: when an hour enters, leaves the last hour, stops being the hour before,
leaves the last day or the last week.  Timers emit the changes of items without new events, and an item whose
week is empty leaves the state.  Sketches stay binary in the state and are united by Spark's own functions after it.

State: at most ``WEEK`` closed hours per item seen within a week (more only inside a batch that closes a longer time at once),
and the open hours of the aggregation.  ``horizons_in_batch`` is the same table from a batch frame with exact viewers;
it works on hourly rows, so neither events nor viewers of a hot item meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY, WEEK = 24, 168
#: hours after an active hour's start at which one of the numbers changes
CHANGES = (1, 2, 3, DAY + 1, WEEK + 1)
LG_K = 12  # of the sketches: relative standard error about 1.04 / sqrt(2 ** LG_K) = 1.6 percent
HOUR_MS = 3_600_000
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE = "done bigint, hours array<bigint>, views array<bigint>, likes array<bigint>, users array<binary>"
COUNTS = "as_of_hour bigint, views_1h bigint, views_24h bigint, views_7d bigint, likes_24h bigint, acceleration bigint, users array<binary>"


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB store; a session that names another provider class is changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)


def hourly_items(events: DataFrame, ts: str = "event_time", delay: str = "1 hour", item: str = "item_id", user: str = "user_id") -> DataFrame:
    """``item, hour`` (hours since 1970)``, views, likes, users`` (sketch) of every closed hour.

    Events without an item are one group, which the processor drops: a filter would be pushed below the watermark, and
    their times would no longer move it.
    """
    g = events.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour"), F.col(item).alias("item"))
    out = g.agg(F.count(F.lit(1)).alias("views"), F.sum("liked").cast("bigint").alias("likes"),
                F.hll_sketch_agg(F.col(user).cast("bigint"), F.lit(LG_K)).alias("users"))
    return out.select("item", F.col("window.end").alias("closed"), (F.unix_seconds("window.start") / 3600).cast("bigint").alias("hour"),
                      "views", F.coalesce("likes", F.lit(0)).alias("likes"), "users")


class HourRing(StatefulProcessor):
    """The hours of an item's last week; one row at every hour at which a number changes.

    What is due by the watermark is emitted at once, and one timer stands at the next change.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None or key[0] != key[0]:
            return
        done, ring = self._load()
        for part in rows:
            for hour, views, likes, users in zip(part["hour"], part["views"], part["likes"], part["users"]):
                ring[int(hour)] = (int(views), int(likes), bytes(users))
        yield from self._advance(key, done, ring, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, *self._load(), timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, done: int, ring: dict[int, tuple[int, int, bytes]], timerValues) -> Iterator[pd.DataFrame]:
        """Emit the changes up to the watermark, forget hours beyond the week, wait for the next change."""
        now = timerValues.getCurrentWatermarkInMs() // HOUR_MS
        changes = sorted({h + c for h in ring for c in CHANGES if h + c > done})
        due = np.array([c for c in changes if c <= now], dtype=np.int64)
        if len(due):
            yield self._rows(key[0], due, ring)
        left = {h: v for h, v in ring.items() if h + CHANGES[-1] > now}
        if left:
            hours = sorted(left)
            self.ring.update((max(done, now), hours, *[[left[h][k] for h in hours] for k in range(3)]))
            self.handle.registerTimer(next(c for c in changes if c > now) * HOUR_MS)
        else:
            self.ring.clear()

    @staticmethod
    def _rows(item, due: np.ndarray, ring: dict[int, tuple[int, int, bytes]]) -> pd.DataFrame:
        order = sorted(ring)
        hours = np.array(order)
        sums = [np.concatenate([[0], np.cumsum([ring[h][k] for h in order])]) for k in (0, 1)]
        at = np.searchsorted(hours, due)  # hours before ``due``
        first = {n: np.searchsorted(hours, due - n) for n in (1, 2, DAY, WEEK)}
        views = {n: sums[0][at] - sums[0][f] for n, f in first.items()}
        users = [[ring[h][2] for h in order[a:b]] for a, b in zip(first[DAY].tolist(), at.tolist())]
        return pd.DataFrame({"item": [item] * len(due), "as_of_hour": due, "views_1h": views[1], "views_24h": views[DAY], "views_7d": views[WEEK],
                             "likes_24h": sums[1][at] - sums[1][first[DAY]], "acceleration": 2 * views[1] - views[2], "users": users})

    def _load(self) -> tuple[int, dict[int, tuple[int, int, bytes]]]:
        if not self.ring.exists():
            return 0, {}
        done, hours, views, likes, users = self.ring.get()
        return int(done), {h: (v, n, bytes(u)) for h, v, n, u in zip(hours, views, likes, users)}


def _viewers() -> F.Column:
    united = F.aggregate(F.slice("users", 2, WEEK), F.element_at("users", 1), lambda a, b: F.hll_union(a, b))
    return F.when(F.size("users") == 0, F.lit(0)).otherwise(F.hll_sketch_estimate(united)).cast("bigint")


OUT = ("views_1h", "views_24h", "views_7d", "likes_24h", "acceleration")


def rolling_horizons(events: DataFrame, ts: str = "event_time", delay: str = "1 hour", item: str = "item_id", user: str = "user_id") -> DataFrame:
    """Stream of ``item, as_of, views_1h, views_24h, views_7d, likes_24h, acceleration, viewers_24h`` (sketched).

    ``as_of`` is a full hour; a row says what holds from then until the item's next row.  Append mode; needs ``use_state_store``.
    """
    hours = hourly_items(events, ts, delay, item, user)
    kind = dict(hours.dtypes)["item"]
    out = hours.groupBy("item").transformWithStateInPandas(HourRing(), f"item {kind}, {COUNTS}", "Append", "EventTime")
    return out.select(F.col("item").alias(item), F.timestamp_seconds(F.col("as_of_hour") * 3600).alias("as_of"), *OUT, _viewers().alias("viewers_24h"))


def horizons_in_batch(events: DataFrame, ts: str = "event_time", item: str = "item_id", user: str = "user_id") -> DataFrame:
    """The rows of ``rolling_horizons`` once all hours are closed, from a batch frame, with exact viewers.

    Everything is folded to rows per item and hour before the windows; a viewer's hours become intervals of the
    hours at which he counts, so distinct viewers are a running sum of arrivals and departures.
    """
    e = events.where(F.col(item).isNotNull()).select(
        F.col(item).alias("item"), F.col(user).cast("bigint").alias("user"), F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 3600).alias("hour"), "liked")
    hourly = e.groupBy("item", "hour").agg(F.count(F.lit(1)).alias("views"), F.sum(F.coalesce("liked", F.lit(0))).cast("bigint").alias("likes"))
    seen = e.where("user IS NOT NULL").select("item", "user", "hour").distinct()
    own = Window.partitionBy("item", "user").orderBy("hour")
    gap_before = F.col("hour") - F.lag("hour").over(own)
    gap_after = F.lead("hour").over(own) - F.col("hour")
    seen = seen.select("item", "hour", F.coalesce(gap_before > DAY, F.lit(True)).alias("comes"), F.coalesce(gap_after > DAY, F.lit(True)).alias("goes"))
    comes = seen.where("comes").select("item", (F.col("hour") + 1).alias("at"), F.lit(1).alias("d"))
    goes = seen.where("goes").select("item", (F.col("hour") + DAY + 1).alias("at"), F.lit(-1).alias("d"))
    viewers = comes.unionByName(goes).groupBy("item", "at").agg(F.sum("d").alias("arrivals"))
    asked = hourly.select("item", F.explode(F.array(*[F.col("hour") + c for c in CHANGES])).alias("at")).distinct()
    # an hour's counts stand at its end, so that the last n hours before ``at`` are the rows at - n + 1 .. at
    points = hourly.select("item", (F.col("hour") + 1).alias("at"), "views", "likes")
    rows = (asked.withColumn("asked", F.lit(True)).join(points, ["item", "at"], "full").join(viewers, ["item", "at"], "full")
            .fillna(0, ["views", "likes", "arrivals"]))
    w = Window.partitionBy("item").orderBy("at")

    def last(column: str, n: int, until: int = 0) -> F.Column:
        return F.coalesce(F.sum(column).over(w.rangeBetween(1 - n - until, -until)), F.lit(0))

    out = rows.select("item", "at", "asked", last("views", 1).alias("views_1h"), last("views", DAY).alias("views_24h"), last("views", WEEK).alias("views_7d"),
                      last("likes", DAY).alias("likes_24h"), (last("views", 1) - last("views", 1, 1)).alias("acceleration"),
                      F.sum("arrivals").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("viewers_24h"))
    return out.where("asked").select(F.col("item").alias(item), F.timestamp_seconds(F.col("at") * 3600).alias("as_of"), *OUT, "viewers_24h")
