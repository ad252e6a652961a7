"""Predictions meet the labels that come later, as a stream (JN-09).

Two streams are joined by id within a time window: a label counts from the prediction's time until ``window`` later.
Both sides are cleared of repeats first, so a prediction leaves the join exactly once: with its label as soon as that has come,
or without one when the watermark shows that it can no longer come.  State is bounded by the window: predictions
and labels are dropped once nothing can match them.

Rows are written under the number of their micro-batch, which a replay overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def with_late_labels(predictions: DataFrame, labels: DataFrame, window: str = "2 days", id_col: str = "prediction_id", at: str = "predicted_at",
                     label_at: str = "labelled_at", delay: str = "1 hour") -> DataFrame:
    """``predictions`` with ``label, labelled_at, labelled``; every prediction once.

    Of repeated predictions and labels of an id the first counts (in a stream: within ``delay`` of each other's time, the
    first to come), and a label outside the window of its prediction is none.  Rows without an id or a time are left out.  The
    frames are both streams (append mode) or both batch frames, which give what the streams give in the end.
    """
    p = predictions.where(F.col(id_col).isNotNull() & F.col(at).isNotNull())
    y = labels.select(F.col(id_col).alias("_label_id"), F.col(label_at).cast("timestamp").alias("labelled_at"), "label")
    y = y.where(F.col("_label_id").isNotNull() & F.col("labelled_at").isNotNull())
    if p.isStreaming:
        p = p.withWatermark(at, delay).dropDuplicatesWithinWatermark([id_col])
        y = y.withWatermark("labelled_at", delay).dropDuplicatesWithinWatermark(["_label_id"])
    else:
        p, y = _first(p, id_col, at), _first(y, "_label_id", "labelled_at")
    inside = (F.col("labelled_at") >= F.col(at)) & (F.col("labelled_at") <= F.col(at) + F.expr(f"INTERVAL {window}"))
    j = p.join(y, (F.col(id_col) == F.col("_label_id")) & inside, "left")
    return j.select(*predictions.columns, "label", "labelled_at", F.col("_label_id").isNotNull().alias("labelled"))


def _first(df: DataFrame, key: str, at: str) -> DataFrame:
    """The earliest row of each key (of equal times one by the hash of the row)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(F.col(at), F.xxhash64(*[F.col(c) for c in df.columns]))
    return df.groupBy(key).agg(F.min_by(row, order).alias("_row")).select("_row.*")


def write_epochs(stream: DataFrame, target: str, checkpoint: str, mode: str = "append",
                 change: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write each micro-batch to ``target/epoch=<number>``; a batch that runs again replaces what it wrote before."""

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = change(batch) if change else batch
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}/epoch={epoch}")

    return stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_epochs(spark: SparkSession, target: str, schema=None) -> DataFrame:
    """All micro-batches written so far, with their ``epoch``."""
    reader = spark.read.option("basePath", target)
    return (reader.schema(schema) if schema is not None else reader).parquet(f"{target}/epoch=*").withColumn("epoch", F.col("epoch").cast("bigint"))


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key from its newest epoch: what an upsert table holds."""
    w = Window.partitionBy(*keys).orderBy(F.desc("epoch"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "epoch")
