"""Joins (JN-01..09, SET-01, TOP-01).

Joins are plain equi-joins; the strategy (broadcast hash vs sort-merge vs
shuffled hash) is left to Spark: with adaptive execution on, a side whose
*measured* size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
is broadcast at run time, and skewed partitions of the big side are split
(``spark.sql.adaptive.skewJoin.enabled``).  No hint forces a broadcast of a
side whose size grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_fill(dim: DataFrame, agg: DataFrame, key: str | Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """JN-01: every dimension row, its aggregate or the fill values."""
    return dim.join(agg, key, "left").fillna(dict(fill))


def enrich_with_products(facts: DataFrame, products: DataFrame, key: str = "product_id", price: str = "price",
                         cost: str = "cost", qty: str = "quantity") -> DataFrame:
    """JN-02: facts with product attributes and profit = (price - cost) * quantity."""
    j = facts.join(products, key, "left")
    return j.withColumn("profit", (F.col(price) - F.col(cost)) * F.col(qty))


def attach_entity_features(facts: DataFrame, users: DataFrame, items: DataFrame, user: str = "user_id",
                           item: str = "item_id") -> DataFrame:
    """JN-05: interaction rows with user and item feature rows (key joins, never positional)."""
    return facts.join(users, user).join(items, item)


def unscored(candidates: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """JN-07: rows whose id has no prediction yet (incremental scoring)."""
    return candidates.join(scored.select(key), key, "left_anti")


def attach_labels(predictions: DataFrame, labels: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """JN-08 / JN-09: predictions with late-arriving labels (inner equi-join on the id, H13)."""
    return predictions.join(labels, key)


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-01: union by column name (``pd.concat``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """TOP-01: sort and keep n rows (planned as a per-task top-n and a merge)."""
    return df.orderBy(*order).limit(n)
