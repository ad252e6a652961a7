"""Connected components of links between any ids, as joins and grouped minima.

Every node takes the smallest label among itself and its neighbours, then the label of its label
(which halves the length of chains), until nothing changes.  Labels are node ids; every round is
written to the checkpoint folder, and only the number of changed nodes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for all nodes in ``links`` (columns ``a, b``); the component is its smallest node."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.least("component", "m").alias("c"), F.col("component").alias("old"))
        root = labels.select(F.col("node").alias("r"), F.col("component").alias("rc"))  # labels of labels
        new = materialize(hooked.join(root, hooked["c"] == root["r"]).select("node", F.least("c", "rc").alias("component"), "old"), "labels")
        labels = new.select("node", "component")
        if new.where("component <> old").isEmpty():
            return labels


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (``node, component``) after adding links: only links between classes are followed, as links of their
    components, so what is settled is not gone through again."""
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = materialize(classes.select("node", "component").unionByName(
        ends.join(classes, "node", "left_anti").select("node", F.col("node").alias("component"))), "known")
    of = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    between = links.select("a", "b").join(of("a"), "a").join(of("b"), "b").where("ca <> cb")
    between = materialize(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "between")
    if between.isEmpty():
        return known
    merged = components(between).select(F.col("node").alias("old"), F.col("component").alias("new"))
    out = known.join(merged, known["component"] == merged["old"], "left")
    return materialize(out.select("node", F.coalesce("new", "component").alias("component")), "classes")
