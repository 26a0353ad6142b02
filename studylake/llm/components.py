"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with a link; label is the least node reachable.

    Each round takes the least label among a node's neighbours, offers it to the
    node and to the node's present label, and then follows labels one step, so
    that long chains halve. Nodes, labels and links stay in tables; a node with
    many links is pre-aggregated, and the joins read stored tables on both sides
    so that adaptive execution can split it. NULL ends are left out.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter(
        F.col("node").isNotNull() & F.col("other").isNotNull() & (F.col("node") != F.col("other")))
    both = materialize(
        both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
        .distinct())
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("_least")).select(
        "node", F.least("node", "_least").alias("label")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "label"), "other")
        near = materialize(seen.groupBy("node").agg(F.min("label").alias("near")))
        better = labels.join(near, "node").filter(F.col("near") < F.col("label"))
        offers = better.select("node", "near").unionByName(
            better.select(F.col("label").alias("node"), "near"))
        offers = materialize(offers.groupBy("node").agg(F.min("near").alias("offer")))
        if offers.isEmpty():
            return labels
        hooked = materialize(labels.join(offers, "node", "left").select(
            "node", F.least("label", "offer").alias("label")))
        step = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = materialize(hooked.join(step, "label", "left").select(
            "node", F.coalesce("further", "label").alias("label")))
