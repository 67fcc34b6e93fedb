"""Connected components of a graph held as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitloom.session import settle


def component_labels(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach, of every node of ``links(a, b)``.

    Each round a node takes the smallest label among itself and its
    neighbours, then the label of that label, so that labels travel twice as
    far each time.  Every round is written to the shared folder: lineage stays
    short and a lost executor costs one round.  Hubs are no problem: their
    labels are combined before the shuffle, and their links can be split in the
    join.
    """
    both = settle(
        links.filter(F.col("a") != F.col("b"))
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
        .select("l.a", "l.b")
        .distinct(),
        "links",
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("_seen"))
        )
        hooked = settle(
            labels.join(seen, "node").select(
                "node", F.col("label").alias("_old"), F.least("label", "_seen").alias("label")
            ),
            "labels",
        )
        jumps = hooked.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        labels = settle(
            hooked.join(jumps, "label").select("node", "_old", F.least("label", "_far").alias("label")), "labels"
        )
        if labels.filter(F.col("label") != F.col("_old")).isEmpty():
            return labels.select("node", "label")
        labels = labels.drop("_old")
