"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.shared import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component``: for every node of ``links`` (``a, b``) the smallest node it reaches.

    Every round gives a node the smallest label among its neighbours and then the label of its
    label, so that chains shorten by half. Rounds are written, not kept in lineage.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(),
        "links",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("component")
        ),
        "labels",
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(
            F.col("a").alias("node")
        ).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("low")
        )
        beyond = labels.select(F.col("node").alias("low"), F.col("component").alias("beyond"))
        following = stored(
            lower.join(beyond, "low").select(
                "node", F.least("low", "beyond").alias("component"),
                (F.least("low", "beyond") < F.col("component")).alias("changed"),
            ),
            "labels",
        )
        labels = following.select("node", "component")
        if following.where("changed").isEmpty():
            return labels
