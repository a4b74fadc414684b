"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.shared_storage import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that is reachable, for every node of ``links`` (a, b).

    Each round takes the smallest label among a node and its neighbours and then the label of that
    label, so long chains shrink fast. Groupings combine before the shuffle, so a node with very many
    links is one row per task. Every round is written to the shared folder; no links give no rows.
    """
    both = settle(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select("b", "a"))
        .distinct()
    )
    labels = settle(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.least("component", "near").alias("to"), F.col("component").alias("was")
        )
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("next"))
        moved = settle(
            lower.join(jump, "to").select("node", F.least("to", "next").alias("component"), "was")
        )
        labels = moved.select("node", "component")
        if moved.where(F.col("component") != F.col("was")).isEmpty():
            return labels
