"""Connected components of a link table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``v`` and ``label`` (the least vertex of its component) for all ends of ``edges`` (u, v).

    Each round a vertex takes the least label around it, then the label of that label; labels are written each
    round.  A vertex with many links is cut to one row per task before its exchange.
    """
    both = stage(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    own = both.select(F.col("u").alias("v"), F.col("u").alias("label")).distinct()
    near = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("near"))
    labels = stage(own.join(near, "v").select("v", F.least("label", "near").alias("label")), "labels")
    while True:
        around = (
            both.join(labels, "v")
            .groupBy(F.col("u").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(around, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        after = stage(
            lower.join(jump, "label", "left").select("v", "old", F.least("label", F.coalesce("next", "label")).alias("label")),
            "labels",
        )
        labels = after.select("v", "label")
        if after.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
