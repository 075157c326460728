"""Connected components of an edge table, by labels that only ever fall."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.sources.scratch import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node each node reaches. `edges` are settled (a, b).

    Each round a node takes the smallest label next to it, then the label of its label, so
    a chain shortens by more than half. Labels are written after each round; the driver sees
    the number of changes only.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    lowest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = settle(lowest.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("via"))
        ends = labels.select(F.col("node").alias("via"), F.col("label").alias("end"))
        moved = settle(step.join(ends, "via", "left").select(
            "node", "was", F.least("via", F.coalesce("end", "via")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label < was").isEmpty():
            return labels
