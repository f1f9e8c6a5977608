"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest
    node. Each round takes the smallest name among the neighbours and then the name of that name, so
    that long chains shrink fast. Rounds end when no name changes."""
    both = written(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a != b").distinct()
    )
    names = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        .select("node", F.least("node", "other").alias("component"))
    )
    while True:
        near = (
            both.join(names.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        least = names.join(near, "node").select(
            "node", "component", F.least("component", "near").alias("least")
        )
        jumped = least.alias("l").join(
            names.select(F.col("node").alias("at"), F.col("component").alias("next")),
            F.col("l.least") == F.col("at"),
        )
        new = written(
            jumped.select("node", F.col("next").alias("component"), F.col("l.component").alias("old"))
        )
        if new.where("component != old").isEmpty():
            return names
        names = new.select("node", "component")
