"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of ``edges`` (a, b), both long.

    Every vertex is merged into its smallest neighbour until no edge is left
    between two; each round is written to the shared folder.  The number of
    rounds is about the logarithm of the longest path.
    """
    edges = stage(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b").distinct(), "edges")
    labels = stage(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component")), "components")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        into = stage(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "into")
        left, right = into.select(F.col("a").alias("x"), F.col("p").alias("px")), into.select(F.col("a").alias("y"), F.col("p").alias("py"))
        edges = stage(
            edges.join(left, F.col("a") == F.col("x")).join(right, F.col("b") == F.col("y"))
            .filter("px != py").select(F.least("px", "py").alias("a"), F.greatest("px", "py").alias("b")).distinct(),
            "edges",
        )
        labels = stage(
            labels.join(into, F.col("component") == F.col("a"), "left").select("id", F.coalesce("p", "component").alias("component")),
            "components",
        )
    return labels
