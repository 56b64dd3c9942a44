"""Connected components of a table of edges, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaudit.llm.shared import stage


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """``(node, root)`` for every node of an edge; the root is a node of its component.

    Each round points every node at its smallest neighbour if that is smaller,
    replaces the ends of all edges by what they point at and drops edges that
    have become loops. The number of nodes that still have edges at least
    halves, so rounds are few; every round is written to the shared folder,
    and nothing but row counts reaches the driver. A hub only enters
    aggregates and joins of written sides, which Spark can split.
    """
    rest = edges.select(F.col(first).alias("u"), F.col(second).alias("v")).where("u <> v").distinct()
    rest = stage(rest, "edges")
    labels = stage(
        rest.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")), "labels"
    )
    while not rest.isEmpty():
        ends = F.explode(
            F.array(
                F.struct(F.col("u").alias("from"), F.col("v").alias("to")),
                F.struct(F.col("v").alias("from"), F.col("u").alias("to")),
            )
        )
        smallest = rest.select(ends.alias("end")).groupBy("end.from").agg(F.min("end.to").alias("to"))
        moves = stage(smallest.where("`to` < `from`"), "moves")
        rest = stage(
            rest.join(moves.withColumnsRenamed({"from": "u", "to": "u2"}), "u", "left")
            .join(moves.withColumnsRenamed({"from": "v", "to": "v2"}), "v", "left")
            .select(F.coalesce("u2", "u").alias("u"), F.coalesce("v2", "v").alias("v"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
        labels = stage(
            labels.join(moves.withColumnsRenamed({"from": "root", "to": "next"}), "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            ),
            "labels",
        )
    return labels
