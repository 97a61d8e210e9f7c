"""Connected components of an edge table by rounds of contraction.

Each round every node points to its smallest neighbour or itself, the pointers
are followed to their ends by self-joins, and the edges are rewritten between the
ends; what remains has at most half of the nodes. Only joins and minimum
aggregates run, so a node with any number of neighbours is never gathered, and
every table is written, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import materialize


def _ends(pointers: DataFrame) -> DataFrame:
    """``node, to`` with every pointer followed to its end."""
    pointers = materialize(pointers, "pointers")
    while True:
        further = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moved = materialize(pointers.join(further, "to").select(
            "node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "pointers")
        pointers = moved.select("node", "to")
        if moved.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another; ``root`` is the
    smallest node of its component."""
    edges = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    ends = lambda e: e.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        e.select(F.col("b").alias("node"), F.col("a").alias("near")))
    roots = None
    while not edges.isEmpty():
        to = _ends(ends(edges).groupBy("node").agg(F.min(F.least("near", "node")).alias("to")))
        roots = to.select("node", F.col("to").alias("root")) if roots is None else materialize(
            roots.join(to.select(F.col("node").alias("root"), "to"), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")), "roots")
        edges = materialize(
            edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if roots is None:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return roots
