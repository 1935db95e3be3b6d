"""Connected components of a graph given as edges, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.tables import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b) that is linked with a lesser one; root is the least.

    Each round hangs the neighbours of a node on the least of them, which halves the depth of the
    trees or better; rounds end when nothing changes. Only two numbers a round come to the driver.
    """
    current = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _mark(current)
    while before[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialise(least.select("u", F.col("m").alias("v")).union(hung).distinct(), "small-star")
        now = _mark(current)
        if now == before:
            break
        before = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
