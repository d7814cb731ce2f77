"""Connected components over tables of links, without a driver-side graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """links: a, b (longs, not null). Returns node, root: the smallest node that each linked node reaches.

    Each round every node takes its smallest neighbour or itself, chains of
    takers are jumped to their ends, and links are rewritten between the ends.
    A round leaves only local minima, so rounds are few.  Every table of a round
    is written to the shared folder.
    """
    both = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(both, "links")
    roots = None
    while not edges.isEmpty():
        sides = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("next")))
        parent = materialize(sides.groupBy("node").agg(F.min("next").alias("low")).select("node", F.least("node", "low").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            parent = materialize(parent.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("new"), "root"), "jumped")
            moved = parent.where("new <> root").isEmpty()
            parent = parent.select("node", F.col("new").alias("root"))
            if moved:
                break
        if roots is None:
            roots = parent
        else:
            ends = parent.select(F.col("node").alias("root"), F.col("root").alias("end"))
            roots = materialize(roots.join(ends, "root", "left").select("node", F.coalesce("end", "root").alias("root")), "roots")
        for side in ("a", "b"):
            ends = parent.select(F.col("node").alias(side), F.col("root").alias("end"))
            edges = edges.join(ends, side, "left").withColumn(side, F.coalesce("end", side)).drop("end")
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = materialize(edges, "links")
    return both.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if roots is None else roots
