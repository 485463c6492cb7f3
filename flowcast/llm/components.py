"""Connected components of an edge table by alternating large and small stars."""

from pyspark.sql import functions as F

from flowcast.sources.staging import stage


def components(edges, label="components"):
    """(node, root) for every node of the edges (a, b), root being the smallest node reachable.

    Each round lets every node point its larger neighbours at the smallest one it knows (large
    star), then its smaller ones (small star). Minima are pre-aggregated, and joined back with
    adaptive splitting, so a node with very many neighbours is no bottleneck. Every round
    is written to the shared folder, which cuts the lineage. Rounds grow with the logarithm
    of the longest chain. Loops and repeated edges are allowed; null ends are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = stage(edges, label), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = edges.join(low, "b").select("a", F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low.select("a", F.col("m").alias("b"))))
        edges = stage(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
