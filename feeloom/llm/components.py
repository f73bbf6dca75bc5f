"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeloom.llm.common import materialize


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b), both of one orderable type.

    Every round hangs each node on the smallest of its neighbours, first those above it and then those below, until
    nothing changes: then each component is a star around its smallest node. A round moves no more rows than there are
    links, and is written to the scratch folder.
    """
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, f"{purpose}-0")
    state = None
    turn = 0
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        # Now every link leads from a node to a smaller one.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = materialize(small.where(F.col("a") != F.col("b")).distinct(), f"{purpose}-{turn}")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()  # one row
        if new == state:
            break
        state = new
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
