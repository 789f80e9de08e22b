"""Connected components of an edge table, by joins and groupings alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayengine.session import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the component's least node.

    Alternating star contraction: each node first sends all larger neighbours, then its smaller ones, to the least
    of them. A node with very many neighbours is one group of a partial aggregate and one key of a join that
    adaptive execution can split. Rounds grow with the logarithm of a component's length; each is written to the
    shared folder, which cuts the lineage. Loops and repeated edges don't matter; no edges give no rows.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, last = stage(ordered, "edges"), None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.unionByName(small_least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
