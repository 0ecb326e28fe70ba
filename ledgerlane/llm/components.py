"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import shared_root


def components(edges: DataFrame) -> DataFrame:
    """Per node of an edge (src, dst): node, root (the smallest node reachable).

    Every round ties each node to the smallest of its neighbours and ties those neighbours to it in
    turn, which at least halves the length of the longest path; no node ever gathers its neighbours
    in one place, minima and joins do. Rounds are kept in the shared folder by ``checkpoint()``.
    """
    shared_root(edges.sparkSession)
    pairs = edges.select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).where("u > v").distinct().checkpoint()
    previous = None
    while True:
        # each node's smallest smaller neighbour; larger neighbours move over to it
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        both = pairs.join(low, "u")
        grafted = both.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = low.select("u", F.col("m").alias("v")).unionAll(grafted).distinct()
        # a node tied to one that is itself tied is tied to that one's neighbour
        up = stars.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), "m")
        pairs = (
            stars.join(up, "v", "left")
            .select("u", F.coalesce("m", "v").alias("v"))
            .unionAll(stars.join(up, "v").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct().checkpoint()
        )
        state = pairs.agg(
            F.count("*").alias("n"), F.countDistinct("u").alias("nodes"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark"),
        ).first()
        if state["n"] == state["nodes"] and state == previous:
            break
        previous = state
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots).distinct()
