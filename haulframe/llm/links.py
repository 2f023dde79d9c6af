"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulframe.llm.landed import landed

MAX_ROUNDS = 200  # a chain of n links takes about log n rounds; running out is an error, never a cut


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of the links ``a``, ``b``.

    Each round hangs the larger neighbours of a node, then the node and its smaller neighbours, on the
    smallest of them, until every node hangs on a root directly. No neighbour list is built, so a node
    with very many links is only a key with many rows of joins that adaptive execution splits. Rounds
    are written to the shared folder.
    """
    edges = landed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    for _ in range(MAX_ROUNDS):
        # one aggregate, as every shuffle of a round is state that the driver holds
        roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
        )
        loose = roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if loose.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty():
            roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # edges hold each pair once with u the larger; seen from v, u is a larger neighbour
        larger = edges.join(low.withColumnRenamed("u", "v"), "v").where("u <> m").select("u", F.col("m").alias("v"))
        larger = landed(larger.distinct(), label)
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = landed(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
