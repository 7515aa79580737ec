"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import checkpointed

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b); component is the smallest node reachable.

    Large-star hangs each larger neighbour of a node on its smallest neighbour, small-star each smaller
    one; repeated, every component becomes a star around its smallest node in about log2(n) rounds. Each
    round is two aggregations with partial sums and is written to the checkpoint folder; only a row count
    and a checksum reach the driver. Rows with nulls and loops are ignored.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), name)
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = checkpointed(small, name)
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return (now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
