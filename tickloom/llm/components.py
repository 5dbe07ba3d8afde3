"""Connected components of an edge table by alternating large and small stars.

Every round is a few joins and groupings over the edges, written to the shared folder, so the plan does not
grow and a lost executor costs one round at most. Only a count and a checksum of the edges reach the
driver. A hub's edges are reduced to a minimum before they are shuffled; the join that hands the
minimum back is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage


def _state(edges: DataFrame) -> tuple:
    checks = F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.crc32(F.concat_ws(",", "u", "v"))).alias("s")
    return tuple(edges.agg(F.count("*").alias("n"), *checks).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge other than the roots themselves; the root is the
    smallest node of the component. ``edges`` has integer columns ``u`` and ``v``."""
    edges = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no components after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
