"""Connected components by alternating large-star and small-star steps, all on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import drop_written, written


def _state(edges: DataFrame) -> tuple:
    """What tells two edge sets apart: their number and a checksum."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the least node of its neighbourhood.

    The minima are written before the edges join them: both sides of the join are then plain shuffles, of which Spark
    may split a hub's.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of them."""
    edges = written(edges, "edges")
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    Edges with a null end and loops join nothing; repeated edges count once; no edges give an empty result. A hub's
    minimum is pre-aggregated on the map side and its edges meet it in a join, which Spark can split; each round is
    written to the shared folder and the one before deleted. The rounds grow with the logarithm of the size of a component.
    """
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    now = written(ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    before = _state(now)
    if before[0]:
        for _ in range(rounds):
            last, now = now, written(_small_star(_large_star(now)), "edges")
            drop_written(last)
            after = _state(now)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"the components have not settled after {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
