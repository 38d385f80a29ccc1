"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.session import ensure_checkpoint_dir


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    """For (u, v) rows: every row with ``m``, the smallest of u and its v's."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("_m"))
    return pairs.join(smallest, "u").select("u", "v", F.least("u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _min_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _min_neighbour(down)
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        starred.select("u", F.col("m").alias("v"))
    )


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(``node``, ``root``) for each node of the undirected edges ``u``, ``v`` (longs).

    ``root`` is the smallest node of the component. Every round halves the trees at
    least roughly; rounds end when the edge set stays the same. Rounds are cut off from
    each other by reliable checkpoints; only two numbers a round reach the driver.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def distinct_edges(e: DataFrame) -> DataFrame:
        return e.where("u <> v").distinct()

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    current = distinct_edges(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).checkpoint()
    before = state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        current = distinct_edges(_small_star(_large_star(current))).checkpoint()
        now = state(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
