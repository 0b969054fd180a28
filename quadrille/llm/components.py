"""Connected components over an edge table, in DataFrame operations only.

Alternating large-star and small-star rounds: every round replaces a node's neighbours by links to the smallest of
them, so the edge count never grows and the number of rounds grows with the logarithm of a component's diameter.
Each round is written to the shared folder, which keeps plans short and lets a lost executor be replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialise, scope


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def _least(edges: DataFrame) -> DataFrame:
    """Of every node: its smallest neighbour and how many it has."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = heavy_join(both.where("v > u"), _least(both), ["u"], "n", total=2 * n)
    return materialise(starred.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "edges")


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Edges run from a larger to a smaller node."""
    least = _least(edges)
    moved = heavy_join(edges, least, ["u"], "n", total=n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialise(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Return ``(node, component)`` for every node of ``edges (u, v)``; a component is named by its smallest node.

    ``u`` and ``v`` may be of any one type with an order.  Self-links and repeated links change nothing, links with
    a null end are left out, and an empty table gives an empty result.  A hub with very many links is aggregated
    before the shuffle, and its links are dealt in parts where they meet their smallest.
    """
    with scope(edges.sparkSession) as own:
        clean = edges.select("u", "v").where("u is not null and v is not null and u <> v")
        current = materialise(clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = _digest(current)
        for _ in range(max_rounds):
            if not now[0]:
                break
            current = _small_star(_large_star(current, now[0]), now[0])
            was, now = now, _digest(current)
            own.clear(current)
            if was == now:
                break
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        return own.keep(current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))
