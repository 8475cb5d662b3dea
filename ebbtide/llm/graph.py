"""Connected components as joins and aggregates, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges`` (columns ``a``, ``b``).

    Rounds of two steps: every node hands its larger neighbours, then its smaller ones, to the
    smallest node around, until all edges are stars. The number of rounds grows with the logarithm
    of the longest path, and no step makes more edges than it gets. Minima are pre-aggregated, so a
    node with very many edges is no more work than the same edges spread; each round is a written
    table, so a lost executor costs no more than one.
    """
    links = written(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v").distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        links = both.join(low, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        low = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(low, "u").selectExpr("v as u", "m as v").where("u <> v")
        links = written(moved.unionByName(low.selectExpr("u", "m as v")).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select("v").distinct().selectExpr("v as node", "v as root")
    return links.selectExpr("u as node", "v as root").unionByName(roots)


def _state(links: DataFrame) -> tuple:
    return tuple(links.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
