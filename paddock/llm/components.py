"""Connected components of links between tags, by alternating large and small stars.

Every step is a minimum over the neighbours of a node, combined before the shuffle, and a
join that gives each link that minimum.  A node may have any number of links.  Steps are
stored tables, nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (node, to), node > to, after one large-star or small-star step."""
    seen = links.select("node", "to")
    if large:
        seen = seen.union(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
    least = seen.groupBy("node").agg(F.least("node", F.min("to")).alias("least"))
    # both sides are stored, so that adaptive execution can split a node with very many links
    least = materialize(least, "least")
    joined = seen.join(least, "node")
    if large:
        out = joined.where("to > node").select(F.col("to").alias("node"), F.col("least").alias("to"))
    else:
        own = least.select("node", F.col("least").alias("to"))
        out = joined.select(F.col("to").alias("node"), F.col("least").alias("to")).union(own)
    return out.where("node > to").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, to) for every node that is not the smallest of its component ``to``."""
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))
    now = materialize(ordered.distinct(), "stars")
    state = _state(now)
    while state[0]:
        now = materialize(_star(materialize(_star(now, large=True), "stars"), large=False), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    return now


def _state(links: DataFrame) -> tuple:
    """Links only ever move to smaller ends, so equal sums mean that nothing moved."""
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.col("to").cast("decimal(38,0)")), F.sum(F.col("node").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
