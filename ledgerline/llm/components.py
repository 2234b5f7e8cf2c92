"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (node, other). Every node sends the smallest of its neighbours and itself to its larger neighbours (large)
    or to its smaller ones and itself (small)."""
    if large:
        both = links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    else:
        both = links.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    lowest = both.groupBy("node").agg(F.min("other").alias("low"))
    lowest = lowest.select("node", F.least("node", "low").alias("low"))
    if large:
        sent = both.filter("other > node").join(lowest, "node").select(F.col("other").alias("node"), F.col("low").alias("other"))
    else:
        sent = both.join(lowest, "node").select(F.col("other").alias("node"), F.col("low").alias("other")).union(lowest)
    return sent.filter("node <> other").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns node, other): root is the smallest node reachable, possibly the
    node itself. Links may repeat, point either way or to the node itself. Each round is written to the shared folder;
    a node with very many links is aggregated before it is moved."""
    at = stored(links.select("node", "other").filter("node <> other").distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        at = stored(_star(_star(at, True), False), "links")
        state = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = at.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct()
    return at.select("node", F.col("other").alias("root")).union(roots)
