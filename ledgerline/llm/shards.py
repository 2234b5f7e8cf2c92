"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards, and every shard has a weight; an inner node weighs what its
shards weigh. A key descends from the root: among the children of a node, the one with the largest weighted hash draw
``ln(u) / weight`` wins, u being a hash of key and child in (0, 1). A child's draw depends on nothing but the key, its
own name and its own weight, so changing a weight moves keys only into or out of the subtrees whose weights changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

ROWS_PER_CELL = 65_536
ROW_OVERHEAD = 16


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has the number of its shard and its own weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 0.0

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"shard-{shard}", (), shard, weight)


def tree(weights: list[float], shards_per_rack: int = 5, racks_per_region: int = 2) -> Node:
    """Shards 0, 1, ... with the given weights, filled rack by rack and region by region."""
    leaves = [leaf(i, weight) for i, weight in enumerate(weights)]
    racks = [
        Node(f"rack-{i}", tuple(leaves[at : at + shards_per_rack]))
        for i, at in enumerate(range(0, len(leaves), shards_per_rack))
    ]
    regions = [
        Node(f"region-{i}", tuple(racks[at : at + racks_per_region]))
        for i, at in enumerate(range(0, len(racks), racks_per_region))
    ]
    return Node("root", tuple(regions))


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard as a region of its own: only the draw between regions sees it, so keys move into it alone."""
    shard = 1 + max(node.shard for node in _level(root, 3))
    region = Node(f"region-of-{shard}", (Node(f"rack-of-{shard}", (leaf(shard, weight),)),))
    return Node(root.name, (*root.children, region))


def _level(root: Node, depth: int) -> list[Node]:
    nodes = [root]
    for _ in range(depth):
        nodes = [child for node in nodes for child in node.children]
    return nodes


def _winner(key: Column, candidates: list[tuple[int, Node]]) -> Column:
    """The number of the child with the largest draw; a child without weight draws nothing."""
    draws = []
    for number, child in candidates:
        if child.weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11)
            draw = F.log((bits + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(child.weight))
            draws.append(F.struct(draw.alias("draw"), F.lit(number).alias("number")))
    if len(draws) < 2:
        return draws[0]["number"] if draws else F.lit(None).cast("int")
    return F.array_max(F.array(*draws))["number"]


def place(df: DataFrame, key: str, root: Node, into: str) -> DataFrame:
    """df with the shard of each row's key in column ``into``. A null key is a key like any other."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null"))
    at = F.lit(0)
    for depth in range(3):
        numbered = list(enumerate(_level(root, depth + 1)))
        chosen, start = None, 0
        for number, node in enumerate(_level(root, depth)):
            own = numbered[start : start + len(node.children)]
            start += len(own)
            pick = _winner(text, own)
            if depth == 0:
                chosen = pick
            else:
                chosen = F.when(at == number, pick) if chosen is None else chosen.when(at == number, pick)
        df = df.withColumn(into, chosen)
        at = F.col(into)
    numbers = F.array(*[F.lit(node.shard) for node in _level(root, 3)])
    return df.withColumn(into, F.element_at(numbers, at + 1))


def assign(df: DataFrame, root: Node, grown: Node | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, slot and (with ``grown``) the shard in the grown tree of every row.

    Returns key, size (UTF-8 bytes of the text plus 16; a null text has none), text_crc32 (a null text counts as empty),
    shard, slot, grown_shard. Slots run from 0 without gaps in each shard, ordered by hash cell and key. Rows of one
    shard are numbered cell by cell (about 65,536 rows), so no task gathers a shard; equal rows share a cell and get
    neighbouring slots. Other columns of df are not carried, whatever their names; an empty df gives no rows.
    """
    shards = len(_level(root, 3))
    narrow = df.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
    )
    narrow = place(narrow, "key", root, "shard")
    narrow = place(narrow, "key", grown, "grown") if grown else narrow.withColumn("grown", F.lit(None).cast("int"))
    narrow = stored(narrow, "shards")
    cells = max(8, -(-narrow.count() // (shards * ROWS_PER_CELL)))
    narrow = narrow.withColumn("cell", F.pmod(F.xxhash64("key", "crc", F.lit("cell")), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        narrow.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "cell").orderBy("key", "crc", "size")
    numbered = narrow.withColumn("rank", F.row_number().over(inside))
    return numbered.join(starts, ["shard", "cell"]).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"), F.col("grown").alias("grown_shard"),
    )
