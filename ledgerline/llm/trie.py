"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt into shards of neighbouring ids. A shard indexes every (position, turn) by the bitset of the
conversations that have the turn there, and every length by the bitset of those that end there. Walking depth first,
the intersection of a node's bitset with the posting of a next turn is a child; its popcount is the number of members,
its intersection with the ends of its depth the end list. Nodes of different shards are one node where the digests of
their paths agree. What holds for all shards (smallest member, number of members, childless or not) is merged by
digest; sums over subtrees are then taken inside the shards, each node counting in the shard of its smallest member, and
merged by digest again. A turn or a path that very many conversations share is one row in each shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: A shard is closed by the first conversations that reach one of these: bounds of its bitmaps.
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 200_000
ROWS_AT_ONCE = 20_000
ROOT = bytes(16)

Turn = tuple[bytes, int]  # digest and bytes of the text
Rebuild = Callable[[int, dict[int, list[Turn]]], dict[int, list[Turn]]]

LOCAL = pa.schema([
    ("shard", pa.int64()), ("number", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("low", pa.int64()),
    ("n", pa.int64()), ("size", pa.int64()), ("n_ends", pa.int64()), ("ends", pa.string()),
])
SUMS = pa.schema([
    ("shard", pa.int64()), ("node", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
    ("parent_conv_id", pa.int64()),
])
NODES = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
DDL = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {DDL[field.type]}" for field in schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


class Bitmaps:
    """The index of one shard. Conversations are added in the order of their ids; bit i stands for the i-th."""

    def __init__(self, most: int = SHARD_CONVERSATIONS) -> None:
        self.most = most
        self.ids: list[int] = []
        self.paths: list[list[bytes]] = []
        self.turns = 0
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ends: dict[int, int] = {}
        self.size: dict[bytes, int] = {}

    def add(self, conv: int, turns: list[Turn]) -> None:
        bit = 1 << len(self.ids)
        for at in enumerate(digest for digest, _ in turns):
            self.postings[at] = self.postings.get(at, 0) | bit
        self.size.update(turns)
        self.ends[len(turns)] = self.ends.get(len(turns), 0) | bit
        self.ids.append(conv)
        self.paths.append([digest for digest, _ in turns])
        self.turns += len(turns)

    def full(self) -> bool:
        return len(self.ids) >= self.most or self.turns >= SHARD_TURNS

    def nodes(self) -> Iterator[tuple]:
        """LOCAL rows of the shard's trie, every node before its descendants and after its elder siblings' ones."""
        if not self.ids:
            return
        number, open_ = 0, [(0, ROOT, 0, (1 << len(self.ids)) - 1)]
        while open_:
            depth, node, size, members = open_.pop()
            ended = members & self.ends.get(depth, 0)
            low = (members & -members).bit_length() - 1
            yield (self.ids[0], number, depth, node, self.ids[low], members.bit_count(), size, ended.bit_count(),
                   ",".join(str(self.ids[i]) for i in bits(ended)))
            number += 1
            going = members ^ ended
            while going:
                turn = self.paths[(going & -going).bit_length() - 1][depth]
                child = going & self.postings[depth, turn]
                open_.append((depth + 1, hashlib.md5(node + turn).digest(), self.size[turn], child))
                going ^= child


def bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def as_they_are(_: int, block: dict[int, list[Turn]]) -> dict[int, list[Turn]]:
    return block


def local_nodes(rows: Iterator[tuple], rebuild: Rebuild, most: int) -> Iterator[tuple]:
    """rows: (block, conversation, digest, size), a conversation's turns in order, blocks and conversations ascending."""
    shard, block, turns = Bitmaps(most), None, {}

    def close() -> None:
        for conv, path in sorted(rebuild(block, turns).items()):
            shard.add(conv, path)

    for at, conv, digest, size in rows:
        if at != block:
            if turns:
                close()
                if shard.full():
                    yield from shard.nodes()
                    shard = Bitmaps(most)
            block, turns = at, {}
        turns.setdefault(conv, []).append((digest, size))
    if turns:
        close()
    yield from shard.nodes()


def subtree_sums(rows: Iterator[tuple]) -> Iterator[tuple]:
    """SUMS rows from (shard, depth, node, conv_id, n_convs, own, leaf, size, ends), each node after its descendants."""
    below: dict[int, list[int]] = {}    # sums over the nodes of a depth whose parent is still to come
    waiting: dict[int, list[tuple]] = {}  # and these nodes
    for shard, depth, node, conv, n, own, leaf, size, ends in rows:
        children, leaves, saved = below.pop(depth + 1, (0, 0, 0))
        if own:
            leaves, saved = leaves + leaf, saved + (n - 1) * size
        for child in waiting.pop(depth + 1, ()):
            yield (*child, conv)
        row = (shard, node, depth, conv, n, children, leaves, saved, ends)
        if not depth:
            yield (*row, None)
            continue
        sums = below.setdefault(depth, [0, 0, 0])
        sums[0] += own
        sums[1] += leaves
        sums[2] += saved
        waiting.setdefault(depth, []).append(row)


def merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """NODES rows from SUMS rows in order of node and shard. An end list is hashed as it streams by."""
    last = None
    for shard, node, depth, conv, n, children, leaves, saved, ends, parent in rows:
        if node != last:
            if last is not None:
                yield (*head, *total, digest.hexdigest())
            last, head, total, digest, any_end = node, (conv, depth, parent, n), [0, 0, 0], hashlib.sha256(), False
        total = [a + b for a, b in zip(total, (children, leaves, saved))]
        if ends:
            digest.update(f",{ends}".encode() if any_end else ends.encode())
            any_end = True
    if last is not None:
        yield (*head, *total, digest.hexdigest())


def prefix_trie(
    df: DataFrame, block: Column | None = None, rebuild: Rebuild = as_they_are, conv_id: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text", shard_conversations: int = SHARD_CONVERSATIONS,
) -> DataFrame:
    """The nodes of the trie of all conversations: NODES.

    A conversation is its rows in order of turn, null first; equal turns stand in order of role and of the digest of their
    text, so repeated rows are turns next to each other. Null role or text count as empty. Rows without a conv_id belong
    to no conversation and are left out; an empty df has no nodes, not even a root. Conversations of one ``block`` (a
    non-decreasing function of conv_id; by default each is its own) are handed to ``rebuild`` together, as {conv_id:
    [(digest, bytes of the text)]} with the block's value, and enter the trie as it returns them, with turns or without.
    Other columns are not read, whatever their names. Paths are compared by 128-bit digests of role and text.
    """
    said, speaker = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    turns = df.filter(F.col(conv_id).isNotNull()).select(
        (F.col(conv_id) if block is None else block).cast("long").alias("block"), F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"), speaker.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(speaker).cast("string"), F.lit(" "), speaker, said))).alias("digest"),
        F.octet_length(said).cast("long").alias("size"),
    )
    in_order = turns.repartitionByRange("block").sortWithinPartitions(
        "block", "conv", F.asc_nulls_first("turn"), "role", "digest"
    )
    local = in_order.select("block", "conv", "digest", "size").mapInArrow(
        lambda batches: batches_of(local_nodes(rows_of(batches), rebuild, shard_conversations), LOCAL), ddl(LOCAL)
    )
    local = stored(local, "trie")
    everywhere = Window.partitionBy("node")
    known = local.withColumns({
        "conv_id": F.min("low").over(everywhere), "n_convs": F.sum("n").over(everywhere),
        "all_ends": F.sum("n_ends").over(everywhere),
    })
    from_below = known.repartition("shard").sortWithinPartitions("shard", F.desc("number")).select(
        "shard", "depth", "node", "conv_id", "n_convs", (F.col("low") == F.col("conv_id")).cast("long").alias("own"),
        (F.col("all_ends") == F.col("n_convs")).cast("long").alias("leaf"), "size", "ends",
    )
    sums = from_below.mapInArrow(lambda batches: batches_of(subtree_sums(rows_of(batches)), SUMS), ddl(SUMS))
    by_node = sums.repartition("node").sortWithinPartitions("node", "shard")
    return by_node.mapInArrow(lambda batches: batches_of(merged(rows_of(batches)), NODES), ddl(NODES))
