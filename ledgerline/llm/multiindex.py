"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length one and cut into halves; each half has a codebook of its own (k-means on a bounded sample), and
the product of the two codebooks is a grid of cells. Every vector is indexed in its own cell and, as a query, visits the
cells in the order of the multi-sequence traversal: by the sum of its two halves' squared distances to the cell's two
codewords. How many cells are visited is set by measurement: sample queries are compared with all vectors until enough of
them have neighbours, and the traversal goes as far as these neighbours' cells require for the target recall. Where
neighbours are too rare for that, it also goes as far as neighbours made at the threshold require. Pairs that meet in a cell are
verified by cosine in double precision, block by block.

Equal vectors are one class. A cell with many vectors or visitors is cut into blocks that are compared task by task. A
block gives, for each vector, its number of links and the root of its component within the block, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import stored

#: Bounds of what the driver fits and measures on, and of a block's rows.
FIT_ROWS, SAMPLE_QUERIES, BLOCK = 20_000, 256, 1024
ROWS_PER_CELL, MOST_CODEWORDS = 32, 256
TARGET = 0.995
#: Sample queries are drawn in growing blocks until so many have neighbours, all rows are drawn, or MOST_QUERIES are.
ENOUGH, LARGEST_DRAW, MOST_QUERIES = 256, 4096, 1 << 18
#: Cells that every query visits, even where the neighbours' cells require fewer.
LEAST_VISITS = 8
FOUND = "node long, links long, root long"


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # the squares of very large or small values stay in range
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    draw = np.random.default_rng(seed)
    words = rows[draw.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        own = distances(rows, words).argmin(axis=1)
        count = np.bincount(own, minlength=len(words))
        for d in range(rows.shape[1]):
            total = np.bincount(own, rows[:, d], len(words))
            words[:, d] = np.where(count > 0, total / np.maximum(count, 1), words[:, d])
    return words


def distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ words.T + (words**2).sum(1)


class Grid:
    """The two codebooks. Cell number: word of the first half * words of the second + word of the second."""

    def __init__(self, rows: np.ndarray, words: int, seed: int = 3):
        self.cut = max(1, rows.shape[1] // 2)
        self.first = k_means(rows[:, : self.cut], words, seed)
        self.second = k_means(rows[:, self.cut :], words, seed + 1)
        self.cells = len(self.first) * len(self.second)

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(rows[:, : self.cut], self.first), distances(rows[:, self.cut :], self.second)

    def own(self, rows: np.ndarray) -> np.ndarray:
        first, second = self.halves(rows)
        return first.argmin(1) * len(self.second) + second.argmin(1)

    def visited(self, rows: np.ndarray, most: int) -> np.ndarray:
        """The first ``most`` cells of each row's multi-sequence traversal, the row's own cell first.

        A cell among the first ``most`` has words of ranks (i, j) with (i + 1) * (j + 1) <= most: all cells before it in both
        sequences come earlier. Only those are compared.
        """
        most = min(most, self.cells)
        first, second = self.halves(rows)
        order_1, order_2 = first.argsort(1, kind="stable"), second.argsort(1, kind="stable")
        first, second = np.take_along_axis(first, order_1, 1), np.take_along_axis(second, order_2, 1)
        pairs = [(i, j) for i in range(first.shape[1]) for j in range(second.shape[1]) if (i + 1) * (j + 1) <= most]
        i, j = np.array(pairs).T
        total = first[:, i] + second[:, j]
        chosen = total.argsort(1, kind="stable")[:, :most]
        row = np.arange(len(rows))[:, None]
        return order_1[row, i[chosen]] * len(self.second) + order_2[row, j[chosen]]


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def traversal_length(classes: DataFrame, grid: Grid, dimension: int, threshold: float, target: float) -> int:
    """Cells to visit so that sample queries reach the target share of their true neighbours, on average."""
    drawn = classes.select("node", "vector", F.xxhash64("node", F.lit("query")).alias("draw"))
    ranks, met, seen, size, unfinished = [], 0, 0, SAMPLE_QUERIES, True
    rest = drawn
    while True:
        sample = rest.orderBy("draw", "node").limit(size).toPandas()
        if not len(sample):
            unfinished = False
            break
        found = neighbour_ranks(classes, grid, dimension, threshold, sample)
        ranks.append(found.assign(query=found["query"] + seen))
        met, seen = met + found["query"].nunique(), seen + len(sample)
        if met >= ENOUGH or seen >= MOST_QUERIES:
            break
        draw, node = int(sample["draw"].iloc[-1]), int(sample["node"].iloc[-1])
        rest = drawn.filter((F.col("draw") > draw) | ((F.col("draw") == draw) & (F.col("node") > node)))
        size = min(4 * size, LARGEST_DRAW, MOST_QUERIES - seen)
    least = LEAST_VISITS
    if met < ENOUGH and unfinished:
        least = max(least, made_ranks(unit(np.stack(sample["vector"][:ENOUGH])), grid, threshold, target))
    found = pd.concat(ranks) if ranks else pd.DataFrame()
    if not len(found):
        return least
    share = found["pairs"] / found.groupby("query")["pairs"].transform("sum") / found["query"].nunique()
    by_rank = share.groupby(found["rank"]).sum().sort_index().cumsum()
    reached = by_rank.index[np.searchsorted(by_rank.to_numpy(), min(target, by_rank.iloc[-1]) - 1e-9)]
    return max(least, int(reached))


def rank_of(first: np.ndarray, second: np.ndarray, cell: int) -> int:
    """The place of a cell in the traversal of one query with these distances to the words, of equals the last."""
    cost = (first[:, None] + second[None, :]).ravel()
    return int((cost <= cost[cell]).sum())


def neighbour_ranks(classes: DataFrame, grid: Grid, dimension: int, threshold: float, sample: pd.DataFrame) -> pd.DataFrame:
    """(query, rank, pairs): how many neighbours of each sample query stand in the cell of that place in its traversal."""
    queries, nodes = unit(np.stack(sample["vector"])), sample["node"].to_numpy()
    first, second = grid.halves(queries)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[tuple[int, int], int] = {}
        for batch in (whole.slice(at, BLOCK) for whole in batches for at in range(0, whole.num_rows, BLOCK)):
            rows = unit(matrix(batch.column("vector"), dimension))
            cells = grid.own(rows)
            query, row = np.nonzero(queries @ rows.T >= threshold)
            other = nodes[query] != batch.column("node").to_numpy()[row]
            query, row = query[other], row[other]
            pairs = list(zip(query.tolist(), cells[row].tolist()))
            for q, cell in set(pairs) - places.keys():
                places[q, cell] = rank_of(first[q], second[q], cell)
            rank = np.array([places[pair] for pair in pairs], np.int64)
            found = pd.DataFrame({"query": query.astype(np.int64), "rank": rank, "pairs": 1}).groupby(["query", "rank"]).sum()
            yield pa.RecordBatch.from_pandas(found.reset_index().astype("int64"), preserve_index=False)

    found = classes.select("node", "vector").mapInArrow(compare, "query long, rank long, pairs long")
    return found.groupBy("query", "rank").agg(F.sum("pairs").alias("pairs")).toPandas()


def made_ranks(queries: np.ndarray, grid: Grid, threshold: float, target: float) -> int:
    """Cells to visit for the target share of neighbours that lie at the threshold in random directions."""
    away = np.random.default_rng(11).standard_normal(queries.shape)
    away = unit(away - (away * queries).sum(1, keepdims=True) * queries)
    cells = grid.own(threshold * queries + (1 - threshold**2) ** 0.5 * away)
    first, second = grid.halves(queries)
    ranks = np.sort([rank_of(first[q], second[q], cell) for q, cell in enumerate(cells)])
    return int(ranks[int(np.ceil(target * len(ranks))) - 1])


def compare_block(threshold: float, dimension: int):
    """Function for one block: queries (side 0) against the indexed vectors of one cell (side 1)."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, times, own = (table.column(c).to_numpy() for c in ("node", "times", "own"))
        rows = unit(matrix(table.column("vector"), dimension))
        q, x = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near = rows[q] @ rows[x].T >= threshold
        near &= node[q][:, None] != node[x][None, :]
        i, j = np.nonzero(near)
        if not len(i):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        links = np.zeros(len(node), np.int64)
        np.add.at(links, q[i], times[x[j]])
        # A pair is met again from the other side if the indexed vector visits the query's own cell; else both count here.
        visits = table.column("cells").combine_chunks().take(pa.array(x)).to_pylist()
        width = max(map(len, visits))
        visits = np.array([v + [-1] * (width - len(v)) for v in visits])
        cross = np.flatnonzero(own[q[i]] != own[x[j]])
        for at in range(0, len(cross), 1 << 18):
            part = cross[at : at + (1 << 18)]
            once = part[~(visits[j[part]] == own[q[i[part]]][:, None]).any(axis=1)]
            np.add.at(links, x[j[once]], times[q[i[once]]])
        # Smallest vector reachable within the block.
        root = node.copy()
        while True:
            before = root.copy()
            np.minimum.at(root, x[j], root[q[i]])
            np.minimum.at(root, q[i], root[x[j]])
            same = {}
            for n, r in zip(node.tolist(), root.tolist()):  # a vector may be on both sides
                same[n] = min(r, same.get(n, r))
            root = np.array([same[n] for n in node.tolist()])
            if (root == before).all():
                break
        used = np.unique(np.concatenate([q[i], x[j]]))
        return pa.table({"node": node[used], "links": links[used], "root": root[used]})

    return run


def search(classes: DataFrame, grid: Grid, dimension: int, visits: int, threshold: float) -> DataFrame:
    """(node, links, root) for every vector and block with links; columns of classes: node, times, vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(matrix(batch.column("vector"), dimension))
            cells = grid.visited(rows, visits).astype(np.int32)
            ends = np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("times"), batch.column("vector"), pa.array(cells[:, 0]),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ravel()))],
                ["node", "times", "vector", "own", "cells"],
            )

    placed_as = f"node long, times long, vector {classes.schema['vector'].dataType.simpleString()}, own int, cells array<int>"
    placed = stored(classes.mapInArrow(place, placed_as), "placed")
    visitors = placed.select("node", "times", "vector", "own", F.explode("cells").alias("cell"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    # One short row for each cell in use: at most the square of MOST_CODEWORDS.
    indexed = placed.groupBy(F.col("own").alias("cell")).agg(F.count(F.lit(1)).alias("indexed"))
    visiting = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("visiting"))
    sizes = indexed.join(visiting, "cell").select("cell", blocks("indexed").alias("x_blocks"), blocks("visiting").alias("q_blocks"))
    sizes = F.broadcast(stored(sizes, "cells"))
    salt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visitors.join(sizes, "cell").select(
        "cell", salt("q_blocks").alias("q"), every("x_blocks").alias("x"), F.lit(0).alias("side"), "node", "times", "vector",
        "own", F.array().cast("array<int>").alias("cells"),
    )
    right = placed.withColumn("cell", F.col("own")).join(sizes, "cell").select(
        "cell", every("q_blocks").alias("q"), salt("x_blocks").alias("x"), F.lit(1).alias("side"), "node", "times", "vector",
        "own", "cells",
    )
    return left.union(right).groupBy("cell", "q", "x").applyInArrow(compare_block(threshold, dimension), FOUND)


def near_vectors(df: DataFrame, threshold: float = 0.9, target: float = TARGET, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, n_links (other vectors linked directly), component_id (smallest key reachable), kept, for every row.

    A vector that is null, empty, zero, or holds a null or non-finite component links with nothing, vectors of different
    lengths not with each other: every length has an index of its own. Cosines are taken in double precision, from vectors of
    the precision they come in. Rows that share a key are one document for the component. A row without a key is compared with nothing: its
    component is null, it is kept. Other columns are dropped, whatever their names; an empty df gives no rows.
    """
    kind = df.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0)
    rows = rows.select("id", F.when(F.coalesce(sound, F.lit(False)), F.col("vector")).alias("vector"))
    lengths = sorted(r[0] for r in rows.filter("vector is not null").select(F.size("vector")).distinct().collect())
    if not lengths:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"))
    parts = [_linked(rows, dimension, threshold, target) for dimension in lengths]
    classes, found = (reduce(DataFrame.union, tables) for tables in zip(*parts))
    counts = found.groupBy("dimension", "node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("node <> root").select("node", F.col("root").alias("other")))
    known = classes.join(counts, ["dimension", "node"], "left").join(roots, "node", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("root", "node").alias("component")
    )
    component = F.coalesce("component", "id")
    return rows.join(known, "vector", "left").select(
        F.col("id").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _linked(rows: DataFrame, dimension: int, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors of this length, and the links found between them."""
    classes = stored(
        rows.filter(F.size("vector") == dimension).groupBy("vector")
        .agg(F.min("id").cast("long").alias("node"), F.count(F.lit(1)).alias("times")).select("node", "times", "vector"), "classes"
    )
    fitted = classes.orderBy(F.xxhash64("node"), "node").limit(FIT_ROWS).select("vector").toPandas()
    words = int(np.clip(np.ceil((classes.count() / ROWS_PER_CELL) ** 0.5), 2, MOST_CODEWORDS))
    grid = Grid(unit(np.stack(fitted["vector"])), words)
    visits = traversal_length(classes, grid, dimension, threshold, target)
    found = stored(search(classes, grid, dimension, visits, threshold), "found")
    of_length = F.lit(dimension).alias("dimension")
    return classes.select("*", of_length), found.select("*", of_length)
