"""Whitening of vectors on the leading eigenvectors of their covariance, found by spectrum slicing.

The number of positive pivots in the LDLᵀ factorisation of V - sI is the number of eigenvalues of V above s. Bisecting
with these counts encloses each leading eigenvalue in an interval that holds no other one (or only ones that cannot be
told apart in double precision); Rayleigh quotient iteration, from a vector orthogonal to the eigenvectors already
found, converges cubically inside it, and counts just below and above the value certify its number.

Spark makes the distinct list, its exact sums, the covariance (centred, added up in the tasks first) and the result. The
driver gets one covariance matrix, whose size depends on the dimension only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this count as this, so that no vector of finite entries overflows.
LARGEST = float(2**62)
EPS = np.finfo(np.float64).eps


# -- the eigenvectors --------------------------------------------------------------------------------------------------

def inertia(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of the symmetric matrix above ``shift``, from the signs of D in LDLᵀ of matrix - shift I.

    Symmetric pivoting with blocks of one or two rows (Bunch and Parlett) keeps the factorisation stable when the shifted
    matrix is indefinite. A block of two has one positive and one negative eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    limit = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(np.tril(a, -1))
        r, s = np.unravel_index(off.argmax(), off.shape)
        if diagonal[i] >= limit * off[r, s]:
            if diagonal[i] == 0:
                return above
            keep = np.arange(len(a)) != i
            column = a[keep, i]
            above += a[i, i] > 0
            a = a[np.ix_(keep, keep)] - np.outer(column, column / a[i, i])
        else:
            pair = [int(r), int(s)]
            keep = np.ones(len(a), bool)
            keep[pair] = False
            columns = a[np.ix_(keep, pair)]
            above += 1
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
        a = (a + a.T) / 2
    return int(above)


class Eigenpairs(NamedTuple):
    values: np.ndarray   # falling
    vectors: np.ndarray  # one in each column


def _refined(matrix: np.ndarray, low: float, high: float, before: np.ndarray, seed: int) -> tuple[float, np.ndarray] | None:
    """An eigenpair in the slice, orthogonal to the columns of ``before``, by Rayleigh quotient iteration; None where the
    iteration ends outside."""
    size, scale = len(matrix), np.abs(matrix).sum(axis=1).max()
    shift, small = (low + high) / 2, 64 * size * EPS * scale

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - before @ (before.T @ x)
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        for _ in range(60):
            try:
                y = np.linalg.solve(matrix - shift * np.eye(size), x)
                if np.isfinite(y).all():
                    return orthogonal(y / np.abs(y).max())
            except np.linalg.LinAlgError:
                pass
            shift += 4 * EPS * scale
        raise RuntimeError("the shifted covariance cannot be factored")

    x = orthogonal(np.random.default_rng(seed).standard_normal(size))
    for _ in range(4):  # towards the slice
        x = solved(shift, x)
    best, residual = x, np.inf
    for _ in range(20):
        value = float(x @ matrix @ x)
        rest = float(np.linalg.norm(matrix @ x - value * x))
        if rest >= residual / 2 and residual <= small:
            break
        if rest < residual:
            best, residual = x, rest
        x = solved(value if low < value <= high else shift, x)
    value = float(best @ matrix @ best)
    return (value, best) if residual <= small and low < value <= high else None


def leading(matrix: np.ndarray, count: int) -> Eigenpairs:
    """The ``count`` largest eigenvalues of a symmetric positive semidefinite matrix that are not zero to rounding, falling,
    with unit eigenvectors. Eigenvalues that agree to rounding get any orthonormal basis of their space."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    close = 8 * size * EPS * scale
    known = {close: inertia(matrix, close), scale * (1 + 1e-9): 0} if scale else {close: 0}  # eigenvalues above each shift
    count = min(count, known[close])
    values, vectors = [], np.zeros((size, 0))

    def halved(low: float, high: float, number: int) -> tuple[float, float]:
        middle = (low + high) / 2
        known[middle] = inertia(matrix, middle)
        return (middle, high) if known[middle] >= number else (low, middle)

    while len(values) < count:
        number = len(values) + 1
        low = max(s for s, n in known.items() if n >= number)
        high = min(s for s, n in known.items() if n < number)
        # the slice (low, high] holds eigenvalue ``number``: cut it until it holds no other one, or cannot be cut
        while known[low] - known[high] > 1 and high - low > close:
            low, high = halved(low, high, number)
        together = known[low] - known[high]
        margin = close if together > 1 else 0.0  # eigenvalues that agree to rounding may stand just outside
        for k in range(min(together, count - len(values))):
            while (pair := _refined(matrix, low - margin, high + margin, vectors, number + k)) is None:
                if together > 1 or high - low <= close / 4:
                    margin += close
                    if margin > 64 * close:
                        raise RuntimeError(f"no eigenvector found between {low} and {high}")
                else:
                    low, high = halved(low, high, number)
            values.append(pair[0])
            vectors = np.column_stack([vectors, pair[1]])
    order = np.argsort(-np.array(values), kind="stable").astype(int)
    values, vectors = np.array(values)[order], vectors[:, order]
    for i, value in enumerate(values):  # counts just above and below certify the number
        if not inertia(matrix, value + 2 * close) <= i < inertia(matrix, value - 2 * close):
            raise RuntimeError(f"eigenvalue {i + 1} is not in its place")
    return Eigenpairs(values, vectors)


# -- Spark -------------------------------------------------------------------------------------------------------------

def whole_numbers(vector: str) -> Column:
    """floor(64 c) + 1000000 of every entry as long."""
    def entry(c: Column) -> Column:
        scaled = F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(scaled).cast("long") + SHIFT

    return F.transform(vector, entry)


def usable(vector: str) -> Column:
    """The vector is there and all its entries are finite."""
    def finite(c: Column) -> Column:
        value = c.cast("double")
        return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, length, rows of the batch with vectors of this length, these vectors as a matrix). x is the last column."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            yield batch, size, rows, flat[starts[rows][:, None] + np.arange(size)]


class Fit(NamedTuple):
    """What the vectors of one length have in common."""

    n: int
    sums: list[int]         # S, exact
    near: np.ndarray        # whole numbers next to S / n
    rest: np.ndarray        # S / n - near
    widest: int             # bound of |x - near|
    values: np.ndarray
    components: np.ndarray  # eigenvectors over the roots of their eigenvalues
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)² of each row, exact; None where no long holds it."""
        moved = x - self.near
        left = [self.n * int(m) - s for m, s in zip(self.near.tolist(), self.sums)]  # n x - S = n (x - near) + left
        if len(self.sums) * (self.n * (self.widest + 1)) ** 2 < 2**63:
            whole = self.n * moved + np.array(left, np.int64)
            return (whole * whole).sum(axis=1).tolist()
        exact = [sum((self.n * a + b) ** 2 for a, b in zip(row, left)) for row in moved.tolist()]
        return [value if value < 2**63 else None for value in exact]


def _totals(fit_list: DataFrame) -> dict[int, tuple[int, list[int], list[int]]]:
    """n, S and the largest absolute entry of each dimension, for each length; one row a dimension reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for _, size, _, x in matrices(batches):
            parts = [np.full(size, len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            held = found.setdefault(size, [0, 0, 0, np.full(size, -(2**63)), np.full(size, 2**63 - 1)])
            held[:3] = [a + b for a, b in zip(held, parts)]
            held[3:] = [np.maximum(held[3], x.max(axis=0)), np.minimum(held[4], x.min(axis=0))] if size else held[3:]
        for size, (n, high, low, top, bottom) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, size)), pa.array(np.arange(size)), *map(pa.array, (n, high, low, top, bottom))],
                ["size", "i", "n", "high", "low", "top", "bottom"],
            )

    names = "size long, i long, n long, high long, low long, top long, bottom long"
    rows = fit_list.mapInArrow(run, names).groupBy("size", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.max("top").alias("top"), F.min("bottom").alias("bottom"),
    )
    out: dict[int, tuple] = {}
    for row in rows.orderBy("size", "i").collect():
        n, sums, ranges = out.setdefault(row["size"], (row["n"], [], []))
        sums.append((int(row["high"]) << 32) + int(row["low"]))
        ranges.append((row["bottom"], row["top"]))
    return out


def _products(fit_list: DataFrame, centres: dict, through: dict | None = None) -> dict[int, np.ndarray]:
    """Sum over the list of y yᵀ for each length, y being x less the whole numbers next to the mean, or what ``through``
    makes of x. Whole numbers add up exactly, in any order, as long as the sums stay below 2^53."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for _, size, _, x in matrices(batches):
            if size in centres:
                y = through[size].whitened(x) if through else (x - centres[size]).astype(np.float64)
                found[size] = found.get(size, 0) + y.T @ y
        for size, total in found.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size)), pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(total[i, j])],
                ["size", "i", "j", "value"],
            )

    rows = fit_list.mapInArrow(run, "size long, i long, j long, value double").groupBy("size", "i", "j")
    out: dict[int, np.ndarray] = {}
    for row in rows.agg(F.sum("value").alias("value")).collect():
        size = through[row["size"]].components.shape[1] if through else row["size"]
        total = out.setdefault(row["size"], np.zeros((size, size)))
        total[row["i"], row["j"]] = total[row["j"], row["i"]] = row["value"]
    return out


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of every length of vectors in a list without repeats (column x)."""
    totals = _totals(fit_list)
    near = {
        size: np.array([(2 * s + n) // (2 * n) for s in sums], np.int64) for size, (n, sums, _) in totals.items()
    }
    products = _products(fit_list, near)
    out = {}
    for size, (n, sums, ranges) in totals.items():
        rest = np.array([(s - n * int(m)) / n for s, m in zip(sums, near[size].tolist())])
        covariance = products[size] / n - np.outer(rest, rest)
        widest = max(max(top - m, m - bottom) for (bottom, top), m in zip(ranges, near[size].tolist()))
        pairs = leading(covariance, components)
        out[size] = Fit(
            n, sums, near[size], rest, widest, pairs.values, pairs.vectors / np.sqrt(pairs.values), float(np.trace(covariance))
        )
    return out


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each row of df and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null, infinite or NaN entries are dropped. Repeated rows and equal vectors are kept
    and count once in the fit. Vectors of different lengths are whitened apart, each with the others of its length.
    There are as many components as eigenvalues above rounding, ``components`` at most: none for a single
    distinct vector, for empty vectors and for an empty df, whose rows then have no result. Scaled entries beyond 2^62 count
    as 2^62; a deviation that no long holds is null. Other columns are not read, whatever their names.
    """
    used = df.filter(usable(vector)).select(F.col(key), whole_numbers(vector).alias("x"))
    fit_list = stored(used.select("x").distinct(), "vectors")
    fits = {size: found for size, found in fit(fit_list, components).items() if len(found.values)}
    spreads = _products(fit_list, fits, fits) if fits else {}
    errors = {
        size: float(np.abs(spread / fits[size].n - np.eye(len(spread))).max()) for size, spread in spreads.items()
    }
    kind = df.schema[key]
    schema = T.StructType([
        T.StructField(kind.name, kind.dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size, rows, x in matrices(batches):
            if size not in fits:
                continue
            found = fits[size]
            count, total = len(found.values), len(rows) * len(found.values)
            each = np.repeat(np.arange(len(rows)), count)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(total, found.n)), pa.array(found.deviation(x), pa.int64()).take(pa.array(each)),
                pa.array(found.whitened(x).ravel()), pa.array(np.tile(found.values / found.trace, len(rows))),
                pa.array(np.full(total, errors[size])),
            ], schema.names)

    return used.mapInArrow(run, schema)
