"""Whitening components of embeddings by shifted CholeskyQR.

Entries are put on a whole-number grid, ``x = floor(grid * c) + offset``, so that
column sums are exact. With n rows and column sums S, the centred rows
A = x - S / n are taken as (n x - S) / n, whose numerator is exact as well.

*Shifted CholeskyQR.* A pass sums the Gram matrix G = Q'Q of the rows (Q = A at
first) over all tasks, the driver factors G + shift = R'R, and the next pass
orthogonalises the rows through a triangular solve, Q := Q R^-1. The shift, at the
size of G's rounding error, lets the first factor exist however ill-conditioned
A is; further passes bring Q'Q to the identity, and the R factors multiply to
one R with A = Q R. Passes end once Q'Q is the identity to rounding, after
``MAX_PASSES`` at the latest.

*Components.* The SVD of (Q'Q)^(1/2) R gives A's singular values s and right
singular vectors: unit eigenvectors of the covariance A'A / n, and its
eigenvalues e = s^2 / n. (Q'Q)^(1/2) is the identity to rounding where A has full
rank; where columns depend on each other it keeps the factorisation exact. A
component whose eigenvalue is zero to rounding cannot be whitened and is left out.

Each pass is one scan of the vectors. A task gives back one matrix of d x d, whose
entries Spark sums by place, partly in each task's own output first; the driver
holds matrices of at most ``MAX_DIM`` x ``MAX_DIM``. Rows are never gathered.

Defined results: rows whose vector is null, or holds null, non-finite or (beyond
``LIMIT``) too large entries for exact sums, are left out, as are vectors of
another length than most have (of lengths that are equally frequent the
smaller counts); repeated rows and ties count each; a table without such rows, or one
whose vectors are all equal, gives an empty result; null ids are carried along;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.scratch import written

GRID, OFFSET = 1024, 100_000
#: Largest dimension; the driver's matrices have its square of entries.
MAX_DIM = 4096
#: Largest size of a grid value: n of them add up exactly for n below 2^63 / LIMIT.
LIMIT = 1 << 40
MAX_PASSES = 6
#: Rows that a task turns into one block.
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Fit:
    n: int
    sums: np.ndarray
    #: One unit column a component, by falling eigenvalue; of either sign the one whose largest entry is positive.
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int


def grid_rows(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors (of length ``dim``, if given, else all equally long ones) and their grid values."""
    lists = column.cast(pa.large_list(pa.float64()))
    offsets, values = lists.offsets.to_numpy(), lists.values
    flat = values.to_numpy(zero_copy_only=False) if not values.null_count else np.where(
        values.is_null().to_numpy(zero_copy_only=False), np.nan, values.fill_null(0).to_numpy(zero_copy_only=False))
    with np.errstate(invalid="ignore", over="ignore"):
        grid = np.floor(GRID * flat) + OFFSET
    bad = np.concatenate([[0], np.cumsum(~(np.abs(grid) <= LIMIT))])
    size = np.diff(offsets)
    good = (bad[offsets[1:]] == bad[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(good & (size == dim))
    return at, grid[offsets[at][:, None] + np.arange(dim)].astype(np.int64)


def _lengths(column: pa.Array) -> list[int]:
    sizes = np.diff(column.cast(pa.large_list(pa.float64())).offsets.to_numpy())[column.is_valid().to_numpy(zero_copy_only=False)]
    return np.unique(sizes).tolist()


def _blocks(batches: Iterator[pa.RecordBatch], at: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches in blocks of rows, with the places and grid values of their usable vectors."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(i, BLOCK_ROWS)
            rows, x = grid_rows(part.column(at), dim)
            if len(rows):
                yield part, rows, x


def column_sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The number of usable vectors of the commonest length, and their exact column sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.column(0).slice(i, BLOCK_ROWS)
                for dim in _lengths(part):
                    rows, x = grid_rows(part, dim)
                    n, sums = found.get(dim, (0, np.zeros(dim, np.int64)))
                    found[dim] = n + len(rows), sums + x.sum(axis=0)
        for dim, (n, sums) in found.items():
            if n and dim:
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))], ["dim", "n", "sums"])

    partial = written(vectors.mapInArrow(run, "dim int, n long, sums array<long>"), "whitening-sums")
    most = partial.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").limit(1).first()
    if most is None:
        return 0, np.zeros(0, np.int64)
    if most.dim > MAX_DIM:
        raise ValueError(f"vectors of {most.dim} entries; the driver's matrices are bounded at {MAX_DIM}")
    sums = partial.filter(F.col("dim") == most.dim).select(F.posexplode("sums").alias("j", "x")).groupBy("j").agg(F.sum("x").alias("x"))
    return most.n, np.array([r.x for r in sums.orderBy("j").collect()], np.int64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once."""
    return (n * x - sums) / n


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows`` R^-1 for upper triangular R, by forward substitution over the columns."""
    out = np.empty(rows.shape, order="F")
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _summed(vectors: DataFrame, dim: int, width: int, rows_of: Callable[[np.ndarray], np.ndarray], gram: bool) -> np.ndarray:
    """Over all usable vectors: the column sums of ``rows_of`` their grid values, or the Gram matrix of those rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width if gram else 1, width))
        seen = False
        for _, _, x in _blocks(batches, 0, dim):
            q, seen = rows_of(x), True
            total += q.T @ q if gram else q.sum(axis=0)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    places = vectors.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    # of a Gram matrix the upper half says all
    found = places.filter("j >= i").groupBy("i", "j").agg(F.sum("x").alias("x")) if gram else places.groupBy("i", "j").agg(F.sum("x").alias("x"))
    known = found.toArrow()
    out = np.zeros((width if gram else 1, width))
    i, j, value = (known[c].to_numpy() for c in ("i", "j", "x"))
    out[i, j] = value
    if gram:
        out[j, i] = value
    return out


def fit(embeddings: DataFrame, vector_col: str = "embedding") -> Fit:
    """Components of the covariance (divisor n) of the grid values of all usable vectors."""
    vectors = embeddings.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    n, sums = column_sums(vectors)
    dim = len(sums)
    none = Fit(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0, 0)
    if not n:
        return none
    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        rows = centred(x, n, sums)
        for r in factors:
            rows = solve_upper(rows, r)
        return rows

    eps, total = np.finfo(float).eps, np.eye(dim)
    gram, trace, done = None, None, 0
    while True:
        gram = _summed(vectors, dim, dim, orthogonal, gram=True)
        done += 1
        trace = float(np.trace(gram)) / n if trace is None else trace
        if not trace:
            return none
        if done > 1 and np.abs(gram - np.eye(dim)).max() <= 64 * dim * eps or done == MAX_PASSES:
            break
        # the first shift is that of Fukaya et al. (2020); later ones only keep a dependent column's factor alive
        shift = 11 * (n * dim + dim * (dim + 1)) * eps / 2 * np.linalg.norm(gram, 2) if done == 1 else 0.0
        shift = min(shift, 1e-8 * float(np.linalg.norm(gram, 2)))
        r = None
        while r is None:
            try:
                r = np.linalg.cholesky(gram + shift * np.eye(dim)).T
            except np.linalg.LinAlgError:
                shift = max(10 * shift, dim * eps * float(np.linalg.norm(gram, 2)))
        factors.append(r)
        total = r @ total
    values, sides = np.linalg.eigh(gram)
    root = (sides * np.sqrt(np.maximum(values, 0))) @ sides.T
    _, singular, right = np.linalg.svd(root @ total)
    e = singular ** 2 / n
    keep = e > (16 * dim * eps) ** 2 * e[0] if len(e) and e[0] > 0 else np.zeros(dim, bool)
    parts = right.T[:, keep]
    parts = parts * np.sign(parts[np.abs(parts).argmax(axis=0), np.arange(parts.shape[1])])
    return Fit(n, sums, parts, e[keep], trace, done)


def identity_error(embeddings: DataFrame, model: Fit, n_components: int, vector_col: str = "embedding") -> float:
    """The largest entry of the difference between the covariance of the whitened rows and the identity."""
    k, dim = min(n_components, len(model.eigenvalues)), len(model.sums)
    vectors = embeddings.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    mean = _summed(vectors, dim, k, lambda x: whitened(x, model, k), gram=False)[0] / model.n
    cov = _summed(vectors, dim, k, lambda x: whitened(x, model, k) - mean, gram=True) / model.n
    return float(np.abs(cov - np.eye(k)).max())


def whitened(x: np.ndarray, model: Fit, k: int) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components[:, :k] / np.sqrt(model.eigenvalues[:k]))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S)^2; null beyond 2^63."""
    away = n * x - sums
    near = (away.astype(float) ** 2).sum(axis=1) < 2.0 ** 62
    out: list[int | None] = (away * away).sum(axis=1).tolist() if near.all() else [None] * len(x)
    if not near.all():
        for i, row in enumerate(away.tolist()):
            exact = sum(v * v for v in row)
            out[i] = exact if exact < 1 << 63 else None
    return out


def whiten(embeddings: DataFrame, n_components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    model = fit(embeddings, vector_col)
    k, dim = min(n_components, len(model.eigenvalues)), len(model.sums)
    error = identity_error(embeddings, model, k, vector_col) if k else 0.0
    rows = embeddings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    shape = rows.schema["id"].dataType.simpleString()
    share = model.eigenvalues[:k] / model.trace if k else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, x in _blocks(batches, 1, dim) if k else ():
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), pa.array([d for d in deviations(x, model.n, model.sums) for _ in range(k)], pa.int64()),
                 pa.array(whitened(x, model, k).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    found = rows.mapInArrow(run, f"id {shape}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return found.withColumnRenamed("id", id_col)
