"""Embedding whitening: principal components by QDWH spectral divide and conquer, then a broadcast projection.

1.  ``totals``: number and exact sums of the vectors, by length, from every partition.
2.  ``covariance``: each task centres its vectors at the nearest whole numbers to the mean and
    multiplies; products are whole numbers that double arithmetic holds exactly, and they
    add up as decimals, so the covariance is exact until its last division.
3.  ``components``: a symmetric matrix is split at a shift: the polar factor of the shifted
    matrix (``polar``: QR-based dynamically weighted Halley iterations) is the sign of its
    eigenvalues, so half of factor plus identity projects on the invariant subspace above
    the shift.  Bases of both subspaces come from the projector, and each half is split again,
    down to single components.  The matrix has the embedding's width (``MOST_WIDTH`` at most), whatever the number of rows.
4.  ``whitened``: mean and scaled components are broadcast (32 vectors), and each row is projected where it is.

Whole numbers: an entry c is x = floor(64 * c) + 1000000.  Vectors are rows of the commonest length (the
greatest of equally common ones).

Defined cases: a row takes no part if its vector is null or empty, holds a null or non-finite entry or
one beyond 2**31, or has another length; a null id stays null; repeated rows count and are returned as often
as they are there; components whose variance is zero (below 1e-12 of the greatest) can't be whitened and aren't returned, so equal
vectors, a single one or an empty table give no rows; a deviation beyond a long is null in the query
(``deviation_exact`` holds it up to 38 digits); equal eigenvalues get some orthonormal basis of their space; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lunchbox.llm.runtime import ship, written

SCALE, ADDED = 64, 1_000_000
MOST_WIDTH, MOST_ENTRY = 2048, 1 << 31
COMPONENTS = 32
#: variances below this share of the greatest are zero
ZERO = 1e-12


def vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, values as double) for each length of usable vectors in an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_list(pa.float64()))
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    length = np.where(there, np.diff(at), 0)
    flat = column.values
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.r_[0, np.cumsum(~(np.abs(values) <= MOST_ENTRY))]
    usable = (length > 0) & (bad[at[1:]] == bad[at[:-1]])
    for n in np.unique(length[usable]):
        rows = np.flatnonzero(usable & (length == n))
        yield int(n), rows, values[at[rows][:, None] + np.arange(n)]


def whole(values: np.ndarray) -> np.ndarray:
    """x of each entry, as long."""
    return np.floor(SCALE * values).astype(np.int64) + ADDED


def totals(embeddings: DataFrame) -> tuple[int, np.ndarray]:
    """n and the exact sums S (Python integers) of the vectors of the commonest length; (0, no sums) without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for width, rows, values in vectors(batch.column("embedding")):
                x = whole(values) - ADDED
                own = x.astype(object).sum(0) if np.abs(x).max() > (1 << 62) // len(x) else x.sum(0).astype(object)
                have = sums.setdefault(width, [0, np.zeros(width, object)])
                have[0] += len(rows)
                have[1] += own
        for width, (n, own) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([width] * (width + 1), pa.int32()), pa.array(range(-1, width), pa.int32()),
                                              pa.array([n, *map(int, own)], pa.decimal128(38, 0))], ["width", "i", "value"])

    parts = written(embeddings.select("embedding").mapInArrow(run, "width int, i int, value decimal(38,0)"), "totals")
    top = parts.where("i = -1").groupBy("width").agg(F.sum("value").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return 0, np.zeros(0, object)
    if top.width > MOST_WIDTH:
        raise ValueError(f"vectors have {top.width} entries, {MOST_WIDTH} are the most")
    rows = parts.where((F.col("width") == top.width) & (F.col("i") >= 0)).groupBy("i").agg(F.sum("value").alias("value")).collect()
    n, sums = int(top.n), np.zeros(top.width, object)
    for row in rows:  # as many as a vector has entries
        sums[row.i] = int(row.value) + n * ADDED
    return n, sums


def covariance(embeddings: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance of the x-vectors, divisor n, correctly rounded."""
    width = len(sums)
    centre = [round(Fraction(int(s), n)) for s in sums]  # whole numbers next to the mean
    near = np.array(centre, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        part, held = np.zeros((width, width)), 0.0
        for batch in batches:
            for length, _, values in vectors(batch.column("embedding")):
                if length != width:
                    continue
                y = (whole(values) - near).astype(np.float64)
                most = max(float(np.abs(y).max()), 1.0) ** 2
                step = max(1, int((1 << 52) / most))  # rows whose products double arithmetic adds exactly
                for k in range(0, len(y), step):
                    block = y[k:k + step]
                    if most > 1 << 52:
                        whole_block = block.astype(np.int64).astype(object)
                        total = total + whole_block.T.dot(whole_block)
                        continue
                    if held + most * len(block) > 1 << 53:
                        total, part, held = total + part.astype(np.int64).astype(object), np.zeros((width, width)), 0.0
                    part += block.T @ block
                    held += most * len(block)
        total = total + part.astype(np.int64).astype(object)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array((i * width + j).astype(np.int32)), pa.array([int(v) for v in total[i, j]], pa.decimal128(38, 0))], ["at", "value"])

    parts = embeddings.select("embedding").mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    off = [int(s) - n * c for s, c in zip(sums, centre)]
    out = np.empty((width, width))
    found = parts.toArrow()  # half a square of the width, whatever the rows
    for at, value in zip(found.column("at").to_pylist(), found.column("value")):
        i, j = divmod(at, width)
        out[i, j] = out[j, i] = float(Fraction(n * int(value.as_py()) - off[i] * off[j], n * n))
    return out


def _least(x: np.ndarray) -> float:
    """A bound below the least singular value, from the inverse's norm; 1e-16 for a singular matrix."""
    try:
        return float(np.clip(0.9 / np.linalg.norm(np.linalg.inv(x)), 1e-16, 0.9))
    except np.linalg.LinAlgError:
        return 1e-16


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QR-based dynamically weighted Halley iterations."""
    n = len(a)
    x = a / np.linalg.norm(a)  # the greatest singular value is 1 at most
    low = _least(x)
    eye = np.eye(n)
    for _ in range(40):
        if low < 1:
            d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
            wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d)))
        else:
            wa = 3.0
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        low = min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        moved, x = np.linalg.norm(new - x), new
        if moved < 1e-10 and low > 1 - 1e-10:  # convergence is cubic
            break
    return (x + x.T) / 2


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below a shift; None if all eigenvalues are one."""
    n, size = len(a), np.linalg.norm(a)
    mid = np.trace(a) / n
    if np.linalg.norm(a - mid * np.eye(n)) <= 4 * n * np.finfo(float).eps * size:
        return None
    best = None
    for shift in (float(np.median(np.diag(a))), mid, *(mid + s * np.linalg.norm(a - mid * np.eye(n)) / np.sqrt(n) for s in (1e-3, -1e-3, 0.1, -0.1, 0.5, -0.5))):
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n:
            continue
        # the longest columns of the projector span its range; a second step makes the basis exact
        start = projector[:, np.argsort(-(projector * projector).sum(0), kind="stable")]
        basis = np.linalg.qr(_independent(start, rank), mode="complete")[0]
        basis = np.linalg.qr(projector @ basis[:, :rank], mode="complete")[0]
        up, down = basis[:, :rank], basis[:, rank:]
        left = np.linalg.norm(down.T @ a @ up)
        if best is None or left < best[0]:
            best = (left, up, down)
        if left <= 16 * n * np.finfo(float).eps * size:
            break
    return None if best is None else best[1:]


def _independent(columns: np.ndarray, rank: int) -> np.ndarray:
    """``rank`` columns chosen one by one by the greatest part outside the earlier ones."""
    rest, chosen = columns.copy(), []
    for _ in range(rank):
        k = int(np.argmax((rest * rest).sum(0)))
        chosen.append(k)
        q = rest[:, k] / np.linalg.norm(rest[:, k])
        rest = rest - np.outer(q, q @ rest)
        rest[:, k] = 0
    return columns[:, chosen]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    n = len(a)
    size = np.linalg.norm(a)
    done: list[np.ndarray] = []
    todo = [np.eye(n)] if n else []
    while todo:
        basis = todo.pop()
        if basis.shape[1] > 1 and (halves := _split(own := (lambda m: (m + m.T) / 2)(basis.T @ a @ basis))) is not None:
            todo += [np.linalg.qr(basis @ half)[0] for half in halves]
        else:
            done.append(basis)
    if not done:
        return np.zeros(0), np.zeros((0, 0))
    basis = _refined(a, np.hstack(done), size)
    values = np.einsum("ij,ij->j", basis, a @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


def _refined(a: np.ndarray, basis: np.ndarray, size: float) -> np.ndarray:
    """One Newton step on all eigenvectors together, in extended precision: what rounding left of their angles goes."""
    wide, x = a.astype(np.longdouble), basis.astype(np.longdouble)
    r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
    s = x.T @ wide @ x
    values = np.diag(s) / (1 - np.diag(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > 1e-9 * size
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    q, r = np.linalg.qr((x + x @ e).astype(np.float64))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """Mean (n and exact sums), components (columns) with their eigenvalues, and the trace of the covariance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def __post_init__(self):
        whole_mean = [int(s) // self.n for s in self.sums] if self.n else []
        self.floor = np.array(whole_mean, np.int64)
        self.rest = np.array([float(Fraction(int(s) - m * self.n, self.n)) for s, m in zip(self.sums, whole_mean)])
        self.scaled = self.vectors / np.sqrt(self.values)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of x-vectors (long)."""
        return ((x - self.floor).astype(np.float64) - self.rest) @ self.scaled

    def deviation(self, x: np.ndarray) -> list[int]:
        """Exact sum of (n * x - S)**2 of each x-vector."""
        off = [int(s) - int(m) * self.n for s, m in zip(self.sums, self.floor)]
        y = x - self.floor
        most = self.n * int(np.abs(y).max(initial=0)) + self.n
        if len(self.sums) * most ** 2 < 1 << 62:
            return (((self.n * y - np.array(off, np.int64)) ** 2).sum(1)).tolist()
        wide = self.n * y.astype(object) - np.array(off, object)
        return [int(v) if v < 10 ** 38 else None for v in (wide * wide).sum(1)]


def fitted(embeddings: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The greatest ``most`` components of all usable vectors; None without any variance."""
    ship(embeddings.sparkSession)
    n, sums = totals(embeddings)
    if not n:
        return None
    cov = covariance(embeddings, n, sums)
    values, basis = components(cov)
    keep = int((values > max(ZERO * max(values[0], 0), 0)).sum())
    keep = min(keep, most)
    return Whitening(n, sums, basis[:, :keep], values[:keep], float(np.trace(cov))) if keep else None


def projected(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation_exact and whitened (an array, component by component) of every usable row."""
    ship(embeddings.sparkSession)
    shared = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for width, rows, values in vectors(batch.column("embedding")):
                if width != len(own.sums):
                    continue
                x = whole(values)
                flat = own.project(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(own.deviation(x), pa.decimal128(38, 0)), lists],
                                                 ["vec_id", "deviation_exact", "whitened"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, "vec_id long, deviation_exact decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, n: int, width: int) -> float:
    """Greatest absolute entry of the covariance of ``rows``' whitened values minus the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, line = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            own = batch.column("whitened").flatten().to_numpy().reshape(-1, width)
            square += own.T @ own
            line += own.sum(0)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[i * width + j, -1 - np.arange(width)].astype(np.int32)), pa.array(np.r_[square[i, j], line])], ["at", "value"])

    parts = rows.select("whitened").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()  # width**2 rows at most
    got = {r["at"]: r.value for r in parts}
    mean = np.array([got[-1 - k] / n for k in range(width)])
    cov = np.array([[got[min(i, j) * width + max(i, j)] / n for j in range(width)] for i in range(width)]) - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(width)).max())


def whitened(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    model = fitted(embeddings, most)
    if model is None:
        none = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).where(F.lit(False))
        return none.selectExpr("vec_id", "0 as component", "0L as n", "0L as deviation", "0D as whitened", "0D as explained", "0D as identity_error")
    rows = projected(embeddings, model)
    error = identity_error(rows, model.n, len(model.values))
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    each = rows.select("vec_id", F.expr("try_cast(deviation_exact as long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
