"""Embedding whitening by incremental eigendecomposition.

A partition keeps the mean and the spectrum (eigenvalues and eigenvectors of
the centred scatter) of the vectors it has seen.  A block of vectors is centred
and turned by a QR step onto at most as many rows as dimensions, which have the
same scatter; each row, and the shift of the mean, is then a rank-one update:
the eigenvalues are the roots of the secular equation, the eigenvectors follow
from them, and entries that don't matter are deflated first.  Spectra of
partitions are combined in a tree, one's scaled eigenvectors being rank-one
updates of the other.  A last distributed pass projects all centred vectors on
the combined basis; the Rayleigh-Ritz problem of that nearly diagonal matrix
removes what thousands of updates left, so the components are those of the
exact covariance to double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import small_batches, written

SCALE = 256
COMPONENTS = 4
#: Vectors centred and turned together; spectra or partial sums that meet in one task of a tree.
BLOCK_ROWS = 4096
FAN_IN = 16
EPS = np.finfo(np.float64).eps
#: Entries beyond this have no exact integer image in a double.
MOST = float(1 << 52)


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x), one behind each pole of the rising `d`: (pole nearest to each root, distance from it).

    Every root sits in the gap behind its pole.  A rational function with the two poles of the gap is fitted at the
    current point, its root is the next point; a step that leaves the known bracket is replaced by its middle.
    """
    n = len(d)
    gap = np.append(np.diff(d), z2.sum())
    at = np.arange(n)
    middle = 1 + (z2 / ((d[None, :] - d[:, None]) - gap[:, None] / 2)).sum(axis=1)
    right = (middle < 0) & (at < n - 1)  # the root is in the right half of its gap: measure from there
    origin = at + right
    delta = d[None, :] - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where((middle < 0) & (at == n - 1), gap, gap / 2))
    low = np.where((middle < 0) & ~right, gap / 2, low)
    x = (low + high) / 2
    left_side = at[None, :] <= at[:, None]
    own, other = delta[at, at], np.append(delta[at[:-1], at[1:]], np.inf)
    with np.errstate(all="ignore"):
        for _ in range(200):
            terms = z2 / (delta - x[:, None])
            f = 1 + terms.sum(axis=1)
            slopes = terms / (delta - x[:, None])
            psi = np.where(left_side, slopes, 0.0).sum(axis=1)
            phi = slopes.sum(axis=1) - psi
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            a, b = own - x, other - x
            # Fitted: c + r / (own - y) + s / (other - y), equal in value and in both slopes at x.
            c = f - a * psi - np.where(np.isinf(b), 0.0, b * phi)
            p = (a + b) * f - a * b * (psi + phi)
            q = a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0.0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            last = a + a * a * psi / (f - a * psi)  # behind the last pole: one pole and a constant
            step = np.where(np.isinf(b), last, step)
            new = x + step
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            # Settled: the value is within its own rounding, or the point can't move.
            still = (np.abs(f) > EPS * n * (1 + np.abs(terms).sum(axis=1))) & (np.abs(new - x) > EPS * np.abs(new))
            x = np.where(still, new, x)
            if not still.any():
                break
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of vectors diag(values) vectors' + v v'."""
    z = vectors.T @ v
    size = max(np.abs(values).max(initial=0.0), float(z @ z))
    if size == 0:
        return values, vectors
    d, q, tol = values.copy(), vectors.copy(), 8 * EPS * size
    # Equal eigenvalues: turn their vectors so that one of them takes the whole of v.
    start = 0 if (np.diff(d) <= tol).any() else len(d)
    while start < len(d):
        stop = int(np.searchsorted(d, d[start] + tol, side="right"))
        if stop - start > 1 and (norm := np.linalg.norm(z[start:stop])) > 0:
            w = z[start:stop].copy()
            w[-1] += np.copysign(norm, w[-1])
            w /= np.linalg.norm(w)
            q[:, start:stop] -= 2 * np.outer(q[:, start:stop] @ w, w)
            z[start:stop - 1], z[stop - 1] = 0.0, -np.copysign(norm, z[stop - 1])
        start = max(stop, start + 1)
    # Deflation: an eigenpair that v hardly meets stays as it is.
    live = np.flatnonzero(np.abs(z) * np.linalg.norm(z) > tol)
    if len(live):
        poles = d[live]
        origin, x = _roots(poles, z[live] ** 2)
        away = (poles[:, None] - poles[origin][None, :]) - x[None, :]  # pole i minus root j, without cancellation
        # The z for which these roots are exact gives vectors that are orthogonal to working precision.
        between = poles[:, None] - poles[None, :]
        np.fill_diagonal(between, 1.0)
        ratio = -away / np.where(np.eye(len(live), dtype=bool), 1.0, -between)
        exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.where(z[live] < 0, -1.0, 1.0)
        u = exact[:, None] / away
        u /= np.linalg.norm(u, axis=0)
        d[live], q[:, live] = poles[origin] + x, q[:, live] @ u
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the centred scatter of vectors seen so far."""

    def __init__(self, dim: int, n: int = 0, mean=None, values=None, vectors=None):
        self.n = n
        self.mean = np.zeros(dim) if mean is None else mean
        self.values = np.zeros(dim) if values is None else values
        self.vectors = np.eye(dim) if vectors is None else vectors

    def absorb(self, rows: np.ndarray, n: int, mean: np.ndarray) -> None:
        """Adds `n` vectors with this mean whose centred scatter is rows' rows, one rank-one update for each row."""
        if not n:
            return
        if self.n:
            shift = np.sqrt(self.n * (n / (self.n + n))) * (mean - self.mean)
            rows = np.vstack([rows, shift[None, :]])
        for row in rows:
            if row.any():
                self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, block: np.ndarray) -> None:
        """Adds vectors as they are."""
        mean = block.mean(axis=0)
        centred = block - mean
        self.absorb(np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred, len(block), mean)

    def combine(self, other: Spectrum) -> None:
        self.absorb(np.sqrt(np.maximum(other.values, 0.0))[:, None] * other.vectors.T, other.n, other.mean)

    def packed(self) -> tuple[int, bytes]:
        return self.n, np.concatenate([self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, n: int, data: bytes, dim: int) -> Spectrum:
        x = np.frombuffer(data)
        return cls(dim, n, x[:dim].copy(), x[dim:2 * dim].copy(), x[2 * dim:].reshape(dim, dim).copy())


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) int64 of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches, dim: int):
    """The rows of the first column of all batches, about BLOCK_ROWS at a time."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch.column(0), dim))
            rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield np.concatenate(held)
            held, rows = [], 0
    if rows:
        yield np.concatenate(held)


def _row(**columns) -> pa.RecordBatch:
    types = {"part": pa.int64(), "n": pa.int64(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], types[k]) for k, v in columns.items()], list(columns))


def _tree(parts: DataFrame, merge) -> bytes | None:
    """Reduces rows (part, n, data) by `merge`, a function of a table, in tasks of at most FAN_IN rows; the last row's data."""
    parts = written(parts, "partials")
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return None
    while most >= 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("part").applyInArrow(
            merge, "part long, n long, data binary")
        most //= FAN_IN
    return bytes(parts.first()["data"])


def _merge_spectra(dim: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["n"].to_pylist(), table["data"].to_pylist()), key=lambda r: (-r[0], r[1]))
        whole = Spectrum.unpacked(*rows[0], dim)
        for row in rows[1:]:
            whole.combine(Spectrum.unpacked(*row, dim))
        n, data = whole.packed()
        return pa.Table.from_batches([_row(part=table["part"][0].as_py(), n=n, data=data)])

    return run


def _merge_sums(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x) for x in sorted(table["data"].to_pylist()))
    return pa.Table.from_batches([_row(part=table["part"][0].as_py(), n=0, data=total.tobytes())])


def spectrum(fit: DataFrame, dim: int) -> Spectrum | None:
    """The spectrum of the `x` vectors (array<long> of `dim` entries) of all rows; None without rows."""

    def run(batches):
        held = Spectrum(dim)
        for block in _blocks(batches, dim):
            held.add(block.astype(np.float64))
        if held.n:
            n, data = held.packed()
            yield _row(part=TaskContext.get().partitionId(), n=n, data=data)

    data = _tree(fit.select("x").mapInArrow(run, "part long, n long, data binary"), _merge_spectra(dim))
    return None if data is None else Spectrum.unpacked(0, data, dim)


def projected_scatter(fit: DataFrame, dim: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """basis' C basis, where C is the sum over rows of (x - mean)(x - mean)'; centred before it is multiplied."""
    shared = fit.sparkSession.sparkContext.broadcast((mean, basis))  # dim * dim doubles

    def run(batches):
        at, onto = shared.value
        total = np.zeros((onto.shape[1], onto.shape[1]))
        for block in _blocks(batches, dim):
            y = (block - at) @ onto
            total += y.T @ y
        yield _row(part=TaskContext.get().partitionId(), n=0, data=total.tobytes())

    data = _tree(fit.select("x").mapInArrow(run, "part long, n long, data binary"), _merge_sums)
    return np.frombuffer(data).reshape(basis.shape[1], -1)


def totals(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(rows, sum of each dimension), exact."""

    def run(batches):
        n, sums = 0, [0] * dim
        for block in _blocks(batches, dim):
            n += len(block)
            # Two halves of each entry: neither sum can leave 64 bits.
            low, high = (block & 0xFFFFFFFF).sum(axis=0), (block >> 32).sum(axis=0)
            sums = [s + (int(h) << 32) + int(lo) for s, h, lo in zip(sums, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([str(x) for x in [n, *sums]])], ["i", "s"])

    rows = fit.select("x").mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["i"]: int(r["s"]) for r in rows.collect()}  # dim + 1 rows
    return found.get(-1, 0), [found.get(k, 0) for k in range(dim)]


def integer_vectors(rows: DataFrame, vector_col: str, scale: int = SCALE, dim: int | None = None) -> tuple[DataFrame, int]:
    """(rows with x in place of the vector, their dimension); rows without a usable vector go."""
    v = F.col(vector_col)
    usable = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * scale) < MOST))
    kept = rows.where(usable & (F.size(v) > 0))
    if dim is None:
        lengths = kept.groupBy(F.size(v).alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc())
        first = lengths.first()
        dim = first["n"] if first else 0
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return kept.where(F.size(v) == dim).select(*[c for c in rows.columns if c != vector_col], x.alias("x")), dim


class Whitener:
    """Fitted on distinct vectors: n, their per-dimension sums, eigenvalues, components (columns), explained shares, identity error."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.mean = np.array([s / n for s in sums]) if n else np.zeros(len(sums))
        # An eigenvalue within rounding of 0 has no direction to scale.
        self.flat = values <= len(sums) * 8 * EPS * max(trace, 0.0)
        self.onto = np.where(self.flat, 0.0, vectors / np.sqrt(np.where(self.flat, 1.0, values)))
        self.explained = values / trace if trace > 0 else np.zeros_like(values)
        self.identity_error = 0.0

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2 of each row, exact; null where it takes more than 63 bits."""
        most = float(self.n) * float(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if most * most * max(len(self.sums), 1) < 2.0 ** 62:
            return (((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1)).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit_whitener(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener | None:
    """Fits on every row of `fit`, a table with distinct `x`; None if it has no row."""
    n, sums = totals(fit, dim)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(spectrum(fit, dim).vectors)[0]
    # Rayleigh-Ritz over the whole basis: exact for the covariance whatever the basis has gathered of rounding.
    ritz = projected_scatter(fit, dim, mean, basis) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(dim)] < 0, -1.0, 1.0)
    k = min(components, dim)
    model = Whitener(n, sums, values[:k].copy(), vectors[:, :k].copy(), float(np.trace(ritz)))
    covariance = projected_scatter(fit, dim, model.mean, model.onto) / n
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, dim: int | None = None) -> DataFrame:
    """One row for each usable row and component: all columns but the vector, plus component, n, deviation,
    whitened, explained and identity_error.

    An entry c counts as floor(scale * c).  Null vectors, those with null, NaN, infinite or (times scale) 2**52
    or larger entries, empty ones and those of another length than `dim` (null: the most frequent length, of
    equally frequent ones the longest) are left out.  The covariance is that of the distinct vectors; each of them
    counts once, however many rows or ids repeat it, and every repeated row has its results.  Signs make the largest
    entry of a component positive.  A component without variance has whitened 0; with fewer dimensions than
    `components` there are only that many.  deviation is null where it doesn't fit a long.  An empty table gives an
    empty result.  Columns of `rows` that are named like the new ones are replaced.
    """
    spark = rows.sparkSession
    small_batches(spark)
    new = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = rows.drop(*({*new, "x"} - {id_col, vector_col}))
    table, dim = integer_vectors(rows, vector_col, scale, dim)
    table = written(table, "vectors")
    model = fit_whitener(written(table.select("x").distinct(), "distinct"), dim, components) if dim else None
    names = [c for c in table.columns if c != "x"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields if f.name != "x"]
    schema = ", ".join([*fields, "component int, n long, deviation long, whitened double, explained double, identity_error double"])
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)  # dim * components doubles

    def run(batches):
        m = shared.value
        k = m.onto.shape[1]
        for batch in batches:
            x, rows_in = _matrix(batch.column(len(names)), dim), batch.num_rows
            again = pa.array(np.repeat(np.arange(rows_in), k))
            repeated = lambda a: pa.array(np.tile(a, rows_in))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(again) for c in batch.columns[:-1]), repeated(np.arange(1, k + 1, dtype=np.int32)),
                 repeated(np.full(k, m.n, dtype=np.int64)), pa.array(m.deviations(x), pa.int64()).take(again),
                 pa.array(((x - m.mean) @ m.onto).ravel()), repeated(m.explained), repeated(np.full(k, m.identity_error))],
                [*names, *new])

    return table.select(*names, "x").mapInArrow(run, schema)
