"""Whitening of vectors: leading eigenpairs of the covariance by spectrum slicing and Rayleigh quotient iteration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillwarden.llm.tables import keep

SAFE = 1 << 62  # sums are kept below it in 64-bit arithmetic, beyond it in exact big integers
ALPHA = (1 + 17**0.5) / 8  # Bunch and Kaufman's bound on growth


def ldl(a: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray, np.ndarray]:
    """Symmetric factors P A P' = L D L' with pivots of one or two rows (Bunch and Parlett's choice).

    Returns the pivot blocks (first row, block), L, and the row order.
    """
    a = np.array(a, np.float64)
    n = len(a)
    order, low, pivots = np.arange(n), np.eye(n), []
    k = 0
    while k < n:
        rest = a[k:, k:]
        diagonal = np.abs(np.diag(rest))
        r = int(diagonal.argmax())
        off = np.abs(np.tril(rest, -1))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        s = 1 if n - k == 1 or diagonal[r] >= ALPHA * off[i, j] else 2
        for to, of in zip(range(k, k + s), [k + r] if s == 1 else [k + int(j), k + int(i)], strict=True):
            if to != of:
                a[[to, of]] = a[[of, to]]
                a[:, [to, of]] = a[:, [of, to]]
                low[[to, of], :k] = low[[of, to], :k]
                order[[to, of]] = order[[of, to]]
        block = a[k : k + s, k : k + s].copy()
        pivots.append((k, block))
        below = a[k + s :, k : k + s]
        if len(below) and np.abs(block).max() > 0:
            part = np.linalg.solve(block, below.T).T if s == 2 else below / block
            low[k + s :, k : k + s] = part
            a[k + s :, k + s :] -= part @ below.T
        k += s
    return pivots, low, order


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of v exceed the shift: the positive inertia of v - shift (Sylvester's law)."""
    pivots, _, _ = ldl(v - shift * np.eye(len(v)))
    return sum(int((b > 0).sum()) if b.size == 1 else int((np.linalg.det(b) < 0) or 2 * (np.trace(b) > 0)) for _, b in pivots)


def _solve(factors: tuple, x: np.ndarray, tiny: float) -> np.ndarray:
    """Solution with the factors of ldl; a vanishing pivot counts as `tiny`, as inverse iteration wants."""
    pivots, low, order = factors
    y = x[order].copy()
    for i in range(len(y)):
        y[i] -= low[i, :i] @ y[:i]
    for k, b in pivots:
        if b.size == 1:
            p = b[0, 0]
            y[k] /= p if abs(p) > tiny else (tiny if p >= 0 else -tiny)
        else:
            y[k : k + 2] = np.linalg.solve(b, y[k : k + 2])
    for i in range(len(y) - 1, -1, -1):
        y[i] -= low[i + 1 :, i] @ y[i + 1 :]
    out = np.empty_like(y)
    out[order] = y
    return out


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows.

    Inertia counts of shifted matrices halve an interval until it holds one
    eigenvalue and is narrow against the gaps beside it; Rayleigh quotient
    iteration starts from there, orthogonal to what was found. Two more counts,
    just above and below the value, certify its number; if they deny it the
    interval is halved further. Values closer than rounding allows to tell
    apart keep their order of discovery and get orthogonal vectors.
    """
    d = len(v)
    most = min(most, d)
    size = float(np.abs(v).sum(axis=1).max()) if d else 0.0
    values, vectors = np.zeros(most), np.zeros((most, d))
    if not d or size == 0:
        vectors[np.arange(most), np.arange(most)] = 1.0
        return values, vectors
    eps = np.finfo(float).eps * size
    seen = {-size * 1.01: d, size * 1.01: 0}  # counts already known, by shift

    def count(s: float) -> int:
        if s not in seen:
            seen[s] = count_above(v, s)
        return seen[s]

    rng = np.random.default_rng(1)
    for k in range(1, most + 1):
        lo = max(s for s, c in seen.items() if c >= k)
        hi = min(s for s, c in seen.items() if c < k)
        wide = True
        while True:
            # one value in (lo, hi), or an interval that cannot be halved
            while hi - lo > 8 * eps and (wide or not (count(lo) == k and count(hi) == k - 1)):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if count(mid) >= k else (lo, mid)
                wide = not (count(lo) == k and count(hi) == k - 1)
            held = vectors[: k - 1]
            x = rng.standard_normal(d)
            shift = (lo + hi) / 2
            for turn in range(30):
                x -= held.T @ (held @ x)
                x -= held.T @ (held @ x)
                x /= np.linalg.norm(x)
                value = float(x @ v @ x)
                left = np.linalg.norm(v @ x - value * x)
                if left <= 4 * eps:
                    break
                # fixed shifts until the quotient is in the interval for sure, then quotients: the cubic part
                if turn >= 2 and lo < value < hi and left < (hi - lo) / 2:
                    shift = value
                x = _solve(ldl(v - shift * np.eye(d)), x, eps)
            slack = max(left, 8 * eps)
            if hi - lo <= 8 * eps or (count(value - slack) >= k > count(value + slack)):
                break
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if count(mid) >= k else (lo, mid)
            wide = False
        values[k - 1], vectors[k - 1] = value, x
    return values, vectors


@dataclass
class Fit:
    """Number of distinct vectors, exact sums per dimension, leading eigenpairs and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], np.float64)


def steps(vector: str = "embedding") -> Column:
    """Each entry as floor(256 * c)."""
    return F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))


def usable(vector: str = "embedding") -> Column:
    """Vectors that are there and hold finite entries only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].reshape(len(column), -1)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                own = x.sum(axis=0).tolist() if _largest(x) * len(x) < SAFE else x.astype(object).sum(axis=0).tolist()
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array([str(t) for t in total])], names=["i", "n", "s"])

    rows = fit.mapInArrow(part, "i int, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def _products(fit: DataFrame, column: Column, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Sum over fit of centred outer products, optionally after a projection. Only numbers of dimensions come back."""
    shared = fit.sparkSession.sparkContext.broadcast((mean, project))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = shared.value
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x")) - centre
                x = x if turn is None else x @ turn.T
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"])

    rows = fit.select(column).mapInArrow(part, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    d = len(mean) if project is None else len(project)
    out = np.zeros((d, d))
    out[rows["i"], rows["j"]] = rows["s"]
    out[rows["j"], rows["i"]] = rows["s"]
    return out


def whiten(table: DataFrame, *, components: int = 4, vec_id: str = "vec_id", vector: str = "embedding", dimension: int | None = None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, a row per vector and component.

    Rows whose vector is null or holds null or non-finite entries are left out,
    as are vectors not of the table's dimension: `dimension`, or the commonest
    length (the larger at a tie); vectors of length 0 have no component.
    Repeated rows and null ids are returned each; the fit list has each
    distinct vector once. A component whose eigenvalue is not above rounding
    (all vectors alike, or fewer than components) has whitened null and
    explained 0. deviation is null where its exact value exceeds a long. Empty
    tables give no rows. Other columns, of whatever names, are not read.

    The vectors stay in Spark: tasks add up sums and centred products, of which
    only dimension * (dimension + 1) / 2 numbers reach the driver.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = table.sparkSession
    rows = table.where(usable(vector)).select(F.col(vec_id).cast("long").alias("vec_id"), steps(vector).alias("x"))
    if dimension is None:
        lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
        dimension = lengths["d"] if lengths else 0
    rows = rows.where(F.size("x") == dimension)
    fit = keep(rows.select("x").distinct())
    n, sums = _sums(fit)
    if not n:
        return spark.createDataFrame([], schema)
    mean = np.array([s / n for s in sums], np.float64)
    v = _products(fit, F.col("x"), mean) / n
    values, vectors = leading(v, components)
    found = Fit(n, sums, values, vectors, float(np.trace(v)))
    real = found.values > len(v) * np.finfo(float).eps * max(found.trace, np.finfo(float).tiny)
    turn = np.where(real, 1 / np.sqrt(np.where(real, found.values, 1.0)), 0.0)[:, None] * found.vectors
    white = _products(fit, F.col("x"), mean, turn[real]) / n if real.any() else np.zeros((0, 0))
    error = float(np.abs(white - np.eye(len(white))).max()) if len(white) else 0.0
    explained = np.where(real, found.values / (found.trace or 1.0), 0.0)
    shared = spark.sparkContext.broadcast((n, sums, mean, turn, real, explained, error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, mean, turn, real, explained, error = shared.value
        k = len(turn)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            bound = _largest(x) * n + max(abs(s) for s in sums)
            if bound * bound * len(sums) < SAFE:
                gap = n * x - np.array(sums, np.int64)
                deviation = pa.array((gap * gap).sum(axis=1))
            else:
                exact = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
                deviation = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
            place = np.repeat(np.arange(len(x)), k)
            white = ((x - mean) @ turn.T).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(place), n)),
                    deviation.take(pa.array(place)), pa.array(white, mask=np.tile(~real, len(x))), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(place), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
