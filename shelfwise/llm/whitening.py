"""Whitening of embedding vectors by their leading principal components.

1. *Sums.* Vectors become longs (a fixed-point grid), and one aggregate gives
   their number and exact sums per dimension.
2. *Covariance.* Every task centres its vectors and multiplies them block by
   block, holding one matrix of d x d; the matrices of all tasks are summed row
   by row in two steps, so that no task adds up all of them.
3. *Eigenvectors of a d x d matrix.* Householder reflections make it
   tridiagonal; bisection on Sturm counts (the number of eigenvalues below a
   point, from the signs of the pivots) finds the leading eigenvalues; inverse
   iteration on the tridiagonal matrix gives the vectors, made orthogonal within
   clusters of close eigenvalues; the reflections carry them back. The matrix
   does not grow with the rows; MAX_DIMENSIONS bounds it (128 MB).
4. *Projection.* The components, scaled to unit variance, are broadcast and
   every task projects its own vectors.

Defined results: null vectors and vectors with null or non-finite entries are
left out, as are those with entries beyond 2^38, which the grid does not hold, and
those whose length is not the commonest one (the greater of
equally common ones); components beyond the dimension do not exist; a component
without variance (rank below the number of components) has whitened null and
explained 0 and does not count in the identity error; repeated rows are
whitened alike; tables without a usable vector give no rows.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import quoted, staged

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MAX_DIMENSIONS = 4096
#: Partial matrices are first summed in so many groups a row.
GROUPS = 32
#: Vectors multiplied at once, and the share of the largest eigenvalue below which there is no variance.
BLOCK, NO_VARIANCE = 4096, 1e-12
#: Greatest magnitude of an entry; a batch's sums of longs are then exact.
LIMIT = float(1 << 38)


# ---- symmetric eigenproblem -------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit Householder vectors of Q'AQ = T."""
    a = np.array(a, dtype=float)
    n = len(a)
    mirrors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0] if x[0] else 1.0)
        size = np.linalg.norm(v)
        v = v / size if size else v
        mirrors.append(v)
        # two-sided update of the rest: B - v w' - w v'
        rest = a[k + 1:, k + 1:]
        p = 2.0 * (rest @ v)
        w = p - v * (v @ p)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2.0 * v * (v @ x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(d: np.ndarray, e: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Eigenvalues below each point: negative pivots of T - point."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    below = np.zeros(len(points), np.int64)
    q = d[0] - points
    for i in range(len(d)):
        if i:
            q = d[i] - points - e[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, all bisected together until the
    halves no longer differ."""
    n = len(d)
    reach = np.zeros(n)
    reach[:-1] += np.abs(e)
    reach[1:] += np.abs(e)
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    wanted = n - np.arange(k)               # eigenvalues at or below the i-th largest
    while True:
        mid = low + (high - low) / 2
        still = (mid > low) & (mid < high)
        if not still.any():
            return high
        under = sturm_counts(d, e, mid) >= wanted
        high = np.where(still & under, mid, high)
        low = np.where(still & ~under, mid, low)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - shift) x = b by elimination with row exchanges; zero
    pivots become ``least``."""
    n = len(d)
    diag, up, up2, low = d - shift, np.append(e, 0.0), np.zeros(n), e.copy()
    x = b.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(diag[i]):
            diag[i], low[i] = low[i], diag[i]
            up[i], diag[i + 1] = diag[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(diag[i]) < least:
            diag[i] = least
        f = low[i] / diag[i]
        diag[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        x[i + 1] -= f * x[i]
    if abs(diag[-1]) < least:
        diag[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= diag[i]
    return x


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix by inverse
    iteration; each is made orthogonal to the earlier ones of its cluster."""
    n = len(d)
    norm = max(np.abs(d).max() + (2 * np.abs(e).max() if n > 1 else 0.0), np.finfo(float).tiny)
    gap, least = 1e-3 * norm, np.finfo(float).eps * norm
    r = np.random.default_rng(12)
    out = np.zeros((n, len(values)))
    start, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > gap:
            start = j
        # equal eigenvalues get shifts a little apart
        shift = value if j == start else min(value, shift - 10 * least)
        x = r.standard_normal(n)
        for _ in range(6):
            x = _solve(d, e, shift, x / np.linalg.norm(x), least)
            for _ in range(2):
                x -= out[:, start:j] @ (out[:, start:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling) of a symmetric matrix and unit
    eigenvectors as columns, each with its largest entry positive."""
    k = min(k, len(a))
    size = np.abs(a).max()
    if not size:
        return np.zeros(k), np.eye(len(a))[:, :k]
    d, e, mirrors = tridiagonal(a / size)
    values = leading_eigenvalues(d, e, k)
    vectors = tridiagonal_vectors(d, e, values)
    for at in range(len(mirrors) - 1, -1, -1):
        v, part = mirrors[at], vectors[at + 1:]
        part -= 2.0 * np.outer(v, v @ part)
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]
    return values * size, vectors * np.where(top < 0, -1.0, 1.0)


# ---- distributed parts --------------------------------------------------------------

def grid_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) with x the fixed-point longs of every usable vector of the
    commonest length; written once."""
    c = F.transform(quoted(embedding), lambda v: v.cast("double"))
    x = F.transform("c", lambda v: F.floor(F.lit(float(SCALE)) * v).cast("long") + F.lit(SHIFT).cast("long"))
    whole = ~F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > LIMIT))
    usable = table.select(quoted(vec_id).alias("vec_id"), c.alias("c")).where((F.size("c") > 0) & whole)
    kept = staged(usable.select("vec_id", x.alias("x"), F.size("c").alias("d")))
    length = kept.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.where(F.col("d") == (length["d"] if length else 0)).drop("d")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def column_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""
    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            n += batch.num_rows
            total = [a + int(b) for a, b in zip(total, _matrix(batch.column("x"), d).sum(axis=0))]
        whole = pa.array([decimal.Decimal(x) for x in (n, *total)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d), pa.int32()), whole], names=["i", "s"])
    got = dict(map(tuple, vectors.select("x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s")).collect()))
    return int(got.get(-1, 0)), [int(got.get(i, 0)) for i in range(d)]


def deviations(m: np.ndarray, n: int, sums: list[int]) -> list[decimal.Decimal]:
    """Exact sum over dimensions of (n x - S)^2 of every row: in longs where no
    product can overflow, else in Python's integers."""
    if n * int(np.abs(m).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        off = n * m - np.array(sums, np.int64)
        if len(sums) * int(np.abs(off).max(initial=0)) ** 2 >= 1 << 62:
            off = off.astype(object)
    else:
        off = n * m.astype(object) - np.array(sums, object)
    return [decimal.Decimal(int(x)) for x in (off * off).sum(axis=1)]


def covariance(vectors: DataFrame, column: str, n: int, mean: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of a column of equally long arrays, centred before
    multiplying: d rows of d doubles reach the driver."""
    d = len(mean)

    def run(batches):
        total, task = np.zeros((d, d)), 0
        for batch in batches:
            m = _matrix(batch.column("x"), d)
            for at in range(0, len(m), BLOCK):
                y = m[at:at + BLOCK] - mean
                total += y.T @ y
            task += batch.num_rows
        if task:
            rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), d).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), rows], names=["i", "row"])

    def add(keys):
        def run_group(t: pa.Table) -> pa.Table:
            total = _matrix(t.column("row"), d).sum(axis=0)
            return pa.table({**{k: t.column(k)[:1] for k in keys}, "row": pa.array([total], pa.list_(pa.float64()))})
        return run_group

    parts = (vectors.select(F.col(column).alias("x")).mapInArrow(run, "i int, row array<double>")
             .withColumn("g", F.spark_partition_id() % GROUPS))
    parts = parts.groupBy("i", "g").applyInArrow(add(("i", "g")), "i int, g int, row array<double>")
    parts = parts.groupBy("i").applyInArrow(add(("i",)), "i int, row array<double>")
    out = np.zeros((d, d))
    for r in parts.collect():
        out[r["i"]] = r["row"]
    return (out + out.T) / (2 * n)


def whiten(table: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n, deviation decimal, whitened, explained, identity_error) of
    every usable vector: ``whitened`` and ``explained`` are arrays by component."""
    spark = table.sparkSession
    vectors = grid_vectors(table, vec_id, embedding)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>"
    one = vectors.first()
    if one is None:
        return (spark.createDataFrame([], schema).withColumn("n", F.lit(0).cast("long"))
                .withColumns({"explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)}))
    d = len(one["x"])
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; at most {MAX_DIMENSIONS} are supported")
    n, sums = column_sums(vectors, d)
    mean = np.array([s / n for s in sums])
    v = covariance(vectors, "x", n, mean)
    values, basis = leading_eigenpairs(v, components)
    trace = float(np.trace(v))
    held = values > NO_VARIANCE * max(values[0], np.finfo(float).tiny)
    scaled = basis[:, held] / np.sqrt(values[held])
    shared = spark.sparkContext.broadcast((scaled, mean, sums))

    def run(batches):
        scaled, mean, sums = shared.value
        for batch in batches:
            m = _matrix(batch.column("x"), d)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviations(m, n, sums), pa.decimal128(38, 0)),
                 pa.array(list((m - mean) @ scaled), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    out = staged(vectors.mapInArrow(run, schema))
    error = 0.0
    if held.any():
        # of the written result itself, centred by its own mean
        centre = out.agg(*[F.avg(F.get("whitened", F.lit(i))).alias(f"m{i}") for i in range(int(held.sum()))]).first()
        error = float(np.abs(covariance(out, "whitened", n, np.array(list(centre))) - np.eye(int(held.sum()))).max())
    share = [float(x / trace) if h else 0.0 for x, h in zip(values, held)]
    missing = F.array_repeat(F.lit(None).cast("double"), int((~held).sum()))
    return (out.withColumn("whitened", F.concat("whitened", missing)).withColumn("n", F.lit(n).cast("long"))
            .withColumns({"explained": F.array(*[F.lit(s) for s in share]), "identity_error": F.lit(error)}))
