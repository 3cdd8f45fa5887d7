"""Whitening of embeddings by a bidiagonal qd solver.

The centred rows are never multiplied into a covariance: blocks of them are
reduced by QR to triangular factors, which are stacked and reduced again, some
at a time, until one R is left. Householder reflections bring R to an upper
bidiagonal B; the dqds recurrence (differential quotient-difference with
shifts) finds the singular values of B to high relative accuracy; twisted
factorisations of B'B give their vectors, which the reflections carry back to
the whitening directions.

What leaves the tasks is a factor of dimension x dimension numbers, whatever
the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 64, 1_000_000
BLOCK = 2048  # centred rows reduced at a time
FAN = 16  # factors reduced together
LEVELS = 5  # FAN ** LEVELS factors at most end in one
EPS = np.finfo(float).eps
CLUSTER = 1e-3  # relative gap of eigenvalues below which their vectors are made orthogonal


# -- the dense solver, on one triangular factor ---------------------------------

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction of a square matrix to upper bidiagonal form:
    diagonal, superdiagonal and the right reflectors (unit vectors)."""
    a = np.array(r, float)
    d = len(a)
    right = []
    for k in range(d):
        if k < d - 1:
            v = _reflector(a[k:, k])
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit v such that x - 2 v (v'x) has only its first entry (zero x: zero v)."""
    v = x.astype(float).copy()
    top = np.abs(v).max(initial=0.0)
    if top == 0:
        return v
    v /= top
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def carry_back(right: list[np.ndarray], z: np.ndarray) -> np.ndarray:
    """Vectors of the bidiagonal matrix (columns) as vectors of the full one."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        z[k + 1:] -= 2 * np.outer(right[k], right[k] @ z[k + 1:])
    return z


def _dqds_step(q, e, shift):
    """One dqds transform of the qd array, or None where the shift is too large."""
    n = len(q)
    nq, ne = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        nq[i] = d + e[i]
        if nq[i] == 0:
            ne[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / nq[i]
            ne[i] = e[i] * t
            d = d * t - shift
    if not d >= 0:
        return None
    nq[-1] = d
    return nq, ne


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B from the squared diagonal and superdiagonal of B, by
    dqds transforms, each as far shifted as stays below the smallest one; rows
    part where a superdiagonal entry has become negligible. Falling order."""
    found, work = [], [(list(map(float, q)), list(map(float, e)), 0.0)]
    while work:
        q, e, done = work.pop()
        for _ in range(40 * len(q) + 200):
            if len(q) == 1:
                found.append(q[0] + done)
                break
            if len(q) == 2:
                found += [x + done for x in _two(*q, e[0])]
                break
            cut = [i for i in range(len(e)) if e[i] <= EPS * EPS * (done + min(q[i], q[i + 1])) or e[i] == 0]
            if cut:
                i = cut[-1] + 1
                work += [(q[:i], e[:i - 1], done), (q[i:], e[i:], done)]
                break
            if q[0] < q[-1]:  # small values to the end: the transpose, flipped, is bidiagonal with the same values
                q, e = q[::-1], e[::-1]
            shift = _two(q[-2], q[-1], e[-1])[1] * (1 - 4 * EPS)
            step = None
            for _ in range(3):
                step = _dqds_step(q, e, shift)
                if step:
                    break
                shift *= 0.5 if shift > EPS * q[-1] else 0.0
            if not step:
                shift, step = 0.0, _dqds_step(q, e, 0.0)
            q, e = step
            done += shift
        else:
            raise ArithmeticError("the qd iteration did not converge")
    return sorted(found, reverse=True)


def _two(a: float, b: float, e: float) -> tuple[float, float]:
    """Eigenvalues of the 2 x 2 qd array (a, b; e), larger first."""
    half = (a + b + e) / 2
    if half == 0:
        return 0.0, 0.0
    gap = np.sqrt(((a - b + e) / 2) ** 2 + b * e)
    large = half + gap
    return float(large), float(a / large * b)


def twisted_vector(d: np.ndarray, f: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B (diagonal d, superdiagonal f of B, d not zero)
    for an accurate eigenvalue: the stationary factorisation from the top and
    the progressive one from the bottom meet where the twist is smallest."""
    n = len(d)
    tiny = np.finfo(float).tiny / EPS
    q, l = d * d, np.append(f / d[:-1], 0.0)
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        lower[i] = q[i] * l[i] / pivot
        s[i + 1] = lower[i] * l[i] * s[i] - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = q[i] * l[i] * l[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        upper[i] = l[i] * q[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    twist = s + p + value
    r = int(np.nanargmin(np.abs(twist)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def principal_axes(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a triangular factor, falling, and its unit
    right vectors (columns) in that order."""
    d, f, right = bidiagonalise(r)
    n = len(d)
    size = max(np.abs(d).max(initial=0.0), np.abs(f).max(initial=0.0))
    if size == 0:
        return np.zeros(n), np.eye(n)
    d, f = d / size, f / size
    d = np.where(np.abs(d) < EPS * EPS, EPS * EPS, d)
    # the matrix falls apart where the superdiagonal is below the rounding of both its neighbours
    cuts = [0, *(i + 1 for i in range(n - 1) if abs(f[i]) <= 4 * EPS * min(abs(d[i]), abs(d[i + 1]))), n]
    values, vectors = [], []
    for a, b in zip(cuts, cuts[1:]):
        part = dqds(list(d[a:b] ** 2), list(f[a:b - 1] ** 2))
        for group in _clusters(part):
            held: list[np.ndarray] = []
            for k in group:
                z = np.zeros(n)
                z[a:b] = _orthogonal(d[a:b], f[a:b - 1], part[k], held, k)
                held.append(z[a:b])
                values.append(part[k])
                vectors.append(z)
    order = np.argsort(-np.array(values), kind="stable")
    z = carry_back(right, np.array(vectors).T[:, order])
    return np.array(values)[order] * size * size, z


def _clusters(values: list[float]) -> list[list[int]]:
    groups: list[list[int]] = []
    for k, v in enumerate(values):
        if groups and values[k - 1] - v <= CLUSTER * values[k - 1]:
            groups[-1].append(k)
        else:
            groups.append([k])
    return groups


def _orthogonal(d, f, value, held, seed):
    """The eigenvector of ``value`` orthogonal to those found in its cluster:
    the twisted one where it is, else inverse iteration from there with the
    same factorisations."""
    z = twisted_vector(d, f, value)
    rng = np.random.default_rng(seed)
    for _ in range(8):
        rest = _without(z, held)
        if np.linalg.norm(rest) > 0.5:
            break
        if np.linalg.norm(rest) < 1e-8:
            rest = _without(rng.standard_normal(len(d)), held)
        z = _solve(d, f, value, rest)
    rest = _without(z, held)
    return rest / np.linalg.norm(rest)


def _without(z, held):
    """z less its parts along the held vectors."""
    for _ in range(2):
        for h in held:
            z = z - (h @ z) * h
    return z


def _solve(d, f, value, b):
    """Solution of (B'B - value) x = b by the stationary factorisation, scaled."""
    n = len(d)
    floor = EPS * max(value, np.finfo(float).tiny / EPS)
    q, l = d * d, np.append(f / d[:-1], 0.0)
    pivots, lower, s = np.empty(n), np.zeros(n), -value
    for i in range(n):
        pivots[i] = s + q[i]
        if abs(pivots[i]) < floor:
            pivots[i] = -floor
        if i < n - 1:
            lower[i] = q[i] * l[i] / pivots[i]
            s = lower[i] * l[i] * s - value
    x = b / np.linalg.norm(b)
    for i in range(1, n):
        x[i] -= lower[i - 1] * x[i - 1]
    x = x / pivots
    for i in range(n - 2, -1, -1):
        x[i] -= lower[i] * x[i + 1]
    return x / np.linalg.norm(x)


# -- the distributed part -----------------------------------------------------------

def usable(vector: Column) -> Column:
    """Whether a vector is whole: not null, no null and no non-finite entry,
    and small enough for 64 c + 1,000,000 to be a long."""
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float(1 << 56), F.lit(False))),
                      F.lit(False))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch as integers floor(64 c) + 1,000,000."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    return np.floor(SCALE * c).astype(np.int64) + OFFSET


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the exact integers n x - S, divided once."""
    return _deviations(x, n, sums).astype(float) / n


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    top = int(np.abs(x).max(initial=0))
    if n * top + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(dev: np.ndarray) -> list[int]:
    """Exact sums of squares over the dimensions."""
    top = int(np.abs(dev).max(initial=0))
    if dev.dtype != object and top * top * dev.shape[1] < 1 << 62:
        return (dev * dev).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in dev]


def _sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and per-dimension sums, exactly."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * dim
        for batch in batches:
            x = _integers(batch.column(0), dim)
            n += len(x)
            top = int(np.abs(x).max(initial=0))
            part = x.sum(axis=0) if top * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
            s = [a + int(b) for a, b in zip(s, part)]
        yield pa.RecordBatch.from_pydict({"dim": list(range(-1, dim)), "total": [str(n), *map(str, s)]})

    found = (rows.mapInArrow(partial, "dim long, total string").groupBy("dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())  # one row per dimension
    total = {r["dim"]: int(r["total"]) for r in found}
    return total.get(-1, 0), [total.get(i, 0) for i in range(dim)]


def _factor(rows: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, any_rows = np.zeros((dim, dim)), False
        for batch in batches:
            x = _integers(batch.column(0), dim)
            for i in range(0, len(x), BLOCK):
                r, any_rows = _reduce(r, _centred(x[i:i + BLOCK], n, sums)), True
        if any_rows:
            yield pa.RecordBatch.from_pydict({"r": [r.tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        r = np.zeros((dim, dim))
        for raw in table.column("r"):
            r = _reduce(r, np.frombuffer(raw.as_py()).reshape(dim, dim))
        return pa.table({"g": pa.array([table.column("g")[0].as_py() // FAN], pa.int64()), "r": [r.tobytes()]})

    parts = rows.mapInArrow(blocks, "r binary").select(F.floor(F.spark_partition_id() / FAN).cast("long").alias("g"), "r")
    for _ in range(LEVELS):
        parts = parts.groupBy("g").applyInArrow(merge, "g long, r binary")
    r = np.zeros((dim, dim))
    for row in parts.select("r").toLocalIterator():  # one factor
        r = _reduce(r, np.frombuffer(row["r"]).reshape(dim, dim))
    return r


def _reduce(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([r, rows]), mode="r")


def _identity_error(rows: DataFrame, dim: int, n: int, sums: list[int], axes: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = axes.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _centred(_integers(batch.column(0), dim), n, sums) @ axes
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_pydict({"i": np.arange(k * k + k), "v": np.concatenate([second.ravel(), first])})

    got = rows.mapInArrow(partial, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # k (k + 1) rows
    v = np.zeros(k * k + k)
    for r in got:
        v[r["i"]] = r["v"]
    mean = v[k * k:] / n
    return float(np.abs(v[:k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 32, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Every usable vector whitened: (``id_col``, whitened array<double>, n,
    deviation decimal(38,0), explained array<double>, identity_error double).

    Vectors enter as the integers floor(64 c) + 1,000,000 of their entries;
    ``deviation`` is the exact sum over dimensions of (n x - S)^2, the arrays
    go by falling eigenvalue. Rows are dropped whose vector is null, holds a
    null or non-finite entry (or one beyond 2^56, which gives no exact long),
    is empty, or has not the most frequent length (ties: the longest).
    Directions without variance (a singular value below dimension x rounding
    of the largest) have no whitening and are left out, so the arrays may be
    shorter than ``components``: empty where all rows are equal. Repeated rows
    and ids count each; an empty table gives no rows; other columns are not
    read.
    """
    spark = vectors.sparkSession
    good = vectors.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{vector}`").alias("_v")).where(
        usable(F.col("_v")) & (F.size("_v") > 0))
    schema = T.StructType([good.schema[id_col], T.StructField("whitened", T.ArrayType(T.DoubleType())),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("explained", T.ArrayType(T.DoubleType())),
                           T.StructField("identity_error", T.DoubleType())])
    lengths = good.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dim = lengths[0]["d"]
    good = good.where(F.size("_v") == dim)
    rows = good.select("_v")
    n, sums = _sums(rows, dim)
    squares, directions = principal_axes(_factor(rows, dim, n, sums))
    held = squares > (dim * EPS) ** 2 * squares[0]
    values, directions = squares[held] / n, directions[:, held]
    explained = (values / values.sum())[:components].tolist() if len(values) else []
    axes = directions[:, :components] / np.sqrt(values[:components])
    error = _identity_error(rows, dim, n, sums, axes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            dev = _deviations(_integers(batch.column(1), dim), n, sums)
            w = (dev.astype(float) / n) @ axes
            m, k = w.shape
            arrays = [pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * k), pa.array(flat))
                      for flat in (w.ravel(), np.tile(np.array(explained, float), m))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), arrays[0], pa.array(np.full(m, n)),
                 pa.array([Decimal(s) for s in _squares(dev)], pa.decimal128(38, 0)), arrays[1],
                 pa.array(np.full(m, error))], names=schema.fieldNames())

    return good.select(id_col, "_v").mapInArrow(project, schema)


def whitened_components(vectors: DataFrame, components: int = 32) -> DataFrame:
    """One row per usable vector and component (numbered from 1)."""
    w = whiten(vectors, components)
    pairs = w.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error",
                     F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c"))
    return pairs.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation",
                        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
