"""Embedding whitening by a bidiagonal qd solver.

Entries become fixed-point integers ``floor(1024 c) + 100000``. One pass adds them up exactly. A second
pass centres the rows and reduces them blockwise by QR: a task keeps one triangle, triangles are
combined in a tree of ``FAN_IN``. The driver holds the last triangle only, dimension squared numbers:
Householder reflections make it bidiagonal, dqds finds its singular values with high relative
accuracy, and twisted factorisations give the right singular vectors, which are the principal
directions. The third pass projects each row and divides by the standard deviation; the covariance
of the projections is then measured over all rows.

Defined cases: rows whose vector is null or empty, holds null or non-finite entries or entries of 2^52 or
more (their integers need not fit 64 bits) are left out; so are rows of another length than the most
frequent one (of equally frequent lengths the longest). Repeated rows and null ids count and are returned like others. Only
components with variance are returned: at most the dimension, none for one row or equal rows. An
empty table gives an empty result. Other columns are not read.

No row is shuffled: sums leave a task as one row per dimension, triangles as one row per task. The
driver's work grows with the dimension, not with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.session import stored

#: Fixed values of the fixed-point form.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
FAN_IN = 16

_BLOCK_ROWS = 2048
_SAFE = 1 << 62
_EPS = float(np.finfo(float).eps)
_NEGLIGIBLE = (100 * _EPS) ** 2
_CLUSTER = 1e-3  # relative gap below which vectors are made orthogonal to their neighbours


# Rows ---------------------------------------------------------------------------------------


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str,
                dimension: int | None = None) -> tuple[DataFrame, int]:
    """(id, v array<double>) of the rows that count, and their dimension, sought where it is not given."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter((F.size("v") > 0) & F.coalesce(F.forall(
        "v", lambda c: c.isNotNull() & (F.abs(c) < float(1 << 52))), F.lit(False)))
    if dimension is None:
        sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
        largest = sizes.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
        dimension = largest["d"] if largest else 0
    return rows.filter(F.size("v") == dimension), dimension


def _fixed_point(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(-1, dimension)).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK_ROWS):
            part = batch.slice(start, _BLOCK_ROWS)
            yield part.column("id"), _fixed_point(part.column("v"), dimension)


def _exact_sums(x: np.ndarray) -> list[int]:
    largest = int(np.abs(x).max(initial=0))
    if largest * len(x) < _SAFE:
        return x.sum(0).tolist()
    return [sum(c) for c in x.T.tolist()]


@dataclass(frozen=True)
class Sums:
    """Exact number of rows and sums per dimension."""

    n: int
    totals: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - sum`` exactly: 64-bit integers, or Python's where these would overflow."""
        largest = max(abs(int(x.min(initial=0))), int(x.max(initial=0)))
        bound = self.n * largest + max(map(abs, self.totals))
        wide = np.int64 if bound < _SAFE else object
        return x.astype(wide) * self.n - np.array(self.totals, wide)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)

    def squared(self, x: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of the squared deviations; null beyond 38 digits."""
        gaps = self.deviations(x)
        largest = max(abs(int(gaps.min(initial=0))), int(gaps.max(initial=0)))
        if largest * largest * gaps.shape[1] < _SAFE:
            return pa.array((gaps.astype(np.int64) ** 2).sum(1), pa.int64()).cast(pa.decimal128(38, 0))
        whole = [sum(g * g for g in row) for row in gaps.tolist()]
        return pa.array([Decimal(w) if w < 10**38 else None for w in whole], pa.decimal128(38, 0))


def exact_sums(rows: DataFrame, dimension: int) -> Sums:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * dimension
        for _, x in _blocks(batches, dimension):
            n += len(x)
            totals = [t + s for t, s in zip(totals, _exact_sums(x), strict=True)]
        if n:  # 32 low bits apart, so that sums of many tasks stay 64-bit numbers
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(range(dimension), pa.int32()),
                "n": pa.array([n] * dimension, pa.int64()),
                "high": pa.array([t >> 32 for t in totals], pa.int64()),
                "low": pa.array([t & 0xFFFFFFFF for t in totals], pa.int64())})

    found = rows.mapInArrow(add_up, "place int, n long, high long, low long").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    by_place = {r["place"]: r for r in found.collect()}
    if not by_place:
        return Sums(0, [])
    totals = [(by_place[i]["high"] << 32) + by_place[i]["low"] for i in range(dimension)]
    return Sums(by_place[0]["n"], totals)


# Blockwise QR -------------------------------------------------------------------------------


def _stacked(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    both = rows if triangle is None else np.vstack([triangle, rows])
    return np.linalg.qr(both, mode="r")


def _triangle_row(triangle: np.ndarray, part: int) -> dict[str, pa.Array]:
    return {"part": pa.array([part], pa.int64()),
            "r": pa.array([triangle.ravel()], pa.list_(pa.float64()))}


def triangle(rows: DataFrame, dimension: int, sums: Sums) -> np.ndarray:
    """R of the QR factorisation of all centred rows, padded with zeros to a square."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for _, x in _blocks(batches, dimension):
            own = _stacked(own, sums.centred(x))
        if own is not None:
            yield pa.RecordBatch.from_pydict(_triangle_row(own, 0))

    def combine(group: pa.Table) -> pa.Table:
        own = None
        for r in group.column("r"):
            own = _stacked(own, r.values.to_numpy().reshape(-1, dimension))
        return pa.table(_triangle_row(own, group.column("part")[0].as_py() // FAN_IN))

    factors = rows.mapInArrow(reduce, "part long, r array<double>")
    factors = stored(factors.withColumn("part", F.spark_partition_id().cast("bigint")), "triangles")
    while (count := factors.count()) > 1:
        factors = stored(factors.groupBy(F.floor(F.col("part") / FAN_IN).alias("of")).applyInArrow(
            combine, "part long, r array<double>"), "triangles")
    if not count:
        return np.zeros((dimension, dimension))
    own = np.array(factors.first()["r"]).reshape(-1, dimension)
    return np.vstack([own, np.zeros((dimension - len(own), dimension))])


# Bidiagonal form, singular values, vectors --------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta so that (1 - beta v v') x has zeros after its first entry."""
    largest = np.abs(x).max(initial=0.0)
    if len(x) < 2 or largest == 0 or not np.abs(x[1:]).max():
        return x, 0.0
    v = x / largest
    v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w): non-negative diagonal and superdiagonal of B, where r' r = w B' B w'."""
    m, d = r.astype(float).copy(), len(r)
    w = np.eye(d)
    for k in range(d):
        v, beta = _reflector(m[k:, k])
        if beta:
            m[k:, k:] -= np.outer(beta * v, v @ m[k:, k:])
        if k < d - 2:
            v, beta = _reflector(m[k, k + 1:])
            if beta:
                m[k:, k + 1:] -= np.outer(m[k:, k + 1:] @ v, beta * v)
                w[:, k + 1:] -= np.outer(w[:, k + 1:] @ v, beta * v)
    a, b = np.diag(m).copy(), np.diag(m, 1).copy()
    signs = np.cumprod(np.concatenate([[1.0], np.where(a[:-1] * b < 0, -1.0, 1.0)]))
    return np.abs(a), np.abs(b), w * signs


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd step with a shift, and the smallest d; that is negative if the shift is too large."""
    new_q, new_e, d = [], [], q[0] - shift
    least = d
    for i in range(len(e)):
        total = d + e[i]
        if total <= 0:
            return new_q, new_e, min(least, -1.0)
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, largest first."""
    unit = max(float(a.max(initial=0.0)), float(b.max(initial=0.0))) or 1.0
    found: list[float] = []
    work = [((a / unit) ** 2, (b / unit) ** 2, 0.0, 0.0)]
    while work:
        q, e, moved, least = work.pop()
        q, e = list(q), list(e)
        cut = next((i for i in range(len(e))
                    if e[i] <= _NEGLIGIBLE * (moved + q[i + 1]) or e[i] <= _NEGLIGIBLE * q[i]), None)
        if cut is not None:
            work += [(q[:cut + 1], e[:cut], moved, 0.0), (q[cut + 1:], e[cut + 1:], moved, 0.0)]
            continue
        if len(q) == 1:
            found.append(moved + max(q[0], 0.0))
            continue
        if q[0] < q[-1]:  # the smallest values leave at the end
            q, e = q[::-1], e[::-1]
        for part in (0.999, 0.75, 0.25, 0.0):
            new_q, new_e, new_least = _transformed(q, e, part * least)
            if new_least >= 0:
                break
        else:  # without a shift only rounding can make d negative
            new_q, new_e, new_least = [max(x, 0.0) for x in new_q], new_e, 0.0
        work.append((new_q, new_e, moved + part * least, new_least))
    return np.sort(found)[::-1] * unit * unit


class Twisted:
    """Twisted factorisation of B' B - value, for a bidiagonal B without zeros."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = self.n = len(a)
        square, ratio = a * a, b / a[:-1]
        tiny = _EPS * _EPS * max(float(square.max()), value, 1e-300)
        top, bottom = np.empty(n), np.empty(n)  # the differences of the two sweeps
        self.down, self.up = np.empty(n), np.empty(n)  # their pivots
        self.lower, self.upper = np.empty(n - 1), np.empty(n - 1)
        s, p = -value, square[-1] - value
        for i in range(n - 1):
            top[i] = s
            self.down[i] = (s + square[i]) or tiny
            self.lower[i] = a[i] * b[i] / self.down[i]
            s = self.lower[i] * ratio[i] * s - value
        top[n - 1], self.down[n - 1] = s, (s + square[n - 1]) or tiny
        for i in range(n - 2, -1, -1):
            bottom[i + 1] = p
            self.up[i + 1] = (b[i] * b[i] + p) or tiny
            t = square[i] / self.up[i + 1]
            self.upper[i] = ratio[i] * t
            p = p * t - value
        bottom[0] = p
        gaps = top + bottom + value
        self.at = int(np.argmin(np.abs(gaps)))
        self.gap = gaps[self.at] or tiny

    def vector(self) -> np.ndarray:
        z = np.zeros(self.n)
        z[self.at] = 1.0
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(self.at, self.n - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, f: np.ndarray) -> np.ndarray:
        g, r = f.astype(float).copy(), self.at
        for i in range(1, r + 1):
            g[i] -= self.lower[i - 1] * g[i - 1]
        for i in range(self.n - 2, r - 1, -1):
            g[i] -= self.upper[i] * g[i + 1]
        g[:r] /= self.down[:r]
        g[r + 1:] /= self.up[r + 1:]
        g[r] /= self.gap
        for i in range(r - 1, -1, -1):
            g[i] -= self.lower[i] * g[i + 1]
        for i in range(r, self.n - 1):
            g[i + 1] -= self.upper[i] * g[i]
        return g / np.linalg.norm(g)


def _vectors_of_block(a: np.ndarray, b: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """Unit right singular vectors of the block for the squared singular values, largest first."""
    if len(a) == 1:
        return [np.ones(1) for _ in values]
    a = np.maximum(a, _EPS * _EPS * max(float(a.max()), float(b.max())))
    found: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for i, value in enumerate(values):
        if not i or values[i - 1] - value > _CLUSTER * values[i - 1]:
            cluster = []
        factors = Twisted(a, b, value)
        z = factors.vector()
        for _ in range(8 if cluster else 0):
            for y in cluster * 2:
                z = z - (y @ z) * y
            left = float(np.linalg.norm(z))
            z = z / left if left else np.eye(len(a))[len(cluster)]
            if left > 0.7:
                break
            z = factors.solve(z)
        found.append(z)
        cluster.append(z)
    return found


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns): the largest squared singular values of ``r`` that are not zero."""
    a, b, w = bidiagonal(r)
    b[b <= _EPS * (a[:-1] + a[1:])] = 0.0
    starts = [0, *(np.flatnonzero(b == 0) + 1).tolist(), len(a)]
    blocks = list(zip(starts, starts[1:], strict=False))
    ranked = sorted(((v, k) for k, (i, j) in enumerate(blocks) for v in dqds(a[i:j], b[i:j - 1])),
                    reverse=True)
    floor = (len(a) * _EPS) ** 2 * (ranked[0][0] if ranked else 0.0)
    ranked = [x for x in ranked[:most] if x[0] > floor]
    vectors = np.zeros((len(a), len(ranked)))
    for k, (i, j) in enumerate(blocks):
        own = [c for c, (_, block) in enumerate(ranked) if block == k]
        for c, z in zip(own, _vectors_of_block(a[i:j], b[i:j - 1], [ranked[c][0] for c in own]),
                        strict=True):
            vectors[i:j, c] = z
    vectors = w @ vectors
    for c in range(len(ranked)):  # the largest entry is positive
        vectors[:, c] *= np.sign(vectors[np.abs(vectors[:, c]).argmax(), c])
    return np.array([v for v, _ in ranked]), vectors


# Whitening ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What whitening needs: exact sums, directions over standard deviations, explained shares."""

    dimension: int
    sums: Sums
    weights: np.ndarray
    explained: list[float]


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
        components: int = COMPONENTS) -> Model:
    rows, dimension = usable_rows(vectors, id_col, vector_col)
    sums = exact_sums(rows, dimension) if dimension else Sums(0, [])
    if not sums.n:
        return Model(0, sums, np.zeros((0, 0)), [])
    r = triangle(rows, dimension, sums)
    values, found = directions(r, components)
    whole = float((r * r).sum())
    return Model(dimension, sums, found / np.sqrt(values / sums.n),
                 [float(v) / whole for v in values])


def project(vectors: DataFrame, model: Model, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(id, deviation decimal, whitened array<double>) of the usable rows of the model's dimension."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, deviation decimal(38,0), whitened array<double>"
    if not model.explained:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, model.dimension):
            z = model.sums.centred(x) @ model.weights
            yield pa.RecordBatch.from_arrays(
                [ids, model.sums.squared(x), pa.array(list(z), pa.list_(pa.float64()))],
                ["id", "deviation", "whitened"])

    rows, _ = usable_rows(vectors, id_col, vector_col, model.dimension)
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest entry of the projections' covariance minus the identity, measured over all rows."""
    z = [F.col("whitened")[i] for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)],
                        *[F.avg(z[i] * z[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"g{i}_{j}"] - row[f"m{i}"] * row[f"m{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per usable row and component."""
    model = fit(vectors, id_col, vector_col, components)
    projected = project(vectors, model, id_col, vector_col)
    found, error = len(model.explained), None
    if found:
        projected = stored(projected, "whitened")
        error = identity_error(projected, found)
    shares = F.array(*map(F.lit, model.explained)).cast("array<double>")
    return projected.select(id_col, "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        id_col, (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.sums.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
