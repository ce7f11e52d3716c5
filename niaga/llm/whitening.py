"""Whitening of embeddings by spectrum slicing (operator 11).

Entries become whole numbers, floor(256 c). The mean and the covariance (divisor n) are those of the distinct vectors: their sums
are exact, and the products are made of centred entries inside the partitions and summed by Spark; the driver holds one matrix of
the size of the dimensions. There, the inertia of the LDL' factors of the shifted covariance counts the eigenvalues above a shift
(Sylvester's law). Bisection on these counts isolates each leading eigenvalue, Rayleigh quotient iteration from the interval
converges cubically to its vector, and two more counts around the quotient certify its number. Equal eigenvalues cannot be isolated:
an interval that is as narrow as rounding allows is taken for a cluster, whose vectors are kept orthogonal to each other.

Results for odd rows: vectors that are null or hold null or non-finite entries, or entries whose 256-fold is no long, are dropped;
empty vectors have no component, and rows of them no result; vectors of another length are a data set of their own, with its own
fit; repeated rows are returned each and fitted once; a null id stays null; a component whose variance is within rounding of zero (one
distinct vector, fewer vectors or dimensions than components) is not returned; a deviation beyond 38 digits is null; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from niaga.llm.common import BATCH_BYTES, batch, cut
from niaga.llm.vectors import matrix

COMPONENTS = 4
SCALE = 256
_EPS = np.finfo(float).eps
_SAFE = 1 << 62  # sums below it are exact in 64 bits


class Model(NamedTuple):
    """What is learned from the distinct vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray  # leading eigenvalues, falling
    directions: np.ndarray  # (dimensions, components)
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - sum)^2, exact."""
        most = max(1, int(np.abs(x.astype(float)).max(initial=0)) + 1)
        reach = self.n * most + max(abs(s) for s in self.sums)
        if reach * reach * len(self.sums) < _SAFE:
            apart = x * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        squares = _dot(x, x, most * most)
        mixed = _dot(x, np.array(self.sums, object), most * max(abs(s) for s in self.sums))
        own = sum(s * s for s in self.sums)
        return [self.n * self.n * int(q) - 2 * self.n * int(p) + own for q, p in zip(squares, mixed, strict=True)]


def _dot(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Row sums of x * y in whole numbers; in 64 bits where no sum can leave them."""
    if most * x.shape[1] < _SAFE:
        return (x * y.astype(np.int64)).sum(axis=1)
    return (x.astype(object) * y.astype(object)).sum(axis=1)


# --- spectrum slicing on the driver ---------------------------------------------------------


def above(v: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of a symmetric matrix above a shift: the positive ones of D in LDL' of v - shift I."""
    a, count = v - shift * np.eye(len(v)), 0
    limit = (1 + 17**0.5) / 8  # bounds the growth of the entries
    while len(a):
        size, swap = 1, 0
        rest = np.abs(a[1:, 0])
        if len(rest) and abs(a[0, 0]) < limit * rest.max():
            r = 1 + int(rest.argmax())
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < limit * rest.max() ** 2:
                swap, size = (r, 1) if abs(a[r, r]) >= limit * row.max() else (r, 2)
        if swap:
            to = size - 1
            a[[to, swap]] = a[[swap, to]]
            a[:, [to, swap]] = a[:, [swap, to]]
        pivot, below = a[:size, :size], a[size:, :size]
        if size == 2:
            count += 1  # such a pivot has one eigenvalue of each sign
            a = a[2:, 2:] - below @ np.linalg.solve(pivot, below.T)
        else:
            count += int(pivot[0, 0] > 0)
            a = a[1:, 1:] - (np.outer(below[:, 0], below[:, 0]) / pivot[0, 0] if pivot[0, 0] else 0)
    return count


def _refined(v: np.ndarray, start: float, others: np.ndarray, norm: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift, orthogonal to the vectors already found."""
    d, random = len(v), np.random.default_rng(len(v))
    x, shift, best = random.normal(size=d), start, None
    for turn in range(60):
        for beside in (0, 4, 16):  # a shift that is an eigenvalue to the last bit cannot be solved for
            try:
                y = np.linalg.solve(v - (shift + beside * _EPS * norm) * np.eye(d), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                break
        else:
            y = random.normal(size=d)
        for _ in range(2):
            y = y / (np.abs(y).max() or 1)
            y = y - others @ (others.T @ y)
            if not y.any():
                y = random.normal(size=d)
            y = y / np.sqrt(y @ y)
        value = float(y @ v @ y)
        left = v @ y - value * y
        left = left - others @ (others.T @ left)
        error = float(np.sqrt(left @ left))
        if best is not None and error >= best[0] and best[0] <= 64 * _EPS * norm:
            break  # no nearer in double precision
        if best is None or error < best[0]:
            best = error, value, y
        x = y
        if turn >= 2:  # the first solves stay at the start, to reach the nearest eigenvalue
            shift = value
    return best[1], best[2]


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the largest eigenvalues of a covariance, numbered by counts; only those above rounding."""
    d = len(v)
    norm = float(np.abs(v).sum(axis=1).max())
    rounding = 4 * d * _EPS * norm
    values: list[float] = []
    vectors = np.zeros((d, 0))
    counted: dict[float, int] = {}

    def count(shift: float) -> int:
        if shift not in counted:
            counted[shift] = above(v, shift)
        return counted[shift]

    for k in range(1, min(wanted, count(rounding)) + 1):
        # eigenvalue k lies in (low, high]
        low = max(s for s in (rounding, *counted) if count(s) >= k)
        high = min((s for s in counted if s > low and counted[s] < k), default=norm + rounding)
        while True:
            while high - low > rounding and not (count(low) == k and count(high) == k - 1):
                middle = (low + high) / 2
                low, high = (middle, high) if count(middle) >= k else (low, middle)
            value, vector = _refined(v, (low + high) / 2, vectors, norm)
            near = low - rounding <= value <= high + rounding
            if near and count(value - rounding) >= k and count(value + rounding) < k or high - low <= rounding:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= k else (low, middle)
        values.append(value)
        vectors = np.column_stack([vectors, vector])
    return np.array(values), vectors


# --- the data -------------------------------------------------------------------------------


def whole(v: Column) -> Column:
    """The entries as whole numbers; null for a vector that is dropped."""
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float((1 << 63) // SCALE)))
    return F.when(F.coalesce(fits, F.lit(False)), F.transform(v, lambda c: F.floor(c * SCALE).cast("long")))


def _by_length(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their vectors as a matrix) for each length in it."""
    column = part.column("x")
    sizes = np.asarray(column.value_lengths())
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, matrix(column.take(pa.array(rows)) if len(rows) < len(sizes) else column)


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """(n, exact sums) of the vectors of each length."""
    kinds = [("d", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part in batches:
            for _, x in _by_length(part):
                n, s = held.get(x.shape[1], (0, [0] * x.shape[1]))
                most = int(np.abs(x.astype(float)).max(initial=0)) + 1
                own = (x if most * len(x) < _SAFE else x.astype(object)).sum(axis=0)
                held[x.shape[1]] = n + len(x), [a + int(b) for a, b in zip(s, own, strict=True)]
        for d, (n, s) in held.items():
            yield batch(schema, [d] * d, range(d), [n] * d, s)

    made = fit.mapInArrow(work, "d int, i int, n long, s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in made.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect():
        out.setdefault(r.d, (r.n, []))[1].append(int(r.s))
    return out


def _covariances(fit: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Covariance of the vectors of each length: centred, then multiplied, summed inside each partition."""
    means = {d: np.array([s / n for s in own]) for d, (n, own) in sums.items()}
    schema = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("c", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in batches:
            for _, x in _by_length(part):
                apart = x - means[x.shape[1]]
                held[x.shape[1]] = held.get(x.shape[1], 0) + apart.T @ apart
        for d, c in held.items():
            for i in range(d):
                yield batch(schema, [d] * (d - i), [i] * (d - i), range(i, d), c[i, i:])

    made = fit.mapInArrow(work, "d int, i int, j int, c double").groupBy("d", "i", "j").agg(F.sum("c").alias("c")).toArrow()
    d, i, j, c = (made.column(name).to_numpy() for name in ("d", "i", "j", "c"))
    out = {}
    for size in means:
        own = d == size
        v = np.zeros((size, size))
        v[i[own], j[own]] = c[own]
        out[size] = (v + np.triu(v, 1).T) / sums[size][0]
    return out


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: the largest entry of the whitened vectors' covariance beyond the identity."""
    schema = pa.schema([("d", pa.int32()), ("y", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for _, x in _by_length(part):
                yield batch(schema, [x.shape[1]] * len(x), list(models[x.shape[1]].whiten(x)))

    most = max((len(m.values) for m in models.values()), default=0)
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    if not pairs:
        return dict.fromkeys(models, 0.0)
    of = lambda a: F.get("y", F.lit(a))
    covered = fit.mapInArrow(work, "d int, y array<double>").groupBy("d")
    rows = covered.agg(*[F.covar_pop(of(a), of(b)).alias(f"c{a}_{b}") for a, b in pairs]).collect()
    found = dict.fromkeys(models, 0.0)
    for r in rows:
        own = [(a, b) for a, b in pairs if b < len(models[r.d].values)]
        found[r.d] = max((abs(r[f"c{a}_{b}"] - (a == b)) for a, b in own), default=0.0)
    return found


def fit_models(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The model of each vector length, from distinct vectors (x array<long>)."""
    sums = _sums(fit)
    out = {}
    for d, v in _covariances(fit, sums).items():
        values, directions = leading(v, components)
        out[d] = Model(*sums[d], values, directions, float(np.trace(v)))
    return out


def whitened(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every vector and component, from 1."""
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col).cast("array<double>")).alias("x"))
    rows = rows.filter("x is not null and size(x) > 0")
    fit = cut(rows.select("x").distinct())
    models = fit_models(fit, components)
    errors = _identity_errors(fit, models)
    kinds = [("vec_id", pa.int64()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("identity_error", pa.float64())]
    schema = pa.schema([*kinds, ("whitened", pa.list_(pa.float64())), ("explained", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at, x in _by_length(part):
                m = models[x.shape[1]]
                if len(m.values):
                    apart = [a if a < 10**38 else None for a in m.deviations(x)]
                    same = [m.n] * len(x), apart, [errors[x.shape[1]]] * len(x)
                    yield batch(schema, part.column("vec_id").take(pa.array(at)), *same, list(m.whiten(x)), [m.values / m.trace] * len(x))

    made = rows.mapInArrow(
        work, "vec_id long, n long, deviation decimal(38,0), identity_error double, whitened array<double>, explained array<double>"
    )
    each = made.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
