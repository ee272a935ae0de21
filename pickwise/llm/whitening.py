"""Whitening of vectors with a covariance put together from squared sums (polarisation).

For whole numbers a and b, the variance of a + b is var(a) + var(b) + 2 cov(a, b). So only squares are
summed: one sum for every dimension and one for the sum of every pair of dimensions, each over the
centred values of the distinct vectors. Differences of these sums give all covariances.

Everything up to the matrix is exact. An entry c counts as x = floor(256 c). With n distinct vectors and
their sum S per dimension, the centred value times n is n x - S = n u + r, where u = x - m, m is the whole
number nearest to S / n, and r = n m - S. The tasks square and sum u, and as the sum of u is known to be
-r, the sum of (n x - S)^2 is n^2 sum(u^2) - n r^2 in Python's unbounded whole numbers.

* Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are those with
  an entry outside +-2^54, where 256 c no longer fits a long.
* Vectors of another length than most (of equals: the longer) are dropped: they have no covariance with
  the others.
* Repeated vectors count once for the fit; every row gets its result. Null ids stay null.
* An empty table gives an empty one. Components without variance get the eigenvalue 0, a null
  ``whitened``, and do not count for ``identity_error``, which is null if there are no others.
* ``deviation`` is a decimal, null beyond 38 digits. Other columns of the table are ignored.

Tasks hold a batch of rows and one sum per pair of dimensions. The driver sees the sums, a number of
values that depends on the dimensions alone.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.workspace import materialize, scratch_scope

COMPONENTS = 4
_SCALE, _LARGEST = 256.0, 2.0**54
#: Rows squared at a time.
_ROWS = 1024
#: Partial sums travel as digits of this many bits, so that sums of them stay within a long.
_DIGIT = 32
_DIGITS = 5


@dataclass
class Fit:
    """Distinct vectors, their sums, and the whitening; ``axes`` has a column per component."""

    n: int
    sums: list[int]
    middle: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    identity_error: float | None = None

    @property
    def rest(self) -> list[int]:
        """n m - S for each dimension."""
        return [self.n * int(m) - s for m, s in zip(self.middle, self.sums)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of x by component; NaN for components without variance."""
        shift = np.array([r / self.n for r in self.rest])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ((x - self.middle) + shift) @ self.axes / np.sqrt(self.values)
        out[:, self.values <= 0] = np.nan
        return out


def whole_numbers(vector: Column) -> Column:
    """floor(256 c) of every entry as a long; null for a vector that takes no part."""
    c = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(c, lambda v: F.coalesce(F.abs(v) < _LARGEST, F.lit(False)))  # NaN is the largest
    return F.when(good & (F.size(c) > 0), F.transform(c, lambda v: F.floor(v * _SCALE).cast("long")))


def _rows(column: pa.Array) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _split(value: int) -> list[int]:
    low = [(value >> (_DIGIT * k)) & ((1 << _DIGIT) - 1) for k in range(_DIGITS - 1)]
    return [*low, value >> (_DIGIT * (_DIGITS - 1))]


def _total(partial: DataFrame) -> list[int]:
    """The sums by place, from rows of (place, digits)."""
    digits = [F.sum(F.col("digits")[k]).alias(f"d{k}") for k in range(_DIGITS)]
    rows = partial.groupBy("place").agg(*digits).orderBy("place").collect()
    return [sum(row[f"d{k}"] << (_DIGIT * k) for k in range(_DIGITS)) for row in rows]


def _summed(table: DataFrame, terms) -> list[int]:
    """Exact column sums of ``terms(x)`` over all rows; one row per place and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            x = _rows(batch.column(0))
            for at in range(0, len(x), _ROWS):
                found = terms(x[at : at + _ROWS])
                sums = found if sums is None else [a + b for a, b in zip(sums, found)]
        if sums is not None:
            yield pa.RecordBatch.from_pydict(
                {"place": range(len(sums)), "digits": [_split(s) for s in sums]},
                pa.schema([("place", pa.int64()), ("digits", pa.list_(pa.int64()))]),
            )

    return _total(table.select("x").mapInArrow(run, "place long, digits array<long>"))


def _column_sums(x: np.ndarray) -> list[int]:
    if np.abs(x).max(initial=0) >= 1 << 50:
        x = x.astype(object)
    return [int(s) for s in x.sum(0)]


def pair_places(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i + 1, d)]


def squared_sums(u: np.ndarray) -> list[int]:
    """Sums of u_i^2 for all dimensions, then of (u_i + u_j)^2 for all pairs in order."""
    if np.abs(u).max(initial=0) >= 1 << 25:  # (2 * 2^25)^2 * 1024 rows still fit a long
        u = u.astype(object)
    out = [int(s) for s in (u * u).sum(0)]
    for i in range(u.shape[1] - 1):
        pair = u[:, i : i + 1] + u[:, i + 1 :]
        out += [int(s) for s in (pair * pair).sum(0)]
    return out


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariance of x from the sums of ``squared_sums`` over u = x - m, each entry rounded once.

    n^2 times a covariance is a whole number times n^-1; the division is the only rounding.
    """
    d = len(rest)
    own = [n * n * squares[i] - n * rest[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n**3
    for (i, j), square in zip(pair_places(d), squares[d:]):
        both = n * n * square - n * (rest[i] + rest[j]) ** 2
        out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**3)
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Whitening of the distinct vectors ``x`` (equal lengths); None without any."""
    n = distinct.count()
    if not n:
        return None
    sums = _summed(distinct, _column_sums)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    squares = _summed(distinct, lambda x: squared_sums(x - middle))
    rest = [n * int(m) - s for m, s in zip(middle, sums)]
    v = covariance(n, rest, squares)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    # What is left of a zero eigenvalue by rounding.
    values = np.where(values > len(v) * np.finfo(float).eps * max(values[0], 0), values, 0.0)
    trace = float(np.trace(v))
    explained = [float(e) / trace if trace else None for e in values[:components]]
    found = Fit(n, sums, middle, axes[:, :components], values[:components], explained)
    found.identity_error = _identity_error(distinct, found)
    return found


def _identity_error(distinct: DataFrame, fit: Fit) -> float | None:
    """Largest absolute entry of the measured covariance of the whitened vectors minus the identity."""
    alive = np.flatnonzero(fit.values > 0)
    if not len(alive):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(alive)
        sums = np.zeros(k + k * k)
        for batch in batches:
            w = fit.whitened(_rows(batch.column(0)))[:, alive]
            sums += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(sums)), "part": sums})

    partial = distinct.select("x").mapInArrow(run, "place long, part double")
    rows = partial.groupBy("place").agg(F.sum("part").alias("part")).orderBy("place").collect()
    sums = np.array([row["part"] for row in rows]) / fit.n
    mean, square = sums[: len(alive)], sums[len(alive) :].reshape(len(alive), -1)
    # The vectors are centred before they are projected; their mean is what rounding leaves.
    return float(np.abs(square - np.outer(mean, mean) - np.eye(len(alive))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sums over the dimensions of (n x - S)^2, exactly."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    s = np.array(sums, object)
    if most * most * x.shape[1] < 1 << 62:
        return (((n * x) - s.astype(np.int64)) ** 2).sum(1).tolist()
    return ((x.astype(object) * n - s) ** 2).sum(1).tolist()


_EXACT = decimal.Context(prec=60)


def _decimals(values: list[int]) -> pa.Array:
    fits = [_EXACT.create_decimal(v) if v < 10**38 else None for v in values]
    return pa.array(fits, pa.decimal128(38, 0))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``vec_id, embedding`` and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``. The fit runs at once, the rows are computed when read."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    spark = vectors.sparkSession
    usable = vectors.select("vec_id", whole_numbers(F.col("embedding")).alias("x")).filter("x IS NOT NULL")
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if lengths is None:
        return spark.createDataFrame([], schema)
    usable = usable.filter(F.size("x") == lengths["d"])
    with scratch_scope(spark):
        found = fit(materialize(usable.select("x").distinct(), "vectors"), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found.values)
        for batch in batches:
            x = _rows(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            whitened = found.whitened(x).ravel()
            of = np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(of + 1, pa.int32()),
                    pa.array(np.full(len(each), found.n)),
                    _decimals(deviations(x, found.n, found.sums)).take(pa.array(each)),
                    pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(found.explained, pa.float64()).take(pa.array(of)),
                    pa.array([found.identity_error] * len(each), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable.mapInArrow(run, schema)


def results(whitened: DataFrame) -> DataFrame:
    """``deviation`` as a long, null where it does not fit one."""
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
