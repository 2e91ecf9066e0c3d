"""Operator 13: whitening of embeddings, with covariances by polarisation.

Components are turned into integers, so that all sums are exact. One aggregate gives the
rows and the sum of each dimension; a second one gives, for each dimension and for each
sum of two dimensions, the sum of squares of the values centred at the whole part of
their mean, which the remainders of the means correct exactly. Half of what the variance
of a sum of two dimensions has more than both variances is their covariance. ``eigh`` on
the driver then sees one number for each pair of dimensions, however many rows there are.
Nothing is shuffled but these sums: each task emits one row for each pair.

Edge cases: rows whose vector is null or holds a null or non-finite entry are dropped;
shorter vectors (empty ones as well) count as filled with zeros; repeated rows count as
often as they occur; a null vec_id stays. A component without variance (constant vectors,
a single row, fewer independent dimensions) has a null ``whitened`` and no part in
``identity_error``; ``explained`` is null if nothing varies. A ``deviation`` beyond a long
is null. Fewer than ``k`` dimensions give fewer components. No rows give no rows. Other
columns are ignored. Entries beyond 2**43 in size are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
_SUMS = "i int, j int, n long, total decimal(38,0)"


def whole_vector(column: str | Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.forall(c, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of doubles, filled with zeros at the right, and the length of each vector."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = int(size.max()) if len(size) else 0
    if (size == wide).all():
        return flat.reshape(len(size), wide), size
    out = np.zeros((len(size), wide))
    out[np.arange(wide) < size[:, None]] = flat
    return out, size


def integers(vectors: pa.Array, scale: int, shift: int, wide: int | None = None) -> np.ndarray:
    """``floor(scale * c) + shift`` of each entry, with ``wide`` columns if given."""
    rows, _ = matrix(vectors)
    if wide is not None and rows.shape[1] < wide:
        rows = np.concatenate([rows, np.zeros((len(rows), wide - rows.shape[1]))], 1)
    if rows.size and np.abs(rows).max() > 2**43:
        raise OverflowError("an entry of a vector is beyond 2**43")
    return np.floor(rows * scale).astype(np.int64) + shift


def _squares(z: np.ndarray) -> list[int]:
    """The exact sum of squares of each column."""
    if z.size and float(np.abs(z).max()) ** 2 * len(z) >= 2**62:
        z = z.astype(object)
        return [int(x) for x in (z * z).sum(0)]
    return np.einsum("ij,ij->j", z, z).tolist()


def _emitted(sums: dict[tuple[int, int], tuple[int, int]]) -> pa.RecordBatch:
    from decimal import Decimal

    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in sums], pa.int32()),
            pa.array([j for _, j in sums], pa.int32()),
            pa.array([n for n, _ in sums.values()], pa.int64()),
            pa.array([Decimal(t) for _, t in sums.values()], pa.decimal128(38, 0)),
        ],
        names=["i", "j", "n", "total"],
    )


def _added(parts: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(i, j) to (rows, sum); a number of rows that the dimension bounds."""
    found = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    return {(r.i, r.j): (r.n, int(r.total)) for r in found}


@dataclass
class Whitening:
    n: int
    sums: list[int]  #: of the integers, by dimension
    values: np.ndarray  #: eigenvalues kept, falling
    axes: np.ndarray  #: unit eigenvectors, a column for each
    trace: float

    @property
    def whole(self) -> np.ndarray:
        """The whole part of each mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times what the mean has beyond its whole part."""
        return np.array([s % self.n for s in self.sums], np.int64)

    @property
    def alive(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values > max(top, 0.0) * len(self.sums) * np.finfo(float).eps


def covariance(n: int, sums: list[int], squares: dict[tuple[int, int], tuple[int, int]]) -> np.ndarray:
    """The covariance matrix (divisor n) of the sums of squares around the whole parts of the means."""
    d = len(sums)
    rest = [s % n for s in sums]
    var = [n * squares[i, i][1] - rest[i] ** 2 for i in range(d)]  # times n * n
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = var[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares[i, j][1] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - var[i] - var[j]) / (2 * n * n)
    return out


def fit(vectors: DataFrame, column: str = "embedding", k: int = 8, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none."""
    rows = vectors.filter(whole_vector(column)).select(F.col(column).alias("v"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, there, total = 0, [], []  # of each dimension: vectors that reach it, and their sum
        for batch in batches:
            x = integers(batch.column("v"), scale, shift)
            n += len(x)
            more = x.shape[1] - len(total)
            there, total = there + [0] * more, total + [0] * more
            exact = x if not x.size or float(np.abs(x).max()) * len(x) < 2**62 else x.astype(object)
            for t, s in enumerate(exact.sum(0).tolist()):
                there[t] += len(x)
                total[t] += s
        if n:
            yield _emitted({(-1, -1): (n, 0), **{(t, t): x for t, x in enumerate(zip(there, total, strict=True))}})

    found = _added(rows.mapInArrow(summed, _SUMS))
    if not found:
        return None
    n = found.pop((-1, -1))[0]
    # rows that were in no batch with so long a vector are filled here
    sums = [found[t, t][1] + shift * (n - found[t, t][0]) for t in range(len(found))]
    if not sums:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    d = len(sums)

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            c = integers(batch.column("v"), scale, shift, d) - whole
            for i in range(d):
                pairs = _squares(c[:, i : i + 1] + c[:, i + 1 :])
                for j, s in enumerate([_squares(c[:, i : i + 1])[0], *pairs], i):
                    total[i, j] = total.get((i, j), 0) + s
        if total:
            yield _emitted({ij: (0, t) for ij, t in total.items()})

    v = covariance(n, sums, _added(rows.mapInArrow(squared, _SUMS)))
    values, axes = np.linalg.eigh(v)
    first = np.argsort(-values, kind="stable")[:k]
    return Whitening(n, sums, values[first], axes[:, first], float(np.trace(v)))


def _projected(model: Whitening, c: np.ndarray) -> np.ndarray:
    """Whitened values of rows centred at the whole parts; of the living components only."""
    alive = model.alive
    return (c - model.rest / model.n) @ (model.axes[:, alive] / np.sqrt(model.values[alive]))


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> float | None:
    """The largest entry, in size, of the whitened vectors' covariance less the identity; measured on all of them."""
    k, d, whole = int(model.alive.sum()), len(model.sums), model.whole
    if not k:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _projected(model, integers(batch.column("v"), scale, shift, d) - whole)
            total += np.concatenate([w.sum(0, keepdims=True), w.T @ w])
        row, at = np.divmod(np.arange(total.size), k)
        yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "s"])

    rows = vectors.filter(whole_vector(column)).select(F.col(column).alias("v")).mapInArrow(products, "i int, j int, s double")
    found = {(r.i, r.j): r.s for r in rows.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    mean = np.array([found[0, j] for j in range(k)]) / model.n
    second = np.array([[found[i + 1, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, column: str = "embedding", k: int = 8, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each usable vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.filter(whole_vector(column)).select("vec_id", F.col(column).alias("v"))
    model = fit(vectors, column, k, scale, shift)
    error = model and identity_error(vectors, model, column, scale, shift)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is None:
            return
        whole, rest, alive, d = model.whole, model.rest, model.alive, len(model.sums)
        k = len(alive)
        share = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
        for batch in batches:
            c = integers(batch.column("v"), scale, shift, d) - whole
            y = c * model.n - rest if not c.size or float(np.abs(c).max()) * model.n < 2**62 else c.astype(object) * model.n - rest
            if y.dtype == object or y.size and float(np.abs(y).max()) ** 2 * d >= 2**62:
                y = y.astype(object)
                deviation = [int(s) if s < 2**63 else None for s in (y * y).sum(1)]
            else:
                deviation = (y * y).sum(1).tolist()
            white = np.full((len(c), k), np.nan)
            white[:, alive] = _projected(model, c)
            at = np.repeat(np.arange(len(c)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(c))),
                    pa.array(np.full(len(at), model.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(at)),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(np.tile(share, len(c)), from_pandas=True),
                    pa.array([error] * len(at), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(out, schema)
