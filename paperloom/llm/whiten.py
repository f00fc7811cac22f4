"""Whitening of embeddings.

Entries become integers (floor of ``SCALE`` times the entry), so that equal vectors are equal bytes: the fit
list is every distinct vector once, made by one ``distinct``, which combines before it shuffles.  Counts and sums are exact
integers.  Tasks add up the outer products of centred vectors; one matrix of dimension squared per task is summed by Spark and comes to
the driver, whose memory follows the dimension and never the rows.

The scatter matrix is factored there by Cholesky with diagonal pivots, as far as its rank goes, and one-sided Jacobi
rotations are applied directly to the triangular factor until its columns are orthogonal: their squared norms are the eigenvalues, the normalised
columns the components.  A last pass over the fit list measures how far the covariance of the whitened vectors is from the identity.

Defined results: rows whose vector is null, empty, or has a null, NaN or infinite entry are left out; so are vectors whose length is not the
most frequent one (of equally frequent ones the longest); repeated rows give repeated results; components whose
eigenvalue is zero to double precision are left out, so a table with one distinct vector or none gives an empty result; an entry that leaves
64 bits, or an exact deviation that does, is an error; kept columns must not be named like results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from paperloom.llm.arrow import enter, small_batches
from paperloom.llm.common import stage

SCALE = 256
#: Components that rows are projected on.
COMPONENTS = 4
RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


# --- matrices -----------------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """A factor L of as many columns as the rank, with L L' equal to the positive semidefinite matrix.

    Its rows stand in the order of the matrix; in the order of the pivots it is lower triangular.
    """
    d = len(matrix)
    factor = np.zeros((d, d))
    left = np.diag(matrix).astype(np.float64).copy()
    least = d * np.finfo(np.float64).eps * max(left.max(initial=0.0), 0.0)
    used = np.zeros(d, bool)
    for k in range(d):
        pivot = int(np.argmax(np.where(used, -np.inf, left)))
        if left[pivot] <= least:
            return factor[:, :k]
        used[pivot] = True
        column = np.where(used, 0.0, matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k])
        root = np.sqrt(left[pivot])
        factor[:, k] = column / root
        factor[pivot, k] = root
        left -= factor[:, k] ** 2
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times an orthogonal matrix, such that its columns are orthogonal; disjoint pairs are rotated at once."""
    columns = factor.T.copy()
    r = len(columns)
    if r < 2:
        return columns.T
    seats = list(range(r + r % 2))
    tiny = np.finfo(np.float64).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(i, j) for i, j in zip(seats[:half], reversed(seats[half:])) if max(i, j) < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            i, j = np.array(pairs).T
            a, b = columns[i], columns[j]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            on = np.abs(ab) > tiny * np.sqrt(aa * bb)
            if not on.any():
                continue
            turned = True
            i, j, a, b, aa, bb, ab = (x[on] for x in (i, j, a, b, aa, bb, ab))
            zeta = (bb - aa) / (2 * ab)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            cos, sin = cos[:, None], (cos * t)[:, None]
            columns[i], columns[j] = cos * a - sin * b, sin * a + cos * b
        if not turned:
            break
    return columns.T


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of a positive semidefinite matrix, falling, and the unit eigenvectors as rows."""
    columns = one_sided_jacobi(pivoted_cholesky(matrix)).T
    norms = np.sqrt((columns * columns).sum(1))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, columns[order] / norms[order][:, None]


# --- vectors as bytes ---------------------------------------------------------


def _pack(vectors: pa.Array, scale: float) -> pa.Array:
    """Integer vectors as bytes of the least width that holds all entries; null where a vector cannot be used."""
    out = []
    for vector in vectors:
        values = vector.values if vector.is_valid else None
        if values is None or len(values) == 0 or values.null_count:
            out.append(None)
            continue
        real = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
        if not np.isfinite(real).all():
            out.append(None)
            continue
        whole = np.floor(scale * real)
        if np.abs(whole).max() >= 2.0**63:
            raise ArithmeticError("an entry leaves 64 bits")
        whole = whole.astype(np.int64)
        width = next(w for w in (2, 4, 8) if w == 8 or np.abs(whole).max() < 1 << (8 * w - 1))
        out.append(bytes([width]) + whole.astype(f"<i{width}").tobytes())
    return pa.array(out, pa.binary())


def _unpack(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, f"<i{p[0]}", offset=1) for p in packed]).astype(np.int64)


def _length(packed: str):
    width = F.conv(F.hex(F.substring(packed, 1, 1)), 16, 10).cast("int")
    return ((F.octet_length(packed) - 1) / width).cast("int")


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in small_batches(batches, column, 1 << 20, 4096):
        if batch.num_rows:
            yield batch, _unpack(batch.column(column).to_pylist())


# --- the fit ------------------------------------------------------------------


@dataclass
class Whitening:
    """What a fit knows: n vectors with exact sums per dimension, components as rows with their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    components: np.ndarray
    identity_error: float = 0.0

    def _off(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers where nothing can leave them, whole numbers of any size otherwise."""
        most = max(int(np.abs(x.astype(np.float64)).max(initial=0)) + 1, 1 + max(abs(s) for s in self.sums) // self.n)
        safe = (2 * self.n * most) ** 2 * len(self.sums) < 1 << 62
        kind = np.int64 if safe else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self._off(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int]:
        off = self._off(x)
        return (off * off).sum(1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.values)


def _moments(parts: Iterator[np.ndarray]) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Count, mean and centred scatter of rows that come in parts, each centred by itself before multiplying."""
    n, mean, scatter = 0, None, None
    for rows in parts:
        own = rows.mean(0)
        off = rows - own
        if mean is None:
            n, mean, scatter = len(rows), own, off.T @ off
            continue
        step = own - mean
        whole = n + len(rows)
        scatter += off.T @ off + np.outer(step, step) * (n * len(rows) / whole)
        mean, n = mean + step * (len(rows) / whole), whole
    return None if mean is None else (n, mean, scatter)


def pack_vectors(rows: DataFrame, keep: list[str], vector: str, scale: float = SCALE) -> DataFrame:
    """``keep`` columns with ``_x``, the integer vector as bytes, of the rows whose vector can be used."""
    names = [f"_k{i}" for i in range(len(keep))]
    named = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{vector}`").alias("_v"))
    schema = T.StructType([*[T.StructField(n, named.schema[n].dataType) for n in names], T.StructField("_x", T.BinaryType())])

    def run(batches):
        enter("whiten")
        for batch in batches:
            columns = [batch.column(c) for c in names] + [_pack(batch.column("_v"), scale)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    packed = named.mapInArrow(run, schema)
    return packed.where(F.col("_x").isNotNull()).select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "_x")


def fit_whitening(packed: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors ``_x``; None without any."""
    fit = stage(packed.select("_x").distinct(), "fit-list")

    def sums(batches):
        total: list[int] = []
        n = 0
        for batch, x in _batches(batches, "_x"):
            high, low = x >> 32, x & 0xFFFFFFFF
            own = [(int(h) << 32) + int(s) for h, s in zip(high.sum(0), low.sum(0))]
            total = [a + b for a, b in zip(total, own)] if total else own
            n += len(x)
        if n:
            # Exact sums may pass 64 bits: two halves, each added up by Spark.
            yield pa.RecordBatch.from_pydict(
                {"i": list(range(len(total))), "n": [n] * len(total), "high": [t >> 32 for t in total], "low": [t & 0xFFFFFFFF for t in total]}
            )

    added = fit.mapInArrow(sums, "i bigint, n bigint, high bigint, low bigint").groupBy("i")
    rows = sorted(added.agg(F.sum("n"), F.sum("high"), F.sum("low")).collect())
    if not rows:
        return None
    d = len(rows)
    model = Whitening(rows[0][1], [(h << 32) + low for _, _, h, low in rows], np.zeros(0), 0.0, np.zeros((0, d)))

    def summed(map_rows, width: int) -> np.ndarray:
        """Sum over all tasks of a matrix that each makes of its part of the fit list."""

        def run(batches):
            enter("whiten")
            made = map_rows(x for _, x in _batches(batches, "_x"))
            if made is not None:
                yield pa.RecordBatch.from_pydict(
                    {"i": np.arange(made.size) // made.shape[1], "j": np.arange(made.size) % made.shape[1], "v": made.ravel()}
                )

        parts = fit.mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
        table = parts.toArrow()
        out = np.zeros((width, width))
        out[table["i"].to_numpy(), table["j"].to_numpy()] = table["v"].to_numpy()
        return out

    def scatter(parts):
        total = None
        for x in parts:
            z = model.centred(x)
            total = z.T @ z if total is None else total + z.T @ z
        return total

    covariance = summed(scatter, d) / model.n
    values, vectors = eigen(covariance)
    model.trace = float(np.trace(covariance))
    model.values, model.components = values[:components], vectors[:components]
    k = len(model.values)

    def moments(parts):
        found = _moments(model.whitened(x) for x in parts)
        if found is None:
            return None
        n, mean, own = found
        # Sums of (1, z) (1, z)', from which the parts are put together around the common mean.
        wide = np.concatenate([[1.0], mean])
        out = n * np.outer(wide, wide)
        out[1:, 1:] += own
        return out

    if k:
        whole = summed(moments, k + 1)
        mean = whole[0, 1:] / whole[0, 0]
        got = whole[1:, 1:] / whole[0, 0] - np.outer(mean, mean)
        model.identity_error = float(np.abs(got - np.eye(k)).max())
    return model


def whiten(
    rows: DataFrame, keep: list[str], vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE
) -> DataFrame:
    """``keep`` columns of every usable row times its components, with ``RESULTS``."""
    if set(keep) & set(RESULTS):
        raise ValueError(f"a kept column is named like a result: {sorted(set(keep) & set(RESULTS))}")
    packed = pack_vectors(rows, keep, vector, scale)
    common = packed.groupBy(_length("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kept = [packed.schema[c] for c in keep]
    kinds = zip(RESULTS, (T.IntegerType(), T.LongType(), T.LongType(), *[T.DoubleType()] * 3))
    names = [f"_k{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, kept)] + [T.StructField(n, t) for n, t in kinds])
    spark = rows.sparkSession
    back = [F.col(n).alias(c) for n, c in zip(names, keep)] + [F.col(c) for c in RESULTS]
    if common is None:
        return spark.createDataFrame([], schema).select(*back)
    packed = packed.where(_length("_x") == common["d"])
    model = fit_whitening(packed, components)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        enter("whiten")
        model = shared.value
        k = len(model.values)
        for batch, x in _batches(batches, "_x"):
            at = np.repeat(np.arange(len(x)), k)
            columns = [batch.column(c).take(pa.array(at)) for c in names]
            size = len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(at)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x)) if k else np.zeros(0)),
                    pa.array(np.full(size, model.identity_error)),
                ],
                names=schema.names,
            )

    named = packed.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], "_x")
    return named.mapInArrow(run, schema).select(*back)
