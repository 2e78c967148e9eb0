"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson without the covariance.

The covariance V of the vectors is never formed. What is asked of it is V U for a few columns U at a time: every
task takes its rows, centres them and adds up Z' (Z U); tasks' sums are added by shards, and arrays of dimension
times columns reach the driver, whatever the number of rows.

The search keeps an orthonormal basis W of a subspace and V W. Rayleigh-Ritz in it gives the pairs (e, u) nearest
to the largest eigenvalues. For those whose residual V u - e u is not yet small, the correction equation

    (I - Q Q') (V - e I) (I - Q Q') t = -residual,   Q: all wanted vectors at hand,

is solved roughly by a few steps of MINRES, for all of them side by side, so that one pass over the rows serves
every equation; the corrections widen the subspace. Pairs whose residual has reached double precision are locked
and are projected out from then on. A full subspace is cut back to the best Ritz vectors. The search ends when
all wanted pairs are locked, and one more Rayleigh-Ritz over them, from a fresh product, gives the result.

Entries become whole numbers first, x = floor(64 c) + 1,000,000, kept in a written table. Sums of x are exact;
centring takes (n x - S) / n, rounded once.

Rows whose vector is null, or holds null or non-finite entries, are left out; so are empty vectors and vectors of
another length than the most frequent one (of equally frequent ones the longest), since they lie in no common
space. Components whose eigenvalue is nought to double precision (at most dimension * 2^-52 * the largest) have
no scale and are left out: one row, or equal rows only, have none, an empty table neither. Null ids and repeated
rows are treated row by row. Entries beyond 2^46 and deviations beyond 64 bits raise ArithmeticError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import _offsets, extended, written

#: Components kept at most.
COMPONENTS = 32
#: Residuals of locked pairs, relative to the largest eigenvalue.
PRECISION = 2.0**-47
#: MINRES steps per correction, columns of the subspace beyond the wanted ones when it is cut, rounds.
INNER, ROOM, ROUNDS = 8, 2, 200
#: Rows multiplied at once; sums of so many are added in extended precision where there is one.
BLOCK = 4096
#: Groups in which the sums of tasks are added before the driver adds those.
SHARDS = 32


def scaled(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` without its vectors, with ``x``: whole numbers as 64-bit little-endian binary, null for rows to leave out."""
    kept, schema = extended(df, "x binary", drop=vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(vector)
            offsets = _offsets(column).astype(np.int64)
            entries = column.values.slice(offsets[0], offsets[-1] - offsets[0])
            c = entries.cast(pa.float64()).to_numpy(zero_copy_only=False)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])  # null entries come as NaN
            offsets = offsets - offsets[0]
            good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
            good &= np.diff(offsets) > 0
            values = np.floor(64.0 * np.where(np.isfinite(c), c, 0.0))
            if (np.abs(values) > 2.0**46).any():
                raise ArithmeticError("an entry is too large to be scaled")
            data = (values.astype("<i8") + 1_000_000).tobytes()
            # Rows to leave out keep their bytes, so that offsets stay as they are, but count as null.
            known = pa.array(good).buffers()[1]
            places = (8 * offsets).astype(np.int32)
            x = pa.Array.from_buffers(pa.binary(), len(good), [known, pa.py_buffer(places), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), x], names=schema.names)

    cast = F.col(f"`{vector}`").cast("array<double>")
    return df.select(*(F.col(f"`{k}`") for k in kept), cast.alias(vector)).mapInArrow(run, schema)


def _rows(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    """The numbers of a binary column, in blocks."""
    offsets = _offsets(column)
    data = column.buffers()[2]
    flat = np.frombuffer(data.to_pybytes()[offsets[0] : offsets[-1]] if data is not None else b"", "<i8").reshape(-1, dim)
    for begin in range(0, len(flat), BLOCK):
        yield flat[begin : begin + BLOCK]


def _summed(df: DataFrame, column: str, make: Callable[[pa.Array], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of what ``make`` gives for the values of a batch, as doubles.

    Tasks add in extended precision; their sums are added by shard in the order of tasks, so the result does not
    depend on when tasks end.
    """
    size = int(np.prod(shape))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size, np.longdouble)
        for batch in batches:
            if batch.num_rows:
                total += make(batch.column(0)).ravel()
        task = TaskContext.get().partitionId()
        yield pa.record_batch(
            [pa.array([task % SHARDS], pa.int32()), pa.array([task], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary())],
            ["shard", "task", "part"],
        )

    def together(parts: list[bytes]) -> np.ndarray:
        total = np.zeros(size, np.longdouble)
        for p in parts:
            total += np.frombuffer(p, "<f8")
        return total

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = together(rows.column("part").to_pylist()).astype("<f8").tobytes()
        return pa.table({"shard": rows.column("shard").slice(0, 1), "part": pa.array([total], pa.binary())})

    parts = df.select(column).mapInArrow(add, "shard int, task int, part binary")
    parts = parts.groupBy("shard").applyInArrow(merge, "shard int, part binary")
    rows = sorted(parts.collect(), key=lambda r: r.shard)
    return together([r.part for r in rows]).astype(np.float64).reshape(shape)


@dataclass(frozen=True)
class Model:
    """Fitted components: ``vectors`` are columns, by falling ``values``; ``sums`` are exact."""

    n: int
    dim: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int = 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / float(self.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) / np.sqrt(self.values)


def _minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of symmetric systems, one per column; ``product`` takes and gives all columns at once."""

    def safe(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x, 1.0)

    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    alive = beta > 0
    v, v_old = right / safe(beta), np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    rest = beta.copy()
    cos, cos_old = np.ones_like(beta), np.ones_like(beta)
    sin, sin_old = np.zeros_like(beta), np.zeros_like(beta)
    last_beta = np.zeros_like(beta)
    first = beta.copy()
    for _ in range(steps):
        p = product(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - last_beta * v_old
        next_beta = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix under the two rotations before it.
        epsilon = sin_old * last_beta
        delta = cos * (cos_old * last_beta) + sin * alpha
        gamma_bar = cos * alpha - sin * (cos_old * last_beta)
        gamma = np.hypot(gamma_bar, next_beta)
        alive = alive & (gamma > 0)
        cos_old, sin_old = cos, sin
        cos, sin = gamma_bar / safe(gamma), next_beta / safe(gamma)
        w, w_old = (v - delta * w - epsilon * w_old) / safe(gamma), w
        x = x + np.where(alive, cos * rest, 0.0) * w
        rest = -sin * rest
        alive = alive & (next_beta > 1e-14 * first) & (np.abs(rest) > 1e-3 * first)
        v, v_old = p / safe(next_beta), v
        last_beta = next_beta
        if not alive.any():
            break
    return x


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns that span what ``new`` adds to the orthonormal ``basis``; directions that add nothing are dropped."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
    q, weights, _ = np.linalg.svd(new, full_matrices=False)
    q = q[:, weights > 1e-8]
    for _ in range(2):
        q = q - basis @ (basis.T @ q)
        q, _ = np.linalg.qr(q)
    return q


def leading(
    product: Callable[[np.ndarray], np.ndarray],
    dim: int,
    wanted: int,
    precision: float = PRECISION,
    inner: int = INNER,
    seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive operator and their unit vectors as columns."""
    wanted = min(wanted, dim)
    most = min(dim, (2 + ROOM) * wanted)
    rng = np.random.default_rng(seed)
    fixed = np.empty((dim, 0))
    fixed_image = np.empty((dim, 0))
    basis, _ = np.linalg.qr(rng.standard_normal((dim, min(dim, wanted + max(2, wanted // 4)))))
    image = product(basis)
    for _ in range(ROUNDS):
        h = basis.T @ image
        values, s = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-values)
        values, s = values[order], s[:, order]
        ritz, ritz_image = basis @ s, image @ s
        k = min(wanted - fixed.shape[1], len(values))
        residual = ritz_image[:, :k] - ritz[:, :k] * values[:k]
        scale = max(values[0], *np.sum(fixed * fixed_image, axis=0), 0.0) if fixed.shape[1] else max(values[0], 0.0)
        # Only a leading stretch of pairs is locked, so that none is passed over by a smaller one.
        small = np.linalg.norm(residual - fixed @ (fixed.T @ residual), axis=0) <= precision * scale
        whole = fixed.shape[1] + basis.shape[1] == dim  # the subspace is everything: these are the eigenpairs
        done = k if whole else int(np.argmin(small)) if not small.all() else k
        if done:
            fixed = np.concatenate([fixed, ritz[:, :done]], axis=1)
            fixed_image = np.concatenate([fixed_image, ritz_image[:, :done]], axis=1)
            ritz, ritz_image, values, residual = ritz[:, done:], ritz_image[:, done:], values[done:], residual[:, done:]
        if fixed.shape[1] == wanted:
            break
        k -= done
        if ritz.shape[1] + k > most - fixed.shape[1]:
            keep = max(k + 1, min(ritz.shape[1], 2 * k))
            ritz, ritz_image = ritz[:, :keep], ritz_image[:, :keep]
        away = np.concatenate([fixed, ritz[:, :k]], axis=1)
        shifts = values[:k]
        open_pairs = np.linalg.norm(residual, axis=0) > precision * scale

        def corrected(t: np.ndarray) -> np.ndarray:
            t = t - away @ (away.T @ t)
            t = product(t) - t * shifts[open_pairs]
            return t - away @ (away.T @ t)

        right = -(residual[:, open_pairs] - away @ (away.T @ residual[:, open_pairs]))
        found = _minres(corrected, right, inner) if open_pairs.any() else right
        more = _orthonormal(np.concatenate([found, right], axis=1), np.concatenate([fixed, ritz], axis=1))
        room = dim - fixed.shape[1] - ritz.shape[1]
        more = more[:, : min(room, more.shape[1])]
        if not more.shape[1]:
            more = _orthonormal(rng.standard_normal((dim, min(room, k))), np.concatenate([fixed, ritz], axis=1))
        basis = np.concatenate([ritz, more], axis=1)
        image = np.concatenate([ritz_image, product(more)], axis=1)
        image = image - fixed @ (fixed.T @ image)
    else:
        raise ArithmeticError(f"{fixed.shape[1]} of {wanted} components after {ROUNDS} rounds")
    q, _ = np.linalg.qr(fixed)
    h = q.T @ product(q)
    values, s = np.linalg.eigh((h + h.T) / 2)
    order = np.argsort(-values)
    vectors = q @ s[:, order]
    return values[order], vectors / np.linalg.norm(vectors, axis=0)


def fit(x: DataFrame, components: int = COMPONENTS, column: str = "x") -> tuple[Model, DataFrame]:
    """Components of the vectors of ``x`` (see ``scaled``), and the rows that have such a vector."""
    sizes = x.where(F.col(column).isNotNull()).groupBy(F.octet_length(column).alias("size")).count()
    sizes = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return Model(0, 0, np.zeros(0), np.zeros(0), np.zeros((0, 0)), 0.0), x.limit(0)
    n, dim = int(sizes[0]["count"]), int(sizes[0]["size"]) // 8
    rows = x.where(F.octet_length(column) == 8 * dim)
    # Whole numbers add exactly in doubles up to 2^53; two halves keep sums exact far beyond that.
    halves = _summed(rows, column, lambda c: sum(np.stack([(r >> 24).sum(0), (r & 0xFFFFFF).sum(0)]) for r in _rows(c, dim)), (2, dim))
    sums = np.array([(int(a) << 24) + int(b) for a, b in halves.T], object)
    if max(abs(s) for s in sums) >= 2**62:
        raise ArithmeticError("the sums of the vectors are beyond 64 bits")
    sums = sums.astype(np.int64)
    model = Model(n, dim, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    passes = 0

    def over_rows(make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        return _summed(rows, column, lambda c: sum(make(model.centred(r)).astype(np.longdouble) for r in _rows(c, dim)), shape) / n

    def product(u: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return over_rows(lambda z: z.T @ (z @ u), u.shape)

    trace = float(over_rows(lambda z: np.array([np.einsum("ij,ij->", z, z)]), (1,))[0])
    if trace == 0:
        return model, rows
    values, vectors = leading(product, dim, min(components, dim))
    keep = values > dim * 2.0**-52 * values[0]
    return Model(n, dim, sums, values[keep], vectors[:, keep], trace, passes), rows


def identity_error(model: Model, rows: DataFrame, column: str = "x") -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    k, dim, n = len(model.values), model.dim, model.n
    if not k:
        return 0.0
    means = _summed(rows, column, lambda c: sum(model.whitened(r).sum(0).astype(np.longdouble) for r in _rows(c, dim)), (k,)) / n

    def products(c: pa.Array) -> np.ndarray:
        some = (model.whitened(r) - means for r in _rows(c, dim))
        return sum((w.T @ w).astype(np.longdouble) for w in some)

    return float(np.abs(_summed(rows, column, products, (k, k)) / n - np.eye(k)).max())


def transform(model: Model, rows: DataFrame, column: str = "x") -> DataFrame:
    """``rows`` with ``deviation``, the exact square of n * x - S, and ``whitened``, one entry per component."""
    kept, schema = extended(rows, "deviation long, whitened array<double>", drop=column)
    dim = model.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            deviations, out = [], []
            for x in _rows(batch.column(column), dim):
                far = model.n * x - model.sums
                if (np.einsum("ij,ij->i", far.astype(np.float64), far.astype(np.float64)) >= 2.0**63).any():
                    raise ArithmeticError("a deviation is beyond 64 bits")
                deviations.append(np.einsum("ij,ij->i", far, far))
                out.append(model.whitened(x))
            flat = np.concatenate(out)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * flat.shape[1])
            white = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.float64()))
            arrays = [*(batch.column(k) for k in kept), pa.array(np.concatenate(deviations), pa.int64()), white]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.select(*(F.col(f"`{k}`") for k in kept), column).mapInArrow(run, schema)


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Model, DataFrame, float]:
    """The model fitted to all vectors of ``df``, its rows with ``deviation`` and ``whitened``, and the identity error."""
    model, rows = fit(written(scaled(df, vector), "whitening"), components)
    return model, transform(model, rows), identity_error(model, rows)


def components_table(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    model, rows, error = whiten(df.select(id_column, vector), vector, components)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values)) if len(model.values) else F.array().cast("array<double>")
    out = rows.select(id_column, "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return out.select(
        id_column,
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("pos") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
