"""Embedding whitening by mixed-precision eigenvectors.

Vectors become whole numbers; each distinct one counts once. Tasks sum the distinct vectors and then
their products about the mean, so only sums and a matrix of the vectors' length leave them. The
eigenvectors of that covariance are found in float32 and corrected by the matrix-multiplication
iteration of Ogita and Aishima with products in extended precision. Where eigenvalues lie closer
together than the present error tells apart, the iteration only mends orthogonality, and the cluster's
own basis is turned by solving the small problem of the matrix within it, shifted by its mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gaugeline.llm.common import store

#: Entries become floor(STEPS * c) + ORIGIN.
STEPS, ORIGIN = 64, 1_000_000
#: Entries from this size on are no embedding and count as not finite; below it all sums are exact.
LARGEST = 2.0 ** 40
#: Most bytes of models and means that go to every task.
MODEL_BYTES = 64 << 20
VECTORS = pa.schema([("vec_id", pa.int64()), ("length", pa.int32()), ("x", pa.binary())])
SUMS = pa.schema([("length", pa.int32()), ("part", pa.int32()), ("n", pa.int64()),
                  ("values", pa.binary())])
MODELS = pa.schema([("length", pa.int32()), ("values", pa.binary()), ("vectors", pa.binary()),
                    ("trace", pa.float64())])
WHITENED = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
                      ("deviation", pa.int64()), ("whitened", pa.float64()),
                      ("explained", pa.float64()), ("identity_error", pa.float64())])


# Eigenvectors ---------------------------------------------------------------------------------

def slices(a: np.ndarray, axis: int, bits: int, count: int = 3) -> list[np.ndarray]:
    """Float64 matrices that sum to ``a`` nearly, their entries short multiples of a common unit."""
    found = []
    for _ in range(count):
        top = np.abs(a).max(axis=axis, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1))) - bits)
        part = np.rint(a / unit) * unit
        found.append(part.astype(np.float64))
        a = a - part
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` in extended precision: products of slices are exact in float64."""
    bits = (52 - int(np.ceil(np.log2(max(a.shape[1], 2))))) // 2
    left, right = slices(a, 1, bits), slices(b, 0, bits)
    out = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for k in reversed(range(len(left))):
        for m in reversed(range(len(right) - k)):
            out += left[k] @ right[m]
    return out


def corrected(a: np.ndarray, x: np.ndarray, norm: float
              ) -> tuple[np.ndarray, np.ndarray, float]:
    """One step of the iteration: (vectors, values, how close values may be to be told apart)."""
    off = np.eye(len(a)) - product(x.T, x)
    s = product(x.T, product(a, x))
    values = np.diag(s) / (1 - np.diag(off))
    rest = (s - np.diag(values)).astype(np.float64)
    close = 2 * float(np.linalg.norm(rest, 2) + norm * np.linalg.norm(off.astype(np.float64), 2))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    step = np.where(apart, (s + values[None, :] * off) / np.where(apart, gap, 1), off / 2)
    return x + product(x, step), values, close


def clusters_solved(a: np.ndarray, x: np.ndarray, values: np.ndarray, close: float) -> np.ndarray:
    """Turn the basis of every cluster of values to the vectors of the matrix inside it."""
    order = np.argsort(values)
    for own in np.split(order, np.flatnonzero(np.diff(values[order]) > close) + 1):
        if len(own) < 2:
            continue
        basis = x[:, own]
        basis = basis + product(basis, np.eye(len(own)) - product(basis.T, basis)) / 2
        # Within the cluster only differences from its mean count; they keep their digits.
        inside = product(basis.T, product(a, basis) - values[own].mean() * basis)
        size = np.abs(inside).max()
        if size > 0:
            inside = ((inside + inside.T) / (2 * size)).astype(np.float64)
            basis = product(basis, np.linalg.eigh(inside)[1].astype(np.longdouble))
        x[:, own] = basis
    return x


def eigenvectors(a: np.ndarray, most: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of a symmetric matrix by falling value, in float64.

    Each vector's entry of largest size is positive. The zero matrix has values 0.
    """
    a = a.astype(np.longdouble)
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm, before = float(np.linalg.norm(a.astype(np.float64), 2)), np.inf
    for _ in range(most):
        x, values, close = corrected(a, x, norm)
        if close >= before / 2:
            break
        x, before = clusters_solved(a, x, values, close), close
    x = (x / np.sqrt((x * x).sum(axis=0)))
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order] * scale
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return values.astype(np.float64), x.astype(np.float64)


# Tasks ----------------------------------------------------------------------------------------

def vector_task(batches) -> Iterator[pa.RecordBatch]:
    """Rows with an embedding of finite entries, as whole numbers."""
    for batch in batches:
        batch = batch.filter(batch["embedding"].is_valid())
        lists = batch["embedding"]
        ends = lists.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        entries = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(entries) < LARGEST))])
        good = (bad[ends[1:]] == bad[ends[:-1]]) & (np.diff(ends) > 0)
        whole = np.floor(STEPS * np.where(np.abs(entries) < LARGEST, entries, 0)).astype(np.int64)
        x = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
            None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(whole + ORIGIN)])
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array(np.diff(ends), pa.int32()), x],
            schema=VECTORS).filter(pa.array(good))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch, their vectors as a matrix)."""
    lengths = batch["length"].to_numpy()
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        rows = batch["x"].take(pa.array(at)).to_pylist()
        yield length, at, np.frombuffer(b"".join(rows), np.int64).reshape(-1, length)


def sum_task(batches) -> Iterator[pa.RecordBatch]:
    """Number and sum of the vectors of each length."""
    sums: dict[int, list] = {}
    for batch in batches:
        for length, at, x in matrices(batch):
            own = sums.setdefault(length, [0, 0])
            own[0] += len(at)
            own[1] = own[1] + x.sum(axis=0)
    if sums:
        yield pa.RecordBatch.from_pylist(
            [{"length": k, "part": 0, "n": n, "values": total.tobytes()}
             for k, (n, total) in sums.items()], schema=SUMS)


def added(group: pa.Table, kind: type) -> pa.Table:
    """One row from the rows of a length and part."""
    values = sum(np.frombuffer(v, kind) for v in group["values"].to_pylist())
    return pa.Table.from_pylist(
        [{"length": group["length"][0].as_py(), "part": group["part"][0].as_py(),
          "n": sum(group["n"].to_pylist()), "values": values.tobytes()}], schema=SUMS)


@dataclass
class Mean:
    n: int
    total: np.ndarray  # sums, whole numbers

    @property
    def centre(self) -> np.ndarray:
        """Whole numbers next to the mean."""
        return (2 * self.total + self.n) // (2 * self.n)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact; Python's integers where 64 bits may not hold it."""
        if self.n * int(np.abs(x).max(initial=0)) < 1 << 61:
            return self.n * x - self.total
        return self.n * x.astype(object) - self.total.astype(object)

    def away(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def product_task(batches, means: dict[int, Mean]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the entries about the rounded mean: one row for each row of the matrix."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, at, x in matrices(batch):
            y = (x - means[length].centre).astype(np.float64)
            sums[length] = sums.get(length, 0) + y.T @ y
    for length, total in sums.items():
        yield pa.RecordBatch.from_pylist(
            [{"length": length, "part": k, "n": 0, "values": row.tobytes()}
             for k, row in enumerate(total)], schema=SUMS)


def solved(group: pa.Table, means: dict[int, Mean], components: int) -> pa.Table:
    """Model of one length from the rows of its matrix; only values clear of rounding count."""
    length = group["length"][0].as_py()
    mean = means[length]
    rows = dict(zip(group["part"].to_pylist(), group["values"].to_pylist()))
    sums = np.array([np.frombuffer(rows[k]) for k in range(length)]).astype(np.longdouble)
    aside = (mean.total - mean.n * mean.centre).astype(np.longdouble) / mean.n
    covariance = sums / mean.n - aside[:, None] * aside[None, :]
    values, vectors = eigenvectors(covariance)
    clear = int((values > length * np.finfo(np.float64).eps * values[0]).sum())
    first = min(components, clear)
    return pa.Table.from_pylist(
        [{"length": length, "values": values[:first].tobytes(),
          "vectors": np.ascontiguousarray(vectors[:, :first].T).tobytes(),
          "trace": float(np.trace(covariance))}], schema=MODELS)


@dataclass
class Model:
    mean: Mean
    values: np.ndarray
    vectors: np.ndarray  # one row for each component
    trace: float
    error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.mean.away(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - sums) squared, exact; null where a long cannot hold it."""
        away = self.mean.scaled(x)
        most = max((abs(int(v)) for v in (away.max(initial=0), away.min(initial=0))))
        if most * most * x.shape[1] < 1 << 62 and away.dtype != object:
            return pa.array((away * away).sum(axis=1), pa.int64())
        exact = (away.astype(object) ** 2).sum(axis=1).tolist()
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def identity_task(batches, models: dict[int, Model]) -> Iterator[pa.RecordBatch]:
    """Sums, and sums of products, of whitened vectors."""
    sums: dict[int, list] = {}
    for batch in batches:
        for length, at, x in matrices(batch):
            z = models[length].whitened(x)
            own = sums.setdefault(length, [0, 0])
            own[0] += len(at)
            own[1] = own[1] + np.concatenate([z.sum(axis=0)[None], z.T @ z])
    if sums:
        yield pa.RecordBatch.from_pylist(
            [{"length": k, "part": 0, "n": n, "values": total.tobytes()}
             for k, (n, total) in sums.items()], schema=SUMS)


def identity_error(n: int, values: bytes) -> float:
    """Largest entry of the whitened vectors' covariance less the identity."""
    sums = np.frombuffer(values)
    size = int((np.sqrt(1 + 4 * len(sums)) - 1) / 2)  # size + size ** 2 numbers
    if not size:
        return 0.0
    mean, products = sums[:size] / n, sums[size:].reshape(size, size) / n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(size)).max())


def whiten_task(batches, models: dict[int, Model]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, at, x in matrices(batch):
            model = models[length]
            k = len(model.values)
            each = pa.array(np.repeat(np.arange(len(at)), k))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(at)).take(each),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                 pa.array(np.full(k * len(at), model.mean.n)), model.deviations(x).take(each),
                 pa.array(model.whitened(x).ravel()),
                 pa.array(np.tile(model.values / model.trace, len(at))),
                 pa.array(np.full(k * len(at), model.error))], schema=WHITENED)


# Jobs -----------------------------------------------------------------------------------------

def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """One row for each usable row of ``embeddings`` and component: vec_id, component (from 1, by
    falling variance), n, deviation, whitened, explained, identity_error.

    Rows whose ``embedding`` is null or empty or holds a null, non-finite or absurd (2 ** 40 and more)
    entry are left out. Entries become x = floor(64 * c) + 1000000. Mean S / n and covariance are those
    of the distinct x vectors, each once, so copies change nothing; every row gets its own result, also
    where it repeats another or its vec_id, which may be null. ``deviation`` is the sum of (n * x - S)
    squared, exact, and null where it exceeds a long. Components whose variance is not clear of rounding
    have no rows: none has where only one vector is distinct. Vectors of different lengths do not
    compare: each length is a space of its own, with its own n and components. An empty table gives no
    rows; other columns are not read, whatever their names.

    The driver sees one mean and one model for each length, of 64 MB together at most; a table with more
    is refused.
    """
    vectors = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        vector_task, from_arrow_schema(VECTORS))
    context = embeddings.sparkSession.sparkContext
    fit = store(vectors.select("length", "x").distinct(), "fit")

    def summed(task, kind: type) -> DataFrame:
        return fit.mapInArrow(task, from_arrow_schema(SUMS)).groupBy("length", "part").applyInArrow(
            lambda group: added(group, kind), from_arrow_schema(SUMS))

    sums = store(summed(sum_task, np.int64), "sums")
    size = sums.agg(F.sum(F.octet_length("values"))).first()[0] or 0
    if size * (components + 1) > MODEL_BYTES:
        raise ValueError("vectors of too many different lengths, or too long")
    means = {r["length"]: Mean(r["n"], np.frombuffer(r["values"], np.int64)) for r in sums.collect()}
    known = context.broadcast(means)
    products = summed(lambda batches: product_task(batches, known.value), np.float64)
    models = {}
    for r in products.groupBy("length").applyInArrow(
            lambda group: solved(group, known.value, components),
            from_arrow_schema(MODELS)).collect():
        models[r["length"]] = Model(means[r["length"]], np.frombuffer(r["values"]), np.frombuffer(
            r["vectors"]).reshape(-1, r["length"]), r["trace"])
    first = context.broadcast(models)
    errors = summed(lambda batches: identity_task(batches, first.value), np.float64).collect()
    for r in errors:
        models[r["length"]].error = identity_error(r["n"], r["values"])
    final = context.broadcast({k: Model(**vars(m)) for k, m in models.items()})
    return vectors.mapInArrow(lambda batches: whiten_task(batches, final.value),
                              from_arrow_schema(WHITENED))
