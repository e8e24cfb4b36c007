"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Entries become integers x, so that counts, sums and deviations are exact.  The wanted eigenvectors
of the covariance V are found without V: a block Q of some more columns than wanted is filtered by a
Chebyshev polynomial of V, by its three-term recurrence.  Each step is one pass over the rows, every
task adding up its part of Xc'(Xc Q) with Xc = x - S/n, the parts being added in a tree of tasks.
The polynomial stays small on [0, smallest Ritz value of the block], the unwanted spectrum, and grows
beyond.  QR and Rayleigh-Ritz follow, until the residuals of all wanted pairs certify them to
rounding.  Of V only blocks of d x (components + GUARD) numbers reach the driver or a task's closure
(d is bounded by MAX_LENGTH), whatever the number of rows.

Rows: vectors that are null or hold null or non-finite entries take no part.  Repeated rows and null
ids are rows like others.  Vectors of each length are a table of their own: fitted, counted and
whitened apart.  Components without variance (constant or dependent entries, one row, equal rows) have
no whitened values and are left out, so an empty table gives an empty result.  ``deviation`` is null
where it exceeds a long.  Entries of 2^34 and more raise.  Further columns are ignored.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C

COMPONENTS = 32
#: columns of the block beyond the wanted ones; the more, the steeper the filter
GUARD = 24
SCALE, OFFSET = 64, 1_000_000
#: longest vectors; bounds what a task's closure and the driver hold
MAX_LENGTH = 16_384
#: numbers that a task turns into one matrix at a time
SLICE = 1 << 21
#: partial sums that one task adds up
FAN_IN = 32
MAX_DEGREE = 24
#: largest ratio by which a filter may raise the first wanted direction over the last
MAX_RATIO = 1e9
MAX_PASSES = 5_000
OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


class Whitening(NamedTuple):
    n: int
    sums: np.ndarray  # S by dimension, less n * base
    base: np.ndarray  # integers near the means
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one per column
    passes: int


def as_integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, len, x) of the vectors that take part; x holds floor(64 c) + 1000000 as 8-byte integers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))) & ~F.isnan(c))
    kept = vectors.where(F.col(vector).isNotNull() & finite & (F.size(vector) > 0)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.size(vector).alias("len"),
        F.col(vector).cast("array<double>").alias("c"))

    def run(batches):
        for b in batches:
            c = b.column(2)
            flat = np.floor(SCALE * c.flatten().to_numpy(zero_copy_only=False))
            if len(flat) and np.abs(flat).max() >= 2.0 ** 40:
                raise ValueError("vector entries of 2^34 and more are not supported")
            x = flat.astype("<i8") + OFFSET
            edges = np.concatenate(([0], np.cumsum(b.column(1).to_numpy().astype(np.int64)))) * 8
            rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(edges), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rows.cast(pa.binary())], names=["vec_id", "len", "x"])

    return kept.mapInArrow(run, "vec_id long, len int, x binary")


def _matrices(batches, length: int):
    """(rows of the batch, integer matrix) in slices of bounded size."""
    step = max(1, SLICE // length)
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            raw, _ = C.text_buffer(part.column(b.schema.get_field_index("x")))
            yield part, np.frombuffer(raw.tobytes(), "<i8").reshape(part.num_rows, length)


def _scaled(x: np.ndarray, n: int, sums: np.ndarray, base: np.ndarray) -> np.ndarray:
    """n x - S, exact."""
    return n * (x - base) - sums


def _added(rows: DataFrame, length: int, kernel, shape: tuple[int, ...], kind: str = "<f8") -> np.ndarray:
    """The sum of kernel(matrix) over all rows: added up by task, then by tasks of FAN_IN partial sums."""

    def add(parts):
        total = None
        for p in parts:
            total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total, kind).tobytes()], pa.binary())], names=["part"])

    def first(batches):
        return add(kernel(x) for _, x in _matrices(batches, length))

    def again(batches):
        return add(np.frombuffer(p, kind) for b in batches for p in b.column(0).to_pylist())

    parts = rows.select("x").mapInArrow(first, "part binary")
    left = rows.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapInArrow(again, "part binary")
    found = parts.collect()
    return np.frombuffer(bytes(found[0][0]), kind).reshape(shape) if found else np.zeros(shape, kind)


def _chebyshev(t: float, degree: int) -> float:
    """log of the Chebyshev polynomial at t > 1."""
    a = degree * np.arccosh(max(t, 1.0))
    return a + np.log1p(np.exp(-2 * a)) - np.log(2)


def fit(rows: DataFrame, length: int, components: int = COMPONENTS, guard: int = GUARD, seed: int = 7) -> Whitening:
    """Eigenpairs of the covariance of the rows (vec_id, x), all of one length."""
    if length > MAX_LENGTH:
        raise ValueError(f"vectors of more than {MAX_LENGTH} entries")
    first = _added(rows, length, lambda x: np.concatenate(([len(x)], (x - OFFSET).sum(0))), (1 + length,), "<i8")
    n = int(first[0])
    total = [int(s) + n * OFFSET for s in first[1:]]
    base = np.array([s // n for s in total], np.int64)
    sums = np.array([s - n * int(b) for s, b in zip(total, base)], np.int64)

    def centred(x):
        return _scaled(x, n, sums, base) / n

    trace = float(_added(rows, length, lambda x: np.array([(centred(x) ** 2).sum()]), (1,))[0]) / n
    wanted, block = min(components, length), min(length, components + guard)
    passes = 0

    def times(q: np.ndarray) -> np.ndarray:
        """V q, by one pass."""
        nonlocal passes
        passes += 1
        if passes > MAX_PASSES:
            raise RuntimeError(f"eigenvectors not certified after {MAX_PASSES} passes")

        def kernel(x):
            c = centred(x)
            return c.T @ (c @ q)

        return _added(rows, length, kernel, q.shape) / n

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((length, block)))[0]
    if trace == 0:
        return Whitening(n, sums, base, 0.0, np.zeros(0), np.zeros((length, 0)), passes)
    while True:
        vq = times(q)
        h = q.T @ vq
        values, y = np.linalg.eigh((h + h.T) / 2)
        values, y = values[::-1], y[:, ::-1]
        q, vq = q @ y, vq @ y
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        tolerance = 16 * np.sqrt(length) * np.finfo(float).eps * values[0]
        if residuals.max() <= tolerance:
            break
        # the filter: small on [0, edge], T_degree beyond
        edge = max(values[-1], 1e-14 * values[0])
        top, last = 2 * values[0] / edge - 1, 2 * max(values[wanted - 1], edge) / edge - 1
        need = np.log(10 * residuals.max() / tolerance)
        degree = 1
        while (degree < MAX_DEGREE and _chebyshev(last, degree) < need
               and _chebyshev(top, degree + 1) - _chebyshev(last, degree + 1) <= np.log(MAX_RATIO)):
            degree += 1
        before, now = q, 2 / edge * vq - q
        for _ in range(degree - 1):
            before, now = now, 2 * (2 / edge * times(now) - now) - before
        # columns near their eigenvectors, of unit length and largest first: QR then loses nothing
        q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
    real = values[:wanted] > length * np.finfo(float).eps * max(trace, values[0])
    return Whitening(n, sums, base, trace, values[:wanted][real], q[:, :wanted][:, real], passes)


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _scaled(x, model.n, model.sums, model.base) / model.n @ model.vectors / np.sqrt(model.values)


def identity_error(rows: DataFrame, length: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows, less the identity."""
    k = len(model.values)
    mean = _added(rows, length, lambda x: whitened(x, model).sum(0), (k,)) / model.n

    def kernel(x):
        w = whitened(x, model) - mean
        return w.T @ w

    return float(np.abs(_added(rows, length, kernel, (k, k)) / model.n - np.eye(k)).max())


def _deviation(v: np.ndarray) -> pa.Array:
    """Sum of squares by row, exact; null where it is no long."""
    if len(v) and float(np.abs(v).max()) ** 2 * v.shape[1] >= 2.0 ** 62:
        exact = [sum(int(a) ** 2 for a in row) for row in v]
        return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
    return pa.array((v * v).sum(1), pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD,
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component (numbered from 1 by falling eigenvalue)."""
    table = C.staged(as_integers(vectors, vec_id, vector), "integers")
    spark, out = vectors.sparkSession, None
    for length in sorted(r[0] for r in table.select("len").distinct().collect()):
        rows = table.where(F.col("len") == length).drop("len")
        model = fit(rows, length, components, guard)
        if len(model.values):
            one = _projected(rows, length, model, identity_error(rows, length, model))
            out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], OUTPUT) if out is None else out


def _projected(rows: DataFrame, length: int, model: Whitening, error: float) -> DataFrame:
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches):
        for part, x in _matrices(batches, length):
            m = part.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n, np.int64)),
                 _deviation(_scaled(x, model.n, model.sums, model.base)).take(each),
                 pa.array(whitened(x, model).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, OUTPUT)
