"""Embedding whitening by merged moments.

Components are taken in fixed point: x = floor(SCALE * c). The covariance is that of the distinct x
vectors. Each partition of these computes their number, exact sums, mean and scatter about its own
mean; treeReduce merges them pairwise by Chan's formula on the executors, so what meets in one task or
on the driver is a number of (d, d) matrices that the depth of the tree bounds. The driver takes the
eigenvectors of one (d, d) matrix. A second pass projects the distinct vectors, merges the moments of
the projections in the same way and states by how much their covariance misses the identity.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor
vectors of another length than the most frequent one (the smaller, in a tie); null and repeated ids
are kept, one set of rows for each vector; repeated vectors count once in the fit and each has its
rows; components whose eigenvalue is under RANK of the trace are left out, as no whitening exists for
them, so one distinct vector alone gives no rows, as does an empty table; components too large for x
are an error, and so is a deviation beyond a long; other columns stay apart and are returned, ours
replace columns of their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fields, given_back, name_of, row_of, stored

SCALE = 256
COMPONENTS = 4
#: Eigenvalues below that share of the trace are taken as zero.
RANK = 1e-12
DEPTH = 3
RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def finite(vector: F.Column) -> F.Column:
    """Not null, not empty and finite throughout."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def moments(x: np.ndarray) -> tuple:
    """(number, mean, scatter about the mean) of rows."""
    mean = x.mean(axis=0)
    y = x - mean
    return len(x), mean, y.T @ y


def merged(a: tuple, b: tuple) -> tuple:
    """Chan's formula: the moments of two sets of rows from those of each."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _reduced(vectors: DataFrame, d: int, seen) -> tuple:
    """(moments, exact sums by dimension) of seen(x) over all x vectors; partitions send one row each into the tree."""
    k = seen(np.zeros((1, d), np.int64)).shape[1]

    def run(batches):
        total, sums = (0, np.zeros(k), np.zeros((k, k))), [0] * d
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(0), d)
                total = merged(total, moments(seen(x)))
                sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (total[0], total[1].tobytes(), total[2].tobytes(), [str(s) for s in sums])], names=["n", "mean", "scatter", "sums"])

    parts = vectors.mapInArrow(given_back(run), "n long, mean binary, scatter binary, sums array<string>").rdd
    read = lambda r: ((r.n, np.frombuffer(r.mean), np.frombuffer(r.scatter).reshape(k, k)), [int(s) for s in r.sums])
    join = lambda a, b: (merged(a[0], b[0]), [s + t for s, t in zip(a[1], b[1], strict=True)])
    return parts.map(read).treeReduce(join, DEPTH)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sums over dimensions of (n x - S)^2, exactly."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    return [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vectors without the vector, one row for each usable one and component, with RESULTS."""
    others = [c for c in vectors.columns if c != vector and c not in RESULTS]
    schema = T.StructType([T.StructField("_row", vectors.select(row_of(others).alias("r")).schema["r"].dataType), *T._parse_datatype_string("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    most = SCALE * F.array_max(F.transform(F.col("_v"), lambda c: F.abs(c))) < float(1 << 62)
    x = F.transform(F.col("_v"), lambda c: F.floor(c * SCALE))
    x = F.when(most, x).otherwise(F.raise_error(F.lit(f"a component is too large for floor({SCALE} c) as a long")))
    fixed = stored(vectors.select(name_of(vector).cast("array<double>").alias("_v"), row_of(others).alias("_row")).filter(finite(F.col("_v"))).select("_row", x.alias("x")))
    lengths = fixed.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "d").limit(1).collect()
    if not lengths:
        return fixed.sparkSession.createDataFrame([], schema).select(*fields("_row", others), *RESULTS)
    d = lengths[0].d
    fixed = fixed.filter(F.size("x") == d)
    fit = stored(fixed.select("x").distinct())
    (n, _, scatter), sums = _reduced(fit, d, lambda v: v.astype(float))
    values, axes = np.linalg.eigh(scatter / n)
    trace = float(values.sum())
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > RANK * trace]
    axes, values = axes[:, order], values[order]
    if len(order):
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(len(order))])  # one sign, whatever the library returns
    centre = np.array([s / n for s in sums])
    projected = lambda v: (v - centre) @ axes / np.sqrt(values)
    (_, _, spread), _ = _reduced(fit, d, projected)
    error = float(np.abs(spread / n - np.eye(len(order))).max(initial=0.0))
    explained = (values / trace).tolist() if trace else []

    def run(batches):
        k = len(order)
        for b in batches:
            v = matrix(b.column(1), d)
            deviation = deviations(v, n, sums)
            if any(y >= 1 << 63 for y in deviation):
                raise OverflowError("a deviation is beyond a long")
            each = np.repeat(np.arange(len(v)), k)
            m = len(each)
            out = [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(v))), pa.array(np.full(m, n)), pa.array(np.array(deviation, np.int64)[each]),
                   pa.array(projected(v).ravel()), pa.array(np.tile(np.array(explained), len(v))), pa.array(np.full(m, error))]
            yield pa.RecordBatch.from_arrays(out, names=["_row", *RESULTS])

    return fixed.mapInArrow(given_back(run), schema).select(*fields("_row", others), *RESULTS)
