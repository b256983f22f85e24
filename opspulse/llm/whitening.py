"""Embedding whitening by polarisation covariance.

Entries become integers, so that every sum is exact. Tasks add up the squares of centred
values for each dimension and for the sum of each pair of dimensions, and nothing else. With
q(z) for n times the variance of z, the covariance of two dimensions is then
(q(a + b) - q(a) - q(b)) / 2n: differences of exact integers, divided once. The matrix goes
to ``eigh`` on the driver; its size is that of a vector, whatever the number of rows.

Values are centred on the whole number below the mean; what that leaves of the mean, less
than one, is taken off the sums exactly. Partial sums are Python integers where a long
could overflow, and travel in two parts of 64 bits.

Defined results: a null vector, or one that holds a null or non-finite entry, takes no
part, and neither does one with an entry beyond a long or of another length than most (of
lengths that are as frequent, the longest); rows with a null id and repeated rows count and
are returned as others; a deviation beyond a long is null; a component without variance has
whitened null and is no part of identity_error; vectors without entries and empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROWS = 1 << 12  # rows of a block
_BIG = 1 << 62
_PART = 1 << 64


def fit_list(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): the vectors that take part, as longs floor(SCALE * c) + SHIFT."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 52))  # noqa: E731  |SCALE * c| + SHIFT is a long
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.forall("v", fine) & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    rows = rows.where(F.size("v") == (lengths[0]["d"] if lengths else 0))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(SCALE * c) + SHIFT).alias("x"))


def _blocks(column: pa.ListArray):
    """Matrices of at most ROWS rows."""
    for i in range(0, len(column), ROWS):
        part = column.slice(i, ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _sums(m: np.ndarray, largest: int) -> list[int]:
    """Sums of the columns, exact; largest bounds the absolute entries of m."""
    m = m if largest * len(m) < _BIG else m.astype(object)
    return [int(v) for v in m.sum(axis=0)]


def _squares(m: np.ndarray, largest: int) -> list[int]:
    """Sums of squares of the columns, exact."""
    if largest * largest * len(m) < _BIG:
        return np.einsum("ij,ij->j", m, m).tolist()
    m = m.astype(object)
    return [int(v) for v in (m * m).sum(axis=0)]


def _added(rows: DataFrame, work) -> list[tuple[int, int, int]]:
    """(i, j, total) over all tasks, from tasks' {(i, j): Python integer}; one row for each pair of dimensions."""

    def partial(batches):
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for x in _blocks(batch.column(0)):
                work(x, total)
        keys = list(total)
        cols = [pa.array([k[c] for k in keys], pa.int32()) for c in (0, 1)]
        for cut in (lambda v: v // _PART, lambda v: v % _PART):
            cols.append(pa.array([Decimal(cut(total[k])) for k in keys], pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(cols, ["i", "j", "hi", "lo"])

    parts = rows.select("x").mapInArrow(partial, "i int, j int, hi decimal(38,0), lo decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("hi"), F.sum("lo")).collect()
    return [(i, j, int(hi) * _PART + int(lo)) for i, j, hi, lo in found]


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the sum of each dimension."""

    def work(x, total):
        total[-1, -1] = total.get((-1, -1), 0) + len(x)
        for i, s in enumerate(_sums(x, _largest(x))):
            total[i, i] = total.get((i, i), 0) + s

    found = {i: s for i, _, s in _added(rows, work)}
    n = found.pop(-1, 0)
    return n, [found[i] for i in range(len(found))]


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x minus the centre: longs where they suffice."""
    if _largest(x) < _BIG // 2:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def polarised_squares(rows: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """(i, i): sum of squares of centred dimension i; (i, j), i < j: that of the sum of dimensions i and j."""

    def work(x, total):
        y = _centred(x, centre)
        largest = 2 * _largest(y)
        columns = np.asfortranarray(y)
        for i in range(y.shape[1]):
            own = _squares(columns[:, i : i + 1], largest)
            sums = _squares(columns[:, i + 1 :] + columns[:, i : i + 1], largest)
            for j, q in enumerate(own + sums, i):
                total[i, j] = total.get((i, j), 0) + q

    return {(i, j): q for i, j, q in _added(rows, work)}


def covariance(n: int, sums: list[int], centre: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix (divisor n); each entry is one exact fraction, rounded once."""
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]  # sums of the centred values, 0 to n - 1
    q = lambda i, j: n * squares[i, j] - ((rest[i] + rest[j]) if i != j else rest[i]) ** 2  # noqa: E731  n * n times a variance
    alone = [q(i, i) for i in range(d)]
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = float(Fraction(alone[i], n * n))
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = float(Fraction(q(i, j) - alone[i] - alone[j], 2 * n * n))
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and their unit eigenvectors (columns), the largest entry of each positive."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1][:k], vectors[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.maximum(e, 0.0), vectors * signs


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component up to k."""
    spark = df.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = scratch.write(fit_list(df, id_col, vec_col))
    n, sums = column_sums(rows)
    centre = [s // n for s in sums] if n else []
    cov = covariance(n, sums, centre, polarised_squares(rows, centre)) if n else np.zeros((0, 0))
    e, vectors = principal(cov, min(k, len(sums)))
    live = e > len(sums) * np.finfo(float).eps * max(float(cov.trace()), 0.0)
    basis = vectors / np.sqrt(np.where(live, e, 1.0))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]

    def work(batches):
        part = np.array([r / n for r in rest])
        for batch in batches:
            deviations, out = [], []
            for x in _blocks(batch.column(1)):
                y = _centred(x, centre)
                if n * (_largest(y) + 1) < _BIG and (n * (_largest(y) + 1)) ** 2 * x.shape[1] < _BIG:
                    z = n * y.astype(np.int64) - np.array(rest, np.int64)
                else:
                    z = n * y.astype(object) - np.array(rest, object)
                deviations += [int(s) for s in (z * z).sum(axis=1)]
                out.append((y.astype(float) - part) @ basis)
            whole = np.concatenate(out) if out else np.zeros((0, basis.shape[1]))
            flat = pa.array(whole.reshape(-1), pa.float64())
            ends = pa.array(np.arange(0, len(whole) * basis.shape[1] + 1, max(1, basis.shape[1]), dtype=np.int32)[: len(whole) + 1])
            kept = pa.array([s if s < 1 << 63 else None for s in deviations], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), kept, pa.ListArray.from_arrays(ends, flat)], ["vec_id", "deviation", "w"])

    kind = df.schema[id_col].dataType.simpleString()
    white = scratch.write(rows.mapInArrow(work, f"vec_id {kind}, deviation bigint, w array<double>"))
    error = identity_error(white, np.flatnonzero(live).tolist())
    total = float(cov.trace())
    shares = F.array(*[F.lit(float(v / total) if total else 0.0) for v in e]) if len(e) else F.array().cast("array<double>")
    alive = F.array(*[F.lit(bool(v)) for v in live]) if len(e) else F.array().cast("array<boolean>")
    out = white.select("vec_id", "deviation", F.posexplode("w").alias("at", "w"))
    whitened = F.when(F.get(alive, F.col("at")), F.col("w"))
    out = out.select(
        F.col("vec_id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        whitened.alias("whitened"), F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
    return scratch.result(out)


def identity_error(white: DataFrame, live: list[int]) -> float:
    """The largest absolute entry of w's covariance (divisor n, centred first) minus the identity, over the components in ``live``."""
    if not live:
        return 0.0
    means = white.agg(*[F.avg(F.get("w", F.lit(a))) for a in live]).first()
    if means[0] is None:
        return 0.0
    c = {a: F.get("w", F.lit(a)) - F.lit(m) for a, m in zip(live, means, strict=True)}
    pairs = [(a, b) for a in live for b in live if a <= b]
    found = white.agg(*[F.avg(c[a] * c[b]) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
