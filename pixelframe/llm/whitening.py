"""Operator 13: embedding whitening by incremental eigendecomposition.

Every entry c becomes the whole number x = floor(64 c) + 1000000.  A task keeps
the spectrum (eigenvalues and eigenvectors of the scatter) of the vectors it has
seen; the next vector adds one centred rank-one term, whose eigenvalues are the
roots of the secular equation.  Entries that the term does not move, and all but
one of equal eigenvalues, are deflated.  The spectra of the tasks are combined
in a tree (``FAN_IN`` at a node): the scatter of two sets is the one's, plus the
other's eigenpairs and the shift of their means, each a rank-one update again.

The tree ends in one basis and in the exact sums n and S.  With them two passes
follow: the covariance of all vectors in that basis, centred by exact integers
before multiplying, whose small eigenproblem turns the basis into the components
to double precision (Rayleigh-Ritz); and the covariance of the whitened vectors,
from which ``identity_error`` comes.  What a task returns is of the size of the
basis, never of the data, and is added up in the tree as well.

Defined results: rows whose vector is null or holds null, NaN or infinite
entries are dropped.  Vectors must have one length; if they do not, the most
frequent length (the larger of equally frequent ones) is kept and others are
dropped like broken ones.  Components whose eigenvalue is at most
``RANK * e_1`` are rounding only and have no rows, so vectors that are all equal
(or a single one, or of length 0) give no rows.  ``deviation`` is null where it
does not fit a long.  Entries beyond +-2^40 count as +-2^40.  Equal rows and
null ``vec_id`` are rows of their own; further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pixelframe.llm.base import read_table, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FAN_IN = 16
#: Eigenvalues up to this part of the largest are rounding.
RANK = 1e-12
_EPS = float(np.finfo(float).eps)
_MOST = float(1 << 40)

_STATE = "node long, n long, sums array<long>, mean array<double>, values array<double>, basis array<double>"


# --- rank-one update of a symmetric eigenproblem --------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) = 0 for ascending different ``d`` and
    positive ``z2``: the k-th lies above d[k].  Each is given as the index of the
    nearer pole and its distance from it, which keeps differences exact."""
    k = len(d)
    half = np.append(np.diff(d), z2.sum()) / 2  # of the room of each root above its own pole
    at_middle = 1 + (z2 / (d - d[:, None] - half[:, None])).sum(axis=1)
    below = (at_middle >= 0) | (np.arange(k) == k - 1)  # the root is nearer to its own pole
    origin = np.where(below, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d - d[origin][:, None]  # poles seen from each root's origin
    low, high = np.where(below, 0.0, -half), np.where(below, half, 0.0)
    low[-1], high[-1] = 0.0, z2.sum()
    if at_middle[-1] < 0:
        low[-1] = half[-1]
    else:
        high[-1] = half[-1]
    right = np.arange(k) < np.arange(k)[:, None] + 1  # poles up to the root's own
    own = np.arange(k)
    nxt = np.minimum(own + 1, k - 1)
    x = np.where(low + high != 0, (low + high) / 2, 0.0)
    for _ in range(80):
        gap = delta - x[:, None]
        terms = z2 / gap
        f = 1 + terms.sum(axis=1)
        done = np.abs(f) <= 4 * _EPS * k * (1 + np.abs(terms).sum(axis=1))
        narrow = high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if np.all(done | narrow):
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        # the sums left and right of the root, each as a constant and one pole
        slopes = terms / gap
        left_slope, right_slope = np.where(right, slopes, 0).sum(axis=1), np.where(right, 0, slopes).sum(axis=1)
        p, q = gap[own, own], gap[own, nxt]
        q[-1] = 1.0
        c = f - p * left_slope - np.where(own == k - 1, 0, q * right_slope)
        # c + s / (p - t) + r / (q - t) = 0 for the step t
        s, r = p * p * left_slope, np.where(own == k - 1, 0, q * q * right_slope)
        b = c * (p + q) + s + r
        e = p * q * c + s * q + r * p
        root = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
        with np.errstate(all="ignore"):
            step = np.where(b > 0, 2 * e / (b + root), (b - root) / (2 * c))
            step = np.where(own == k - 1, np.where(c > 0, p + s / c, np.nan), step)
        new = x + step
        inside = (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return origin, x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) after adding
    ``vector vector'`` to the matrix with this spectrum."""
    z = vector @ basis
    size = max(abs(values[-1]), z @ z)
    if size == 0.0:
        return values, basis
    small = 8 * _EPS * size
    basis = basis.copy()
    # equal eigenvalues: turn their vectors until only one of them meets the term
    starts = np.flatnonzero(np.append(True, np.diff(values) > small))
    for a, b in zip(starts, np.append(starts[1:], len(values))):
        if b - a > 1:
            norm = np.sqrt(z[a:b] @ z[a:b])
            if norm == 0.0:
                continue
            u = z[a:b].copy()
            u[0] += np.copysign(norm, u[0])
            basis[:, a:b] -= np.outer(basis[:, a:b] @ u, u * (2 / (u @ u)))
            z[a], z[a + 1:b] = -np.copysign(norm, z[a]), 0.0
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > small)
    if not len(live):
        return values, basis
    d, zl = values[live], z[live]
    origin, shift = secular_roots(d, zl * zl)
    apart = (d - d[origin][:, None]) - shift[:, None]  # row: root, column: pole; d - root
    # the z for which the computed roots are exact: vectors stay orthogonal however close the roots
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1.0)
    ratio = -apart / np.where(np.eye(len(d), dtype=bool), 1.0, between.T)
    z_exact = np.sqrt(np.abs(np.prod(ratio, axis=0)))
    inner = np.copysign(z_exact, zl)[:, None] / apart.T
    inner /= np.sqrt((inner * inner).sum(axis=0))
    new_values = values.copy()
    new_values[live] = d[origin] + shift
    basis[:, live] = basis[:, live] @ inner
    order = np.argsort(new_values, kind="stable")
    return new_values[order], basis[:, order]


# --- spectra of sets of vectors -------------------------------------------------

class Spectrum:
    """n, exact sums, mean and the spectrum of the scatter of a set of vectors
    (measured from ``OFFSET``)."""

    def __init__(self, dims: int):
        self.n, self.sums, self.mean = 0, np.zeros(dims, np.int64), np.zeros(dims)
        self.values, self.basis = np.zeros(dims), np.eye(dims)

    def add(self, x: np.ndarray) -> None:
        off = (x - OFFSET) - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.sums += x
        self.mean = (self.sums - self.n * OFFSET) / self.n

    def merge(self, other: Spectrum) -> Spectrum:
        if self.n < other.n:
            return other.merge(self)
        if not other.n:
            return self
        shift = (other.mean - self.mean) * np.sqrt(self.n * other.n / (self.n + other.n))
        for vector in [shift, *(other.basis * np.sqrt(np.maximum(other.values, 0))).T]:
            self.values, self.basis = rank_one(self.values, self.basis, vector)
        self.n += other.n
        self.sums = self.sums + other.sums
        self.mean = (self.sums - self.n * OFFSET) / self.n
        return self

    def row(self, node: int) -> pd.DataFrame:
        return pd.DataFrame({"node": [node], "n": [self.n], "sums": [self.sums], "mean": [self.mean],
                             "values": [self.values], "basis": [self.basis.ravel()]})

    @staticmethod
    def of(row) -> Spectrum:
        s = Spectrum(len(row["sums"]))
        s.n, s.sums, s.mean = int(row["n"]), np.array(row["sums"], np.int64), np.array(row["mean"], float)
        s.values, s.basis = np.array(row["values"], float), np.array(row["basis"], float).reshape(len(s.sums), -1)
        return s


def _whole(batch: pa.RecordBatch, dims: int) -> tuple[pa.Array, np.ndarray]:
    """vec_id and x (long, a row each) of the rows of a batch (vec_id, embedding as array<double>) that remain."""
    lists = batch.column(1)
    size = np.asarray(lists.value_lengths().fill_null(-1))
    flat = lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float)
    right = size == dims
    at = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
    rows = flat[at[right][:, None] + np.arange(dims)]
    fine = np.isfinite(rows).all(axis=1)
    keep = np.flatnonzero(right)[fine]
    x = np.floor(np.clip(rows[fine] * SCALE, -_MOST, _MOST)).astype(np.int64) + OFFSET
    return batch.column(0).take(pa.array(keep)), x


def _tree(rows: DataFrame, schema: str, join, fan_in: int, name: str) -> DataFrame:
    """Combine the rows (node, ...), one a task and numbered as the tasks are,
    ``fan_in`` at a node until one is left."""
    left = stored(rows, name)
    last = left.agg(F.max("node")).first()[0] or 0
    while last > 0:
        left = stored(left.withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
                      .groupBy("node").applyInPandas(join, schema), name)
        last //= fan_in
    return left


def spectra(vectors: DataFrame, dims: int, fan_in: int = FAN_IN) -> Spectrum:
    """Spectrum of the scatter of all rows of ``vectors`` (vec_id, embedding)."""

    def run(batches):
        s = Spectrum(dims)
        for batch in batches:
            for x in _whole(batch, dims)[1]:
                s.add(x)
        if s.n:
            yield pa.RecordBatch.from_pandas(s.row(TaskContext.get().partitionId()), preserve_index=False)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n", ascending=False, kind="stable")
        return reduce(Spectrum.merge, [Spectrum.of(r) for r in group.to_dict("records")]).row(int(group["node"].iloc[0]))

    found = _tree(vectors.mapInArrow(run, _STATE), _STATE, join, fan_in, "spectrum").collect()  # one row of dims x dims
    return Spectrum.of(found[0].asDict()) if found else Spectrum(dims)


def covariance(vectors: DataFrame, dims: int, project, width: int, n: int, fan_in: int = FAN_IN) -> np.ndarray:
    """Covariance (divisor ``n``) of ``project(x)``, centred before multiplying:
    by each task's mean, then by the shift of the means."""
    schema = "node long, n long, mean array<double>, scatter array<double>"

    def frame(node, count, mean, scatter):
        return pd.DataFrame({"node": [node], "n": [count], "mean": [mean], "scatter": [scatter.ravel()]})

    def add(a, b):
        (n1, m1, s1), (n2, m2, s2) = a, b
        if not n1:
            return b
        off = m2 - m1
        return n1 + n2, m1 + off * (n2 / (n1 + n2)), s1 + s2 + np.outer(off, off) * (n1 * n2 / (n1 + n2))

    def run(batches):
        so_far = (0, np.zeros(width), np.zeros((width, width)))
        for batch in batches:
            p = project(_whole(batch, dims)[1])
            if len(p):
                mean = p.mean(axis=0)
                so_far = add(so_far, (len(p), mean, (p - mean).T @ (p - mean)))
        if so_far[0]:
            yield pa.RecordBatch.from_pandas(frame(TaskContext.get().partitionId(), *so_far), preserve_index=False)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        parts = [(r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(width, width)) for r in group.to_dict("records")]
        return frame(int(group["node"].iloc[0]), *reduce(add, parts))

    found = _tree(vectors.mapInArrow(run, schema), schema, join, fan_in, "covariance").collect()  # one row of width x width
    return np.array(found[0]["scatter"]).reshape(width, width) / n


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n: by whole numbers as long as they fit, then one division."""
    if n * (np.abs(x - OFFSET).max(initial=0) + 1.0) < 1 << 61:
        return (n * (x - OFFSET) - (sums - n * OFFSET)) / n
    return (x - OFFSET) - (sums - n * OFFSET) / n


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum of (n x - S)^2 per row, exact; null beyond a long."""
    rough = ((centred(x, n, sums) * n) ** 2).sum(axis=1)
    fits = rough < 0.999 * (1 << 63)
    exact = np.zeros(len(x), np.int64)
    off = n * (x[fits] - OFFSET) - (sums - n * OFFSET)
    exact[fits] = (off * off).sum(axis=1)
    return pa.array(exact, mask=~fits)


def whiten(table: DataFrame, components: int = COMPONENTS, fan_in: int = FAN_IN) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    for every remaining row of ``table`` (vec_id, embedding) and component."""
    spark = table.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    vectors = table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].cast("array<double>").alias("embedding"))
    whole = F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    lengths = vectors.where(whole).groupBy(F.size("embedding").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    dims = lengths["k"] if lengths else 0
    if not dims:
        return spark.createDataFrame([], schema)
    s = spectra(vectors, dims, fan_in)
    n, sums, start = s.n, s.sums, np.linalg.qr(s.basis)[0]
    inner = covariance(vectors, dims, lambda x: centred(x, n, sums) @ start, dims, n, fan_in)
    e, turn = np.linalg.eigh((inner + inner.T) / 2)  # dims x dims
    e, axes = e[::-1], start @ turn[:, ::-1]
    used = min(components, int((e > RANK * max(e[0], 0.0)).sum()))
    if not used:
        return spark.createDataFrame([], schema)
    explained, axes = e[:used] / np.trace(inner), axes[:, :used] / np.sqrt(e[:used])
    white = covariance(vectors, dims, lambda x: centred(x, n, sums) @ axes, used, n, fan_in)
    error = float(np.abs(white - np.eye(used)).max())

    def run(batches):
        for batch in batches:
            ids, x = _whole(batch, dims)
            m = len(x)
            if not m:
                continue
            rows = pa.array(np.repeat(np.arange(m), used))
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), m)), pa.array(np.full(m * used, n)),
                 _deviation(x, n, sums).take(rows), pa.array((centred(x, n, sums) @ axes).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * used, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)


def op13_whitening(spark, sf_dir) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
