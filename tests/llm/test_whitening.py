from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelframe.llm.base import read_table
from pixelframe.llm.whitening import OFFSET, Spectrum, centred, rank_one, secular_roots, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def near(values, basis, matrix, tol=1e-12):
    size = max(1.0, np.abs(matrix).max())
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < tol
    assert np.abs(basis * values @ basis.T - matrix).max() < tol * size * len(values)
    assert (np.diff(values) >= -tol * size).all()


@pytest.mark.parametrize("k", [1, 2, 3, 10, 40])
def test_secular_roots(k):
    rng = np.random.default_rng(k)
    for spread in (1.0, 1e-6, 1e6):
        d = np.sort(rng.random(k)) * spread
        z = rng.standard_normal(k) * rng.choice([1.0, 1e-3], k)
        origin, shift = secular_roots(d, z * z)
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
        assert np.allclose(d[origin] + shift, want, rtol=1e-12, atol=1e-13 * want[-1])


@pytest.mark.parametrize("dims", [1, 2, 5, 30])
def test_rank_one_updates(dims):
    rng = np.random.default_rng(dims)
    values, basis, matrix = np.zeros(dims), np.eye(dims), np.zeros((dims, dims))
    vectors = [*rng.standard_normal((40, dims)), np.zeros(dims), np.eye(dims)[0], *np.eye(dims), *np.eye(dims)]
    vectors += [vectors[0]] * 5 + [vectors[1] * 1e-9, vectors[2] * 1e3]
    for v in vectors:
        values, basis = rank_one(values, basis, v)
        matrix += np.outer(v, v)
        near(values, basis, matrix, 1e-11)


@pytest.mark.parametrize("sizes", [(0, 5), (5, 0), (1, 1), (30, 3), (3, 30), (20, 20)])
def test_merge(sizes):
    rng = np.random.default_rng(1)
    x = [np.floor(rng.standard_normal((n, 6)) * 20).astype(np.int64) + OFFSET for n in sizes]
    parts = []
    for rows in x:
        s = Spectrum(6)
        for r in rows:
            s.add(r)
        parts.append(Spectrum.of(s.row(0).iloc[0]))
    s, every = parts[0].merge(parts[1]), np.concatenate(x)
    assert s.n == len(every) and (s.sums == every.sum(axis=0)).all()
    off = every - every.mean(axis=0)
    near(s.values, s.basis, off.T @ off, 1e-10)


def exact(vectors):
    """n, S, covariance and deviations by fractions and whole numbers."""
    x = [[int(np.floor(64.0 * float(c))) + OFFSET for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(dims)]
    off = [[n * r[k] - s[k] for k in range(dims)] for r in x]
    cov = [[float(Fraction(sum(o[i] * o[j] for o in off), n ** 3)) for j in range(dims)] for i in range(dims)]
    return n, np.array(off, float) / n, np.array(cov), [sum(v * v for v in o) for o in off]


def check(rows, ids, vectors, components=32):
    n, off, cov, deviation = exact(vectors)
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    used = min(components, int((e > 1e-12 * e[0]).sum()))
    assert len(rows) == n * used and {r.n for r in rows} == {n}
    assert max(r.identity_error for r in rows) < 1e-9
    want = off @ axes[:, :used] / np.sqrt(e[:used])
    left = {}
    for r in rows:
        left.setdefault((r.vec_id, r.component, r.deviation), []).append(r)
    signs = {}
    for i, vec_id in enumerate(ids):
        for c in range(used):
            r = left[vec_id, c + 1, deviation[i]].pop()
            assert r.explained == pytest.approx(e[c] / np.trace(cov), rel=1e-9)
            signs.setdefault(c, []).append((r.whitened, want[i, c]))
    for pairs in signs.values():
        got, of = np.array(pairs).T
        assert np.allclose(got, of, atol=1e-7) or np.allclose(got, -of, atol=1e-7)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_rows(spark, parts):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((90, 7)).astype(np.float32) * [3, 2.5, 2, 1, 1, 0.5, 0.3]
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(base)]
    rows += [rows[3], rows[3], (None, rows[5][1], None)]
    good = list(rows)
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [1.0, None] + [0.0] * 5, 1), (202, [nan] + [0.0] * 6, 1), (203, [0.0] * 6 + [-inf], 1),
             (204, [], 1), (205, [1.0, 2.0], 1), (206, [inf], 1)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("n", F.lit("x")).withColumn("component", F.lit(1))
    vectors = [np.array(r[1], np.float32) for r in good]
    check(whiten(table, fan_in=3).collect(), [r[0] for r in good], vectors)
    check(whiten(table, components=2).collect(), [r[0] for r in good], vectors, 2)


@pytest.mark.parametrize("vectors", [[], [None, [float("nan")]], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[], []]])
def test_without_components(spark, vectors):
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(4)
    a = np.floor(rng.standard_normal((50, 2)) * 64) / 64
    vectors = np.concatenate([a, a.sum(axis=1, keepdims=True), np.full((50, 1), 0.25)], axis=1)
    rows = whiten(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA).repartition(3)).collect()
    assert {r.component for r in rows} == {1, 2}
    check(rows, range(50), vectors)


def test_table(spark):
    table = read_table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = sorted(table.collect(), key=lambda r: r.vec_id)
    check(whiten(table).collect(), [r.vec_id for r in rows], [np.array(r.embedding) for r in rows])


def test_deviation_beyond_a_long_is_null():
    from pixelframe.llm.whitening import _deviation
    n = 1 << 33
    x = np.array([[OFFSET + 1, OFFSET], [OFFSET + 500, OFFSET]])
    assert _deviation(x, n, np.array([n * OFFSET, n * OFFSET])).to_pylist() == [None, None]
    assert _deviation(x, 10, np.array([10 * OFFSET] * 2)).to_pylist() == [100, 25_000_000]
    assert (centred(x, n, np.array([n * OFFSET, n * OFFSET])) == [[1, 0], [500, 0]]).all()
