import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from viaduct.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, whitened string"


def by_numpy(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    keep = values > whitening.RANK * values[0]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return n, deviation, c @ axes[:, keep] / np.sqrt(values[keep]), values[keep] / np.trace(c.T @ c / n)


def same(rows, ids, vectors):
    n, deviation, white, explained = by_numpy(vectors)
    assert len(rows) == n * len(explained)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and r.identity_error < 1e-4
    for k in range(len(explained)):
        mine = np.array([got[i][k + 1].whitened for i in ids])
        assert min(np.abs(mine - white[:, k]).max(), np.abs(mine + white[:, k]).max()) < 1e-6
        assert got[ids[0]][k + 1].explained == pytest.approx(explained[k], rel=1e-9)
    for i, d in zip(ids, deviation, strict=True):
        assert got[i][1].deviation == d == int(got[i][1].deviation_exact)


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    same(whitening.whitened(table.repartition(7)).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_vectors(spark):
    random = np.random.default_rng(3)
    good = [(i, [float(np.float32(x)) for x in random.normal(size=4) * [3, 2, 1, 0.5]]) for i in range(50)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 0.0, 0.0, 0.0]), (103, [1.0, -inf, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], SCHEMA).repartition(3)
    same(whitening.whitened(table).collect(), [i for i, _ in good], [v for _, v in good])


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [0.5, 0.1]), (None, [0.5, 0.1])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == sorted([(False, 1), (False, 2), (True, 1), (True, 2)] * 2)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None)]])
def test_nothing_to_scale(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(table).count() == 0


def test_large_entries(spark):
    rows = [(i, [10.0 ** (14 if i == 3 else 1), float(i), 1.0]) for i in range(6)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == set(range(6)) and all(r.deviation is None and r.deviation_exact is not None for r in got)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.sampled_from(["full", "clusters", "equal", "low rank", "tiny", "diagonal"]), st.integers(0, 10_000))
def test_leading_components(n, kind, seed):
    random = np.random.default_rng(seed)
    q = np.linalg.qr(random.normal(size=(n, n)))[0]
    e = {
        "full": np.sort(random.uniform(0, 10, n)), "clusters": np.repeat([1.0, 2.0, 2.0 + 1e-13], -(-n // 3))[:n], "equal": np.full(n, 3.0),
        "low rank": np.r_[np.zeros(n - 1), 5.0], "tiny": random.uniform(0, 1e-200, n), "diagonal": random.uniform(0, 1, n),
    }[kind]
    a = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading_components(a, 8)
    size = np.abs(a).max()
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:8]).max() <= 1e-13 * n * size
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-12 * n * size


def test_sturm_counts():
    d, b = np.array([2.0, 0.0, -1.0, 3.0]), np.array([1.0, 0.0, 2.0])
    full = np.linalg.eigvalsh(np.diag(d) + np.diag(b, 1) + np.diag(b, -1))
    at = np.linspace(-4, 5, 37)
    assert whitening.count_above(d, b, at).tolist() == [(full > x).sum() for x in at]


def test_entries_beyond_64_bits(spark):
    rows = [(i, [10.0 ** (300 if i == 3 else 1), float(i), 1.0]) for i in range(6)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == set(range(6)) and all(r.deviation is None for r in got)
