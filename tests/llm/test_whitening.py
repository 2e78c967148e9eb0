"""Whitening against a dense eigenvalue routine, exact sums and planted spectra."""

import numpy as np
import pytest

from tessera.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string"


def plain(vectors):
    """n, deviations and eigenpairs by whole numbers and the dense covariance."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [[n * c - s for c, s in zip(row, sums)] for row in x]
    z = np.array(far, float) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return n, [sum(c * c for c in row) for row in far], z, values[::-1], vectors[:, ::-1]


def spectrum(kind, dim, rng):
    return {
        "even": np.linspace(1, 2, dim),
        "steep": 10.0 ** -np.linspace(0, 9, dim),
        "equal": np.concatenate([np.full(dim // 2, 3.0), np.full(dim - dim // 2, 1.0)]),
        "random": np.sort(rng.random(dim))[::-1],
        "low rank": np.concatenate([[5.0, 4.0, 3.0], np.zeros(max(dim - 3, 0))]),
    }[kind]


@pytest.mark.parametrize("kind", ["even", "steep", "equal", "random", "low rank"])
@pytest.mark.parametrize("dim, wanted", [(1, 3), (7, 7), (64, 32), (300, 10)])
def test_pairs_of_known_operators(kind, dim, wanted):
    rng = np.random.default_rng(dim)
    if dim < 4 and kind == "low rank":
        return
    e = spectrum(kind, dim, rng)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    passes = []

    def product(u):
        passes.append(u.shape[1])
        return a @ u

    values, vectors = whitening.leading(product, dim, wanted)
    k = min(dim, wanted)
    assert values.shape == (k,)
    np.testing.assert_allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1][:k], atol=1e-13 * e.max())
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 3e-14 * e.max()
    assert dim < 300 or max(passes) < dim // 2  # never the whole matrix at once


def test_minres_solves_shifted_systems():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    a = (q * np.concatenate([-np.arange(1.0, 7.0), np.arange(1.0, 7.0)])) @ q.T
    right = rng.standard_normal((12, 4))
    shifts = np.array([0.0, 0.3, -0.4, 0.5])
    x = whitening._minres(lambda t: a @ t - t * shifts, right, 40)
    for i, s in enumerate(shifts):
        assert np.linalg.norm((a - s * np.eye(12)) @ x[:, i] - right[:, i]) < 2e-3 * np.linalg.norm(right[:, i])


def test_query_against_dense_covariance(spark):
    folder = "/root/testdata/sf0.01"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    n, deviations, z, values, parts = plain([vectors[i] for i in ids])
    expected = z @ parts[:, :32] / np.sqrt(values[:32])
    df = queries.QUERIES["op13_jacobi_davidson"](spark, folder)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    rows = df.collect()
    assert len(rows) == 32 * n and {r.n for r in rows} == {n}
    got = np.zeros((n, 32))
    for r in rows:
        at = r.vec_id - ids[0]
        got[at, r.component - 1] = r.whitened
        assert r.deviation == deviations[at]
        assert abs(r.explained * values.sum() / values[r.component - 1] - 1) < 1e-12
    signs = np.sign(np.sum(got * expected, axis=0))
    assert np.abs(got * signs - expected).max() < 1e-9
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and 0 <= rows[0].identity_error < 1e-11


@pytest.mark.parametrize("parts", [1, 7, 70])
def test_sums_do_not_depend_on_partitions(spark, parts):
    rng = np.random.default_rng(0)
    vectors = (rng.standard_normal((500, 5)) * [5, 4, 3, 2, 1]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "s") for i, v in enumerate(vectors)], SCHEMA).repartition(parts)
    model, rows, error = whitening.whiten(df, components=3)
    n, _, z, values, _ = plain(vectors)
    np.testing.assert_allclose(model.values, values[:3], rtol=1e-13)
    assert model.sums.tolist() == [sum(int(np.floor(64 * float(c))) + 1_000_000 for c in col) for col in vectors.T]
    assert error < 1e-12 and rows.count() == 500
    assert rows.columns == ["vec_id", "deviation", "whitened"]  # the column x gave way


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, -3.0], "a"), (1, [1.0, 2.0, -3.0], "a"), (None, [0.5, 0.1, 7.0], None), (3, [4.0, -0.01, 0.0], "b"), (4, [2.0, 2.0, 2.5], "")]
    bad = [(5, None, "a"), (6, [], "a"), (7, [1.0, None, 2.0], "a"), (8, [nan, 1.0, 1.0], "a"), (9, [1.0, inf, 1.0], "a"), (10, [1.0], "a"), (11, [-inf, 0.0, 0.0], "a")]
    df = spark.createDataFrame(bad[:3] + good + bad[3:], SCHEMA).coalesce(2)
    rows = whitening.components_table(df).collect()
    n, deviations, z, values, parts = plain([v for _, v, _ in good])
    assert n == 5 and {r.n for r in rows} == {5}
    assert sorted(str(r.vec_id) for r in rows) == sorted(str(i) for i, _, _ in good for _ in range(3))
    assert {(r.vec_id, r.deviation) for r in rows} == {(i, d) for (i, _, _), d in zip(good, deviations)}
    assert sum(r.explained for r in rows) / 5 == pytest.approx(1.0)
    for k in range(3):
        got = sorted(abs(r.whitened) for r in rows if r.component == k + 1)
        np.testing.assert_allclose(got, np.sort(np.abs(z @ parts[:, k] / np.sqrt(values[k]))), atol=1e-10)


def test_tables_without_components(spark):
    assert whitening.components_table(spark.createDataFrame([], SCHEMA)).collect() == []
    for rows in ([(1, None, "")], [(1, [], "")], [(1, [1.0, 2.0], "")], [(1, [1.0, 2.0], "")] * 3):
        assert whitening.components_table(spark.createDataFrame(rows, SCHEMA)).collect() == []
    with pytest.raises(Exception, match="too large"):
        whitening.components_table(spark.createDataFrame([(1, [1e20], "")], SCHEMA)).collect()
