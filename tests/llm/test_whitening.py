import numpy as np
import pytest

from gaugeflow.llm import whitening as W


def _matrices():
    rng = np.random.default_rng(3)
    turn = [np.linalg.qr(rng.standard_normal((24, 24)))[0] for _ in range(2)]
    for d in (1, 2, 3, 7, 24):
        yield rng.standard_normal((60, d))
    yield rng.standard_normal((90, 24)) * np.logspace(0, -9, 24)
    yield rng.standard_normal((90, 24)) * np.logspace(-9, 0, 24)
    yield np.eye(24)
    yield 3 * turn[0]
    yield turn[0] @ np.diag([5.0] * 9 + [1.0] * 15) @ turn[1]
    for gap in (1e-12, 1e-9, 1e-5):
        yield turn[0] @ np.diag(1 + gap * rng.standard_normal(24)) @ turn[1]
    yield rng.standard_normal((90, 6)) @ rng.standard_normal((6, 24))
    yield np.zeros((24, 24))
    yield np.ones((24, 24))


@pytest.mark.parametrize("a", list(_matrices()))
def test_axes_against_lapack(a):
    r = np.linalg.qr(a, mode="r")
    values, z = W.principal_axes(r)
    s = np.linalg.svd(r, compute_uv=False)
    top = s[0] or 1.0
    assert np.abs(np.sqrt(values) - s).max() <= 1e-14 * top
    assert np.abs(z.T @ z - np.eye(len(s))).max() < 1e-11
    assert np.abs(np.linalg.norm(r @ z, axis=0) - s).max() <= 1e-13 * top
    gram = (r @ z).T @ (r @ z)
    assert np.abs(gram - np.diag(np.diag(gram))).max() <= 1e-12 * top ** 2


def test_singular_values_of_a_graded_bidiagonal_matrix_are_relatively_accurate():
    """The determinant is known: tiny singular values keep their digits."""
    d, f = np.logspace(0, -40, 12), np.logspace(0.3, -39.7, 12)[:-1]
    values = W.dqds(list(d ** 2), list(f ** 2))
    assert np.isclose(np.log(values).sum(), 2 * np.log(d).sum(), rtol=0, atol=1e-12)


def _exact(rows):
    """Contract columns in exact integers, eigenvectors by numpy."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    dev = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    centred = np.array([[v / n for v in r] for r in dev])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    return [i for i, _ in good], n, [sum(v * v for v in r) for r in dev], centred, e[::-1], u[:, ::-1]


def test_contract_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.standard_normal((400, 40)) * np.linspace(1, 3, 40))]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (900, None), (901, []), (902, [None] * 40), (903, [float("nan")] * 40),
             (904, [float("inf")] + [0.0] * 39), (905, [1.0] * 39), (906, [1e300] * 40)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n string")
    got = W.whitened_components(table.repartition(7)).collect()
    usable = [r for r in rows if r[0] not in (900, 901, 902, 903, 904, 905, 906)]
    ids, n, deviation, centred, e, u = _exact(usable)
    assert len(got) == 32 * len(ids) and {r["n"] for r in got} == {n}
    by_row = {}
    for r in got:
        by_row.setdefault((str(r["vec_id"]), r["component"]), []).append(r)
    for k, i in enumerate(ids):
        for c in range(32):
            for r in by_row[str(i), c + 1]:
                assert r["deviation"] == deviation[k]
                want = centred[k] @ u[:, c] / np.sqrt(e[c])
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-8
                assert abs(r["explained"] - e[c] / e.sum()) < 1e-12
                assert r["identity_error"] < 1e-10
    for c in range(32):  # one sign for all rows
        signs = {np.sign(by_row[str(i), c + 1][0]["whitened"] * (centred[k] @ u[:, c])) for k, i in enumerate(ids)
                 if abs(centred[k] @ u[:, c]) > 1e-6}
        assert len(signs) == 1


def test_rank_and_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whitened_components(spark.createDataFrame([], schema)).count() == 0
    assert W.whitened_components(spark.createDataFrame([(1, None)], schema)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], schema)
    assert W.whitened_components(same).count() == 0  # no direction has variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(6)], schema)
    got = W.whitened_components(line).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [2.0 ** 50 * (i % 2), float(i)]) for i in range(10)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in W.whitened_components(wide).collect()} == {None}
    exact = {int(r["deviation"]) for r in W.whiten(wide).collect()}
    assert min(exact) > 1 << 63


def test_factor_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 5))
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    n, sums = W._sums(rows.repartition(3), 5)
    want = W._centred(np.floor(64 * x).astype(np.int64) + 1_000_000, n, sums)
    for parts in (1, 40):
        r = W._factor(rows.repartition(parts), 5, n, sums)
        assert np.allclose(r.T @ r, want.T @ want, rtol=1e-12)
