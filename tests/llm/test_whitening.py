"""Whitening: the rank-one updates against a dense solver, the query against whole-number arithmetic."""

import numpy as np
import pytest

from fieldlens.llm.queries import QUERIES
from fieldlens.llm.whitening import Moments, Spectrum, Whitening, fit, secular_roots, whiten, whole_rows


def scatter(rows):
    apart = rows - rows.mean(axis=0)
    return apart.T @ apart


def rebuilt(s):
    return (s.vectors * s.values) @ s.vectors.T


def test_secular_roots():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 17, 60):
        for scale in (1.0, 1e-9, 1e9):
            poles = np.cumsum(rng.random(k) ** 4 + 1e-9) * scale
            z2 = rng.random(k) ** 6 + 1e-12
            roots, apart = secular_roots(poles, z2, 0.3 * scale)
            z = np.sqrt(z2)
            assert np.allclose(roots, np.linalg.eigvalsh(np.diag(poles) + 0.3 * scale * np.outer(z, z)), rtol=1e-12)
            assert (np.sign(apart) == 1 - 2 * np.tri(k)).all()  # strictly between the poles, whatever their sum rounds to
            assert np.allclose(apart, poles[None, :] - roots[:, None], atol=1e-12 * poles[-1] + 1e-12 * scale)


@pytest.mark.parametrize("n", [2, 3, 11, 12, 13, 40, 600])
def test_updates_equal_the_dense_spectrum(n):
    rng = np.random.default_rng(n)
    rows = rng.integers(-500, 500, (n, 12)) + 100_000
    rows[n // 2:, 3] = rows[n // 2:, 4]
    one, two = Spectrum.of_none(12), Spectrum.of_none(12)
    for k, r in enumerate(rows):
        (one if k % 3 else two).add(r)
    one.merge(two)
    whole = scatter(rows)
    assert np.abs(rebuilt(one) - whole).max() < 1e-11 * max(1, np.abs(whole).max())
    assert np.abs(one.vectors.T @ one.vectors - np.eye(12)).max() < 1e-12
    assert one.n == n and (one.sums == rows.sum(axis=0)).all()


def test_deflation():
    line = np.arange(6)[None, :] * np.arange(9)[:, None]
    corners = np.eye(6, dtype=int)[[0, 0, 1, 1, 2, 3, 0, 4]]
    for rows in (line, corners, np.ones((5, 6), int), np.repeat(corners, 40, axis=0)):
        s = Spectrum.of_none(6)
        for r in rows:
            s.add(r)
        assert np.abs(rebuilt(s) - scatter(rows)).max() < 1e-10
        weighted = Spectrum.of_none(6)
        distinct, times = np.unique(rows, axis=0, return_counts=True)
        for r, n in zip(distinct, times):
            weighted.add(r, int(n))
        assert np.abs(rebuilt(weighted) - scatter(rows)).max() < 1e-10


def test_states_survive_packing():
    s = Spectrum.of_none(3)
    for r in ([1, 2, 3], [4, 5, 9], [0, 0, 1]):
        s.add(np.array(r))
    again = Spectrum.unpacked(s.packed(), 3)
    assert again.n == 3 and (again.sums == s.sums).all() and (again.vectors == s.vectors).all() and (again.mean == s.mean).all()
    m = Moments.of_none(2)
    m.add(np.array([[1.0, 2], [3, 5]]))
    assert (Moments.unpacked(m.packed(), 2).products == m.products).all()


def brute(vectors):
    """id, component -> the query's numbers, by Python's whole numbers and a dense solver."""
    rows = [(i, [int(np.floor(float(c) * 1024)) + 100_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n = len(rows)
    sums = [sum(x[k] for _, x in rows) for k in range(len(rows[0][1]))]
    apart = np.array([[(n * x[k] - sums[k]) / n for k in range(len(sums))] for _, x in rows])
    values, basis = np.linalg.eigh(apart.T @ apart / n)
    values, basis = values[::-1], basis[:, ::-1]
    out = []
    for (i, x), a in zip(rows, apart):
        deviation = sum((n * p - q) ** 2 for p, q in zip(x, sums))
        for k in range(min(8, len(sums))):
            out.append((i, k + 1, n, deviation, a @ basis[:, k] / np.sqrt(values[k]), values[k] / values.sum()))
    return out


def compare(rows, expected):
    rows = sorted((r for r in rows), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation, r.component))
    expected = sorted(expected, key=lambda r: (r[0] is None, r[0] or 0, r[3], r[1]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in rows] == [r[:4] for r in expected]
    for k in {r.component for r in rows}:
        ours = np.array([r.whitened for r in rows if r.component == k])
        theirs = np.array([r[4] for r in expected if r[1] == k])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < 1e-9
    assert max(abs(r.explained / e[5] - 1) for r, e in zip(rows, expected)) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query_equals_whole_number_arithmetic(spark, small):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    compare(QUERIES["op11_whitening"](spark, small).collect(), brute(given))


SCHEMA = "vec_id long, embedding array<float>, x string, id string, part int, n long"


def odd_rows():
    rng = np.random.default_rng(3)
    good = [(k, [float(np.float32(c)) for c in rng.normal(size=5) * [3, 2, 1, 0.5, 0.1]]) for k in range(60)]
    odd = [(70, None), (71, [1.0, None, 0.0, 0.0, 0.0]), (72, [float("nan")] * 5), (73, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (None, good[3][1]), (4, good[4][1]), (4, good[4][1]), (5, good[9][1])]
    return good + odd


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in rows], SCHEMA)
    for parts in (1, 7, 40):
        compare(whiten(df.repartition(parts)).collect(), brute(rows))


def test_other_lengths_are_left_out(spark):
    rows = odd_rows() + [(90, [1.0, 2.0]), (91, []), (92, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in rows], SCHEMA)
    compare(whiten(df).collect(), brute(odd_rows()))


def test_no_component(spark):
    make = lambda vs: spark.createDataFrame([(i, v, "", "", 0, 0) for i, v in enumerate(vs)], SCHEMA)
    for vs in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 4, [None, None], [[], []]):
        assert whiten(make(vs)).collect() == []
    flat = whiten(make([[float(k), 2.0 * k, 1.0] for k in range(9)]))
    assert {r.component for r in flat.collect()} == {1}


def test_deviations_up_to_the_end_of_a_long():
    model = Whitening(1, np.zeros(3, np.int64), np.ones(1), np.zeros((3, 1)), 1.0)
    assert model.deviations(np.array([[3_000_000_000, 0, 1]])).tolist() == [9 * 10 ** 18 + 1]
    with pytest.raises(OverflowError):
        model.deviations(np.array([[3_000_000_000, 1_000_000_000, 1]]))


def test_components_are_fitted_on_all_rows(spark):
    rows, d = whole_rows(spark.createDataFrame([(k, [k / 7.0, (k * k % 11) / 3.0]) for k in range(500)],
                                               "vec_id long, embedding array<double>").repartition(33))
    model = fit(rows, d)
    x = np.array([r.x for r in rows.collect()])
    assert model.n == 500 and np.allclose(model.variances, np.linalg.eigvalsh(scatter(x) / 500)[::-1], rtol=1e-12)
