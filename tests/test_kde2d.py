"""The 2-D kernel density against the sum over all rows."""

import numpy as np

from ratelens.operators import profile as P


def _frame(spark, x, y):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (2.0, None)], "a double, b double")


def test_against_all_rows(spark):
    gen = np.random.default_rng(2)
    x = gen.normal(size=300) * 3 + 1
    y = 0.6 * x + gen.normal(size=300)
    rows = P.kde2d(_frame(spark, x, y), "a", "b", 60).collect()
    cov = np.cov(x, y) * 300 ** (-1 / 3)
    inv, norm = np.linalg.inv(cov), 2 * np.pi * np.sqrt(np.linalg.det(cov)) * 300
    at = np.array([(r.x, r.y) for r in rows])
    d = at[:, None, :] - np.column_stack([x, y])[None]
    want = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", d, inv, d)).sum(1) / norm
    got = np.array([r.density for r in rows])
    assert len(rows) == 3600 and np.abs(got - want).max() < 0.03 * want.max()
    cell = (at[:, 0].max() - at[:, 0].min()) * (at[:, 1].max() - at[:, 1].min()) / 59 ** 2
    assert abs(got.sum() * cell - 1) < 0.02
    assert abs(at[:, 0].min() - (x.min() - 3 * np.sqrt(cov[0, 0]))) < 1e-9


def test_no_kernel(spark):
    line = P.kde2d(_frame(spark, range(10), range(10)), "a", "b", 5).collect()
    assert len(line) == 25 and {r.density for r in line} == {None}
    flat = P.kde2d(_frame(spark, [1.0] * 5, range(5)), "a", "b", 5).collect()
    assert len(flat) == 25 and {r.density for r in flat} == {None}
    assert P.kde2d(spark.createDataFrame([(None, 1.0)], "a double, b double"), "a", "b", 5).count() == 0
    one = P.kde2d(spark.createDataFrame([(3.0, 1.0)], "a double, b double"), "a", "b", 5).collect()
    assert {r.density for r in one} == {None}
