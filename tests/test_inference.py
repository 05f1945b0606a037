"""Tail probabilities as expressions and least squares of any rank, against numbers from elsewhere."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.functions import pvalues as V
from ratelens.operators import models as M


def _values(spark, rows, schema, body):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.p for r in df.select("i", body.alias("p")).orderBy("i").collect()]


def test_expressions_equal_the_functions(spark):
    ts = [(t, n) for t in (0.0, 0.3, 1.0, 2.5, 8.0, 40.0, -1.7) for n in (1.0, 2.0, 7.0, 60.0, 999.0, 250000.0, 3e6, 1e12)]
    for (t, n), p in zip(ts, _values(spark, ts, "t double, n double", V.t_two_sided_col(F.col("t"), F.col("n")))):
        assert p == pytest.approx(V.t_two_sided(t, n), rel=1e-8, abs=1e-300)
    fs = [(f, a, b) for f in (0.1, 1.0, 2.5, 30.0) for a in (1.0, 2.0, 9.0) for b in (1.0, 5.0, 400.0, 90000.0, 2e7)]
    for (f, a, b), p in zip(fs, _values(spark, fs, "f double, a double, b double", V.f_sf_col(F.col("f"), F.col("a"), F.col("b")))):
        assert p == pytest.approx(V.f_sf(f, a, b), rel=1e-8, abs=1e-300)
    cs = [(x, k) for x in (0.2, 1.0, 3.3, 12.0, 90.0, 1100.0, 2.0e6) for k in (1.0, 2.0, 3.0, 10.0, 1000.0, 2.0e6, 1e7)]
    for (x, k), p in zip(cs, _values(spark, cs, "x double, k double", V.chi2_sf_col(F.col("x"), F.col("k")))):
        assert p == pytest.approx(V.chi2_sf(x, k), rel=1e-7, abs=1e-12)


def test_edges_of_the_expressions(spark):
    rows = [(0.5, 2), (1.0, 5), (-1.0, 5), (None, 9), (0.3, None), (0.0, 9), (math.nan, 9)]
    assert _values(spark, rows, "r double, n long", V.pearson_p_col(F.col("r"), F.col("n"))) == [None, 0.0, 0.0, None, None, pytest.approx(1.0), None]
    rows = [(-1.0, 2.0, 3.0), (0.0, 2.0, 3.0), (math.inf, 2.0, 3.0), (1.0, 0.0, 3.0), (1.0, 2.0, 0.0), (None, 1.0, 1.0)]
    assert _values(spark, rows, "f double, a double, b double", V.f_sf_col(F.col("f"), F.col("a"), F.col("b"))) == [1.0, 1.0, 0.0, None, None, None]
    assert _values(spark, [(-1.0, 2.0), (0.0, 3.0), (1.0, 0.0)], "x double, k double", V.chi2_sf_col(F.col("x"), F.col("k"))) == [1.0, 1.0, None]


def test_known_values(spark):
    got = _values(spark, [(1.0, 1.0), (2.0, 2.0)], "t double, n double", V.t_two_sided_col(F.col("t"), F.col("n")))
    assert got == [pytest.approx(0.5, rel=1e-10), pytest.approx(1 - 2 / math.sqrt(6), rel=1e-10)]
    got = _values(spark, [(3.3, 2.0), (3.3, 1.0), (7.0, 4.0)], "x double, k double", V.chi2_sf_col(F.col("x"), F.col("k")))
    assert got == [pytest.approx(math.exp(-1.65), rel=1e-10), pytest.approx(math.erfc(math.sqrt(1.65)), rel=1e-10), pytest.approx(math.exp(-3.5) * 4.5, rel=1e-10)]


def _pinv(x, y):
    """The pseudo-inverse of the whole design matrix, with its inference."""
    x = np.column_stack([np.ones(len(x)), x])
    inv = np.linalg.pinv(x, rcond=1e-9)
    coef, rank = inv @ y, np.linalg.matrix_rank(x, tol=1e-8 * np.linalg.svd(x, compute_uv=False)[0])
    sse = ((y - x @ coef) ** 2).sum()
    return coef, np.sqrt(np.diag(inv @ inv.T) * sse / (len(y) - rank)), rank, 1 - sse / ((y - y.mean()) ** 2).sum()


@pytest.mark.parametrize("case", ["full", "twice", "sum", "constant", "zero", "constant and twice"])
def test_least_squares_of_any_rank(spark, case):
    gen = np.random.default_rng(4)
    x = gen.normal(size=(60, 3)) * [1.0, 30.0, 0.01] + [5.0, -100.0, 0.3]
    y = x @ [0.5, -0.02, 9.0] + gen.normal(size=60)
    if "twice" in case:
        x = np.column_stack([x, x[:, 1]])
    if case == "sum":
        x = np.column_stack([x, 2 * x[:, 0] - x[:, 1] + 3])
    if "constant" in case:
        x = np.column_stack([x, np.full(60, 7.0)])
    if case == "zero":
        x = np.column_stack([x, np.zeros(60)])
    names = [f"f{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)] + [(*[None] * len(names), 1.0)], ", ".join(f"{c} double" for c in [*names, "y"]))
    rows = M.ols(df, names, "y").collect()
    coef, se, rank, r2 = _pinv(x, y)
    assert [r.coef for r in rows] == pytest.approx(coef.tolist(), rel=1e-6, abs=1e-9)
    assert [r.std_err for r in rows] == pytest.approx(se.tolist(), rel=1e-6, abs=1e-9)
    assert {r["rank"] for r in rows} == {rank} and rows[0].r2 == pytest.approx(r2, rel=1e-9) and rows[0].singular == (rank <= len(names))
    f = (r2 / (rank - 1)) / ((1 - r2) / (60 - rank))
    assert rows[0].f_stat == pytest.approx(f, rel=1e-8) and rows[0].f_p_value == pytest.approx(V.f_sf(f, rank - 1, 60 - rank), rel=1e-8)


def test_ols_without_enough_rows(spark):
    schema = "a double, y double"
    none = M.ols(spark.createDataFrame([(None, 1.0)], schema), ["a"], "y").collect()
    assert [(r.term, r.coef, r.n) for r in none] == [("const", None, 0), ("a", None, 0)]
    one = M.ols(spark.createDataFrame([(2.0, 1.0)], schema), ["a"], "y").collect()
    assert [r.coef for r in one] == pytest.approx([0.2, 0.4]) and [r.std_err for r in one] == [None, None]
    two = M.ols(spark.createDataFrame([(2.0, 1.0), (4.0, 2.0)], schema), ["a"], "y").collect()
    assert [r.coef for r in two] == pytest.approx([0.0, 0.5], abs=1e-12) and two[0].std_err is None
