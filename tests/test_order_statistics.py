"""Rank selection vs the map strategy, average ranks, p-values, LOWESS."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ratelens.functions import pvalues as PV
from ratelens.operators import quantiles as Q
from ratelens.operators import stattests as T


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice("abc"), float(rnd.randint(0, 30)) if i % 13 else None, rnd.gauss(0, 1))
            for i in range(2000)]
    rows += [(5000 + i, "a", 3.0, 0.5) for i in range(700)]  # a hot value: a quarter of the rows
    return spark.createDataFrame(rows, "id long, g string, x double, y double")


@pytest.mark.parametrize("buckets", [None, 1, 7])
def test_rank_equals_map(spark, data, buckets, monkeypatch):
    probs = [0.0, 0.05, 0.25, 0.5, 0.77, 0.99, 1.0]
    a = Q.quantiles(data, "x", probs, method="map").first()
    if buckets:
        orig = Q.value_offsets
        monkeypatch.setattr(Q, "value_offsets", lambda df, x, by=(), **k: orig(df, x, by, buckets=buckets))
    b = Q.quantiles(data, "x", probs, method="rank").first()
    assert [pytest.approx(v, abs=1e-12) for v in a] == list(b)
    ga = {r["g"]: r for r in Q.quantiles(data, "y", probs, by=["g"], method="map").collect()}
    gb = {r["g"]: r for r in Q.quantiles(data, "y", probs, by=["g"], method="rank").collect()}
    for k in ga:
        assert [pytest.approx(v, abs=1e-12) for v in ga[k][1:]] == list(gb[k][1:])


def test_value_offsets_buckets(data):
    a = {r["x"]: (r["n"], r["before"]) for r in Q.value_offsets(data, "x", buckets=1).collect()}
    b = {r["x"]: (r["n"], r["before"]) for r in Q.value_offsets(data, "x", buckets=5).collect()}
    assert a == b


def test_average_rank_sum(data):
    r = Q.average_rank(data, "x")
    n = data.where("x IS NOT NULL").count()
    s = r.agg(F.sum("x_rank")).first()[0]
    assert s == pytest.approx(n * (n + 1) / 2)
    assert r.count() == data.count()
    assert r.where("x IS NULL AND x_rank IS NOT NULL").count() == 0


def test_partition_invariance(data):
    a = Q.quantiles(data.repartition(1), "y", [0.3], method="rank").first()[0]
    b = Q.quantiles(data.repartition(8), "y", [0.3], method="rank").first()[0]
    assert a == b


def test_spearman_matches_pandas(data):
    pdf = data.select("x", "y").toPandas().dropna()
    expect = pdf["x"].rank().corr(pdf["y"].rank())
    got = T.spearman_grid(data, ["x"], ["y"], with_p=False).first()
    assert got["coef"] == pytest.approx(expect, abs=1e-12) and got["n"] == len(pdf)


def test_kruskal_three_groups_closed_form(data):
    r = T.kruskal(data, "g", ["y"]).first()
    assert r["p_value"] == pytest.approx(math.exp(-r["statistic"] / 2), rel=1e-9)
    a = T.anova(data, "g", ["y"]).first()
    assert a["n_groups"] == 3 and a["statistic"] >= 0


def test_pvalues_closed_forms():
    t = 1.7
    assert PV.t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-12)
    assert PV.t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-12)
    assert PV.chi2_sf(3.3, 2) == pytest.approx(math.exp(-1.65), rel=1e-12)
    assert PV.chi2_sf(3.3, 1) == pytest.approx(math.erfc(math.sqrt(1.65)), rel=1e-10)
    assert PV.f_sf(2.5, 2, 7) == pytest.approx((1 + 2 * 2.5 / 7) ** -3.5, rel=1e-12)
    assert PV.pearson_p(1.0, 10) == 0.0 and math.isnan(PV.pearson_p(0.3, 2))


def test_pearson_p_equals_slope_p(spark, data):
    from ratelens.operators.models import ols
    d = data.where("x IS NOT NULL")
    p = T.pearson_grid(d, ["x"], ["y"], {}, {}).first()["p_value"]
    o = {r["term"]: r for r in ols(d, ["x"], "y").collect()}
    assert p == pytest.approx(o["x"]["p_value"], rel=1e-6)


def test_lowess_on_a_line(spark):
    from ratelens.operators.smooth import lowess
    df = spark.createDataFrame([(i, float(i % 50), 2.0 * (i % 50) + 1.0) for i in range(300)],
                               "id long, x double, y double")
    out = lowess(df, "x", "y", frac=0.3)
    assert out.count() == 300
    assert out.agg(F.max(F.abs(F.col("fit") - F.col("y")))).first()[0] < 1e-9
