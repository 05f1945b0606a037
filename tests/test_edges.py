"""Constant columns, one group and no rows give documented results; p-values keep their digits at large n."""

import math

import pytest

from ratelens.functions import pvalues as V
from ratelens.functions.lists import parse_list
from ratelens.operators import aggregate as G
from ratelens.operators import derive as D
from ratelens.operators import models as M
from ratelens.operators import profile as P
from ratelens.operators import stattests as T


@pytest.fixture(scope="module")
def constant(spark):
    return spark.createDataFrame([(i, f"g{i % 2}", 3.0, float(i)) for i in range(6)], "id int, g string, c double, y double")


def test_constant_column(spark, constant):
    for table in (constant, constant.where("id = 0"), constant.where("false")):
        D.standardized_product(table, "c", "c", "out").collect()
        assert all(r.out is None for r in D.standardized_product(table, "c", "y", "out").collect())
        assert all(r.density is None for r in P.kde(table, "c", 5).collect())
        assert M.regression_metrics(table, "c", "c").first().r2 is None
        fit = M.quadratic_fit(table, "c", "y").first()
        assert fit.a2 is None and fit.a1 is None
    assert T.anova(constant, "g", ["c"]).first().statistic is None
    assert T.kruskal(constant, "g", ["c"]).first().statistic is None


def test_one_group(spark, constant):
    one = constant.where("g = 'g0'")
    assert T.anova(one, "g", ["y"]).first().statistic is None
    assert T.kruskal(one, "g", ["y"]).first().n_groups == 1
    with pytest.raises(Exception, match="at least two groups"):
        T.group_tests(one, "g", ["y"]).collect()
    sizes = {(r.metric, r.group): r["size"] for r in T.group_test_sizes(constant, "g", ["c", "y"]).collect()}
    assert sizes == {("c", "g0"): 3, ("c", "g1"): 3, ("y", "g0"): 3, ("y", "g1"): 3}


def test_rating_metrics_edges(spark):
    rows = [(1, 1, 5, "x"), (1, 1, 5, None), (1, 2, 4, "y"), (1, None, None, "z"), (2, 3, None, None), (None, 4, 1, "w"), (3, 5, 2, "v")]
    df = spark.createDataFrame(rows, "recipe_id int, user_id int, rating int, review string")
    got = {r.recipe_id: tuple(r)[1:7] for r in G.recipe_metrics(df).collect()}
    assert got == {1: (3, 4.667, 5.0, 0.577, 2, 3), 2: (0, None, None, None, 1, 0), 3: (1, 2.0, 2.0, None, 1, 1)}
    assert G.recipe_metrics(df.where("false")).count() == 0


@pytest.mark.parametrize("n", [1e9, 1e11, 1e13])
def test_t_tail_at_many_rows(n):
    for t in (0.5, 2.0, 5.0):
        assert V.t_two_sided(t, n) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-7)


def test_tails_against_closed_forms():
    assert V.t_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-12)            # Cauchy
    assert V.t_two_sided(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6), rel=1e-12)
    assert V.chi2_sf(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-12)
    assert V.chi2_sf(7.0, 4) == pytest.approx(math.exp(-3.5) * 4.5, rel=1e-12)
    assert V.f_sf(3.0, 2, 10) == pytest.approx((1 + 2 * 3.0 / 10) ** -5, rel=1e-12)
    assert V.chi2_sf(1e6, 1e6) == pytest.approx(0.49981, abs=5e-6)
    for below, above in ((V.MANY * 0.999, V.MANY * 1.001),):
        assert V.chi2_sf(below + 700, below) == pytest.approx(V.chi2_sf(above + 700, above), abs=2e-3)
        assert V.t_two_sided(1.3, below) == pytest.approx(V.t_two_sided(1.3, above), rel=1e-7)
    assert V.f_sf(2.5, 3, 0.9e7) == pytest.approx(V.f_sf(2.5, 3, 1.1e7), rel=1e-5)
    assert math.isnan(V.pearson_p(0.5, 2)) and V.pearson_p(1.0, 5) == 0.0


def test_lists_that_json_cannot_read(spark):
    cases = [("['a','b',]", ["a", "b"]), (r"['\x41']", ["A"]), ("['a', None]", ["a", None]), ("['a' 'b']", ["ab"]), ("('a', 'b')", None),
             ("['it\\'s', \"x\"]", ["it's", "x"]), ("[]", []), ("['a'", None), ("abc", None), (None, None), ("[1, 2]", ["1", "2"]), (r"['é']", ["é"])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", parse_list("t").alias("v")).collect()}
    assert [got[i] for i in range(len(cases))] == [v for _, v in cases]


def test_general_format(spark):
    from ratelens.functions.expr import general_format
    values = [0.0, 1.0, -1.5, 0.05, 0.000123456, 0.0000999951, 0.00001234, 123.456, 999.6, 1234.5, 9.996, 0.1, 1e-300, 2.5e20, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.t for r in df.select("i", general_format("v").alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [None if v is None else "%.3g" % v for v in values]


def test_staged_tables_are_removed(spark, tmp_path):
    import os
    from ratelens import session
    before = list(session._MADE)
    path = session.checkpoint_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    session._MADE[:] = [path]
    assert os.path.exists(path) and session.remove_staged(spark) == 1 and not os.path.exists(path)
    session._MADE[:] = before


def test_changed_input_is_seen(spark, tmp_path):
    import shutil
    from tests.conftest import SMALL_DIR
    from ratelens.plans import catalog
    here = str(tmp_path / "in")
    shutil.copytree(SMALL_DIR, here)
    first = catalog._inputs(spark, here)
    assert first == catalog._inputs(spark, here)
    import os
    os.utime(f"{here}/part.parquet", (1, 1))
    assert first != catalog._inputs(spark, here)


def test_study_queries_grow_the_study_s_forest(monkeypatch):
    from ratelens.plans import catalog
    grown = []

    class Forest:
        def __init__(self, numTrees, **_):
            grown.append(numTrees)

        def fit(self, _):
            return self

    def study(*_, rf_params=None, **__):
        M._fit_forest(None, [], "y", 1, rf_params)
    monkeypatch.setattr(M, "RandomForestRegressor", Forest)
    monkeypatch.setattr(M, "_assemble", lambda *_: None)
    monkeypatch.setattr(M, "holdout_predictions", study)
    monkeypatch.setattr(M, "run_models", study)
    monkeypatch.setattr(catalog, "analysis", lambda *_: None)
    monkeypatch.setattr(D, "add_feature_columns", lambda *_: (None, None))
    catalog.q_study_predictions(None, None)
    catalog.q_run_models(None, None)
    assert grown == [100, 100]


def test_list_items_reads_what_json_does_not(spark):
    df = spark.createDataFrame([("['a', 'b',]",), ("['a' 'b']",), ("['c']",), ("broken",), (None,)], "tags string")
    assert sorted(r.item for r in G.list_items(df, "tags").collect()) == ["a", "ab", "b", "c"]


def test_tags_query_reads_what_json_does_not(spark, monkeypatch):
    from ratelens.plans import catalog
    df = spark.createDataFrame([(1, "['a', 'b',]"), (2, "['c']"), (3, None)], "id int, tags string")
    monkeypatch.setattr(catalog, "raw_recipes", lambda *_: df)
    assert sorted((r.id, r.pos, r.item) for r in catalog.q_parse_tags(spark, None).collect()) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
