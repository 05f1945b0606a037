"""Hand-computed answers on the small tables (four recipes, edge cases)."""

import math

import pytest
from pyspark.sql import functions as F

from ratelens.functions.lists import avg_words_per_step, list_or_empty, split_fixed_list
from ratelens.operators import aggregate as G
from ratelens.operators import clean as C
from ratelens.operators import derive as D
from ratelens.operators import profile as P
from ratelens.sources import readers as R

FOUR = [
    ("Recipe A", 1, 30, 101, "2020-01-01", "['easy', 'quick']", "[100.0, 5.0, 3.0, 2.0, 10.0, 1.0, 20.0]", 5,
     "['mix', 'bake']", "desc a", "['salt', 'flour']", 5),
    ("Recipe B", 2, 60, 102, "2020-02-01", "['easy']", "[200.0, 6.0, 4.0, 3.0, 11.0, 2.0, 21.0]", 8,
     "['stir']", None, "['salt', 'sugar']", 7),
    ("Recipe C", 3, 0, 101, "2020-03-01", "['quick']", "[150.0, 7.0, 5.0, 4.0, 12.0, 3.0, 22.0]", 3,
     "['cut', 'fry']", "desc c", "['salt']", 3),
    ("Recipe D", 4, 432000, 103, "2020-04-01", "['slow']", "[300.0, 8.0, 6.0, 5.0, 13.0, 4.0, 23.0]", 12,
     "['wait']", "desc d", "['water']", 4),
]


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame(FOUR, R.RECIPES_SCHEMA)


def test_profile(four):
    rows = {r["column"]: r for r in P.profile(four).collect()}
    r = next(iter(rows.values()))
    assert r["n_rows"] == 4 and r["n_columns"] == 12 and r["total_missing"] == 1
    assert rows["description"]["n_missing"] == 1


def test_profile_empty(spark):
    empty = spark.createDataFrame([], R.RECIPES_SCHEMA)
    rows = P.profile(empty).collect()
    assert len(rows) == 12 and all(r["n_rows"] == 0 and r["n_missing"] == 0 for r in rows)


def test_minutes_and_outliers(four):
    s = P.seven_number(four, "minutes").first()
    assert s["min"] == 0 and s["max"] == 432000
    assert C.remove_outliers(four, "minutes", 1000).count() == 3
    rep = C.removed_count(four, "minutes", 1000).first()
    assert (rep["n_before"], rep["n_after"], rep["n_removed"]) == (4, 3, 1)


def test_contributors(four):
    r = G.contributor_concentration(four).first()
    assert r["n_unique"] == 3 and r["top_key"] == 101 and r["top_count"] == 2
    assert r["top_pct"] == 50.0 and r["mean_count"] == 1 and r["median_count"] == 1.0


def test_items(four):
    f = {r["item"]: r["n"] for r in G.item_frequency(four, "ingredients").collect()}
    assert f["salt"] == 3
    top = G.item_summary(four, "ingredients", 1).where("part = 'top'").first()
    assert top["item"] == "salt" and top["n_unique"] == 4 and top["n_total"] == 6


def test_count_summary(four):
    r = {x["column"]: x for x in P.count_summary(four).collect()}
    assert r["n_steps"]["mean"] == 7.0 and r["n_steps"]["median"] == 6.5 and r["n_steps"]["mode"] == 3.0


def test_nutrition(four):
    r = {x["column"]: x for x in P.multi_stats(split_fixed_list(four), ["calories", "nope"]).collect()}
    assert r["calories"]["mean"] == 187.5 and r["calories"]["median"] == 175.0 and "nope" not in r


def test_malformed_lists(spark):
    df = spark.createDataFrame([("invalid_list_format", "invalid_format", "[100.0, 5.0]")],
                               "tags string, ingredients string, nutrition string")
    assert G.list_items(df, "tags").count() == 0
    assert G.list_items(df, "ingredients").count() == 0
    assert split_fixed_list(df, "nutrition", require_width=True).columns == df.columns
    with pytest.raises(ValueError):
        G.list_items(df, "missing")


def test_words_per_step(spark):
    df = spark.createDataFrame([("['a b', '', '  ', 'c']",), ("[]",), (None,)], "steps string")
    arr = list_or_empty(df, "steps")
    got = [r[0] for r in df.select(avg_words_per_step(arr, True)).collect()]
    assert got == [1.0, 0.0, 0.0]
    got = [r[0] for r in df.select(avg_words_per_step(arr, False)).collect()]
    assert got == [0.75, 0.0, 0.0]


def test_rating_metrics_edges(spark):
    rows = [(1, 10, 0, "x"), (1, 11, 0, None), (2, 10, 5, "y"), (3, 12, 4, None), (3, 13, 2, "z")]
    it = spark.createDataFrame(rows, "recipe_id long, user_id long, rating int, review string")
    it = C.sentinel_to_null(it, "rating")
    m = {r["recipe_id"]: r for r in G.recipe_metrics(it).collect()}
    assert m[1]["n_interactions"] == 0 and m[1]["avg_rating"] is None
    assert m[1]["wilson_lb"] == 0.0 and m[1]["bayes_mean"] is None and m[1]["n_unique_users"] == 2
    assert m[2]["std_rating"] is None and m[2]["n_interactions"] == 1
    gm = (5 + 4 + 2) / 3
    assert m[3]["bayes_mean"] == pytest.approx((3.0 * 2 + gm * 10) / 12)
    for r in m.values():
        assert 0.0 <= r["wilson_lb"] <= 1.0


def test_constant_minmax_and_zscore(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "id long, x double")
    got = [r["x_scaled"] for r in D.minmax_scale(df, ["x"]).orderBy("id").collect()]
    assert got == [0.0, 0.0, 0.0]
    z, meta = D.add_feature_columns(df, interaction=False, columns_to_standardize=["x", "absent"])
    assert [r["x_std"] for r in z.orderBy("id").collect()] == [0.0, 0.0, 0.0]
    assert meta.count() == 1


def test_qcut_and_cut(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 2, 3, 4, 5, 6])], "id long, x double")
    got = [r["bin"] for r in D.qcut(df, "x", 4).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 2, 2]
    with pytest.raises(Exception):
        D.qcut(df, "x", 4, duplicates="raise").collect()
    df2 = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 1, 5, 10])], "id long, x double")
    assert [r["bin"] for r in D.cut(df2, "x", 10).orderBy("id").collect()] == [0, 0, 4, 9]


def test_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = P.shape_moments(df, ["x"]).first()
    assert r["skew"] == pytest.approx(1.763632614803888, rel=1e-12)
    assert r["kurt"] == pytest.approx(3.228, rel=1e-3)
    d = P.describe(df, ["x"]).first()
    assert d["std"] == pytest.approx(4.08248290463863)
    assert d["p50"] == 2.5


def test_winsorize_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    w = D.winsorize(df, ["x"], 0.05, 0.99)
    r = w.agg(F.min("x_w"), F.max("x_w"), F.count("x_w"), F.count("*")).first()
    assert r[0] == 5.0 and r[1] == 99.0 and r[2] == 101 and r[3] == 102


def test_histogram_partitions_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0.5, 1, 2, 3, 3, 10]], "x double")
    h = P.histogram(df, "x", 5).orderBy("bin").collect()
    assert sum(r["count"] for r in h) == 7 and len(h) == 5 and h[-1]["count"] == 1
    assert h[0]["count"] == 3  # [0, 2) holds 0, 0.5 and 1
