"""Plans whose cost must not grow faster than the input: how often a step is computed, and over how many tasks."""

import pytest

from ratelens import session
from ratelens.functions.literals import python_list
from ratelens.operators import aggregate as G
from ratelens.operators import clean as C
from ratelens.operators import stattests as T


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_multiline_csv_is_written_by_many_tasks(spark, tmp_path):
    from ratelens.plans import catalog_lists as L
    docs = spark.createDataFrame([(i, f'line "{i}"\nnext, line', "en", "web", 5) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = L.q_csv_multiline(spark, str(tmp_path))
        assert len(got.inputFiles()) >= 3
        assert sorted(r[0] for r in got.collect()) == list(range(30))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture
def rated(spark, tmp_path):
    path = f"{tmp_path}/rated"
    spark.createDataFrame([(i % 7 if i % 11 else None, i % 5, i % 6 or None, None if i % 4 else "x", i) for i in range(300)],
                          "recipe_id long, user_id long, rating int, review string, other int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_rating_metrics_are_dealt_in_proportion_to_the_input(spark, rated, monkeypatch):
    few = sorted(map(str, G.recipe_metrics(rated).collect()))
    assert session.partitions_for(rated) == 0
    monkeypatch.setattr(session, "PART_BYTES", 64)
    n = session.partitions_for(rated)
    assert n > session.FEW_PARTS
    many = G.recipe_metrics(rated)
    assert f", {n}), REPARTITION_BY_NUM" in _physical(many)
    assert sorted(map(str, many.collect())) == few


def test_global_mean_shares_the_counts_of_the_rating_metrics(spark, rated):
    scans = [x.strip() for x in _physical(G.recipe_metrics(rated)).splitlines() if "FileScan" in x]
    assert len(scans) == 2
    # the same columns and conditions on both sides, so that one exchange serves both
    assert len({x[x.index("ReadSchema"):] for x in scans}) == 1
    assert len({x[x.index("PushedFilters"):x.index("ReadSchema")] for x in scans}) == 1
    done = G.recipe_metrics(rated)
    done.collect()
    assert "ReusedExchange" in _physical(done)


def test_list_grammar_cuts_a_text_once(spark):
    df = spark.createDataFrame([("['a', \"b\",None]",), ("[1, 2",), ("[]",), ("[ ]",), ("['a' 'b',]",), ("['a'] x",), ("[01]",), ("",), (" \n",), (None,), ("[,]",), ("[u'\\x41', 'b\\'c']",)], "s string")
    out = df.select(python_list("s", none="None").alias("l"))
    assert _optimized(out).count("\\G(?:") == 1
    assert [r[0] for r in out.collect()] == [["a", "b", "None"], None, [], [], ["ab"], None, None, None, None, None, None, ["A", "b'c"]]


def test_recipe_filter_and_word_count_parse_once(spark):
    df = spark.createDataFrame([(1, 10, 2, "['a b', \"c\",]", 3, "2001-01-01"), (2, 10, 2, "[]", 3, "2001-01-01"), (3, 10, 2, None, 3, "2001-01-01")],
                               "id long, minutes long, n_steps int, steps string, n_ingredients int, submitted string")
    out = C.derive_recipes(df)
    assert _optimized(out).count("\\G(?:") == 1
    assert [(r["id"], r["avg_words_per_step"]) for r in out.collect()] == [(1, 1.5)]


def test_kruskal_groups_the_rows_for_the_ranks_only(spark, tmp_path):
    path = f"{tmp_path}/k"
    spark.createDataFrame([("ab"[i % 2], float(i % 13 + i % 2)) for i in range(200)], "g string, v double").write.parquet(path)
    out = T.kruskal(spark.read.parquet(path), "g", ["v"], with_p=False, buckets=4)
    assert _optimized(out).count("Relation [") == 3
    r = out.first()
    rows = [("ab"[i % 2], float(i % 13 + i % 2)) for i in range(200)]
    values = sorted(v for _, v in rows)
    rank = {v: values.index(v) + (values.count(v) + 1) / 2 for v in values}
    h = 12 / (200 * 201) * sum(sum(rank[v] for g, v in rows if g == k) ** 2 / 100 for k in "ab") - 3 * 201
    ties = sum(values.count(v) ** 3 - values.count(v) for v in set(values))
    assert r["statistic"] == pytest.approx(h / (1 - ties / (200 ** 3 - 200)), rel=1e-9)
    assert (r["n_groups"], r["n_total"]) == (2, 200)


def test_rows_of_other_recipes_go_before_the_join_with_the_orders(spark, tmp_path):
    from pyspark.sql import functions as F

    from ratelens.plans import pipelines as E
    from ratelens.sources import fixtures as FX
    spark.createDataFrame([(i % 40, i % 9 if i % 13 else None, float(i % 50), i % 7 + 1, "R", "F") for i in range(300)],
                          "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int, l_returnflag string, l_linestatus string") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i % 35, i % 11, "1995-01-02", "1-URGENT") for i in range(45)],
                          "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    recipes = spark.createDataFrame([(i, 10 if i % 3 else 0, 1, "['a']") for i in [*range(8), 4]], "id long, minutes long, n_steps int, steps string")
    late = E.kept_interactions(recipes, FX.interactions(spark, str(tmp_path)))
    early = E.kept_interactions(recipes, lambda ids: FX.interactions(spark, str(tmp_path), ids))
    assert early.columns == late.columns
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect())) != []
    plan = _optimized(early.agg(F.max("user_id")))
    assert plan.index("Join Inner") < plan.index("LeftSemi")


def test_forest_keeps_the_nodes_of_the_rows_between_levels(spark):
    from ratelens.operators import models as M
    rows = spark.createDataFrame([(float(i % 17), float(i * 7 % 23), float((i % 17) * (i * 7 % 23))) for i in range(200)], "a double, b double, y double")
    small = {"numTrees": 4, "maxDepth": 5}
    kept = M._fit_forest(rows, ["a", "b"], "y", 3, small)
    assert kept.getCacheNodeIds()
    again = M._fit_forest(rows, ["a", "b"], "y", 3, {**small, "cacheNodeIds": False})
    assert kept.toDebugString.partition("\n")[2] == again.toDebugString.partition("\n")[2]  # the first line holds a random name


def test_texts_of_large_recipes_are_not_shuffled_for_their_metrics(spark, tmp_path, monkeypatch):
    from ratelens.plans import catalog
    from ratelens.sources import fixtures as FX
    rows = [(i % 40, i % 9 if i % 13 else None, 1, i % 7 + 1, float(i % 50), "R", "F", f"1995-01-{i % 28 + 1:02d}") for i in range(300)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate string") \
        .selectExpr("* except (l_shipdate)", "cast(l_shipdate as timestamp) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i % 35, i % 11, "1995-01-02", "1-URGENT") for i in range(45)], "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string") \
        .selectExpr("o_orderkey", "o_custkey", "cast(o_orderdate as timestamp) as o_orderdate", "o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    keys = [*range(12), 4, None]
    spark.createDataFrame([(k, "red pea", "Brand#12", "STANDARD TIN", 3 + i) for i, k in enumerate(keys)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, f"cut {i}\ncook it\n" if k != 7 else None, "en", "web", 9) for i, k in enumerate([*keys, 3])],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    plain = catalog.stages(spark, str(tmp_path))
    few = [sorted(map(str, df.collect())) for df in plain]
    assert all(few) and FX.recipe_parts(spark, str(tmp_path)) == 0
    monkeypatch.setattr(session, "PART_BYTES", 64)
    monkeypatch.setattr(FX, "PART_SLICE", 64)
    n = FX.recipe_parts(spark, str(tmp_path))
    assert n > session.FEW_PARTS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = catalog.stages(spark, str(tmp_path))
        assert [sorted(map(str, df.collect())) for df in dealt] == few
        plan = _physical(dealt[2])
        # the join with the metrics looks their buckets up: nothing is exchanged for it, and no text sorted
        assert "ShuffledHashJoin" in plan and "hashpartitioning(id" not in plan and "Sort [id" not in plan
        assert len(dealt[0].inputFiles()) <= n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
