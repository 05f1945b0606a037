"""Query catalogue: every registered query as a Spark plan and its DuckDB twin.

Each entry: ``name -> (build(spark, sf_dir) -> DataFrame, spec, inner_sql, ctes)``.
``spec`` lists the output columns and their comparison kinds
(d = double rounded to 6 dp, i = bigint, s = text, b = boolean).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.lists import (NUTRITION_COLUMNS, avg_words_per_step, list_or_empty,
                                      parse_list, split_fixed_list, text_length)
from ratelens.operators import aggregate as G
from ratelens.operators import clean as C
from ratelens.operators import derive as D
from ratelens.operators import models as M
from ratelens.operators import profile as P
from ratelens.operators import stattests as T
from ratelens.operators.quantiles import average_rank
from ratelens.plans import oracle as O
from ratelens.plans.linsolve_sql import chi2_sf_sql, f_sf_sql, inference_sql, pearson_p_sql, t_two_sided_sql
from ratelens.plans.pipelines import (MODEL_STUDY_FEATURES, build_analysis, complete_profile, dashboard, kept_interactions,
                                      nonlinearity_study, popularity_study)
from ratelens.sources import fixtures as FX
from ratelens.sources import readers as R

AS_OF = O.AS_OF

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str, str | None, tuple[str, ...]]] = {}


def register(name: str, spec: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn):
        REGISTRY[name] = (fn, spec, sql, ctes)
        return fn
    return deco


# --- shared inputs -----------------------------------------------------------

def raw_recipes(spark, sf):
    return FX.recipes(spark, sf)


def raw_interactions(spark, sf):
    return FX.interactions(spark, sf)


def stages(spark, sf, leave_out=()):
    """E1 computed from the raw tables (the pipeline itself is the query)."""
    return build_analysis(raw_recipes(spark, sf), lambda ids: FX.interactions(spark, sf, ids), as_of=AS_OF, leave_out=leave_out,
                          parts=FX.recipe_parts(spark, sf))


def clean_recipes(spark, sf):
    """C13 alone: one lazy plan over the recipe adapter."""
    return C.prepare_recipes(raw_recipes(spark, sf))


def kept(spark, sf):
    """J2 alone: the interactions whose recipe C13 keeps; no statistics, no metrics."""
    return kept_interactions(raw_recipes(spark, sf), lambda ids: FX.interactions(spark, sf, ids))


_STORED: dict[tuple, str] = {}


def _inputs(spark, sf) -> tuple:
    """Name, size and change time of the files under ``sf``, by Spark's own file system."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(sf)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(root):
        for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s]):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def analysis(spark, sf):
    """The analysis table as the statistics read it: E1's output, written to the
    shared checkpoint folder (S5) and scanned back (S3), as the study's
    notebooks read the pipeline's table.  A table is taken again only in the
    same application, while no input file changed and the table is there."""
    from ratelens.session import checkpoint_dir
    key = (spark.sparkContext.applicationId, sf, _inputs(spark, sf))
    path = _STORED.get(key)
    if path is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            path = None
    if path is None:
        path = checkpoint_dir(spark, "analysis")
        stages(spark, sf)[2].write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(path)


METRIC_SPEC = ("recipe_id:i, n_interactions:i, avg_rating:d, median_rating:d, std_rating:d, "
               "n_unique_users:i, n_reviews_text:i, bayes_mean:d, wilson_lb:d")
METRIC_COLS = [n for n, _ in O.parse_spec(METRIC_SPEC)]
RAW_SPEC = ("name:s, id:i, minutes:i, contributor_id:i, submitted:s, tags:s, nutrition:s, n_steps:i, "
            "steps:s, description:s, ingredients:s, n_ingredients:i")
RC_SPEC = ("id:i, minutes:i, n_steps:i, n_ingredients:i, submitted:s, log_minutes:d, category_minutes:s, "
           "avg_words_per_step:d, step_length_category:s, complexity:s, category_n_ingredients:s, "
           "log_n_ingredients:d, log_minutes_scaled:d, n_steps_scaled:d, avg_words_per_step_scaled:d, "
           "log_n_ingredients_scaled:d, effort_score:d, effort_category:s")
ANALYSIS_SPEC = (RC_SPEC + ", contributor_id:i, n_interactions:i, avg_rating:d, median_rating:d, std_rating:d, "
                 "n_unique_users:i, n_reviews_text:i, bayes_mean:d, wilson_lb:d, age_months:d, "
                 "interactions_per_month:d, log1p_n_interactions:d, log1p_interactions_per_month:d, "
                 "log1p_n_unique_users:d, log_minutes_w:d, log1p_n_interactions_w:d, "
                 "log1p_interactions_per_month_w:d, log1p_n_unique_users_w:d, rating_gap:d, bayes_gap:d, "
                 "wilson_gap:d")


def _cols(spec):
    return ", ".join(f'"{n}"' for n, _ in O.parse_spec(spec))


# --- minimum slice / flagship ---------------------------------------------------

@register("g3_top_wilson", METRIC_SPEC,
          f"SELECT {_cols(METRIC_SPEC)} FROM rmet ORDER BY wilson_lb DESC, recipe_id LIMIT 50",
          ("rmet",))
def q_top_wilson(spark, sf):
    ic = C.prepare_interactions(raw_interactions(spark, sf))
    met = G.recipe_metrics(ic)
    return P.top_k(met, "wilson_lb", 50, key="recipe_id")


@register("g1_recipe_metrics", METRIC_SPEC, f"SELECT {_cols(METRIC_SPEC)} FROM met", ("met",))
def q_recipe_metrics(spark, sf):
    return G.recipe_metrics(kept(spark, sf))


@register("e1_analysis", ANALYSIS_SPEC, f"SELECT {_cols(ANALYSIS_SPEC)} FROM analysis", ("analysis",))
def q_analysis(spark, sf):
    # the query has no text column
    return stages(spark, sf, ("tags", "nutrition", "steps", "description", "ingredients"))[2]


@register("c13_prepare_recipes", RC_SPEC, f"SELECT {_cols(RC_SPEC)} FROM rc", ("rc",))
def q_prepare_recipes(spark, sf):
    return clean_recipes(spark, sf)


IC_SPEC = "user_id:i, recipe_id:i, date:s, rating:i, review:s, review_length:i"


@register("c14_prepare_interactions", IC_SPEC, f"SELECT {_cols(IC_SPEC)} FROM ic0", ("ic0",))
def q_prepare_interactions(spark, sf):
    return C.prepare_interactions(raw_interactions(spark, sf))



# --- sources ---------------------------------------------------------------

@register("s1_csv_roundtrip", RAW_SPEC, f"SELECT {_cols(RAW_SPEC)} FROM raw_r", ("raw_r",))
def q_csv_roundtrip(spark, sf):
    """S1 + S5: write the raw recipe table as CSV to the shared folder, scan it back."""
    from ratelens.session import checkpoint_dir
    from ratelens.sources.sinks import write_table
    path = checkpoint_dir(spark, "csv")
    write_table(raw_recipes(spark, sf), path, fmt="csv")
    return R.read_csv(spark, path, R.RECIPES_SCHEMA)


@register("s1_csv_null_tokens", "id:i, v:s, x:d",
          "SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE p_type END AS v, "
          "CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS x FROM part")
def q_csv_null_tokens(spark, sf):
    """S1 on single-line fields, files split: NA, n/a and empty text, NaN numbers."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    from ratelens.session import checkpoint_dir
    path = checkpoint_dir(spark, "csv-tokens")
    part = FX.table(spark, sf, "part")
    k = F.col("p_partkey") % 5
    part.select(F.col("p_partkey").alias("id"), F.when(k == 0, "NA").when(k == 1, "n/a").when(k == 2, "").otherwise(F.col("p_type")).alias("v"),
                F.when(k == 3, "NaN").otherwise(F.col("p_size").cast("string")).alias("x")).write.option("header", "true").csv(path)
    schema = StructType([StructField("id", LongType()), StructField("v", StringType()), StructField("x", DoubleType())])
    return R.read_csv(spark, path, schema, multi_line=False)


@register("a1_parse_awkward", "id:i, pos:i, item:s",
          "SELECT id, pos, item FROM (SELECT p_partkey AS id, unnest([0, 1]) AS pos, unnest(CASE p_partkey % 5 "
          "WHEN 0 THEN [p_type, p_brand] WHEN 1 THEN [p_type, NULL] WHEN 2 THEN [p_type || p_brand, 'z'] "
          "WHEN 3 THEN ['A' || p_type, 'q'] END) AS item FROM part WHERE p_partkey % 5 < 4)")
def q_parse_awkward(spark, sf):
    """A1 on texts that JSON cannot read: trailing comma, None, adjacent strings, escapes, tuples."""
    p, k = FX.table(spark, sf, "part"), F.col("p_partkey") % 5
    text = (F.when(k == 0, F.format_string("['%s', '%s',]", "p_type", "p_brand")).when(k == 1, F.format_string("['%s', None]", "p_type"))
            .when(k == 2, F.format_string("['%s' '%s', 'z']", "p_type", "p_brand"))
            .when(k == 3, F.concat(F.lit("['\\x41"), F.col("p_type"), F.lit("', 'q']"))).otherwise(F.format_string("('%s',)", "p_type")))
    return p.select(F.col("p_partkey").alias("id"), F.posexplode(parse_list(text)).alias("pos", "item"))


S3_SPEC = "id:i, effort_score:d, bayes_mean:d, wilson_lb:d, rating_gap:d, bayes_gap:d"


@register("s3_load_analysis", S3_SPEC,
          f"SELECT {_cols(S3_SPEC)} FROM analysis WHERE bayes_mean IS NOT NULL AND rating_gap IS NOT NULL "
          f"AND bayes_gap IS NOT NULL", ("analysis",))
def q_load_analysis(spark, sf):
    return R.load_analysis(analysis(spark, sf), columns=[n for n, _ in O.parse_spec(S3_SPEC)])


@register("s6_stage_roundtrip", "id:i, effort_score:d, effort_category:s",
          "SELECT id, effort_score, effort_category FROM rc", ("rc",))
def q_stage(spark, sf):
    from ratelens.sources.sinks import stage
    rc = stage(clean_recipes(spark, sf).select("id", "effort_score", "effort_category"), "stage")
    return rc


@register("s7_preview", "id:i, name:s, minutes:i", "SELECT id, name, minutes FROM raw_r ORDER BY id LIMIT 5",
          ("raw_r",))
def q_preview(spark, sf):
    return R.preview(raw_recipes(spark, sf), 5, "id").select("id", "name", "minutes")


@register("s8_shape", "n_rows:i, n_columns:i", "SELECT count(*) AS n_rows, 12 AS n_columns FROM raw_r",
          ("raw_r",))
def q_shape(spark, sf):
    return R.shape(raw_recipes(spark, sf))


# --- cleaning ----------------------------------------------------------------

@register("c1_project", "l_orderkey:i, l_partkey:i, l_quantity:d",
          "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def q_project(spark, sf):
    return C.project(FX.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@register("c2_outliers", "id:i, minutes:i",
          "SELECT id, minutes FROM raw_r WHERE minutes <> (SELECT max(minutes) FROM raw_r) AND minutes <= 43200",
          ("raw_r",))
def q_outliers(spark, sf):
    return C.remove_outliers(raw_recipes(spark, sf), "minutes").select("id", "minutes")


@register("c2_removed", "n_before:i, n_after:i, n_removed:i",
          "SELECT count(*) AS n_before, count(*) FILTER (WHERE minutes <> mx AND minutes <= 43200) AS n_after, "
          "count(*) - count(*) FILTER (WHERE minutes <> mx AND minutes <= 43200) AS n_removed "
          "FROM raw_r, (SELECT max(minutes) AS mx FROM raw_r)", ("raw_r",))
def q_removed(spark, sf):
    return C.removed_count(raw_recipes(spark, sf), "minutes")


@register("c3_drop_max_twice", "id:i, minutes:i",
          "SELECT id, minutes FROM (SELECT * FROM raw_r WHERE minutes IS NULL OR minutes <> "
          "(SELECT max(minutes) FROM raw_r)) a WHERE minutes IS NULL OR minutes <> (SELECT max(minutes) FROM "
          "raw_r WHERE minutes <> (SELECT max(minutes) FROM raw_r))", ("raw_r",))
def q_drop_max_twice(spark, sf):
    return C.drop_max(C.drop_max(raw_recipes(spark, sf), "minutes"), "minutes").select("id", "minutes")


@register("c4_sentinel", "id:i, minutes:i",
          "SELECT id, CASE WHEN minutes <> 0 THEN minutes END AS minutes FROM raw_r", ("raw_r",))
def q_sentinel(spark, sf):
    return C.sentinel_to_null(raw_recipes(spark, sf), "minutes").select("id", "minutes")


@register("c5_dropna", "id:i", "SELECT id FROM raw_r WHERE description IS NOT NULL", ("raw_r",))
def q_dropna(spark, sf):
    return C.drop_nulls(raw_recipes(spark, sf), ["description"]).select("id")


@register("c5_report", "n_before:i, n_after:i",
          "SELECT count(*) AS n_before, count(*) FILTER (WHERE description IS NOT NULL AND submitted IS NOT NULL) "
          "AS n_after FROM raw_r", ("raw_r",))
def q_null_report(spark, sf):
    return C.null_drop_report(raw_recipes(spark, sf), ["description", "submitted"])


@register("c6_range", "id:i, minutes:i",
          "SELECT id, minutes FROM raw_r WHERE minutes > 0 AND minutes <= 1440 AND minutes <= 360", ("raw_r",))
def q_range(spark, sf):
    df = C.range_filter(raw_recipes(spark, sf), "minutes", 0, 1440)
    return C.range_filter(df, "minutes", None, 360).select("id", "minutes")


@register("c7_positive", "id:i, n_steps:i", "SELECT id, n_steps FROM raw_r WHERE coalesce(n_steps, 0) > 0",
          ("raw_r",))
def q_positive(spark, sf):
    return C.positive_filter(raw_recipes(spark, sf), "n_steps").select("id", "n_steps")


@register("c8_nonempty_list", "id:i",
          f"SELECT id FROM raw_r WHERE steps IS NOT NULL AND len({O.list_sql('steps')}) > 0", ("raw_r",))
def q_nonempty(spark, sf):
    return C.nonempty_list_filter(raw_recipes(spark, sf), "steps").select("id")


@register("c9_positive_after_join", "id:i, minutes:i",
          "SELECT id, minutes FROM rc JOIN met ON id = recipe_id WHERE minutes IS NOT NULL AND minutes > 0",
          ("rc", "met"))
def q_positive_join(spark, sf):
    rc, met = clean_recipes(spark, sf), G.recipe_metrics(kept(spark, sf)).withColumnRenamed("recipe_id", "_k")
    j = rc.join(met, rc.id == met._k, "inner")
    return C.positive_filter(j, "minutes", null_as_zero=False).select("id", "minutes")


@register("c10_predicates", "id:i, n_steps:i, n_ingredients:i",
          "SELECT id, n_steps, n_ingredients FROM raw_r WHERE n_steps >= 40 OR n_ingredients = 1 OR minutes = 1",
          ("raw_r",))
def q_predicates(spark, sf):
    return C.predicate(raw_recipes(spark, sf), "n_steps >= 40 OR n_ingredients = 1 OR minutes = 1") \
            .select("id", "n_steps", "n_ingredients")


@register("c11_coerce_dates", "id:i, submitted:s",
          "SELECT id, TRY_CAST(submitted AS DATE) AS submitted FROM raw_r", ("raw_r",))
def q_coerce_dates(spark, sf):
    return raw_recipes(spark, sf).select("id", C.coerce_date("submitted").alias("submitted"))


# --- joins -------------------------------------------------------------------

J1_SPEC = "id:i, effort_score:d, n_interactions:i, bayes_mean:d, wilson_lb:d"


@register("j1_inner_join", J1_SPEC, f"SELECT {_cols(J1_SPEC)} FROM rc JOIN met ON rc.id = met.recipe_id",
          ("rc", "met"))
def q_inner_join(spark, sf):
    rc, met = clean_recipes(spark, sf), G.recipe_metrics(kept(spark, sf)).withColumnRenamed("recipe_id", "_k")
    return rc.join(met, rc.id == met._k, "inner").select(*[n for n, _ in O.parse_spec(J1_SPEC)])


@register("j2_semi_join", "user_id:i, recipe_id:i, rating:i",
          "SELECT user_id, recipe_id, rating FROM ic", ("ic",))
def q_semi_join(spark, sf):
    return kept(spark, sf).select("user_id", "recipe_id", "rating")


# --- aggregation ---------------------------------------------------------------

@register("g4_mean_by_rating", "rating:i, mean_review_length:d",
          "SELECT rating, avg(CAST(review_length AS DOUBLE)) AS mean_review_length FROM ic0 "
          "WHERE rating IS NOT NULL GROUP BY rating", ("ic0",))
def q_mean_by(spark, sf):
    ic = C.prepare_interactions(raw_interactions(spark, sf))
    return G.mean_by(ic, "rating", "review_length", "mean_review_length")


STRATA_T = ("bayes_mean", "wilson_lb", "log1p_interactions_per_month_w")
STRATA_SPEC = "stratum:i, " + ", ".join(f"{t}_mean:d, {t}_std:d, {t}_count:i" for t in STRATA_T)


def _qcut_sql(src: str, x: str, q: int, out: str = "stratum") -> str:
    probs = ", ".join(f"quantile_cont({x}, {i / q!r}) AS e{i}" for i in range(q + 1))
    code = " + ".join(f"CASE WHEN e{j} <> e{j - 1} AND e{j} < {x} THEN 1 ELSE 0 END" for j in range(1, q))
    return (f"SELECT s.*, CASE WHEN {x} IS NOT NULL THEN {code or '0'} END AS {out} FROM {src} s, "
            f"(SELECT {probs} FROM {src}) e")


_STRATA_SRC = f"({_qcut_sql('(SELECT * FROM analysis WHERE effort_score IS NOT NULL)', 'effort_score', 4)})"


@register("g5_strata", STRATA_SPEC,
          "SELECT k.stratum, " + ", ".join(
              f"avg({t}) AS {t}_mean, stddev_samp({t}) AS {t}_std, count({t}) AS {t}_count" for t in STRATA_T)
          + f" FROM range(4) k(stratum) LEFT JOIN {_STRATA_SRC} a ON a.stratum = k.stratum GROUP BY k.stratum",
          ("analysis",))
def q_strata(spark, sf):
    return G.strata_summary(analysis(spark, sf), "effort_score", STRATA_T)[1]


@register("g5_edges", "e0:d, e1:d, e2:d, e3:d, e4:d",
          "SELECT " + ", ".join(f"quantile_cont(effort_score, {i / 4!r}) AS e{i}" for i in range(5))
          + " FROM analysis", ("analysis",))
def q_strata_edges(spark, sf):
    return G.strata_summary(analysis(spark, sf), "effort_score", STRATA_T)[2]


G6_SPEC = ("stratum:i, bayes_mean_mean:d, bayes_mean_std:d, bayes_mean_count:i, wilson_lb_mean:d, "
           "n_interactions_mean:d, effort_score_min:d, effort_score_max:d")


@register("g6_quartile_agg", G6_SPEC,
          "SELECT stratum, round_even(avg(bayes_mean), 3) AS bayes_mean_mean, "
          "round_even(stddev_samp(bayes_mean), 3) AS bayes_mean_std, count(bayes_mean) AS bayes_mean_count, "
          "round_even(avg(wilson_lb), 3) AS wilson_lb_mean, round_even(avg(n_interactions), 3) AS "
          "n_interactions_mean, round_even(min(effort_score), 3) AS effort_score_min, "
          f"round_even(max(effort_score), 3) AS effort_score_max FROM {_STRATA_SRC} a "
          "WHERE stratum IS NOT NULL GROUP BY stratum", ("analysis",))
def q_quartile_agg(spark, sf):
    assigned = G.strata_summary(analysis(spark, sf), "effort_score", STRATA_T)[0]
    return G.group_agg(assigned, "stratum", {"bayes_mean": ["mean", "std", "count"], "wilson_lb": ["mean"],
                                             "n_interactions": ["mean"], "effort_score": ["min", "max"]}, 3)


def _cut_sql(src: str, x: str, bins: int, out: str = "bin") -> str:
    lo = "CASE WHEN mx = mn THEN mn - CASE WHEN mn <> 0 THEN abs(mn) * 0.001 ELSE 0.001 END ELSE mn END"
    hi = "CASE WHEN mx = mn THEN mx + CASE WHEN mn <> 0 THEN abs(mn) * 0.001 ELSE 0.001 END ELSE mx END"
    code = " + ".join(f"CASE WHEN _lo + {float(i)!r} * _st < {x} THEN 1 ELSE 0 END" for i in range(1, bins))
    return (f"SELECT s.*, CASE WHEN {x} IS NOT NULL THEN {code} END AS {out} FROM {src} s, "
            f"(SELECT {lo} AS _lo, ({hi} - {lo}) / {float(bins)!r} AS _st FROM "
            f"(SELECT CAST(min({x}) AS DOUBLE) AS mn, CAST(max({x}) AS DOUBLE) AS mx FROM {src}) z) e")


G7_COLS = ("effort_score", "n_interactions", "bayes_mean", "wilson_lb")
G7_SPEC = "bin:i, " + ", ".join(f"mean_{c}:d" for c in G7_COLS)


@register("g7_bin_profile", G7_SPEC,
          "SELECT bin, " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{c}" for c in G7_COLS)
          + f" FROM ({_cut_sql('analysis', 'effort_score', 10)}) b WHERE bin IS NOT NULL GROUP BY bin",
          ("analysis",))
def q_bin_profile(spark, sf):
    return G.bin_profile(analysis(spark, sf), "effort_score", G7_COLS, 10)


@register("g8_frequency", "effort_category:s, n:i, pct:d",
          "SELECT effort_category, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM rc) AS pct "
          "FROM rc WHERE effort_category IS NOT NULL GROUP BY 1", ("rc",))
def q_frequency(spark, sf):
    return G.frequency(clean_recipes(spark, sf), "effort_category")


@register("g8_frequency_events", "event_type:s, n:i, pct:d",
          "SELECT event_type, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM events) AS pct "
          "FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def q_frequency_events(spark, sf):
    return G.frequency(FX.table(spark, sf, "events"), "event_type")


@register("g9_conditional_share", "n_match:i, n_total:i, pct:d",
          "SELECT count(*) FILTER (WHERE rating IS NULL) AS n_match, count(*) AS n_total, "
          "count(*) FILTER (WHERE rating IS NULL) * 100.0 / count(*) AS pct FROM ic0", ("ic0",))
def q_cond_share(spark, sf):
    return G.conditional_share(C.prepare_interactions(raw_interactions(spark, sf)), "rating IS NULL")


@register("g10_conditional_mean", "mean:d",
          "SELECT avg(CAST(rating AS DOUBLE)) FILTER (WHERE review IS NULL) AS mean FROM ic0", ("ic0",))
def q_cond_mean(spark, sf):
    return G.conditional_mean(C.prepare_interactions(raw_interactions(spark, sf)), "rating", "review IS NULL")


G11_SPEC = "min:i, max:i, n_at_min:i, n_at_max:i, n_above:i, n_eq_0:i, n_eq_1:i"


@register("g11_extremes", G11_SPEC,
          "SELECT min(minutes) AS min, max(minutes) AS max, "
          "count(*) FILTER (WHERE minutes = (SELECT min(minutes) FROM raw_r)) AS n_at_min, "
          "count(*) FILTER (WHERE minutes = (SELECT max(minutes) FROM raw_r)) AS n_at_max, "
          "count(*) FILTER (WHERE minutes > 1440) AS n_above, count(*) FILTER (WHERE minutes = 0) AS n_eq_0, "
          "count(*) FILTER (WHERE minutes = 1) AS n_eq_1 FROM raw_r", ("raw_r",))
def q_extremes(spark, sf):
    return G.extremes(raw_recipes(spark, sf), "minutes", above=1440, equal_to=[0, 1])


G12_SPEC = "n_unique:i, top_key:i, top_count:i, top_pct:d, mean_count:i, median_count:d"


@register("g12_contributors", G12_SPEC,
          "WITH per AS (SELECT contributor_id, count(*) AS n FROM raw_r WHERE contributor_id IS NOT NULL GROUP BY 1), "
          "tot AS (SELECT count(*) AS n_rows, count(DISTINCT contributor_id) + max(CASE WHEN contributor_id IS NULL "
          "THEN 1 ELSE 0 END) AS n_unique FROM raw_r) "
          "SELECT n_unique, (SELECT contributor_id FROM per ORDER BY n DESC, contributor_id LIMIT 1) AS top_key, "
          "(SELECT max(n) FROM per) AS top_count, round_even((SELECT max(n) FROM per) * 100.0 / n_rows, 2) AS top_pct, "
          "round_even((SELECT avg(n) FROM per), 0) AS mean_count, (SELECT quantile_cont(n, 0.5) FROM per) AS median_count "
          "FROM tot", ("raw_r",))
def q_contributors(spark, sf):
    return G.contributor_concentration(raw_recipes(spark, sf))


G13_SPEC = "part:s, position:i, item:s, n:i, n_unique:i, n_total:i"


def _items_sql(col: str, k: int, tail: int = 10) -> str:
    return (f"WITH it AS (SELECT unnest({O.list_sql(col)}) AS item FROM raw_r WHERE {col} IS NOT NULL), "
            f"f AS (SELECT item, count(*) AS n FROM it GROUP BY item), "
            f"t AS (SELECT count(*) AS n_unique, sum(n) AS n_total FROM f), "
            f"top AS (SELECT 'top' AS part, item, n FROM f ORDER BY n DESC, item LIMIT {k}), "
            f"tl AS (SELECT 'tail' AS part, item, n FROM f ORDER BY n ASC, item DESC LIMIT {tail}), "
            f"b AS (SELECT * FROM top UNION ALL SELECT * FROM tl) "
            f"SELECT part, row_number() OVER (PARTITION BY part ORDER BY n DESC, item) AS position, item, n, "
            f"n_unique, n_total FROM b, t")


@register("g13_ingredients", G13_SPEC, _items_sql("ingredients", 10), ("raw_r",))
def q_ingredients(spark, sf):
    return G.item_summary(raw_recipes(spark, sf), "ingredients", 10)


@register("g13_tags", G13_SPEC, _items_sql("tags", 20), ("raw_r",))
def q_tags(spark, sf):
    return G.item_summary(raw_recipes(spark, sf), "tags", 20)


@register("g14_group_sizes", "complexity:s, size:i",
          "SELECT complexity, count(*) AS size FROM rc WHERE complexity IS NOT NULL GROUP BY 1", ("rc",))
def q_group_sizes(spark, sf):
    return G.group_sizes(clean_recipes(spark, sf), "complexity")


@register("g15_value_multiset", "recipe_id:i, rating:i, count:i",
          "SELECT recipe_id, rating, count(*) AS count FROM ic WHERE recipe_id IS NOT NULL GROUP BY 1, 2", ("ic",))
def q_multiset(spark, sf):
    return G.value_multiset(kept(spark, sf), "recipe_id", "rating")


# --- profiling -----------------------------------------------------------------

P1_SPEC = "column:s, n_missing:i, n_rows:i, n_columns:i, total_missing:i"
RAW_COLS = [n for n, _ in O.parse_spec(RAW_SPEC)]


@register("p1_profile", P1_SPEC,
          'SELECT c."column", c.n_missing, t.n_rows, 12 AS n_columns, t.total_missing FROM (UNPIVOT (SELECT '
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in RAW_COLS)
          + " FROM raw_r) ON COLUMNS(*) INTO NAME \"column\" VALUE n_missing) c, (SELECT count(*) AS n_rows, "
          + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_COLS)
          + " AS total_missing FROM raw_r) t", ("raw_r",))
def q_profile(spark, sf):
    return P.profile(raw_recipes(spark, sf))


P2_COLS = ("bayes_mean", "wilson_lb", "avg_rating", "std_rating", "submitted")


@register("p2_missing", P1_SPEC,
          'SELECT c."column", c.n_missing, t.n_rows, w.n_columns, t.total_missing FROM (UNPIVOT (SELECT '
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in P2_COLS)
          + " FROM analysis) ON COLUMNS(*) INTO NAME \"column\" VALUE n_missing) c, (SELECT count(*) AS n_rows, "
          + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in P2_COLS)
          + " AS total_missing FROM analysis) t, (SELECT count(*) AS n_columns FROM "
          "(SELECT CAST(COLUMNS(*) AS VARCHAR) FROM analysis LIMIT 1) UNPIVOT INCLUDE NULLS (v FOR k IN (*))) w", ("analysis",))
def q_missing(spark, sf):
    return P.profile(analysis(spark, sf), list(P2_COLS))


P3_SPEC = "mean:d, median:d, min:d, max:d, q1:d, q3:d, std:d"


@register("p3_minutes", P3_SPEC,
          "SELECT avg(minutes) AS mean, quantile_cont(minutes, 0.5) AS median, min(minutes) AS min, "
          "max(minutes) AS max, quantile_cont(minutes, 0.25) AS q1, quantile_cont(minutes, 0.75) AS q3, "
          "stddev_samp(minutes) AS std FROM raw_r", ("raw_r",))
def q_seven(spark, sf):
    return P.seven_number(raw_recipes(spark, sf), "minutes")


P4_COLS = ("minutes", "n_steps", "n_ingredients", "effort_score")
P4_SPEC = "column:s, count:i, mean:d, std:d, min:d, p25:d, p50:d, p75:d, max:d"


def _describe_sql(src: str, cols, extended: bool = False) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        ext = ""
        if extended:
            ext = (f", var_samp({x}) AS var, CASE WHEN count({x}) >= 3 THEN skewness({x}) END AS skew, "
                   f"CASE WHEN count({x}) >= 4 THEN kurtosis({x}) END AS kurt")
        parts.append(f"SELECT '{c}' AS column, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
                     f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                     f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max{ext} FROM {src}")
    return " UNION ALL ".join(parts)


@register("p4_describe", P4_SPEC, _describe_sql("analysis", P4_COLS), ("analysis",))
def q_describe(spark, sf):
    return P.describe(analysis(spark, sf), P4_COLS)


P5_COLS = ("n_interactions", "avg_rating", "bayes_mean", "wilson_lb")
P5_SPEC = P4_SPEC + ", var:d, skew:d, kurt:d"


@register("p5_describe_extended", P5_SPEC, _describe_sql("analysis", P5_COLS, True), ("analysis",))
def q_describe_ext(spark, sf):
    return P.describe(analysis(spark, sf), P5_COLS, extended=True)


P6_COLS = ("minutes", "log_minutes", "n_interactions", "log1p_n_interactions")


@register("p6_skew_kurt", "column:s, skew:d, kurt:d, is_skewed:b",
          " UNION ALL ".join(
              f"SELECT '{c}' AS column, CASE WHEN count({c}) >= 3 THEN skewness(CAST({c} AS DOUBLE)) END AS skew, "
              f"CASE WHEN count({c}) >= 4 THEN kurtosis(CAST({c} AS DOUBLE)) END AS kurt, "
              f"coalesce(CASE WHEN count({c}) >= 3 THEN skewness(CAST({c} AS DOUBLE)) END > 2.0, false) AS is_skewed "
              f"FROM analysis" for c in P6_COLS), ("analysis",))
def q_skew(spark, sf):
    return P.shape_moments(analysis(spark, sf), P6_COLS)


def _mode_sql(src, c):
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@register("p7_count_summary", "column:s, mean:d, median:d, min:d, max:d, mode:d",
          " UNION ALL ".join(
              f"SELECT '{c}' AS column, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, min({c}) AS min, "
              f"max({c}) AS max, {_mode_sql('raw_r', c)} AS mode FROM raw_r" for c in ("n_steps", "n_ingredients")),
          ("raw_r",))
def q_count_summary(spark, sf):
    return P.count_summary(raw_recipes(spark, sf))


def _nutrition_sql() -> str:
    parts = []
    for i, c in enumerate(NUTRITION_COLUMNS):
        p = f"split_part(nutrition, ',', {i + 1})"
        if i == 0:
            p = f"replace({p}, '[', '')"
        if i == len(NUTRITION_COLUMNS) - 1:
            p = f"replace({p}, ']', '')"
        parts.append(f"TRY_CAST(trim(CASE WHEN len(string_split(nutrition, ',')) >= {i + 1} THEN {p} END) AS DOUBLE) AS {c}")
    return f"SELECT id, {', '.join(parts)} FROM raw_r"


A4_SPEC = "id:i, " + ", ".join(f"{c}:d" for c in NUTRITION_COLUMNS)


@register("a4_nutrition", A4_SPEC, _nutrition_sql(), ("raw_r",))
def q_nutrition(spark, sf):
    return split_fixed_list(raw_recipes(spark, sf), "nutrition").select("id", *NUTRITION_COLUMNS)


@register("p8_nutrition_stats", "column:s, mean:d, median:d, min:d, max:d, std:d",
          " UNION ALL ".join(
              f"SELECT '{c}' AS column, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, min({c}) AS min, "
              f"max({c}) AS max, stddev_samp({c}) AS std FROM ({_nutrition_sql()}) n" for c in NUTRITION_COLUMNS),
          ("raw_r",))
def q_nutrition_stats(spark, sf):
    return P.multi_stats(split_fixed_list(raw_recipes(spark, sf), "nutrition"), NUTRITION_COLUMNS)


@register("p9_extreme_row", "id:i, name:s, minutes:i",
          "SELECT id, name, minutes FROM raw_r WHERE minutes IS NOT NULL ORDER BY minutes DESC, id LIMIT 1",
          ("raw_r",))
def q_extreme_row(spark, sf):
    return P.extreme_row(raw_recipes(spark, sf), "minutes", "id", "max").select("id", "name", "minutes")


@register("p10_top_k", "id:i, n_interactions:i, bayes_mean:d",
          "SELECT id, n_interactions, bayes_mean FROM analysis ORDER BY n_interactions DESC NULLS LAST, id LIMIT 5",
          ("analysis",))
def q_topk(spark, sf):
    return P.top_k(analysis(spark, sf), "n_interactions", 5, key="id").select("id", "n_interactions", "bayes_mean")


@register("p11_kpi", "n_rows:i, mean_effort_score:d, mean_bayes_mean:d, mean_wilson_lb:d",
          "SELECT count(*) AS n_rows, avg(effort_score) AS mean_effort_score, avg(bayes_mean) AS mean_bayes_mean, "
          "avg(wilson_lb) AS mean_wilson_lb FROM analysis", ("analysis",))
def q_kpi(spark, sf):
    return P.kpi_row(analysis(spark, sf))


@register("p12_fd_bins", "bins:i, n:i, iqr:d",
          "SELECT CAST(least(100, greatest(10, CASE WHEN q3 - q1 = 0 THEN ceil(sqrt(n)) ELSE "
          "ceil((mx - mn) / (2.0 * (q3 - q1) / pow(n, 1.0 / 3.0))) END)) AS BIGINT) AS bins, n, q3 - q1 AS iqr "
          "FROM (SELECT CAST(count(x) AS DOUBLE) AS n, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q1, "
          "quantile_cont(x, 0.75) AS q3 FROM (SELECT log1p_n_interactions AS x FROM analysis))", ("analysis",))
def q_fd(spark, sf):
    return P.fd_bins(analysis(spark, sf), "log1p_n_interactions")



def _hist_sql(src: str, x: str, bins: int) -> str:
    """numpy-style equal-width histogram with every bin listed."""
    return (f"WITH d AS (SELECT CAST({x} AS DOUBLE) AS x FROM {src} WHERE {x} IS NOT NULL), "
            f"r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, "
            f"CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM d), "
            f"c0 AS (SELECT x, lo, hi, (hi - lo) / {float(bins)!r} AS st, "
            f"least({bins - 1}, CAST(floor((x - lo) * {float(bins)!r} / (hi - lo)) AS INTEGER)) AS i0 FROM d, r), "
            f"c1 AS (SELECT x, lo, st, CASE WHEN x < lo + CAST(i0 AS DOUBLE) * st THEN i0 - 1 ELSE i0 END AS i1 FROM c0), "
            f"c2 AS (SELECT CASE WHEN i1 < {bins - 1} AND x >= lo + CAST(i1 + 1 AS DOUBLE) * st THEN i1 + 1 ELSE i1 END "
            f"AS bin FROM c1), "
            f"cnt AS (SELECT bin, count(*) AS n FROM c2 GROUP BY bin) "
            f"SELECT k.bin, lo + CAST(k.bin AS DOUBLE) * ((hi - lo) / {float(bins)!r}) AS lower, "
            f"lo + CAST(k.bin + 1 AS DOUBLE) * ((hi - lo) / {float(bins)!r}) AS upper, coalesce(n, 0) AS count "
            f"FROM range({bins}) k(bin) CROSS JOIN r LEFT JOIN cnt ON cnt.bin = k.bin WHERE lo IS NOT NULL")


HIST_SPEC = "bin:i, lower:d, upper:d, count:i"


@register("p13_histogram", HIST_SPEC, _hist_sql("analysis", "effort_score", 30), ("analysis",))
def q_hist(spark, sf):
    return P.histogram(analysis(spark, sf), "effort_score", 30)


@register("p13_histogram_events", HIST_SPEC, _hist_sql("events", "value", 50))
def q_hist_events(spark, sf):
    return P.histogram(FX.table(spark, sf, "events"), "value", 50)


@register("p13_histogram_edges", HIST_SPEC,
          "WITH d AS (SELECT CAST(rating AS DOUBLE) AS x FROM ic0 WHERE rating IS NOT NULL AND rating >= 0 AND "
          "rating <= 5), c AS (SELECT (CASE WHEN x >= 1 THEN 1 ELSE 0 END + CASE WHEN x >= 2 THEN 1 ELSE 0 END + "
          "CASE WHEN x >= 3 THEN 1 ELSE 0 END + CASE WHEN x >= 4 THEN 1 ELSE 0 END) AS bin, count(*) AS n FROM d "
          "GROUP BY 1) SELECT k.bin, CAST(k.bin AS DOUBLE) AS lower, CAST(k.bin + 1 AS DOUBLE) AS upper, "
          "coalesce(n, 0) AS count FROM range(5) k(bin) LEFT JOIN c ON c.bin = k.bin", ("ic0",))
def q_hist_edges(spark, sf):
    ic = C.prepare_interactions(raw_interactions(spark, sf))
    return P.histogram(ic, "rating", edges=[0, 1, 2, 3, 4, 5])


BOX_SPEC = "effort_category:s, q1:d, median:d, q3:d, whisker_low:d, whisker_high:d, n_outliers:i, n:i"


def _box_sql(src: str, x: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    on = f"USING ({by})" if by else "ON true"
    return (f"WITH d AS (SELECT {g}CAST({x} AS DOUBLE) AS x FROM {src} WHERE {x} IS NOT NULL"
            f"{f' AND {by} IS NOT NULL' if by else ''}), "
            f"q AS (SELECT {g}quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
            f"quantile_cont(x, 0.75) AS q3 FROM d {gb}) "
            f"SELECT {g}any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3, "
            f"min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_low, "
            f"max(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_high, "
            f"count(*) FILTER (WHERE NOT (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))) AS n_outliers, "
            f"count(*) AS n FROM d JOIN q {on} {gb}")


@register("p14_box_by_group", BOX_SPEC, _box_sql("analysis", "bayes_mean", "effort_category"), ("analysis",))
def q_box(spark, sf):
    return P.box_stats(analysis(spark, sf), "bayes_mean", by=["effort_category"])


@register("p14_box_overall", "q1:d, median:d, q3:d, whisker_low:d, whisker_high:d, n_outliers:i, n:i",
          _box_sql("raw_r", "minutes", None), ("raw_r",))
def q_box_overall(spark, sf):
    return P.box_stats(raw_recipes(spark, sf), "minutes")


@register("p15_kde", "point:i, x:d, density:d",
          "WITH d AS (SELECT CAST(log1p_n_interactions AS DOUBLE) AS v FROM analysis WHERE log1p_n_interactions IS NOT NULL), "
          "vc AS (SELECT v, count(*) AS k FROM d GROUP BY v), "
          "st AS (SELECT CAST(count(v) AS DOUBLE) AS n, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx FROM d), "
          "pts AS (SELECT CAST(i AS INTEGER) AS point, mn + CAST(i AS DOUBLE) * (mx - mn) / 199.0 AS x, "
          "sd * pow(n, -0.2) AS h, n FROM range(200) g(i), st) "
          "SELECT point, x, sum(k * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / any_value(n * h * sqrt(2 * pi())) "
          "AS density FROM vc, pts GROUP BY point, x", ("analysis",))
def q_kde(spark, sf):
    return P.kde(analysis(spark, sf), "log1p_n_interactions", 200)


def _cut_code_sql(x: str, mn: str, mx: str, bins: int) -> str:
    lo = f"(CASE WHEN {mx} = {mn} THEN {mn} - CASE WHEN {mn} <> 0 THEN abs({mn}) * 0.001 ELSE 0.001 END ELSE {mn} END)"
    hi = f"(CASE WHEN {mx} = {mn} THEN {mx} + CASE WHEN {mn} <> 0 THEN abs({mn}) * 0.001 ELSE 0.001 END ELSE {mx} END)"
    st = f"(({hi} - {lo}) / {float(bins)!r})"
    return "(" + " + ".join(f"CASE WHEN {lo} + {float(i)!r} * {st} < {x} THEN 1 ELSE 0 END"
                            for i in range(1, bins)) + ")"


@register("p16_density_2d", "bin_x:i, bin_y:i, count:i, mean_bayes_mean:d",
          "SELECT " + _cut_code_sql("CAST(n_steps AS DOUBLE)", "xmn", "xmx", 20) + " AS bin_x, "
          + _cut_code_sql("CAST(n_ingredients AS DOUBLE)", "ymn", "ymx", 20) + " AS bin_y, count(*) AS count, "
          "avg(bayes_mean) AS mean_bayes_mean FROM analysis, (SELECT CAST(min(n_steps) AS DOUBLE) AS xmn, "
          "CAST(max(n_steps) AS DOUBLE) AS xmx, CAST(min(n_ingredients) AS DOUBLE) AS ymn, "
          "CAST(max(n_ingredients) AS DOUBLE) AS ymx FROM analysis) WHERE n_steps IS NOT NULL AND "
          "n_ingredients IS NOT NULL GROUP BY 1, 2", ("analysis",))
def q_density2d(spark, sf):
    return P.kde2d_grid(analysis(spark, sf), "n_steps", "n_ingredients", 20, hue="bayes_mean")


SCATTER_SPEC = "id:i, effort_score:d, n_interactions:i, bayes_mean:d, effort_category:s"


def _kde2d_sql(src: str, x: str, y: str, grid: int) -> str:
    g = float(grid - 1)
    shares = " UNION ALL ".join(
        f"SELECT ix + {i} AS i, iy + {j} AS j, ({'fx' if i else '1 - fx'}) * ({'fy' if j else '1 - fy'}) AS w FROM pl" for i in (0, 1) for j in (0, 1))
    return (f"WITH kd AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL), "
            f"k0 AS (SELECT CAST(count(*) AS DOUBLE) AS n, pow(count(*), -1.0 / 6) AS f, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, "
            f"var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS cv FROM kd), "
            f"k1 AS (SELECT *, x0 - 3 * f * sqrt(vx) AS xl, (x1 - x0 + 6 * f * sqrt(vx)) / {g} AS xs, y0 - 3 * f * sqrt(vy) AS yl, "
            f"(y1 - y0 + 6 * f * sqrt(vy)) / {g} AS ys, vx * vy - cv * cv AS det FROM k0), "
            f"pl AS (SELECT ix, iy, px - ix AS fx, py - iy AS fy FROM (SELECT px, py, least(floor(px), {grid - 2}) AS ix, least(floor(py), {grid - 2}) AS iy "
            f"FROM (SELECT (x - xl) / xs AS px, (y - yl) / ys AS py FROM kd, k1))), "
            f"ms AS (SELECT i, j, sum(w) AS w FROM ({shares}) GROUP BY i, j), "
            f"gp AS (SELECT a AS point_x, b AS point_y FROM range({grid}) r(a), range({grid}) q(b)) "
            f"SELECT point_x, point_y, any_value(xl + point_x * xs) AS x, any_value(yl + point_y * ys) AS y, sum(w * exp(-0.5 * "
            f"(vy * pow((point_x - i) * xs, 2) - 2 * cv * (point_x - i) * xs * (point_y - j) * ys + vx * pow((point_y - j) * ys, 2)) / (det * f * f))) "
            f"/ any_value(2 * pi() * sqrt(det) * f * f * n) AS density FROM gp, ms, k1 GROUP BY point_x, point_y")


@register("p16_kde_2d", "point_x:i, point_y:i, x:d, y:d, density:d", _kde2d_sql("analysis", "n_steps", "n_ingredients", 40), ("analysis",))
def q_kde2d(spark, sf):
    return P.kde2d(analysis(spark, sf), "n_steps", "n_ingredients", 40)


@register("p17_scatter_sample", SCATTER_SPEC,
          f"SELECT {_cols(SCATTER_SPEC)} FROM analysis", ("analysis",))
def q_scatter(spark, sf):
    return analysis(spark, sf).select(*[n for n, _ in O.parse_spec(SCATTER_SPEC)])


# --- list and scalar functions -------------------------------------------------

@register("a1_parse_tags", "id:i, pos:i, item:s",
          f"SELECT id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS item FROM "
          f"(SELECT id, {O.list_sql('tags')} AS l FROM raw_r WHERE tags IS NOT NULL)", ("raw_r",))
def q_parse_tags(spark, sf):
    return raw_recipes(spark, sf).select("id", F.posexplode(parse_list("tags")).alias("pos", "item"))


@register("a2_parse_steps", "id:i, n_items:i",
          f"SELECT id, coalesce(len({O.list_sql('steps')}), 0) AS n_items FROM raw_r", ("raw_r",))
def q_parse_steps(spark, sf):
    r = raw_recipes(spark, sf)
    return r.select("id", F.size(list_or_empty(r, "steps")).alias("n_items"))


@register("a3_words_per_step", "id:i, avg_words_per_step:d",
          f"SELECT id, {O.avg_words_sql(O.list_sql('steps'))} AS avg_words_per_step FROM raw_r", ("raw_r",))
def q_words(spark, sf):
    r = raw_recipes(spark, sf)
    return r.select("id", avg_words_per_step(list_or_empty(r, "steps"), True).alias("avg_words_per_step"))


@register("a3b_words_study", "id:i, avg_words_per_step:d",
          f"SELECT id, {O.avg_words_sql(O.list_sql('steps'), False)} AS avg_words_per_step FROM raw_r", ("raw_r",))
def q_words_study(spark, sf):
    r = raw_recipes(spark, sf)
    return r.select("id", avg_words_per_step(list_or_empty(r, "steps"), False).alias("avg_words_per_step"))


@register("a3_words_documents", "doc_id:i, avg_words_per_line:d",
          f"SELECT doc_id, {O.avg_words_sql('string_split(text, chr(10))')} AS avg_words_per_line FROM documents")
def q_words_docs(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", avg_words_per_step(F.split(F.col("text"), "\n", -1), True).alias("avg_words_per_line"))


@register("a5_lengths", "recipe_id:i, user_id:i, date:s, len_pipeline:i, len_study:i",
          "SELECT recipe_id, user_id, CAST(date AS VARCHAR) AS date, length(coalesce(review, '')) AS len_pipeline, "
          "length(review) AS len_study FROM raw_i", ("raw_i",))
def q_lengths(spark, sf):
    i = raw_interactions(spark, sf)
    return i.select("recipe_id", "user_id", "date", text_length("review", True).alias("len_pipeline"),
                    text_length("review", False).alias("len_study"))


# --- derived columns -----------------------------------------------------------

D_SPEC = ("id:i, category_minutes:s, complexity:s, step_length_category:s, category_n_ingredients:s, "
          "effort_category:s, log_minutes:d, log_n_ingredients:d")


@register("d4_categories_and_logs", D_SPEC, f"SELECT {_cols(D_SPEC)} FROM rc", ("rc",))
def q_categories(spark, sf):
    return clean_recipes(spark, sf)


D5_SPEC = "id:i, log_minutes_scaled:d, n_steps_scaled:d, avg_words_per_step_scaled:d, log_n_ingredients_scaled:d, effort_score:d"


@register("d5_d6_minmax_score", D5_SPEC, f"SELECT {_cols(D5_SPEC)} FROM rc", ("rc",))
def q_minmax(spark, sf):
    return clean_recipes(spark, sf)


D7_SPEC = "id:i, log_minutes_w:d, log1p_n_interactions_w:d, log1p_interactions_per_month_w:d, log1p_n_unique_users_w:d"


@register("d7_winsorize", D7_SPEC, f"SELECT {_cols(D7_SPEC)} FROM analysis", ("analysis",))
def q_winsor(spark, sf):
    cols = [c.removesuffix("_w") for c, _ in O.parse_spec(D7_SPEC)[1:]]
    return D.winsorize(analysis(spark, sf).select("id", *cols), cols, 0.05, 0.99)


TERC = ("Simple", "Moyennement complexe", "Complexe")


@register("d8_terciles", "id:i, steps_complexity:s",
          f"SELECT id, CASE WHEN avg_words_per_step < q33 THEN '{TERC[0]}' WHEN avg_words_per_step < q67 THEN "
          f"'{TERC[1]}' ELSE '{TERC[2]}' END AS steps_complexity FROM rc, (SELECT quantile_cont(avg_words_per_step, "
          f"0.33) AS q33, quantile_cont(avg_words_per_step, 0.67) AS q67 FROM rc)", ("rc",))
def q_terciles(spark, sf):
    return D.tercile_category(clean_recipes(spark, sf), "avg_words_per_step", TERC, "steps_complexity")


@register("d9_qcut", "id:i, stratum:i",
          f"SELECT id, stratum FROM ({_qcut_sql('analysis', 'effort_score', 4)})", ("analysis",))
def q_qcut(spark, sf):
    return D.qcut(analysis(spark, sf), "effort_score", 4, out="stratum")


@register("d9_qcut_lineitem", "bin:i, n:i",
          f"SELECT bin, count(*) AS n FROM ({_qcut_sql('lineitem', 'l_extendedprice', 10, 'bin')}) GROUP BY bin")
def q_qcut_li(spark, sf):
    b = D.qcut(FX.table(spark, sf, "lineitem"), "l_extendedprice", 10, out="bin")
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@register("d9_qcut_lineitem_rank", "bin:i, n:i",
          f"SELECT bin, count(*) AS n FROM ({_qcut_sql('lineitem', 'l_extendedprice', 10, 'bin')}) GROUP BY bin")
def q_qcut_li_rank(spark, sf):
    """The rank selection that many distinct values take, cut into buckets."""
    b = D.qcut(FX.table(spark, sf, "lineitem"), "l_extendedprice", 10, out="bin", method="rank")
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


_Q_PROBS = (0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0)


@register("d9_quantiles_by_group", "l_returnflag:s, " + ", ".join(f"q{i}:d" for i in range(len(_Q_PROBS))),
          "SELECT l_returnflag, " + ", ".join(f"quantile_cont(CAST(l_extendedprice AS DOUBLE), {p!r}) AS q{i}"
                                              for i, p in enumerate(_Q_PROBS)) + " FROM lineitem GROUP BY 1")
def q_quantiles_by(spark, sf):
    from ratelens.operators.quantiles import quantiles
    return quantiles(FX.table(spark, sf, "lineitem"), "l_extendedprice", _Q_PROBS, by=["l_returnflag"], method="rank", buckets=16)


@register("d9_qcut_labels", "id:i, stratum:i, stratum_label:s",
          f"SELECT id, stratum, ['Q1', 'Q2', 'Q3', 'Q4'][stratum + 1] AS stratum_label FROM "
          f"({_qcut_sql('analysis', 'effort_score', 4)})", ("analysis",))
def q_qcut_labels(spark, sf):
    return D.qcut(analysis(spark, sf), "effort_score", 4, labels=["Q1", "Q2", "Q3", "Q4"], out="stratum")


@register("d10_cut", "id:i, bin:i", f"SELECT id, bin FROM ({_cut_sql('analysis', 'effort_score', 10)})",
          ("analysis",))
def q_cut(spark, sf):
    return D.cut(analysis(spark, sf), "effort_score", 10)


@register("d11_gaps", "id:i, rating_gap:d, bayes_gap:d, wilson_gap:d",
          "SELECT id, rating_gap, bayes_gap, wilson_gap FROM analysis", ("analysis",))
def q_gaps(spark, sf):
    return D.gap_columns(analysis(spark, sf).select("id", "avg_rating", "bayes_mean", "wilson_lb"))


@register("d12_d13_age_rate", "id:i, age_months:d, interactions_per_month:d",
          "SELECT id, age_months, interactions_per_month FROM analysis", ("analysis",))
def q_age(spark, sf):
    df = analysis(spark, sf).select("id", "submitted", "n_interactions")
    df = df.withColumn("age_months", D.age_months("submitted", AS_OF))
    return df.withColumn("interactions_per_month", D.rate_per_month(F.col("n_interactions"), "age_months"))


Z_COLS = ("log_minutes", "n_steps", "n_ingredients", "avg_words_per_step", "age_months", "effort_score",
          "steps_x_ingredients")
Z_SPEC = "id:i, steps_x_ingredients:i, " + ", ".join(f"{c}_std:d" for c in Z_COLS)


def _z_sql() -> str:
    src = "(SELECT *, n_steps * n_ingredients AS steps_x_ingredients FROM analysis)"
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}"
                      for i, c in enumerate(Z_COLS))
    outs = ", ".join(f"CASE WHEN s{i} IS NULL OR s{i} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - m{i}) / s{i} END "
                     f"AS {c}_std" for i, c in enumerate(Z_COLS))
    return f"SELECT id, steps_x_ingredients, {outs} FROM {src} a, (SELECT {stats} FROM {src} b)"


@register("d14_d15_zscore", Z_SPEC, _z_sql(), ("analysis",))
def q_zscore(spark, sf):
    return D.add_feature_columns(analysis(spark, sf))[0]


@register("d14_meta", "column:s, mean:d, std:d",
          " UNION ALL ".join(f"SELECT '{c}' AS column, avg(CAST({c} AS DOUBLE)) AS mean, "
                             f"stddev_pop(CAST({c} AS DOUBLE)) AS std FROM (SELECT *, n_steps * n_ingredients AS "
                             f"steps_x_ingredients FROM analysis)" for c in Z_COLS), ("analysis",))
def q_zmeta(spark, sf):
    return D.add_feature_columns(analysis(spark, sf))[1]


@register("d16_std_product", "id:i, steps_x_ingredients_z:d",
          "SELECT id, ((n_steps - am) / sa) * ((n_ingredients - bm) / sb) AS steps_x_ingredients_z FROM analysis, "
          "(SELECT avg(n_steps) AS am, stddev_samp(n_steps) AS sa, avg(n_ingredients) AS bm, "
          "stddev_samp(n_ingredients) AS sb FROM analysis)", ("analysis",))
def q_std_product(spark, sf):
    return D.standardized_product(analysis(spark, sf), "n_steps", "n_ingredients", "steps_x_ingredients_z")



# --- statistical tests and models ---------------------------------------------------

T1_COLS = ("minutes", "n_steps", "n_ingredients", "effort_score", "bayes_mean", "wilson_lb", "n_interactions")
LI_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _corr_sql(src: str, cols) -> str:
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{a}' AS y, CASE WHEN count({a}) >= 2 AND "
                             f"stddev_pop(CAST({a} AS DOUBLE)) > 0 THEN 1.0 END AS coef, count({a}) AS n FROM {src}")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS coef, "
                             f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM {src}")
    return " UNION ALL ".join(parts)


@register("t1_corr_matrix", "x:s, y:s, coef:d, n:i", _corr_sql("analysis", T1_COLS), ("analysis",))
def q_corr(spark, sf):
    return T.corr_matrix(analysis(spark, sf), T1_COLS)


@register("t1_corr_lineitem", "x:s, y:s, coef:d, n:i", _corr_sql("lineitem", LI_COLS))
def q_corr_li(spark, sf):
    return T.corr_matrix(FX.table(spark, sf, "lineitem"), LI_COLS)


@register("w4_top_abs_corr", "x:s, y:s, coef:d",
          f"SELECT x, y, coef FROM ({_corr_sql('analysis', T1_COLS)}) WHERE x < y "
          "ORDER BY abs(coef) DESC NULLS LAST, x, y LIMIT 5", ("analysis",))
def q_top_abs(spark, sf):
    m = T.corr_matrix(analysis(spark, sf), T1_COLS).where(F.col("x") < F.col("y"))
    return m.orderBy(F.abs("coef").desc_nulls_last(), "x", "y").limit(5).select("x", "y", "coef")


def _pearson_sql() -> str:
    parts = []
    for e in T.DEFAULT_EFFORT_VARS:
        for p in T.DEFAULT_POPULARITY_VARS:
            ec, pc = T.PEARSON_MAP_EFFORT.get(e, e), T.PEARSON_MAP_POPULARITY.get(p, p)
            n = f"count(*) FILTER (WHERE {ec} IS NOT NULL AND {pc} IS NOT NULL)"
            parts.append(f"SELECT '{e}' AS effort, '{p}' AS popularity, '{ec}' AS x_col, '{pc}' AS y_col, "
                         f"CASE WHEN {n} >= 3 THEN corr(CAST({ec} AS DOUBLE), CAST({pc} AS DOUBLE)) END AS coef, "
                         f"{n} AS n FROM analysis")
    return " UNION ALL ".join(parts)


@register("t2_pearson", "effort:s, popularity:s, x_col:s, y_col:s, coef:d, n:i", _pearson_sql(), ("analysis",))
def q_pearson(spark, sf):
    return T.pearson_grid(analysis(spark, sf), with_p=False)


@register("t2_pearson_p", "effort:s, popularity:s, coef:d, n:i, p_value:d",
          f"SELECT *, {pearson_p_sql('coef', 'n')} AS p_value FROM ({_pearson_sql()})", ("analysis",))
def q_pearson_p(spark, sf):
    return T.pearson_grid(analysis(spark, sf), with_p=True)


def _spearman_pair_sql(src: str, xc: str, yc: str, label_x: str, label_y: str) -> str:
    return (f"SELECT '{label_x}' AS effort, '{label_y}' AS popularity, CASE WHEN count(*) >= 3 AND "
            f"stddev_pop(rx) > 0 AND stddev_pop(ry) > 0 THEN corr(rx, ry) END AS coef, count(*) AS n FROM "
            f"(SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, "
            f"rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM "
            f"(SELECT CAST({xc} AS DOUBLE) AS x, CAST({yc} AS DOUBLE) AS y FROM {src} "
            f"WHERE {xc} IS NOT NULL AND {yc} IS NOT NULL))")


@register("t3_spearman", "effort:s, popularity:s, coef:d, n:i",
          " UNION ALL ".join(_spearman_pair_sql("analysis", e, p, e, p)
                             for e in T.DEFAULT_EFFORT_VARS for p in T.DEFAULT_POPULARITY_VARS), ("analysis",))
def q_spearman(spark, sf):
    return T.spearman_grid(analysis(spark, sf), with_p=False)


@register("t3_spearman_p", "effort:s, popularity:s, coef:d, n:i, p_value:d",
          f"SELECT *, {pearson_p_sql('coef', 'n')} AS p_value FROM ({REGISTRY['t3_spearman'][2]})", ("analysis",))
def q_spearman_p(spark, sf):
    return T.spearman_grid(analysis(spark, sf), with_p=True)


def _anova_sql(src: str, g: str, m: str) -> str:
    return (f"SELECT '{m}' AS metric, 'anova' AS method, (sum(n * (mi - gm) * (mi - gm)) / (k - 1)) / "
            f"(sum((n - 1) * coalesce(v, 0.0)) / (nt - k)) AS statistic, k AS n_groups, nt AS n_total FROM "
            f"(SELECT {g}, count(x) AS n, avg(x) AS mi, var_samp(x) AS v FROM (SELECT {g}, CAST({m} AS DOUBLE) AS x "
            f"FROM {src} WHERE {g} IS NOT NULL AND {m} IS NOT NULL) GROUP BY {g}) gg, "
            f"(SELECT sum(n) AS nt, sum(n * mi) / sum(n) AS gm, count(*) AS k FROM (SELECT {g}, count(x) AS n, "
            f"avg(x) AS mi FROM (SELECT {g}, CAST({m} AS DOUBLE) AS x FROM {src} WHERE {g} IS NOT NULL AND "
            f"{m} IS NOT NULL) GROUP BY {g})) tt GROUP BY k, nt, gm")


def _kruskal_sql(src: str, g: str, m: str) -> str:
    d = f"(SELECT {g} AS g, CAST({m} AS DOUBLE) AS x FROM {src} WHERE {g} IS NOT NULL AND {m} IS NOT NULL)"
    return (f"SELECT '{m}' AS metric, 'kruskal' AS method, (12.0 / (nt * (nt + 1)) * sum(rr * rr / n) - "
            f"3.0 * (nt + 1)) / (1.0 - any_value(tt) / (nt * nt * nt - nt)) AS statistic, count(*) AS n_groups, "
            f"nt AS n_total FROM (SELECT g, sum(rk) AS rr, count(*) AS n FROM (SELECT g, rank() OVER (ORDER BY x) + "
            f"(count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM {d}) GROUP BY g) pg, "
            f"(SELECT sum(t * t * t - t) AS tt FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM {d} GROUP BY x)) ti, "
            f"(SELECT CAST(count(*) AS DOUBLE) AS nt FROM {d}) tn GROUP BY nt")


TEST_SPEC = "metric:s, method:s, statistic:d, n_groups:i, n_total:i"


def _strata(spark, sf):
    return G.strata_summary(analysis(spark, sf), "effort_score", STRATA_T)[0]


@register("t4_anova", TEST_SPEC, " UNION ALL ".join(_anova_sql(_STRATA_SRC, "stratum", m) for m in STRATA_T),
          ("analysis",))
def q_anova(spark, sf):
    return T.anova(_strata(spark, sf), "stratum", STRATA_T, na="per_metric", with_p=False)


@register("t5_kruskal", TEST_SPEC, " UNION ALL ".join(_kruskal_sql(_STRATA_SRC, "stratum", m) for m in STRATA_T),
          ("analysis",))
def q_kruskal(spark, sf):
    return T.kruskal(_strata(spark, sf), "stratum", STRATA_T, na="per_metric", with_p=False)


@register("t4_anova_lineitem", TEST_SPEC,
          " UNION ALL ".join(_anova_sql("lineitem", "l_returnflag", m) for m in ("l_quantity", "l_extendedprice")))
def q_anova_li(spark, sf):
    return T.anova(FX.table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"],
                   with_p=False)


@register("t5_kruskal_lineitem", TEST_SPEC,
          " UNION ALL ".join(_kruskal_sql("lineitem", "l_returnflag", m) for m in ("l_quantity", "l_extendedprice")))
def q_kruskal_li(spark, sf):
    return T.kruskal(FX.table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"],
                     with_p=False)


@register("t5_kruskal_lineitem_buckets", TEST_SPEC,
          " UNION ALL ".join(_kruskal_sql("lineitem", "l_returnflag", m) for m in ("l_quantity", "l_extendedprice")))
def q_kruskal_li_buckets(spark, sf):
    return T.kruskal(FX.table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"],
                     with_p=False, buckets=16)


@register("t45_group_sizes", "metric:s, group:s, size:i",
          " UNION ALL ".join(f"SELECT '{m}' AS metric, stratum AS \"group\", count({m}) AS size FROM {_STRATA_SRC} "
                             "WHERE stratum IS NOT NULL GROUP BY stratum" for m in STRATA_T), ("analysis",))
def q_group_test_sizes(spark, sf):
    return T.group_test_sizes(_strata(spark, sf), "stratum", list(STRATA_T), na="per_metric")


@register("t45_group_tests", TEST_SPEC + ", p_value:d",
          f"SELECT *, {f_sf_sql('statistic', 'n_groups - 1', 'n_total - n_groups')} AS p_value FROM ({REGISTRY['t4_anova'][2]}) UNION ALL "
          f"SELECT *, {chi2_sf_sql('statistic', 'n_groups - 1')} AS p_value FROM ({REGISTRY['t5_kruskal'][2]})", ("analysis",))
def q_group_tests(spark, sf):
    return T.group_tests(_strata(spark, sf), "stratum", list(STRATA_T), na="per_metric")


NL_Y = ("n_interactions", "bayes_mean", "wilson_lb")


NL_SRC = "nl AS (SELECT effort_score, n_interactions, bayes_mean, wilson_lb FROM analysis WHERE effort_score IS NOT NULL AND n_interactions IS NOT NULL AND bayes_mean IS NOT NULL AND wilson_lb IS NOT NULL)"


@register("t6_nonlinearity", "x:s, y:s, pearson:d, spearman:d, nonlinear:b",
          "SELECT 'effort_score' AS x, p.popularity AS y, p.coef AS pearson, s.coef AS spearman, "
          "abs(s.coef) > 1.1 * abs(p.coef) AS nonlinear FROM ("
          + " UNION ALL ".join(f"SELECT '{y}' AS popularity, corr(CAST(effort_score AS DOUBLE), CAST({y} AS DOUBLE)) "
                               f"AS coef FROM nl" for y in NL_Y) + ") p JOIN ("
          + " UNION ALL ".join(_spearman_pair_sql("nl", "effort_score", y, "effort_score", y) for y in NL_Y)
          + ") s ON p.popularity = s.popularity",
          ("analysis", "__NL__"))
def q_nonlinear(spark, sf):
    return T.nonlinearity(analysis(spark, sf), "effort_score", NL_Y)


PIV_SPEC = "effort:s, bayes_mean:d, wilson_lb:d, interactions_per_month:d"


@register("t7_pivot", PIV_SPEC,
          "SELECT effort, " + ", ".join(f"max(CASE WHEN popularity = '{p}' THEN round_even(coef, 3) END) AS {p}"
                                        for p in T.DEFAULT_POPULARITY_VARS)
          + f" FROM ({_pearson_sql()}) GROUP BY effort", ("analysis",))
def q_pivot(spark, sf):
    return T.pivot_matrix(T.pearson_grid(analysis(spark, sf), with_p=False),
                          order=list(T.DEFAULT_POPULARITY_VARS))


@register("t7_pivot_formatted", "effort:s, bayes_mean:s, wilson_lb:s, interactions_per_month:s",
          "SELECT effort, " + ", ".join(f"max(CASE WHEN popularity = '{p}' THEN format('{{:.3g}}', coef * coef) END) AS {p}"
                                        for p in T.DEFAULT_POPULARITY_VARS)
          + f" FROM ({_pearson_sql()}) GROUP BY effort", ("analysis",))
def q_pivot_formatted(spark, sf):
    grid = T.pearson_grid(analysis(spark, sf), with_p=False).withColumn("share", F.col("coef") * F.col("coef"))
    return T.pivot_matrix(grid, values="share", order=list(T.DEFAULT_POPULARITY_VARS), fmt="%.3g")


@register("t7_p_matrix", "effort:s, bayes_mean:s, wilson_lb:s, interactions_per_month:s",
          "SELECT effort, " + ", ".join(f"max(CASE WHEN popularity = '{p}' THEN format('{{:.3g}}', p) END) AS {p}"
                                        for p in T.DEFAULT_POPULARITY_VARS)
          + f" FROM (SELECT *, {pearson_p_sql('coef', 'n')} AS p FROM ({_pearson_sql()})) GROUP BY effort", ("analysis",))
def q_p_matrix(spark, sf):
    grid = T.pearson_grid(analysis(spark, sf))
    return T.pivot_matrix(grid, values="p_value", order=list(T.DEFAULT_POPULARITY_VARS), fmt="%.3g")


@register("e3_spearman_matrix", PIV_SPEC,
          "SELECT effort, " + ", ".join(f"max(CASE WHEN popularity = '{p}' THEN round_even(coef, 3) END) AS {p}"
                                        for p in T.DEFAULT_POPULARITY_VARS)
          + " FROM (" + " UNION ALL ".join(_spearman_pair_sql("analysis", e, p, e, p)
                                           for e in T.DEFAULT_EFFORT_VARS for p in T.DEFAULT_POPULARITY_VARS)
          + ") GROUP BY effort", ("analysis",))
def q_spearman_matrix(spark, sf):
    sp = T.spearman_grid(R.load_analysis(analysis(spark, sf)), with_p=False)
    return T.pivot_matrix(sp, order=list(T.DEFAULT_POPULARITY_VARS))


def _lowess_sql(x: str, y: str, iterations: int, anchors: int = 300, frac: float = 0.3) -> tuple[str, str]:
    """CTEs (one set a round) and select of ``x, y, fit``, with every distance written out."""
    a = anchors - 1
    parts = [
        f"lw AS (SELECT id, CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, row_number() OVER (ORDER BY {x}) - 1 AS r FROM analysis "
        f"WHERE {x} IS NOT NULL AND {y} IS NOT NULL)",
        f"lk AS (SELECT count(*) AS n, greatest(1, CAST(floor({frac!r} * count(*) + 1e-10) AS BIGINT)) AS k FROM lw)",
        f"la AS (SELECT DISTINCT x AS a FROM lw, lk, range({anchors}) g(i) WHERE r = i * (n - 1) // {a})",
        "lh AS (SELECT a, d AS h FROM (SELECT a, abs(x - a) AS d, row_number() OVER (PARTITION BY a ORDER BY abs(x - a)) AS o "
        "FROM la, lw), lk WHERE o = k)",
        "l0w AS (SELECT id, x, y, 1.0::DOUBLE AS rw FROM lw)"]
    for i in range(iterations + 1):
        t = f"l{i}"
        parts += [
            f"{t}s AS (SELECT a, h, w * rw AS w, x - a AS u, y FROM (SELECT a, h, x, y, rw, CASE WHEN h > 0 THEN "
            f"power(1 - power(abs(x - a) / h, 3), 3) ELSE 1.0 END AS w FROM lh, {t}w WHERE abs(x - a) < h OR x = a))",
            f"{t}m AS (SELECT a, any_value(h) AS h, sum(w) AS p0, sum(w * u) AS p1, sum(w * u * u) AS p2, sum(w * y) AS q0, "
            f"sum(w * u * y) AS q1 FROM {t}s GROUP BY a)",
            f"{t}f AS (SELECT a, fit, lead(a) OVER (ORDER BY a) AS a2, lead(fit) OVER (ORDER BY a) AS fit2 FROM (SELECT a, CASE WHEN "
            f"p0 * p2 - p1 * p1 > 1e-12 * p0 * p0 * h * h THEN (p2 * q0 - p1 * q1) / (p0 * p2 - p1 * p1) WHEN p0 <> 0 THEN q0 / p0 END AS fit "
            f"FROM {t}m) WHERE fit IS NOT NULL)",
            f"{t}p AS (SELECT id, x, y, CASE WHEN a2 IS NULL OR x = a THEN fit ELSE fit + (x - a) / (a2 - a) * (fit2 - fit) END AS fit "
            f"FROM {t}w JOIN {t}f ON x >= a AND (a2 IS NULL OR x < a2))"]
        if i < iterations:
            parts += [f"{t}q AS (SELECT quantile_cont(abs(y - fit), 0.5) AS s FROM {t}p)",
                      f"l{i + 1}w AS (SELECT id, x, y, CASE WHEN s <= 0 THEN 1.0 WHEN abs(y - fit) < 6 * s THEN "
                      f"power(1 - power(abs(y - fit) / (6 * s), 2), 2) ELSE 0.0 END AS rw FROM {t}p, {t}q)"]
    return ",\n".join(parts), f"SELECT x, y, fit FROM l{iterations}p"


_LOWESS, _LOWESS0 = _lowess_sql("effort_score", "bayes_mean", 3), _lowess_sql("effort_score", "bayes_mean", 0)


@register("t8_lowess", "x:d, y:d, fit:d", _LOWESS[1], ("analysis", _LOWESS[0]))
def q_lowess(spark, sf):
    from ratelens.operators.smooth import lowess
    return lowess(analysis(spark, sf), "effort_score", "bayes_mean", frac=0.3)


@register("t8_lowess_plain", "x:d, y:d, fit:d", _LOWESS0[1], ("analysis", _LOWESS0[0]))
def q_lowess_plain(spark, sf):
    from ratelens.operators.smooth import lowess
    return lowess(analysis(spark, sf), "effort_score", "bayes_mean", frac=0.3, iterations=0)


def _quad_sql(src: str, x: str, y: str, prefix: str) -> tuple[str, str]:
    """CTEs and select of ``a2, a1, a0, n``: a regression on x and its square by elimination."""
    from ratelens.plans.linsolve_sql import ols_sql
    d = f"(SELECT CAST({x} AS DOUBLE) AS x1, CAST({x} AS DOUBLE) * {x} AS x2, CAST({y} AS DOUBLE) AS yy FROM {src})"
    ctes, sel = ols_sql(d, ["x1", "x2"], "yy", prefix)
    return ctes, ("SELECT max(CASE WHEN term = 'x2' THEN coef END) AS a2, max(CASE WHEN term = 'x1' THEN coef END) AS a1, "
                  f"max(CASE WHEN term = 'intercept' THEN coef END) AS a0, max(n) AS n FROM ({sel})")


_T9 = _quad_sql("analysis", "effort_score", "bayes_mean", "t9")


@register("t9_quadratic_fit", "a2:d, a1:d, a0:d, n:i", _T9[1], ("analysis", _T9[0]))
def q_quad(spark, sf):
    return M.quadratic_fit(analysis(spark, sf), "effort_score", "bayes_mean")


@register("t9_quadratic_grid", "point:i, x:d, y_fit:d",
          "SELECT i AS point, mn + i * (mx - mn) / 199.0 AS x, a2 * (mn + i * (mx - mn) / 199.0) * (mn + i * (mx - mn) / 199.0) "
          f"+ a1 * (mn + i * (mx - mn) / 199.0) + a0 AS y_fit FROM range(200) g(i), ({_T9[1]}) q, "
          "(SELECT min(effort_score) AS mn, max(effort_score) AS mx FROM analysis)", ("analysis", _T9[0]))
def q_quad_grid(spark, sf):
    return M.quadratic_curve(analysis(spark, sf), "effort_score", "bayes_mean", 200)


@register("t10_simple_regression", "slope:d, intercept:d, r2:d, n:i",
          "SELECT regr_slope(bayes_mean, effort_score) AS slope, regr_intercept(bayes_mean, effort_score) AS "
          "intercept, regr_r2(bayes_mean, effort_score) AS r2, regr_count(bayes_mean, effort_score) AS n "
          "FROM analysis", ("analysis",))
def q_simple_reg(spark, sf):
    return M.simple_regression(analysis(spark, sf), "effort_score", "bayes_mean")


RES_SQL = ("SELECT *, bayes_mean - (b + a * effort_score) AS residual, b + a * effort_score AS prediction FROM "
           "analysis, (SELECT regr_slope(bayes_mean, effort_score) AS a, regr_intercept(bayes_mean, effort_score) "
           "AS b FROM analysis)")


@register("t10_residuals", "id:i, residual:d", f"SELECT id, residual FROM ({RES_SQL})", ("analysis",))
def q_residuals(spark, sf):
    return M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean")


T11_F = ("effort_score", "avg_words_per_step", "age_months")


def _ols_oracle(src: str, feats, target: str) -> tuple[str, str]:
    from ratelens.plans.linsolve_sql import ols_sql
    return ols_sql(src, feats, target)


_T11 = _ols_oracle("analysis", T11_F, "bayes_mean")


@register("t11_multiple_regression", "term:s, coef:d, r2:d, n:i", _T11[1], ("analysis",))
def q_multi_reg(spark, sf):
    return M.multiple_regression(analysis(spark, sf), T11_F, "bayes_mean")


REGISTRY["t11_multiple_regression"] = (REGISTRY["t11_multiple_regression"][0], "term:s, coef:d, r2:d, n:i",
                                       _T11[1], ("analysis", "__T11__"))

T14_F = ("log_minutes_std", "n_steps_std", "n_ingredients_std", "steps_x_ingredients_std", "age_months_std")
_Z_SRC = f"({_z_sql().replace('SELECT id, steps_x_ingredients,', 'SELECT id, bayes_mean, steps_x_ingredients,')})"
_T14 = _ols_oracle(_Z_SRC, T14_F, "bayes_mean")


@register("t14_ols", "target:s, term:s, coef:d, r2:d, adj_r2:d, n:i",
          "SELECT 'bayes_mean' AS target, CASE WHEN term = 'intercept' THEN 'const' ELSE term END AS term, coef, r2, "
          f"1.0 - (1.0 - r2) * (n - 1) / (n - {len(T14_F)} - 1) AS adj_r2, n FROM ({_T14[1]})",
          ("analysis", "__T14__"))
def q_ols(spark, sf):
    z = D.add_feature_columns(analysis(spark, sf))[0]
    return M.ols(z, T14_F, "bayes_mean")


def _ols_inference_sql() -> tuple[str, str]:
    """Standard errors of the slopes: each feature's variance that the other features leave (a regression each)."""
    from ratelens.plans.linsolve_sql import ols_sql
    whole = f"(SELECT * FROM {_Z_SRC} zz WHERE bayes_mean IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in T14_F) + ")"
    ctes, parts = [_T14[0]], []
    for j, f in enumerate(T14_F):
        c, sel = ols_sql(whole, [g for g in T14_F if g != f], f, f"v{j}")
        ctes.append(c)
        parts.append(f"SELECT '{f}' AS term, (SELECT max(r2) FROM ({sel})) AS r2x, "
                     f"(SELECT var_pop({f}) * count({f}) FROM {whole} w{j}) AS ssx")
    k = len(T14_F)
    return ",\n".join(ctes), (
        f"SELECT 'bayes_mean' AS target, c.term, coef, se AS std_err, coef / se AS t_value, f_stat FROM (SELECT b.term, b.coef, "
        f"sqrt((1 - b.r2) * syy / (b.n - {k} - 1) / (v.ssx * (1 - v.r2x))) AS se, (b.r2 / {k}) / ((1 - b.r2) / (b.n - {k} - 1)) AS f_stat "
        f"FROM ({_T14[1]}) b JOIN ({' UNION ALL '.join(parts)}) v ON v.term = b.term, "
        f"(SELECT var_pop(bayes_mean) * count(bayes_mean) AS syy FROM {whole} y)) c")


_T14SE = _ols_inference_sql()


@register("t14_ols_slopes", "target:s, term:s, coef:d, std_err:d, t_value:d, f_stat:d", _T14SE[1], ("analysis", _T14SE[0]))
def q_ols_slopes(spark, sf):
    return M.ols(D.add_feature_columns(analysis(spark, sf))[0], T14_F, "bayes_mean").where("term <> 'const'")


_INF_SPEC = "target:s, term:s, coef:d, std_err:d, t_value:d, p_value:d"
_ZT_SRC = f"({_z_sql().replace('SELECT id, steps_x_ingredients,', 'SELECT id, ' + ', '.join(M.DEFAULT_MODEL_TARGETS) + ', steps_x_ingredients,')})"
_INF = {t: inference_sql(_ZT_SRC, T14_F, t, f"i{i}") for i, t in enumerate(M.DEFAULT_MODEL_TARGETS)}


def _with_p(target: str) -> str:
    return (f"SELECT '{target}' AS target, *, {t_two_sided_sql('t_value', 'df')} AS p_value, "
            f"{f_sf_sql('f_stat', str(len(T14_F)), 'df')} AS f_p_value FROM ({_INF[target][1]})")


@register("t14_ols_inference", _INF_SPEC + ", f_stat:d, f_p_value:d", _with_p("bayes_mean"), ("analysis", _INF["bayes_mean"][0]))
def q_ols_inf(spark, sf):
    z = D.add_feature_columns(analysis(spark, sf))[0]
    return M.ols(z, T14_F, "bayes_mean")


@register("t14_ols_collinear", _INF_SPEC + ", r2:d, f_stat:d, rank:i",
          "SELECT target, unnest(CASE term WHEN 'n_steps_std' THEN ['n_steps_std', 'n_steps_twin'] ELSE [term] END) AS term, "
          "CASE term WHEN 'n_steps_std' THEN coef / 2 ELSE coef END AS coef, CASE term WHEN 'n_steps_std' THEN std_err / 2 ELSE std_err END AS std_err, "
          f"t_value, p_value, r2, f_stat, {len(T14_F) + 1} AS rank FROM ({_with_p('bayes_mean')}) UNION ALL "
          "SELECT 'bayes_mean', 'nought', 0.0, 0.0, NULL, NULL, max(r2), max(f_stat), " + f"{len(T14_F) + 1} FROM ({_with_p('bayes_mean')})",
          ("analysis", _INF["bayes_mean"][0]))
def q_ols_collinear(spark, sf):
    """T14 with a predictor twice and one that is always 0: two equal shares, and nothing."""
    z = D.add_feature_columns(analysis(spark, sf))[0].withColumn("n_steps_twin", F.col("n_steps_std")).withColumn("nought", F.lit(0.0))
    return M.ols(z, [*T14_F, "n_steps_twin", "nought"], "bayes_mean")


@register("u5_coefficient_table", _INF_SPEC,
          " UNION ALL ".join(f"SELECT * FROM ({_with_p(t)}) WHERE term <> 'const'" for t in M.DEFAULT_MODEL_TARGETS),
          ("analysis", *[c for c, _ in _INF.values()]))
def q_coefficient_table(spark, sf):
    return M.coefficient_table(D.add_feature_columns(analysis(spark, sf))[0], T14_F, list(M.DEFAULT_MODEL_TARGETS))


@register("t12_seeded_sample", "id:i, effort_score:d",
          "SELECT id, effort_score FROM analysis ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id LIMIT 200",
          ("analysis",))
def q_sample(spark, sf):
    return M.seeded_sample(analysis(spark, sf).select("id", "effort_score"), 200, "id", 42)


_TEST_SQL = "row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) <= ceil(0.2::DOUBLE * count(*) OVER ())"


@register("t13_split", "id:i, is_test:b",
          f"SELECT id, {_TEST_SQL} AS is_test FROM analysis", ("analysis",))
def q_split(spark, sf):
    a = analysis(spark, sf)
    return a.select("id", M.split_flag(a, "id", 42, 0.2).alias("is_test"))


@register("t13_split_sizes", "lang:s, n:i, n_test:i",
          "SELECT lang, count(*) AS n, CAST(ceil(0.2::DOUBLE * count(*)) AS BIGINT) AS n_test FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def q_split_sizes(spark, sf):
    """T13's size on tables of different sizes: one split for each language."""
    docs = FX.table(spark, sf, "documents").where("lang IS NOT NULL").select("doc_id", "lang")
    out = None
    for lang in [r[0] for r in docs.select("lang").distinct().orderBy("lang").collect()]:
        d = docs.where(F.col("lang") == lang)
        part = d.select("lang", M.split_flag(d, "doc_id", 7, 0.2).alias("t"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("t").alias("n_test"))


def _holdout_sql(src: str, feat: str, target: str) -> str:
    flag = _TEST_SQL
    d = (f"(SELECT id, CAST({feat} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y, {flag} AS t FROM {src} "
         f"WHERE {feat} IS NOT NULL AND {target} IS NOT NULL)")
    return (f"WITH d AS {d}, st AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM d WHERE NOT t), "
            f"z AS (SELECT y, t, CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (x - m) / s END AS z FROM d, st), "
            f"fit AS (SELECT regr_slope(y, z) AS a, regr_intercept(y, z) AS b, count(*) AS n_train FROM z WHERE NOT t), "
            f"te AS (SELECT y, b + a * z AS p FROM z, fit WHERE t) "
            f"SELECT '{target}' AS target, 'linear_regression' AS model, sqrt(avg((y - p) * (y - p))) AS rmse, "
            f"avg(abs(y - p)) AS mae, 1.0 - avg((y - p) * (y - p)) / var_pop(y) AS r2, count(*) AS n_test, "
            f"any_value(n_train) AS n_train, any_value(b) AS intercept FROM te, fit")


@register("t15_holdout_linear", "target:s, model:s, rmse:d, mae:d, r2:d, n_test:i, n_train:i, intercept:d",
          _holdout_sql("analysis", "effort_score", "bayes_mean"), ("analysis",))
def q_holdout(spark, sf):
    return M.holdout_linear(analysis(spark, sf), ["effort_score"], "bayes_mean", key="id")[0]


@register("t16_random_forest", "target:s, model:s, rmse:d, mae:d, r2:d, n_test:i")
def q_forest(spark, sf):
    z = D.add_feature_columns(analysis(spark, sf))[0]
    return M.holdout_forest(z, list(T14_F), "bayes_mean", key="id", rf_params={"numTrees": 100})[0]


@register("t16_importances", "target:s, feature:s, importance:d")
def q_importances(spark, sf):
    z = D.add_feature_columns(analysis(spark, sf))[0]
    return M.holdout_forest(z, list(T14_F), "bayes_mean", key="id", rf_params={"numTrees": 100})[1]


@register("t17_regression_metrics", "mse:d, rmse:d, mae:d, r2:d, n:i",
          "SELECT avg((bayes_mean - prediction) * (bayes_mean - prediction)) AS mse, "
          "sqrt(avg((bayes_mean - prediction) * (bayes_mean - prediction))) AS rmse, "
          "avg(abs(bayes_mean - prediction)) AS mae, 1.0 - avg((bayes_mean - prediction) * (bayes_mean - prediction)) "
          f"/ var_pop(bayes_mean) AS r2, count(*) AS n FROM ({RES_SQL}) WHERE bayes_mean IS NOT NULL AND "
          "prediction IS NOT NULL", ("analysis",))
def q_metrics(spark, sf):
    return M.regression_metrics(M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean"),
                                "bayes_mean", "prediction")


def _qq_sql(points: int) -> str:
    from statistics import NormalDist
    nd = NormalDist()
    probs = [(i - 0.5) / points for i in range(1, points + 1)]
    qs = ", ".join(f"quantile_cont(residual, {p!r}) AS s{i}" for i, p in enumerate(probs))
    rows = " UNION ALL ".join(f"SELECT {i} AS point, {p!r} AS prob, {nd.inv_cdf(p)!r} AS theoretical, s{i} AS sample, "
                              f"m + sd * {nd.inv_cdf(p)!r} AS line FROM q, st" for i, p in enumerate(probs))
    return (f"WITH r AS ({RES_SQL}), q AS (SELECT {qs} FROM r), st AS (SELECT avg(residual) AS m, "
            f"stddev_samp(residual) AS sd FROM r) {rows}")


@register("t18_qq", "point:i, prob:d, theoretical:d, sample:d, line:d", _qq_sql(20), ("analysis",))
def q_qq(spark, sf):
    return M.qq_points(M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean"), "residual", 20)


@register("t18_residual_hist", HIST_SPEC, _hist_sql(f"({RES_SQL})", "residual", 30), ("analysis",))
def q_res_hist(spark, sf):
    return P.histogram(M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean"), "residual", 30)


def _holdout_rows_sql(src: str, feat: str, target: str) -> str:
    """The test rows of :func:`_holdout_sql` with the linear model's prediction."""
    flag = _TEST_SQL
    d = (f"(SELECT id, {feat}, CAST({feat} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y, {flag} AS t FROM {src} "
         f"WHERE {feat} IS NOT NULL AND {target} IS NOT NULL)")
    return (f"SELECT id, y AS actual, b + a * x AS pred_linear, {feat} FROM {d} d, (SELECT regr_slope(y, x) AS a, "
            f"regr_intercept(y, x) AS b FROM {d} e WHERE NOT t) f WHERE t")


_HOLDOUT_ROWS = _holdout_rows_sql("analysis", "effort_score", "bayes_mean")


@register("t22_holdout_predictions", "id:i, actual:d, pred_linear:d, effort_score:d", _HOLDOUT_ROWS, ("analysis",))
def q_holdout_predictions(spark, sf):
    return M.holdout_predictions(analysis(spark, sf), ["effort_score"], "bayes_mean", "id", forest=False)


@register("t18_residual_vs_prediction", "id:i, model:s, x:d, actual:d, prediction:d, residual:d",
          "SELECT id, 'linear_regression' AS model, effort_score AS x, actual, pred_linear AS prediction, "
          f"actual - pred_linear AS residual FROM ({_HOLDOUT_ROWS})", ("analysis",))
def q_residual_vs_prediction(spark, sf):
    preds = M.holdout_predictions(analysis(spark, sf), ["effort_score"], "bayes_mean", "id", forest=False)
    return M.prediction_residuals(preds, "id", "effort_score")


@register("t18_residual_vs_x", "id:i, effort_score:d, prediction:d, residual:d",
          f"SELECT id, effort_score, prediction, residual FROM ({RES_SQL})", ("analysis",))
def q_residual_vs_x(spark, sf):
    return M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean")


def _study_predictions(spark, sf):
    """E6's table: both models on the study's four features."""
    return M.holdout_predictions(analysis(spark, sf), list(MODEL_STUDY_FEATURES), "bayes_mean", "id")


@register("e6_model_study_predictions", "id:i, actual:d, pred_linear:d, pred_forest:d")
def q_study_predictions(spark, sf):
    return _study_predictions(spark, sf)


@register("t19_compare_models", "target:s, best_model:s, best_r2:d, best_rmse:d, variance_pct:d")
def q_compare(spark, sf):
    return M.compare_models(M.prediction_metrics(_study_predictions(spark, sf), "bayes_mean"))


@register("t20_prediction_examples", "id:i, actual:d, pred_linear:d, effort_score:d",
          f"SELECT * FROM ({_HOLDOUT_ROWS}) ORDER BY md5(CAST(id AS VARCHAR) || ':7'), id LIMIT 5", ("analysis",))
def q_examples(spark, sf):
    preds = M.holdout_predictions(analysis(spark, sf), ["effort_score"], "bayes_mean", "id", forest=False)
    return M.prediction_examples(preds, "id", 5, 7)


@register("t20_study_examples", "id:i, actual:d, pred_linear:d, pred_forest:d, log_minutes:d, n_ingredients:d, avg_words_per_step:d, effort_score:d")
def q_study_examples(spark, sf):
    return M.prediction_examples(_study_predictions(spark, sf), "id", 5, 7)


@register("t21_run_models", "target:s, model:s, metric:s, term:s, value:d")
def q_run_models(spark, sf):
    z = D.add_feature_columns(analysis(spark, sf))[0]
    return M.run_models(z, "id")


@register("t22_actual_vs_predicted", "id:i, bayes_mean:d, prediction:d",
          f"SELECT id, bayes_mean, prediction FROM ({RES_SQL})", ("analysis",))
def q_actual_pred(spark, sf):
    return M.with_residuals(analysis(spark, sf), "effort_score", "bayes_mean").select("id", "bayes_mean", "prediction")


@register("w2_average_rank", "id:i, n_interactions_rank:d",
          "SELECT id, rank() OVER (ORDER BY n_interactions) + (count(*) OVER (PARTITION BY n_interactions) - 1) / 2.0 "
          "AS n_interactions_rank FROM analysis WHERE n_interactions IS NOT NULL", ("analysis",))
def q_rank(spark, sf):
    return average_rank(analysis(spark, sf), "n_interactions").where(F.col("n_interactions").isNotNull())


@register("w2_rank_lineitem", "l_orderkey:i, l_linenumber:i, l_quantity_rank:d",
          "SELECT l_orderkey, l_linenumber, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY "
          "l_quantity) - 1) / 2.0 AS l_quantity_rank FROM lineitem")
def q_rank_li(spark, sf):
    return average_rank(FX.table(spark, sf, "lineitem"), "l_quantity")



# --- composed studies ------------------------------------------------------------

E7_SPEC = ("id:i, category_minutes_balanced:s, steps_complexity:s, n_ingredients_category:s, avg_words_per_step:d, "
           "effort_score:d, effort_category:s")


def _e7_sql() -> str:
    # fixed values, not taken from the operators that they check
    minutes, words, ingredients = ("Rapide", "Moyenne", "Longue"), ("Simple", "Moyennement complexe", "Complexe"), ("Petit", "Moyen", "Grand")

    def terc(x, labels, src):
        return (f"CASE WHEN {x} < (SELECT quantile_cont({x}, 0.33) FROM {src}) THEN '{labels[0]}' "
                f"WHEN {x} < (SELECT quantile_cont({x}, 0.67) FROM {src}) THEN '{labels[1]}' ELSE '{labels[2]}' END")
    s1 = ("(SELECT * FROM raw_r WHERE minutes > 0 AND minutes <= 1440 AND minutes <= 360)")
    s2 = (f"(SELECT *, {terc('minutes', minutes, s1)} AS category_minutes_balanced FROM {s1} a "
          f"WHERE n_steps IS NULL OR n_steps <> 0)")
    s3 = (f"(SELECT *, {O.avg_words_sql(O.list_sql('steps'), False)} AS avg_words_per_step, "
          f"ln(CAST(minutes AS DOUBLE)) AS log_minutes, CASE WHEN n_ingredients IS NOT NULL THEN "
          f"ln(greatest(CAST(n_ingredients AS DOUBLE), 1.0)) END AS log_n_ingredients FROM {s2} b)")
    mm = ", ".join(f"min(CAST({c} AS DOUBLE)) AS mn_{c}, max(CAST({c} AS DOUBLE)) AS mx_{c}"
                   for c in ("log_minutes", "n_steps", "avg_words_per_step", "log_n_ingredients"))
    sc = {c: f"CASE WHEN mn_{c} IS NULL OR mx_{c} IS NULL OR mx_{c} = mn_{c} THEN 0.0 ELSE "
             f"(CAST({c} AS DOUBLE) - mn_{c}) / (mx_{c} - mn_{c}) END"
          for c in ("log_minutes", "n_steps", "avg_words_per_step", "log_n_ingredients")}
    score = (f"(0.3::DOUBLE * {sc['log_minutes']} + 0.25::DOUBLE * {sc['n_steps']} + 0.2::DOUBLE * "
             f"{sc['avg_words_per_step']} + 0.25::DOUBLE * {sc['log_n_ingredients']}) * 100.0::DOUBLE")
    s4 = (f"(SELECT *, {terc('avg_words_per_step', words, s3)} AS steps_complexity, "
          f"{terc('n_ingredients', ingredients, s3)} AS n_ingredients_category, {score} AS effort_score "
          f"FROM {s3} c, (SELECT {mm} FROM {s3} d) m)")
    return (f"SELECT {_cols(E7_SPEC).replace(chr(34) + 'effort_category' + chr(34), '')}"
            f"{O.bucket_sql_esc('effort_score', O.EFFORT_BOUNDS, O.EFFORT_LABELS)} AS effort_category FROM {s4} e")


@register("e7_effort_study", E7_SPEC, _e7_sql(), ("raw_r",))
def q_effort_study(spark, sf):
    from ratelens.plans.pipelines import effort_study
    return effort_study(raw_recipes(spark, sf))


@register("e7_effort_frequency", "effort_category:s, n:i, pct:d",
          f"SELECT effort_category, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM ({_e7_sql()}) z) AS pct "
          f"FROM ({_e7_sql()}) y GROUP BY 1", ("raw_r",))
def q_effort_freq(spark, sf):
    from ratelens.plans.pipelines import effort_study
    return G.frequency(effort_study(raw_recipes(spark, sf)), "effort_category")


@register("e4_group_study_summary", STRATA_SPEC, REGISTRY["g5_strata"][2], ("analysis",))
def q_group_study(spark, sf):
    from ratelens.plans.pipelines import group_study
    return group_study(analysis(spark, sf))["summary"]


NL_ALL = ("effort_score", "n_interactions", "log1p_n_interactions", "bayes_mean", "wilson_lb")
NL_ROWS = f"(SELECT * FROM analysis WHERE {' AND '.join(f'{c} IS NOT NULL' for c in NL_ALL)})"
_E5Q = _quad_sql(NL_ROWS, "effort_score", "log1p_n_interactions", "e5")


@register("e5_quadratic_curve", "point:i, x:d, y_fit:d",
          "SELECT i AS point, mn + i * (mx - mn) / 199.0 AS x, a2 * (mn + i * (mx - mn) / 199.0) * (mn + i * (mx - mn) / 199.0) "
          f"+ a1 * (mn + i * (mx - mn) / 199.0) + a0 AS y_fit FROM range(200) g(i), ({_E5Q[1]}) q, "
          f"(SELECT min(effort_score) AS mn, max(effort_score) AS mx FROM {NL_ROWS})", ("analysis", _E5Q[0]))
def q_e5_curve(spark, sf):
    return nonlinearity_study(analysis(spark, sf))["curve_log1p_n_interactions"]


@register("e5_bins", G7_SPEC,
          "SELECT bin, " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{c}" for c in G7_COLS)
          + f" FROM ({_cut_sql(NL_ROWS, 'effort_score', 10)}) b WHERE bin IS NOT NULL GROUP BY bin", ("analysis",))
def q_e5_bins(spark, sf):
    return nonlinearity_study(analysis(spark, sf))["bins"]


@register("e5_nonlinearity", "x:s, y:s, pearson:d, spearman:d, nonlinear:b", REGISTRY["t6_nonlinearity"][2], ("analysis", "__NL__"))
def q_e5_nonlinear(spark, sf):
    return nonlinearity_study(analysis(spark, sf))["tests"]


@register("e5_residuals", "id:i, effort_score:d, residual:d",
          f"SELECT id, effort_score, n_interactions - (b + a * effort_score) AS residual FROM {NL_ROWS} s, (SELECT "
          f"regr_slope(n_interactions, effort_score) AS a, regr_intercept(n_interactions, effort_score) AS b FROM {NL_ROWS} r)",
          ("analysis",))
def q_e5_residuals(spark, sf):
    return nonlinearity_study(analysis(spark, sf))["residuals_n_interactions"]


def _study(spark, sf):
    return popularity_study(raw_recipes(spark, sf), raw_interactions(spark, sf))


@register("e8_rating_frequency", "rating:i, n:i, pct:d",
          "SELECT rating, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM ic0) AS pct FROM ic0 "
          "WHERE rating IS NOT NULL GROUP BY 1", ("ic0",))
def q_e8_frequency(spark, sf):
    return _study(spark, sf)["rating_frequency"]


_E8_MIN = ("(SELECT CASE WHEN minutes <> 0 THEN minutes END AS minutes FROM (SELECT * FROM raw_r WHERE minutes IS NULL OR minutes <> "
           "(SELECT max(minutes) FROM raw_r)) a WHERE minutes IS NULL OR minutes <> (SELECT max(minutes) FROM "
           "raw_r WHERE minutes <> (SELECT max(minutes) FROM raw_r)))")


@register("e8_minutes_describe", P5_SPEC, _describe_sql(_E8_MIN, ("minutes",), True), ("raw_r",))
def q_e8_describe(spark, sf):
    return _study(spark, sf)["describe"]


@register("e8_gaps", "recipe_id:i, rating_gap:d, bayes_gap:d, wilson_gap:d",
          "SELECT recipe_id, 5 - avg_rating AS rating_gap, 5 - bayes_mean AS bayes_gap, 1 - wilson_lb AS wilson_gap "
          "FROM rmet WHERE recipe_id IN (SELECT id FROM raw_r)", ("raw_r", "rmet"))
def q_e8_gaps(spark, sf):
    return _study(spark, sf)["gaps"]


@register("e8_rating_histogram", HIST_SPEC,
          _hist_sql("(SELECT avg_rating FROM rmet WHERE recipe_id IN (SELECT id FROM raw_r))", "avg_rating", 50), ("raw_r", "rmet"))
def q_e8_histogram(spark, sf):
    return _study(spark, sf)["rating_histogram"]


E9_CORR = ("n_ingredients", "n_steps", "log_minutes", "avg_rating", "n_interactions", "interactions_per_month")


@register("e9_kpi", "n_rows:i, mean_avg_rating:d, mean_minutes:d, mean_n_ingredients:d",
          "SELECT count(*) AS n_rows, avg(avg_rating) AS mean_avg_rating, avg(minutes) AS mean_minutes, "
          "avg(n_ingredients) AS mean_n_ingredients FROM analysis", ("analysis",))
def q_e9_kpi(spark, sf):
    return dashboard(analysis(spark, sf))["kpi"]


@register("e9_scatter", "id:i, x:d, y:d, size:i, color:d, minutes:i, n_ingredients:i, n_steps:i",
          "SELECT id, effort_score AS x, avg_rating AS y, n_interactions AS size, avg_rating AS color, minutes, n_ingredients, n_steps "
          "FROM analysis", ("analysis",))
def q_e9_scatter(spark, sf):
    return dashboard(analysis(spark, sf))["scatter"]


@register("e9_histogram", HIST_SPEC, _hist_sql("analysis", "effort_score", 30), ("analysis",))
def q_e9_histogram(spark, sf):
    return dashboard(analysis(spark, sf))["histogram"]


@register("e9_box", "effort_quartile:i, q1:d, median:d, q3:d, whisker_low:d, whisker_high:d, n_outliers:i, n:i",
          _box_sql(f"({_qcut_sql('analysis', 'effort_score', 4, 'effort_quartile')})", "avg_rating", "effort_quartile"), ("analysis",))
def q_e9_box(spark, sf):
    return dashboard(analysis(spark, sf))["box"]


@register("e9_correlation", "x:s, y:s, coef:d, n:i", _corr_sql("analysis", E9_CORR), ("analysis",))
def q_e9_corr(spark, sf):
    return dashboard(analysis(spark, sf))["correlation"]


@register("e9_preview", "id:i, minutes:i, effort_score:d, avg_rating:d",
          "SELECT id, minutes, effort_score, avg_rating FROM analysis ORDER BY id LIMIT 100", ("analysis",))
def q_e9_preview(spark, sf):
    return dashboard(analysis(spark, sf))["preview"]


@register("s2_load_raw", "table:s, n_rows:i, n_null:i",
          "SELECT 'recipes' AS \"table\", count(*) AS n_rows, count(*) FILTER (WHERE description IS NULL) AS n_null FROM raw_r UNION ALL "
          "SELECT 'interactions', count(*), count(*) FILTER (WHERE review IS NULL) FROM raw_i", ("raw_r", "raw_i"))
def q_load_raw(spark, sf):
    """S5 + S2: both raw tables written to the shared folder and loaded back."""
    from ratelens.session import checkpoint_dir
    from ratelens.sources.sinks import write_table
    paths = [checkpoint_dir(spark, n) for n in ("raw-recipes", "raw-interactions")]
    for path, df in zip(paths, (raw_recipes(spark, sf), raw_interactions(spark, sf))):
        write_table(df, path)
    r, i = R.load_raw(spark, *paths, fmt="parquet")
    return (r.agg(F.count("*").alias("n_rows"), F.count_if(F.col("description").isNull()).alias("n_null")).withColumn("table", F.lit("recipes"))
            .unionByName(i.agg(F.count("*").alias("n_rows"), F.count_if(F.col("review").isNull()).alias("n_null")).withColumn("table", F.lit("interactions"))))


def _register_profiles():
    """Each of the seven tables of the profile, against the SQL of its operator's query."""
    for section, like in (("basic_info", "p1_profile"), ("minutes", "p3_minutes"), ("contributors", "g12_contributors"),
                          ("ingredients", "g13_ingredients"), ("tags", "g13_tags"), ("counts", "p7_count_summary"),
                          ("nutrition", "p8_nutrition_stats")):
        _, spec, sql, ctes = REGISTRY[like]
        register(f"e2_complete_profile_{section}", spec, sql, ctes)(
            lambda spark, sf, section=section: complete_profile(raw_recipes(spark, sf))[section])


_register_profiles()


# --- registry access -------------------------------------------------------------

from ratelens.plans import catalog_lists  # noqa: E402, F401  further queries register themselves

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, (fn, spec, _, _) in REGISTRY.items():
        out[name] = (lambda f, s: (lambda spark, sf: O.normalize_df(f(spark, sf), s)))(fn, spec)
    return out


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (_, spec, sql, ctes) in REGISTRY.items():
        if sql is None:
            continue
        extra = [c for c in ctes if c.startswith("__")]
        base = [c for c in ctes if not c.startswith("__")]
        text = O.ctes(*[c for c in base if " AS (" not in c]) if base else ""
        for c in base:
            if " AS (" in c:
                text += ",\n" + c
        if "__T11__" in extra:
            text += ",\n" + _T11[0]
        if "__NL__" in extra:
            text += ",\n" + NL_SRC
        if "__T14__" in extra:
            text += ",\n" + _T14[0]
        out[name] = O.normalize_sql(sql, spec, text)
    return out
