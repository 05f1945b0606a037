"""Composed entry points (E1–E9) as functions of DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators import aggregate as G
from ratelens.operators import clean as C
from ratelens.operators import derive as D
from ratelens.operators import profile as P
from ratelens.operators import stattests as T

DEFAULT_AS_OF = "2000-01-01"


def _interactions_of(interactions: DataFrame | Callable[[DataFrame], DataFrame], ids: DataFrame) -> DataFrame:
    """The cleaned interactions of the recipes in ``ids`` (recipe_id)."""
    if callable(interactions):
        rows = interactions(ids)
        rows = rows.select("recipe_id", *[c for c in rows.columns if c != "recipe_id"])
    else:
        rows = interactions.join(ids, "recipe_id", "left_semi")
    return C.prepare_interactions(rows)


def build_analysis(recipes: DataFrame, interactions: DataFrame | Callable[[DataFrame], DataFrame], *, as_of: str = DEFAULT_AS_OF,
                   max_minutes: float = 360, leave_out: Sequence[str] = (), parts: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw recipes + interactions -> (clean recipes, kept interactions, analysis).

    The filtered recipes are written once, with the columns that need no
    statistics of the table, so each step text is parsed once; min and max,
    the kept ids and the join with the metrics read narrow columns from there.
    Columns in ``leave_out`` (texts that nobody reads) are not written.

    ``interactions`` is a table, or a function that is given the kept ids
    (recipe_id) and returns the rows of those recipes, so that it can drop the
    others before joins of its own.

    ``parts`` are the partitions of large recipes that come dealt by ``id``:
    the written recipes stay so, and only the metrics move to join them.

    Shuffles: one for the semi-join (or a broadcast of the recipe keys when
    AQE sees them small), those of the per-recipe grouping, one for the join
    of recipes with their metrics; the rest are one-row aggregates.
    """
    from ratelens.sources.sinks import stage_by_key
    derived = stage_by_key(C.derive_recipes(recipes, max_minutes=max_minutes).drop(*leave_out), "recipes-derived", "id", parts)
    rc = C.score_recipes(derived)
    ic = _interactions_of(interactions, derived.select(F.col("id").alias("recipe_id")))
    analysis = D.enrich_analysis(rc, G.recipe_metrics(ic), as_of=as_of, parts=parts)
    return rc, ic, analysis


def kept_interactions(recipes: DataFrame, interactions: DataFrame | Callable[[DataFrame], DataFrame], *,
                      max_minutes: float = 360) -> DataFrame:
    """The cleaned interactions of the recipes that C13 keeps; reads the recipes' filter columns only.

    ``interactions`` as in :func:`build_analysis`.
    """
    ids = C.filter_recipes(recipes, max_minutes=max_minutes).select(F.col("id").alias("recipe_id"))
    return _interactions_of(interactions, ids)


def save_tables(recipes: DataFrame, interactions: DataFrame, path: str, *, as_of: str = DEFAULT_AS_OF) -> None:
    """E1's save: the three tables under ``path``."""
    from ratelens.sources.sinks import write_table
    for name, df in zip(("recipes_clean", "interactions_clean", "analysis"),
                        build_analysis(recipes, interactions, as_of=as_of)):
        write_table(df, f"{path.rstrip('/')}/{name}")


def complete_profile(recipes: DataFrame) -> dict[str, DataFrame]:
    """The seven profile tables of the raw recipe table."""
    from ratelens.functions.lists import split_fixed_list, NUTRITION_COLUMNS
    return {
        "basic_info": P.profile(recipes),
        "minutes": P.seven_number(recipes, "minutes"),
        "contributors": G.contributor_concentration(recipes),
        "ingredients": G.item_summary(recipes, "ingredients", 10),
        "tags": G.item_summary(recipes, "tags", 20),
        "counts": P.count_summary(recipes),
        "nutrition": P.multi_stats(split_fixed_list(recipes, "nutrition"), NUTRITION_COLUMNS),
    }


def correlation_study(analysis: DataFrame) -> dict[str, DataFrame]:
    """S3 -> Spearman and Pearson grids -> matrices."""
    from ratelens.sources.readers import load_analysis
    df = load_analysis(analysis)
    sp = T.spearman_grid(df)
    pe = T.pearson_grid(df)
    return {"spearman": sp, "pearson": pe,
            "spearman_matrix": T.pivot_matrix(sp, order=list(T.DEFAULT_POPULARITY_VARS)),
            "pearson_matrix": T.pivot_matrix(pe, order=list(T.DEFAULT_POPULARITY_VARS))}


def group_study(analysis: DataFrame, score: str = "effort_score",
                metrics: Sequence[str] = ("bayes_mean", "wilson_lb", "log1p_interactions_per_month_w")
                ) -> dict[str, DataFrame]:
    """Quartiles of the score -> per-quartile summary -> ANOVA and Kruskal–Wallis."""
    assigned, summary, edges = G.strata_summary(analysis, score, metrics)
    tests = T.group_tests(assigned, "stratum", list(metrics), na="per_metric")
    return {"summary": summary, "edges": edges, "tests": tests}


# fixed values: tercile labels of the effort study
MINUTES_TERCILES = ("Rapide", "Moyenne", "Longue")
WORDS_TERCILES = ("Simple", "Moyennement complexe", "Complexe")
INGR_TERCILES = ("Petit", "Moyen", "Grand")


def effort_study(recipes: DataFrame) -> DataFrame:
    """The staged effort study as one plan.

    C6 (0, 1440] then <= 360 -> minutes terciles -> C7 (``n_steps != 0``, NULL
    kept) -> A3b words per step -> words and ingredient terciles -> D1/D3 logs
    -> D5 min-max -> D6 score -> D4 effort category.  The parsed rows are
    staged once (S6) before the passes that need global statistics.
    """
    from ratelens.functions.expr import bucketize, log_floor
    from ratelens.functions.lists import avg_words_per_step, list_or_empty
    from ratelens.sources.sinks import stage
    df = C.range_filter(recipes, "minutes", 0, 1440)
    df = C.range_filter(df, "minutes", None, 360)
    df = D.tercile_category(df, "minutes", MINUTES_TERCILES, "category_minutes_balanced")
    df = df.where(F.col("n_steps").isNull() | (F.col("n_steps") != 0))
    df = df.withColumn("avg_words_per_step", avg_words_per_step(list_or_empty(df, "steps"), skip_empty=False))
    df = (df.withColumn("log_minutes", F.ln(F.col("minutes").cast("double")))
            .withColumn("log_n_ingredients", log_floor("n_ingredients", 1.0)))
    df = stage(df.drop("steps", "tags", "ingredients", "nutrition", "description"), "effort-study")
    df = D.tercile_category(df, "avg_words_per_step", WORDS_TERCILES, "steps_complexity")
    df = D.tercile_category(df, "n_ingredients", INGR_TERCILES, "n_ingredients_category")
    df = D.minmax_scale(df, list(C.EFFORT_WEIGHTS))
    df = D.weighted_score(df, C.EFFORT_WEIGHTS, 100.0, "effort_score")
    return df.withColumn("effort_category", bucketize("effort_score", C.EFFORT_BOUNDS, C.EFFORT_LABELS))


#: fixed values: features of the model study, columns of the dashboard's correlation matrix
MODEL_STUDY_FEATURES = ("log_minutes", "n_ingredients", "avg_words_per_step", "effort_score")
DASHBOARD_CORRELATION = ("n_ingredients", "n_steps", "log_minutes", "avg_rating", "n_interactions", "interactions_per_month")


def nonlinearity_study(analysis: DataFrame, x: str = "effort_score", key: str = "id") -> dict[str, DataFrame]:
    """E5 on the rows that are complete in all its columns: T9 curves (200
    points) and T10 residuals per outcome, G7 bins, T6 rank test."""
    from ratelens.operators import models as M
    outcomes = ("n_interactions", "log1p_n_interactions", "bayes_mean", "wilson_lb")
    rows = analysis.select(key, x, *outcomes).na.drop(subset=[x, *outcomes])
    out = {"bins": G.bin_profile(rows, x, (x, "n_interactions", "bayes_mean", "wilson_lb"), 10),
           "tests": T.nonlinearity(rows, x, ("n_interactions", "bayes_mean", "wilson_lb"))}
    for y in ("log1p_n_interactions", "bayes_mean", "wilson_lb"):
        out[f"curve_{y}"] = M.quadratic_curve(rows, x, y, 200)
    for y in ("n_interactions", "bayes_mean", "wilson_lb"):
        out[f"residuals_{y}"] = M.with_residuals(rows, x, y).select(key, x, "residual")
    return out


def model_study(analysis: DataFrame, target: str = "bayes_mean", key: str = "id", *,
                rf_params: dict | None = None) -> dict[str, DataFrame]:
    """Hold-out predictions of both models, their metrics, residuals, examples and the better one."""
    from ratelens.operators import models as M
    preds = M.holdout_predictions(analysis, list(MODEL_STUDY_FEATURES), target, key, rf_params=rf_params)
    metrics = M.prediction_metrics(preds, target)
    return {"predictions": preds, "metrics": metrics, "best": M.compare_models(metrics),
            "residuals": M.prediction_residuals(preds, key, "effort_score"), "examples": M.prediction_examples(preds, key)}


def popularity_study(recipes: DataFrame, interactions: DataFrame) -> dict[str, DataFrame]:
    """C3 and C4 on minutes -> P4-P6; C14 -> G8-G10; G1-G3 -> J1 -> P12, P13, D2, D7, D11."""
    minutes = C.sentinel_to_null(C.drop_max(C.drop_max(recipes, "minutes"), "minutes"), "minutes")
    ic = C.prepare_interactions(interactions)
    metrics = G.recipe_metrics(ic)
    joined = metrics.join(recipes.select(F.col("id").alias("recipe_id")), "recipe_id")
    logged = joined.withColumn("log1p_n_interactions", F.ln(F.lit(1.0) + F.col("n_interactions")))
    return {"describe": P.describe(minutes, ["minutes"], extended=True),
            "shape": P.shape_moments(minutes, ["minutes"]),
            "rating_frequency": G.frequency(ic, "rating"),
            "missing_rating_share": G.conditional_share(ic, "rating IS NULL"),
            "mean_rating_without_review": G.conditional_mean(ic, "rating", "review IS NULL"),
            "metrics": metrics, "joined": joined,
            "rating_histogram": P.histogram(joined, "avg_rating", 50),
            "winsorized": D.winsorize(logged, ["log1p_n_interactions"], 0.05, 0.99),
            "gaps": D.gap_columns(joined).select("recipe_id", "rating_gap", "bayes_gap", "wilson_gap")}


def dashboard(analysis: DataFrame, effort: str = "effort_score", popularity: str = "avg_rating") -> dict[str, DataFrame]:
    """The extracts behind the dashboard's figures, for one chosen pair of columns."""
    quartiles = D.qcut(analysis, effort, 4, out="effort_quartile")
    return {"kpi": analysis.agg(F.count(F.lit(1)).alias("n_rows"),
                                *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in ("avg_rating", "minutes", "n_ingredients")]),
            "scatter": analysis.select("id", F.col(effort).alias("x"), F.col(popularity).alias("y"), F.col("n_interactions").alias("size"),
                                       F.col("avg_rating").alias("color"), "minutes", "n_ingredients", "n_steps"),
            "histogram": P.histogram(analysis, effort, 30),
            "box": P.box_stats(quartiles, popularity, by=["effort_quartile"]),
            "correlation": T.corr_matrix(analysis, list(DASHBOARD_CORRELATION)),
            "preview": analysis.orderBy("id").limit(100)}
