"""Projection, filters and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.expr import bucketize, col, log_floor
from ratelens.functions.lists import avg_words_per_step, list_or_empty, text_length


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep listed columns (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def _with_max(df: DataFrame, c: str) -> DataFrame:
    """Attach the column maximum to every row (one-row broadcast, no driver trip)."""
    mx = df.agg(F.max(c).alias("_max"))
    return df.crossJoin(F.broadcast(mx))


def remove_outliers(df: DataFrame, c: str = "minutes", max_value: float | None = None) -> DataFrame:
    """Drop every row equal to the column maximum, then rows above ``max_value``.

    The maximum is taken before the limit; NULL rows go (they fail ``<=``).
    Default limit: 30 days in minutes.
    """
    lim = 30 * 24 * 60 if max_value is None else max_value
    j = _with_max(df, c)
    keep = (F.col(c) != F.col("_max")) & (F.col(c) <= F.lit(lim))
    return j.where(keep).drop("_max")


def removed_count(df: DataFrame, c: str = "minutes", max_value: float | None = None) -> DataFrame:
    """C2's report: rows before, after and removed, as one row."""
    lim = 30 * 24 * 60 if max_value is None else max_value
    j = _with_max(df, c)
    keep = (F.col(c) != F.col("_max")) & (F.col(c) <= F.lit(lim))
    return j.agg(F.count(F.lit(1)).alias("n_before"),
                 F.count_if(F.coalesce(keep, F.lit(False))).alias("n_after")) \
            .withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def drop_max(df: DataFrame, c: str) -> DataFrame:
    """Drop rows equal to the current maximum; NULL rows stay (NaN != max)."""
    j = _with_max(df, c)
    return j.where(F.col(c).isNull() | (F.col(c) != F.col("_max"))).drop("_max")


def sentinel_to_null(df: DataFrame, c: str, sentinel=0) -> DataFrame:
    """C4: a sentinel value (0 minutes, 0 rating) becomes NULL."""
    return df.withColumn(c, F.when(F.col(c) != F.lit(sentinel), F.col(c)))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``subset`` (all columns if None)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def null_drop_report(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """C5's report: rows before and after, in one pass."""
    ok = F.lit(True)
    for c in subset:
        ok = ok & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(ok).alias("n_after"))


def range_filter(df: DataFrame, c: str, lo: float | None = 0, hi: float | None = 360) -> DataFrame:
    """Half-open ``lo < c <= hi``."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(c) > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(c) <= F.lit(hi))
    return df.where(cond)


def positive_filter(df: DataFrame, c: str, null_as_zero: bool = True) -> DataFrame:
    """``coalesce(c, 0) > 0`` (NULL counts as 0, so it is dropped)."""
    x = F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c)
    return df.where(x > 0)


def nonempty_list_filter(df: DataFrame, c: str = "steps") -> DataFrame:
    """Text present and its parsed list non-empty."""
    return df.where(F.col(c).isNotNull() & (F.size(list_or_empty(df, c)) > 0))


def predicate(df: DataFrame, condition: str | Column) -> DataFrame:
    """Ad-hoc predicate."""
    return df.where(condition)


def coerce_timestamp(c: str | Column, fmt: str | None = None, strict: bool = False) -> Column:
    """C11: unparseable text -> NULL (``to_datetime(errors='coerce')``); with
    ``strict`` it fails the job (``errors='raise'``)."""
    x = col(c)
    if strict:
        return F.to_timestamp(x, fmt) if fmt else F.to_timestamp(x)
    return F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)


def coerce_date(c: str | Column, fmt: str | None = None, strict: bool = False) -> Column:
    return coerce_timestamp(c, fmt, strict).cast("date")


# fixed values: category labels and bounds of the pipeline's rule-based categorisers
MINUTES_LABELS = ("Rapide", "Moyenne", "Longue")
STEPS_BOUNDS, STEPS_LABELS = (5, 10, 20), ("Simple", "Modéré", "Complexe", "Très complexe")
WORDS_BOUNDS, WORDS_LABELS = (10, 20), ("Étapes courtes", "Étapes moyennes", "Étapes longues")
INGR_BOUNDS, INGR_LABELS = (5, 10), ("Peu d'ingrédients", "Ingrédients modérés", "Beaucoup d'ingrédients")
EFFORT_BOUNDS, EFFORT_LABELS = (15, 20, 25, 30), ("Très Facile", "Facile", "Modéré", "Difficile", "Très Difficile")
EFFORT_WEIGHTS = {"log_minutes": 0.30, "n_steps": 0.25, "avg_words_per_step": 0.20,
                  "log_n_ingredients": 0.25}


def category_minutes(c: str | Column = "minutes") -> Column:
    """``< 30`` Rapide, ``<= 90`` Moyenne, else Longue."""
    x = col(c)
    return (F.when(x < 30, MINUTES_LABELS[0]).when(x <= 90, MINUTES_LABELS[1])
            .otherwise(MINUTES_LABELS[2]))


def filter_recipes(recipes: DataFrame, *, max_minutes: float = 360) -> DataFrame:
    """The row filters of C13; cheap range filters run before the list parse.

    Adds ``_steps_arr``, the parsed step list.  Who needs the kept ids alone
    stops here: no statistics, no further parsing.
    """
    df = sentinel_to_null(recipes, "minutes")
    df = df.where(F.col("minutes").isNotNull())
    df = range_filter(df, "minutes", 0, max_minutes)
    df = positive_filter(df, "n_steps")
    df = df.where(F.col("steps").isNotNull())
    # one item to explode, so that the filter is not moved below it, where the text would be parsed once more
    df = df.select("*", F.explode(F.array(list_or_empty(df, "steps"))).alias("_steps_arr"))
    return df.where(F.size("_steps_arr") > 0)


def derive_recipes(recipes: DataFrame, *, max_minutes: float = 360) -> DataFrame:
    """C13 up to the columns that need no statistics of the table: filters, dates, logs, word counts, categories."""
    df = filter_recipes(recipes, max_minutes=max_minutes)
    df = df.withColumn("submitted", coerce_date("submitted"))
    return (df.withColumn("log_minutes", F.ln(F.col("minutes").cast("double")))
            .withColumn("category_minutes", category_minutes("minutes"))
            .withColumn("avg_words_per_step", avg_words_per_step(F.col("_steps_arr"), skip_empty=True))
            .withColumn("step_length_category",
                        bucketize("avg_words_per_step", WORDS_BOUNDS, WORDS_LABELS, closed="left"))
            .withColumn("complexity", bucketize("n_steps", STEPS_BOUNDS, STEPS_LABELS, closed="right"))
            .withColumn("category_n_ingredients",
                        bucketize("n_ingredients", INGR_BOUNDS, INGR_LABELS, closed="right"))
            .withColumn("log_n_ingredients", log_floor("n_ingredients", 1.0))
            .drop("_steps_arr"))


def score_recipes(derived: DataFrame) -> DataFrame:
    """C13's last part: min-max scaling over all rows, effort score and its category."""
    from ratelens.operators.derive import minmax_scale, weighted_score
    df = minmax_scale(derived, list(EFFORT_WEIGHTS))
    df = weighted_score(df, EFFORT_WEIGHTS, scale=100.0, out="effort_score", suffix="_scaled")
    return df.withColumn("effort_category",
                         bucketize("effort_score", EFFORT_BOUNDS, EFFORT_LABELS, closed="right"))


def prepare_recipes(recipes: DataFrame, *, max_minutes: float = 360) -> DataFrame:
    """The pipeline's recipe cleaning and derived columns, in its order.

    One lazy plan.  The min-max statistics of D5 are one aggregate over the
    filtered rows (its scan reads the scaled columns and the step text only),
    joined back as a one-row broadcast; no text is written anywhere.
    """
    return score_recipes(derive_recipes(recipes, max_minutes=max_minutes))


def prepare_interactions(interactions: DataFrame) -> DataFrame:
    """C14: date coercion, rating 0 -> NULL, review length (NULL -> 0)."""
    df = interactions.withColumn("date", coerce_date(F.col("date").cast("string")))
    df = sentinel_to_null(df, "rating")
    return df.withColumn("review_length", text_length("review", null_as_zero=True))
