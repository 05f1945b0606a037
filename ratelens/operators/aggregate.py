"""Aggregations.

All are ``groupBy``/``agg`` plans: partial aggregation runs map-side, so a
key holding a third of the rows reaches the final stage as one partial row
per map task.  Global constants (the prior mean of G2, totals for shares)
are one-row aggregates joined by broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.expr import py_round, round_half_even
from ratelens.functions.lists import parse_list
from ratelens.operators.derive import qcut
from ratelens.operators.derive import cut as cut_bins
from ratelens.session import partitions_for


def rating_metrics(interactions: DataFrame, *, key: str = "recipe_id", rating: str = "rating",
                   user: str = "user_id", review: str = "review", digits: int | None = 3,
                   positive_threshold: float = 4) -> DataFrame:
    """G1: per-key engagement and rating metrics, and ``_pos`` (ratings from the threshold on).

    ``n_interactions`` counts non-NULL ratings (not rows); ``n_unique_users``
    counts distinct users over all rows.  Keys whose ratings are all NULL
    stay, with count 0 and NULL averages.  Values are rounded half-even.

    The rows are read once: dealt by (key, user), which no hot key makes
    uneven, they collapse to (key, user, rating) counts, of which the first of
    each (key, user) counts as one user; those collapse to (key, rating) counts, of which a key has as many as
    ratings have values, and mean, deviation and median come from them.
    """
    return _metrics_of(_rating_counts(interactions, key, rating, user, review).where(F.col(key).isNotNull()), key, digits, positive_threshold)


def _rating_counts(interactions: DataFrame, key: str, rating: str, user: str, review: str) -> DataFrame:
    """``key, _r`` (rating) with ``_w`` rows, ``_reviews`` and ``_users`` (each user of a key counted at one rating)."""
    rows = interactions.select(F.col(key), F.col(user).alias("_u"), F.col(rating).cast("double").alias("_r"), F.col(review).isNotNull().cast("int").alias("_t"))
    n = partitions_for(interactions)
    rows = rows.repartition(n, key, "_u") if n else rows.repartition(key, "_u")
    each = rows.groupBy(key, "_u", "_r").agg(F.count(F.lit(1)).alias("_w"), F.sum("_t").alias("_reviews"))
    first = F.row_number().over(Window.partitionBy(key, "_u").orderBy("_r")) == 1
    return (each.withColumn("_users", (first & F.col("_u").isNotNull()).cast("int"))
            .groupBy(key, "_r").agg(F.sum("_w").alias("_w"), F.sum("_reviews").alias("_reviews"), F.sum("_users").alias("_users")))


def _metrics_of(per: DataFrame, key: str, digits: int | None, positive_threshold: float) -> DataFrame:
    rnd = (lambda c: round_half_even(c, digits)) if digits is not None else (lambda c: c)
    w = F.when(F.col("_r").isNotNull(), F.col("_w"))
    n, mean = F.sum(w), F.try_divide(F.sum(w * F.col("_r")), F.sum(w))
    stats = per.groupBy(key).agg(
        F.coalesce(n, F.lit(0)).alias("n_interactions"), mean.alias("_mean"), F.sum(w * F.col("_r") * F.col("_r")).alias("_ss"),
        F.percentile("_r", 0.5, F.coalesce(w, F.lit(0))).alias("_median"), F.sum("_reviews").alias("n_reviews_text"), F.sum("_users").alias("n_unique_users"),
        F.coalesce(F.sum(F.when(F.col("_r") >= F.lit(float(positive_threshold)), F.col("_w"))), F.lit(0)).alias("_pos"))
    m = F.col("n_interactions")
    var = F.try_divide(F.greatest(F.col("_ss") - m * F.col("_mean") * F.col("_mean"), F.lit(0.0)), m - 1)
    return stats.select(
        key, "n_interactions", rnd(F.col("_mean")).alias("avg_rating"), rnd(F.col("_median")).alias("median_rating"),
        rnd(F.sqrt(F.when(m > 1, var))).alias("std_rating"), "n_unique_users", "n_reviews_text", "_pos")


def wilson_lower_bound(positives: Column, total: Column, confidence: float = 0.95) -> Column:
    """G3 closed form: ``max(0, centre - margin)``; ``total == 0`` gives 0.0."""
    z = 1.96 if confidence == 0.95 else 1.64  # fixed values: the study's two-decimal normal quantiles
    z2 = z * z
    n = total.cast("double")
    p = positives.cast("double") / n
    denom = F.lit(1.0) + F.lit(z2) / n
    centre = (p + F.lit(z2) / (F.lit(2.0) * n)) / denom
    margin = F.lit(z) * F.sqrt((p * (F.lit(1.0) - p) + F.lit(z2) / (F.lit(4.0) * n)) / n) / denom
    return F.when(total == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - margin))


def bayes_mean(avg: Column, n: Column, prior_mean: Column, prior_count: float = 10) -> Column:
    """``(avg*n + m*k) / (n + k)`` (NULL when the key has no rating)."""
    k = F.lit(float(prior_count))
    return (avg * n + prior_mean * k) / (n + k)


def recipe_metrics(interactions: DataFrame, *, key: str = "recipe_id", rating: str = "rating",
                   user: str = "user_id", review: str = "review", prior_count: float = 10,
                   confidence: float = 0.95, positive_threshold: float = 4,
                   bayes_digits: int | None = None) -> DataFrame:
    """G1 + G2 + G3: per-key metrics and one global mean, as one lazy plan.

    G2 uses the already rounded ``avg_rating`` and the mean of all non-NULL
    ratings of ``interactions`` (rows without a key included, as in the
    reference); G3 counts ``rating >= 4`` as positive.  All comes from the
    (key, rating) counts, whose exchange both branches share.
    """
    per = _rating_counts(interactions, key, rating, user, review)
    # both branches name the same columns and neither condition moves below the grouping (no count is negative), so they share the exchanges
    g = _metrics_of(per, key, 3, positive_threshold).where(F.col(key).isNotNull() | (F.col("n_unique_users") < 0))
    w = F.when(F.col("_r").isNotNull(), F.col("_w"))
    gm = per.agg(F.try_divide(F.sum(w * F.col("_r")), F.sum(w)).alias("_gm"), F.sum("_reviews").alias("_gt"), F.sum("_users").alias("_gu")) \
        .where("coalesce(_gt, 0) >= 0 AND coalesce(_gu, 0) >= 0").select("_gm")
    bm = bayes_mean(F.col("avg_rating"), F.col("n_interactions"), F.col("_gm"), prior_count)
    if bayes_digits is not None:
        bm = round_half_even(bm, bayes_digits)
    return (g.crossJoin(F.broadcast(gm)).withColumn("bayes_mean", bm)
             .withColumn("wilson_lb", wilson_lower_bound(F.col("_pos"), F.col("n_interactions"), confidence))
             .drop("_pos", "_gm"))


def mean_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Mean of one column per key (NULL keys dropped, like pandas)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(F.col(value).cast("double")).alias(out or f"mean_{value}"))


def group_agg(df: DataFrame, key: str | Sequence[str], spec: Mapping[str, Sequence[str]],
              digits: int | None = None) -> DataFrame:
    """Several statistics per column and key, flat names ``<col>_<stat>``.

    Stats: count, size, mean, std, var, min, max, median, sum.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fns = {"count": lambda c: F.count(c), "mean": lambda c: F.avg(c.cast("double")),
           "std": lambda c: F.stddev_samp(c.cast("double")), "var": lambda c: F.var_samp(c.cast("double")),
           "min": F.min, "max": F.max, "median": lambda c: F.median(c.cast("double")),
           "sum": F.sum}
    aggs = []
    for c, stats in spec.items():
        for s in stats:
            e = fns[s](F.col(c))
            if digits is not None and s not in ("count",):
                e = round_half_even(e.cast("double"), digits)
            aggs.append(e.alias(f"{c}_{s}"))
    base = df
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    return base.groupBy(*keys).agg(*aggs)


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """Rows per group."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("size"))


def strata_summary(df: DataFrame, score_col: str = "effort_score",
                   targets: Sequence[str] = ("bayes_mean", "wilson_lb", "log1p_interactions_per_month_w"),
                   quantiles: int = 4, labels: Sequence[str] | None = None,
                   method: str = "auto") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Quantile strata of the score, then mean/std/count per target.

    Returns ``(assignment, summary, edges)``.  Strata without rows are kept
    (right join to the stratum list).  Only existing targets are used; none
    -> error, absent score column -> error.
    """
    if score_col not in df.columns:
        raise KeyError(f"column '{score_col}' not found")
    avail = [t for t in targets if t in df.columns]
    if not avail:
        raise ValueError("no valid target for the quantile summary")
    src = df.where(F.col(score_col).isNotNull())
    assigned = qcut(src, score_col, quantiles, labels=labels, out="stratum", keep_edges=True,
                    method=method)
    edges = assigned.select(*[f"e{i}" for i in range(quantiles + 1)]).limit(1)
    assigned = assigned.drop(*[f"e{i}" for i in range(quantiles + 1)])
    aggs = []
    for t in avail:
        x = F.col(t).cast("double")
        aggs += [F.avg(x).alias(f"{t}_mean"), F.stddev_samp(x).alias(f"{t}_std"),
                 F.count(x).alias(f"{t}_count")]
    summ = assigned.groupBy("stratum").agg(*aggs)
    strata = df.sparkSession.range(quantiles).select(F.col("id").cast("int").alias("stratum"))
    summ = strata.join(summ, "stratum", "left").select(
        "stratum", *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c.endswith("_count") else F.col(c)
                     for c in summ.columns if c != "stratum"])
    return assigned, summ, edges


def bin_profile(df: DataFrame, c: str, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins of ``c``, mean of each column per non-empty bin."""
    b = cut_bins(df, c, bins, out="bin")
    return b.where(F.col("bin").isNotNull()).groupBy("bin").agg(
        *[F.avg(F.col(x).cast("double")).alias(f"mean_{x}") for x in cols])


def frequency(df: DataFrame, c: str, dropna: bool = True, pct_of: str = "all") -> DataFrame:
    """Value counts with share in percent.

    ``pct_of='all'`` divides by all rows (the study's loops), ``'counted'``
    by the counted rows (``value_counts(normalize=True)``).  The total is a
    one-row aggregate joined by broadcast, not a window over all groups.
    """
    base = df.where(F.col(c).isNotNull()) if dropna else df
    counts = base.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    tot_src = df if pct_of == "all" else base
    tot = tot_src.agg(F.count(F.lit(1)).alias("_tot"))
    return (counts.crossJoin(F.broadcast(tot))
                  .withColumn("pct", F.try_divide(F.col("n") * F.lit(100.0), F.col("_tot")))
                  .drop("_tot"))


def conditional_share(df: DataFrame, cond: Column | str) -> DataFrame:
    """Rows matching a predicate and their percentage of all rows."""
    p = F.expr(cond) if isinstance(cond, str) else cond
    return df.agg(F.count_if(F.coalesce(p, F.lit(False))).alias("n_match"),
                  F.count(F.lit(1)).alias("n_total")) \
             .withColumn("pct", F.try_divide(F.col("n_match") * F.lit(100.0), F.col("n_total")))


def conditional_mean(df: DataFrame, value: str, cond: Column | str, out: str = "mean") -> DataFrame:
    """Mean of ``value`` over rows matching ``cond``."""
    p = F.expr(cond) if isinstance(cond, str) else cond
    return df.agg(F.avg(F.when(p, F.col(value).cast("double"))).alias(out))


def extremes(df: DataFrame, c: str, above: float | None = None,
             equal_to: Sequence[float] = ()) -> DataFrame:
    """Rows at the minimum, at the maximum, above a threshold, equal to values."""
    mm = df.agg(F.min(c).alias("_mn"), F.max(c).alias("_mx"))
    j = df.crossJoin(F.broadcast(mm))
    aggs = [F.first("_mn").alias("min"), F.first("_mx").alias("max"),
            F.count_if(F.col(c) == F.col("_mn")).alias("n_at_min"),
            F.count_if(F.col(c) == F.col("_mx")).alias("n_at_max")]
    if above is not None:
        aggs.append(F.count_if(F.col(c) > F.lit(above)).alias("n_above"))
    for v in equal_to:
        aggs.append(F.count_if(F.col(c) == F.lit(v)).alias(f"n_eq_{str(v).replace('.', '_')}"))
    return j.agg(*aggs)


def contributor_concentration(df: DataFrame, key: str = "contributor_id") -> DataFrame:
    """Distinct keys (NULL counts as one), top key and count, its share of
    all rows in % (2 dp), mean count per key (rounded to an integer, half-even)
    and median count per key.  Ties for the top key go to the smallest key.
    """
    total = df.agg(F.count(F.lit(1)).alias("n_rows"),
                   (F.count_distinct(F.col(key)) +
                    F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).alias("n_unique"))
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    stats = per.agg(
        F.min_by(F.col(key), F.struct(-F.col("n"), F.col(key))).alias("top_key"),
        F.max("n").alias("top_count"),
        F.avg("n").alias("_mean"),
        F.median(F.col("n").cast("double")).alias("median_count"))
    j = total.crossJoin(stats)
    return j.select(
        "n_unique", "top_key", "top_count",
        py_round(F.col("top_count") * F.lit(100.0) / F.col("n_rows"), 2).alias("top_pct"),
        py_round(F.col("_mean"), 0).cast("long").alias("mean_count"),
        "median_count")


def list_items(df: DataFrame, c: str) -> DataFrame:
    """Exploded items of a list-literal column (A1); malformed rows give none."""
    if c not in df.columns:
        raise ValueError(f"column '{c}' not found")
    return df.select(F.explode(parse_list(F.col(c))).alias("item"))


def item_frequency(df: DataFrame, c: str) -> DataFrame:
    """G13 base: item -> count over the exploded list column."""
    return list_items(df, c).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def item_summary(df: DataFrame, c: str, k: int = 10, tail: int = 10) -> DataFrame:
    """Distinct items, total mentions, top-k and the last ``tail`` of the
    descending order (ties: count desc, item asc).  Long output:
    ``part ('top'|'tail'), position, item, n, n_unique, n_total``.
    The positions come from a per-item count table (one row per item).
    """
    f = item_frequency(df, c)
    tot = f.agg(F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("n_total"))
    top = f.orderBy(F.desc("n"), F.asc("item")).limit(k) \
           .withColumn("part", F.lit("top"))
    last = f.orderBy(F.asc("n"), F.desc("item")).limit(tail) \
            .withColumn("part", F.lit("tail"))
    both = top.unionByName(last)
    w_top = Window.partitionBy("part").orderBy(F.desc("n"), F.asc("item"))
    both = both.withColumn("position", F.row_number().over(w_top))
    return both.crossJoin(F.broadcast(tot)).select("part", "position", "item", "n", "n_unique", "n_total")


def value_multiset(df: DataFrame, key: str, value: str) -> DataFrame:
    """G15 in long form: every value of a key with its multiplicity.

    The reference builds one Python list per key; a list per key would put a
    hot key's whole history on one task, so the multiset is returned as
    ``(key, value, count)`` rows instead (NULL values kept as a value).
    """
    return df.where(F.col(key).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("count"))
