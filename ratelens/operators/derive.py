"""Derived columns that need data-dependent constants.

Every constant (min, max, mean, std, quantile) is one aggregate row joined
back with ``crossJoin(broadcast(...))``: one row, so the broadcast size is
fixed, and no value travels through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.expr import clip, log1p_clipped, round_half_even
from ratelens.operators.quantiles import multi_quantiles, quantiles


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """``(x-min)/(max-min)``; a constant or all-NULL column gives 0.0 everywhere."""
    stats = df.agg(*[F.min(c).cast("double").alias(f"_mn_{i}") for i, c in enumerate(cols)],
                   *[F.max(c).cast("double").alias(f"_mx_{i}") for i, c in enumerate(cols)])
    j = df.crossJoin(F.broadcast(stats))
    outs = []
    for i, c in enumerate(cols):
        mn, mx = F.col(f"_mn_{i}"), F.col(f"_mx_{i}")
        degenerate = mn.isNull() | mx.isNull() | (mx == mn)
        outs.append(F.when(degenerate, F.lit(0.0))
                     .otherwise((F.col(c) - mn) / (mx - mn)).alias(f"{c}{suffix}"))
    keep = [F.col(c) for c in df.columns if c not in {f"{x}{suffix}" for x in cols}]
    return j.select(*keep, *outs)


def weighted_score(df: DataFrame, weights: Mapping[str, float], scale: float = 100.0,
                   out: str = "effort_score", suffix: str = "_scaled") -> DataFrame:
    """``scale * sum(w * x_scaled)``."""
    total = None
    for c, w in weights.items():
        term = F.lit(float(w)) * F.col(f"{c}{suffix}")
        total = term if total is None else total + term
    return df.withColumn(out, total * F.lit(float(scale)))


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                 method: str = "auto") -> DataFrame:
    """One row with ``{col}__q{i}`` for every column and probability."""
    return multi_quantiles(df, {c: (list(probs), [f"{c}__q{i}" for i in range(len(probs))])
                                for c in cols}, method)


def winsorize(df: DataFrame, cols: Sequence[str], lower: float = 0.05, upper: float = 0.99,
              suffix: str = "_w", method: str = "auto", values: DataFrame | None = None) -> DataFrame:
    """Clip each column to its own [lower, upper] quantiles; NULLs stay.

    An all-NULL column has NULL bounds and is returned unchanged.  ``values``
    are the same rows' columns where they are cheaper to read (a stage).
    """
    qs = quantile_row(df if values is None else values, cols, [lower, upper], method)
    j = df.crossJoin(F.broadcast(qs))
    outs = [clip(c, F.col(f"{c}__q0"), F.col(f"{c}__q1")).alias(f"{c}{suffix}") for c in cols]
    keep = [F.col(c) for c in df.columns if c not in {f"{x}{suffix}" for x in cols}]
    return j.select(*keep, *outs)


def tercile_category(df: DataFrame, c: str, labels: Sequence[str], out: str,
                     probs: Sequence[float] = (0.33, 0.67), method: str = "auto") -> DataFrame:
    """``< q33`` -> labels[0], ``< q67`` -> labels[1], else labels[2] (NULL too)."""
    qs = quantiles(df, c, probs, names=["_t0", "_t1"], method=method)
    j = df.crossJoin(F.broadcast(qs))
    x = F.col(c)
    cat = F.when(x < F.col("_t0"), labels[0]).when(x < F.col("_t1"), labels[1]).otherwise(labels[2])
    return j.withColumn(out, cat).drop("_t0", "_t1")


def qcut_edges(df: DataFrame, c: str, q: int = 4, method: str = "auto") -> DataFrame:
    """D9 edges: one row ``e0..e{q}`` of linear quantiles at ``i/q``."""
    return quantiles(df, c, [i / q for i in range(q + 1)], names=[f"e{i}" for i in range(q + 1)],
                     method=method)


def qcut_code(x: Column, q: int) -> Column:
    """Bin code against edge columns ``e0..e{q}``: distinct inner edges below x.

    Intervals are ``(a, b]`` and the first one includes its lower edge, so
    equal values always share a bin.  Duplicate edges are skipped.
    """
    code = F.lit(0)
    for j in range(1, q):
        ej, eprev = F.col(f"e{j}"), F.col(f"e{j - 1}")
        code = code + F.when((ej != eprev) & (ej < x), 1).otherwise(0)
    return F.when(x.isNotNull(), code)


def n_unique_edges(q: int) -> Column:
    n = F.lit(1)
    for j in range(1, q + 1):
        n = n + F.when(F.col(f"e{j}") != F.col(f"e{j - 1}"), 1).otherwise(0)
    return n


def qcut(df: DataFrame, c: str, q: int = 4, labels: Sequence[str] | None = None,
         out: str = "bin", duplicates: str = "drop", method: str = "auto",
         keep_edges: bool = False) -> DataFrame:
    """Quantile cut with ``pd.qcut`` semantics (not ``ntile``: ties share a bin).

    ``duplicates='raise'`` fails the job when two edges coincide; with labels
    the label count must equal the number of bins, as in pandas.
    """
    edges = qcut_edges(df, c, q, method)
    j = df.crossJoin(F.broadcast(edges))
    code = qcut_code(F.col(c).cast("double"), q)
    nbins = n_unique_edges(q) - 1
    if duplicates == "raise":
        code = F.when(nbins == q, code).otherwise(
            F.raise_error(F.lit("Bin edges must be unique")).cast("int"))
    j = j.withColumn(out, code)
    if labels is not None:
        lab = F.when(nbins == len(labels), F.element_at(F.array(*[F.lit(x) for x in labels]),
                                                         F.col(out) + 1)) \
               .otherwise(F.raise_error(F.lit("Bin labels must be one fewer than the number of bin edges")))
        j = j.withColumn(f"{out}_label", F.when(F.col(out).isNotNull(), lab))
    if not keep_edges:
        j = j.drop(*[f"e{i}" for i in range(q + 1)])
    return j


def cut_code(x: Column, mn: Column, mx: Column, bins: int) -> Column:
    """D10 bin code: right-closed equal-width bins over [min, max] (pandas ``cut``).

    Edges are ``min + i*step``; the lowered first edge only widens bin 0, so
    the code is the number of inner edges strictly below x.
    """
    flat = mx == mn
    adj = F.when(mn != 0, F.abs(mn) * 0.001).otherwise(F.lit(0.001))
    lo = F.when(flat, mn - adj).otherwise(mn)
    hi = F.when(flat, mx + adj).otherwise(mx)
    step = (hi - lo) / F.lit(float(bins))
    code = F.lit(0)
    for i in range(1, bins):
        code = code + F.when(lo + F.lit(float(i)) * step < x, 1).otherwise(0)
    return F.when(x.isNotNull(), code)


def cut(df: DataFrame, c: str, bins: int = 10, out: str = "bin") -> DataFrame:
    """Equal-width cut into ``bins`` codes 0..bins-1."""
    mm = df.agg(F.min(c).cast("double").alias("_cmn"), F.max(c).cast("double").alias("_cmx"))
    j = df.crossJoin(F.broadcast(mm))
    return j.withColumn(out, cut_code(F.col(c).cast("double"), F.col("_cmn"), F.col("_cmx"), bins)) \
            .drop("_cmn", "_cmx")


def gap_columns(df: DataFrame) -> DataFrame:
    """Distance to the best possible score."""
    return (df.withColumn("rating_gap", F.lit(5) - F.col("avg_rating"))
              .withColumn("bayes_gap", F.lit(5) - F.col("bayes_mean"))
              .withColumn("wilson_gap", F.lit(1) - F.col("wilson_lb")))


def age_months(submitted: str | Column, as_of: str, clip_zero: bool = True) -> Column:
    """Whole days since ``submitted`` / 30.44, rounded to 1 decimal.

    ``as_of`` is mandatory (no clock inside queries).
    """
    s = F.col(submitted) if isinstance(submitted, str) else submitted
    days = F.datediff(F.to_date(F.lit(as_of)), s.cast("date")).cast("double")
    if clip_zero:
        days = F.when(days.isNotNull(), F.greatest(days, F.lit(0.0)))
    return round_half_even(days / F.lit(30.44), 1)


def rate_per_month(n: str | Column, age: str | Column) -> Column:
    """``n / max(1, age)``; NULL age gives NULL."""
    nn = F.col(n) if isinstance(n, str) else n
    a = F.col(age) if isinstance(age, str) else age
    return F.when(a.isNotNull(), nn / F.greatest(F.lit(1.0), a))


# fixed values: the columns that the study standardises
DEFAULT_STANDARDIZE = ("log_minutes", "n_steps", "n_ingredients", "avg_words_per_step",
                       "age_months", "effort_score", "steps_x_ingredients")


def zscore_meta(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fitted mean / population std per column (long: column, mean, std)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, mean double, std double")
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {stack}) as (column, mean, std)")


def apply_standardization(df: DataFrame, meta: DataFrame, suffix: str = "_std") -> DataFrame:
    """Apply fitted ``(mean, std)`` rows to (new) data; std 0/NULL -> 0.0."""
    cols = [r for r in df.columns]
    wide = meta.groupBy().pivot("column").agg(F.first("mean").alias("m"), F.first("std").alias("s"))
    # pivot names: '<col>_m', '<col>_s'
    j = df.crossJoin(F.broadcast(wide))
    names = [c[:-2] for c in wide.columns if c.endswith("_m")]
    outs = []
    for c in names:
        if c not in cols:
            continue
        m, s = F.col(f"`{c}_m`"), F.col(f"`{c}_s`")
        outs.append(F.when(s.isNull() | (s == 0), F.lit(0.0))
                     .otherwise((F.col(c).cast("double") - m) / s).alias(f"{c}{suffix}"))
    return j.select(*[F.col(c) for c in cols], *outs)


def add_feature_columns(df: DataFrame, *, interaction: bool = True, standardize: bool = True,
                        columns_to_standardize: Sequence[str] | None = None
                        ) -> tuple[DataFrame, DataFrame | None]:
    """D14 + D15: product term and z-scores (population std); absent columns skipped.

    Returns ``(enriched, meta)``; ``meta`` has one row per standardised column.
    """
    out = df
    if interaction:
        out = out.withColumn("steps_x_ingredients", F.col("n_steps") * F.col("n_ingredients"))
    if not standardize:
        return out, None
    targets = [c for c in (columns_to_standardize or DEFAULT_STANDARDIZE) if c in out.columns]
    if not targets:
        return out, zscore_meta(out, [])
    stats = out.agg(*[F.avg(F.col(c).cast("double")).alias(f"_zm{i}") for i, c in enumerate(targets)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"_zs{i}")
                      for i, c in enumerate(targets)])
    j = out.crossJoin(F.broadcast(stats))
    zs = []
    for i, c in enumerate(targets):
        m, s = F.col(f"_zm{i}"), F.col(f"_zs{i}")
        zs.append(F.when(s.isNull() | (s == 0), F.lit(0.0))
                   .otherwise((F.col(c).cast("double") - m) / s).alias(f"{c}_std"))
    keep = [F.col(c) for c in out.columns if c not in {f"{t}_std" for t in targets}]
    return j.select(*keep, *zs), zscore_meta(out, targets)


def standardized_product(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Product of sample-standardised columns (ddof 1, NULLs skipped)."""
    st = df.agg(F.avg(a).alias("_am"), F.stddev_samp(a).alias("_as"),
                F.avg(b).alias("_bm"), F.stddev_samp(b).alias("_bs"))
    j = df.crossJoin(F.broadcast(st))
    # a constant column has no standardised value: NULL
    v = F.try_divide(F.col(a) - F.col("_am"), F.col("_as")) * F.try_divide(F.col(b) - F.col("_bm"), F.col("_bs"))
    return j.withColumn(out, v).drop("_am", "_as", "_bm", "_bs")


def enrich_analysis(recipes_clean: DataFrame, metrics: DataFrame, *, as_of: str,
                    method: str = "auto", parts: int = 0) -> DataFrame:
    """J1 -> D12 -> D13 -> C9 -> D1 -> D2 -> D7 -> D11.

    The join keeps only recipes that have interactions (inner, on purpose).
    The metrics are written once to the shared folder, and so are the four
    columns of D7, from which their quantiles are read: jobs when the plan is
    built, but the interactions are grouped once, and the joined rows are not computed again for each quantile pass.
    With ``parts`` the recipes lie in as many buckets of ``id``: the metrics are
    written alike, and each bucket of theirs (one row an id) is looked up, so
    that the recipes' texts are neither shuffled nor sorted.
    """
    from ratelens.sources.sinks import stage, stage_by_key
    m = metrics.withColumnRenamed("recipe_id", "_mid")
    if parts:
        m = stage_by_key(m.repartition(parts, "_mid"), "metrics", "_mid", parts).hint("shuffle_hash")
    else:
        m = stage(m, "metrics")
    df = recipes_clean.join(m, recipes_clean["id"] == m["_mid"], "inner").drop("_mid")
    df = df.withColumn("age_months", age_months("submitted", as_of))
    df = df.withColumn("interactions_per_month", rate_per_month(F.col("n_interactions"), "age_months"))
    df = df.where(F.col("minutes") > 0)
    df = df.withColumn("log_minutes", F.ln(F.col("minutes").cast("double")))
    for v in ("n_interactions", "interactions_per_month", "n_unique_users"):
        df = df.withColumn(f"log1p_{v}", log1p_clipped(v))
    cols = ["log_minutes", "log1p_n_interactions", "log1p_interactions_per_month", "log1p_n_unique_users"]
    df = winsorize(df, cols, 0.05, 0.99, method=method, values=stage(df.select(*cols), "winsorized-columns"))
    return gap_columns(df)
