"""Regression, hold-out evaluation and sampling.

Linear models use MLlib's normal-equation solver: the executors aggregate
the (p+1)x(p+1) Gram matrix (partial aggregation, tree-combined), the driver
solves a matrix whose size depends on the number of predictors only.
Samples and splits are hash-based (md5 of key and seed), so they do not
depend on partitioning and are identical on any engine.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.operators.quantiles import quantiles

# fixed values: default model features/targets of the study
DEFAULT_MODEL_FEATURES = ("log_minutes_std", "n_steps_std", "n_ingredients_std",
                          "steps_x_ingredients_std", "age_months_std")
DEFAULT_MODEL_TARGETS = ("bayes_mean", "wilson_lb", "log1p_interactions_per_month_w")


def hash_key(key: str | Column, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by the md5 order of (key, seed); all rows if fewer.

    A top-n by hash: each partition keeps its n smallest, then one merge.
    """
    return df.withColumn("_h", hash_key(key, seed)).orderBy("_h", key).limit(n).drop("_h")


#: Hexadecimal digits of the hash that one selection step looks at, and the steps.
_DIGITS, _STEPS = 3, 3


def split_flag(df: DataFrame, key: str, seed: int = 42, test_size: float = 0.2) -> Column:
    """True for the ``ceil(test_size * n)`` rows with the smallest md5(key:seed), ties by key.

    The bound is selected without a sort: each step counts the rows by the
    next three digits of their hash (at most 4096 counts reach the driver) and
    keeps the one prefix that holds the wanted rank; after three steps a top-k
    of the few rows left gives it.  Rows without a key are no test rows; keys
    should be unique, as all rows of the last key are taken.
    """
    h = hash_key(key, seed)
    rows = df.select(F.col(key).alias("k"), h.alias("h"))
    prefix, want = "", None
    for step in range(_STEPS):
        at = len(prefix)
        counts = rows.where(F.col("h").startswith(prefix)) if prefix else rows
        found = {r[0]: r[1] for r in counts.groupBy(F.substring("h", at + 1, _DIGITS)).count().collect()}
        if want is None:
            want = math.ceil(test_size * sum(found.values()))
            want = min(want, sum(v for k, v in found.items() if k is not None))
        if want <= 0:
            return F.lit(False)
        for digits in sorted(k for k in found if k is not None):
            if want <= found[digits]:
                break
            want -= found[digits]
        prefix += digits
    last = rows.where(F.col("h").startswith(prefix)).orderBy("h", "k").limit(want).agg(F.max(F.struct("h", "k")).alias("m")).first()["m"]
    return F.coalesce((h < last["h"]) | ((h == last["h"]) & (F.col(key) <= F.lit(last["k"]))), F.lit(False))


def train_test_split(df: DataFrame, key: str, seed: int = 42, test_size: float = 0.2
                     ) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(df, key, seed, test_size)
    return df.where(~flag), df.where(flag)


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares ``y = a2 x^2 + a1 x + a0`` (numpy ``polyfit(x, y, 2)``).

    Power sums on centred x in one pass after the mean; the 3x3 normal
    equations are solved in closed form as column expressions.
    """
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    mx = d.agg(F.avg("x").alias("_mx"))
    u = F.col("x") - F.col("_mx")
    s = d.crossJoin(F.broadcast(mx)).agg(
        F.first("_mx").alias("mx"), F.count(F.lit(1)).cast("double").alias("s0"),
        F.sum(u).alias("s1"), F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"),
        F.sum(u * u * u * u).alias("s4"), F.sum("y").alias("t0"), F.sum(u * F.col("y")).alias("t1"),
        F.sum(u * u * F.col("y")).alias("t2"))
    return s.selectExpr(*QUAD_SQL_SELECT)


def _det3(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a})*(({e})*({i})-({f})*({h}))-({b})*(({d})*({i})-({f})*({g}))+({c})*(({d})*({h})-({e})*({g})))"


def _quad_sql() -> list[str]:
    M = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
    T = ["t0", "t1", "t2"]
    det = _det3(M)
    cs = []
    for k in range(3):
        mk = [[T[r] if col == k else M[r][col] for col in range(3)] for r in range(3)]
        cs.append(f"try_divide({_det3(mk)}, {det})")  # fewer than three distinct x: NULL
    c0, c1, c2 = cs
    return [f"{c2} AS a2", f"({c1}) - 2.0*({c2})*mx AS a1",
            f"({c0}) - ({c1})*mx + ({c2})*mx*mx AS a0", "CAST(s0 AS BIGINT) AS n"]


QUAD_SQL_SELECT = _quad_sql()


def quadratic_curve(df: DataFrame, x: str, y: str, points: int = 200) -> DataFrame:
    """T9 grid: the fitted parabola on ``points`` equally spaced x over [min, max]."""
    coef = quadratic_fit(df, x, y)
    mm = df.agg(F.min(F.col(x).cast("double")).alias("_mn"), F.max(F.col(x).cast("double")).alias("_mx"))
    g = (df.sparkSession.range(points).crossJoin(mm).crossJoin(coef)
         .withColumn("x", F.col("_mn") + F.col("id").cast("double") * (F.col("_mx") - F.col("_mn"))
                     / F.lit(float(max(points - 1, 1)))))
    return g.select(F.col("id").alias("point"), "x",
                    (F.col("a2") * F.col("x") * F.col("x") + F.col("a1") * F.col("x") + F.col("a0")).alias("y_fit"))


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept, R^2 and n of ``y ~ x`` (built-in ``regr_*``)."""
    xx, yy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(F.regr_slope(yy, xx).alias("slope"), F.regr_intercept(yy, xx).alias("intercept"),
                  F.regr_r2(yy, xx).alias("r2"), F.regr_count(yy, xx).alias("n"))


def with_residuals(df: DataFrame, x: str, y: str, out: str = "residual") -> DataFrame:
    """T10 residual column ``y - (a + b x)`` (coefficients joined as one row)."""
    fit = simple_regression(df, x, y)
    j = df.crossJoin(F.broadcast(fit.select("slope", "intercept")))
    return j.withColumn(out, F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x))) \
            .withColumn("prediction", F.col("intercept") + F.col("slope") * F.col(x)) \
            .drop("slope", "intercept")


def _assemble(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    d = df.select(*[F.col(c).cast("double").alias(c) for c in features],
                  F.col(target).cast("double").alias(target)).na.drop()
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(d)


def fit_linear(df: DataFrame, features: Sequence[str], target: str):
    """Ordinary least squares with intercept on complete rows (MLlib, normal solver)."""
    data = _assemble(df, features, target)
    lr = LinearRegression(featuresCol="_features", labelCol=target, solver="normal",
                          regParam=0.0, elasticNetParam=0.0, fitIntercept=True, standardization=False)
    return lr.fit(data), data


def multiple_regression(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """In-sample coefficients and R^2; long ``term, coef`` + ``r2``, ``n``."""
    model, _ = fit_linear(df, features, target)
    s = model.summary
    rows = [("intercept", float(model.intercept))] + [
        (f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    spark = df.sparkSession
    return spark.createDataFrame([(t, c, float(s.r2), int(s.numInstances)) for t, c in rows],
                                 "term string, coef double, r2 double, n long")


def _moments(df: DataFrame, features: Sequence[str], target: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and population covariances of the features and the target (last), over complete rows.

    One aggregate of built-in covariances, which are centred as they go, so
    large means cost no digits; (p + 1)(p + 2) / 2 numbers reach the driver.
    """
    names = [*features, target]
    d = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).na.drop()
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = d.agg(F.count(F.lit(1)), *[F.avg(f"v{i}") for i in range(len(names))], *[F.covar_pop(f"v{i}", f"v{j}") for i, j in pairs]).first()
    n = int(row[0])
    cov = np.zeros((len(names), len(names)))
    for (i, j), v in zip(pairs, row[1 + len(names):]):
        cov[i, j] = cov[j, i] = v if v is not None else 0.0
    return n, np.array([0.0 if v is None else v for v in row[1:1 + len(names)]]), cov


#: Share of the largest eigenvalue of the scaled cross-products below which a direction counts as none.
RANK_SHARE = 1e-10


def least_squares(n: int, means: np.ndarray, cov: np.ndarray) -> dict:
    """Minimum-norm least squares with a constant, and its inference, from the moments of :func:`_moments`.

    The scaled cross-products are decomposed into eigenvectors.  Directions
    without variance leave the coefficients open; of all solutions the
    shortest vector (constant included) is taken, as the pseudo-inverse of the
    design matrix gives it, and its covariance is that inverse's as well.
    """
    p = len(means) - 1
    m, c, xy, yy = means[:p], cov[:p, :p], cov[:p, p], cov[p, p]
    scale = np.sqrt(np.diag(c))
    flat = scale <= 1e-12 * np.maximum(np.abs(m), 1e-300)  # constant columns
    scale = np.where(flat, 1.0, scale)
    values, vectors = np.linalg.eigh(np.where(flat[:, None] | flat[None, :], 0.0, c) / np.outer(scale, scale))
    held = values > RANK_SHARE * max(values.max(initial=0.0), 1e-300)
    inverse = (vectors[:, held] / values[held]) @ vectors[:, held].T / np.outer(scale, scale)
    slopes = inverse @ xy
    rank = 1 + int(held.sum())
    # back from centred columns: the constant takes what the means of the others say
    back = np.eye(p + 1)
    back[0, 1:] = -m
    coef = back @ np.concatenate([[means[p]], slopes])
    centred = np.zeros((p + 1, p + 1))
    centred[0, 0], centred[1:, 1:] = 1.0, inverse
    unit = back @ centred @ back.T / n
    if rank <= p:
        open_ = back @ np.concatenate([np.zeros((1, p + 1 - rank)), vectors[:, ~held] / scale[:, None]])
        base = np.linalg.qr(open_)[0]
        onto = np.eye(p + 1) - base @ base.T
        coef, unit = onto @ coef, onto @ unit @ onto
        coef[np.abs(coef) < 1e-15 * np.abs(coef).max(initial=0.0)] = 0.0
    rest = n - rank
    sse = max(0.0, n * (yy - xy @ slopes))
    r2 = 1 - sse / (n * yy) if yy > 0 else None
    s2 = sse / rest if rest > 0 else None
    se = np.sqrt(np.maximum(np.diag(unit) * s2, 0.0)) if s2 is not None else None
    fstat = (n * (xy @ slopes) / (rank - 1)) / s2 if s2 and rank > 1 else None
    return {"coef": coef, "se": se, "r2": r2, "adj_r2": 1 - (1 - r2) * (n - 1) / rest if r2 is not None and rest > 0 else None,
            "f": fstat, "rank": rank, "rest": rest}


def ols(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """OLS with inference — coefficient, std error, t, p per term (constant
    first), plus R^2, adjusted R^2, n, F and its p and the rank on every row.

    Collinear predictors share what they explain (the shortest coefficient
    vector); ``singular`` says that there are such.  A term whose standard error is 0 has no t and p;
    without complete rows every number is NULL.
    """
    from ratelens.functions.pvalues import f_sf, t_two_sided
    schema = ("target string, term string, coef double, std_err double, t_value double, p_value double, r2 double, adj_r2 double, "
              "n long, f_stat double, f_p_value double, singular boolean, rank int")
    terms = ["const", *features]
    n, means, cov = _moments(df, features, target)
    if n == 0:
        return df.sparkSession.createDataFrame([(target, t, *[None] * 6, 0, None, None, None, None) for t in terms], schema)
    fit = least_squares(n, means, cov)
    fp = f_sf(fit["f"], fit["rank"] - 1, fit["rest"]) if fit["f"] is not None else None
    rows = []
    for i, t in enumerate(terms):
        c, se = float(fit["coef"][i]), None if fit["se"] is None else float(fit["se"][i])
        tv = c / se if se else None
        rows.append((target, t, c, se, tv, t_two_sided(tv, fit["rest"]) if tv is not None else None,
                     *[None if v is None else float(v) for v in (fit["r2"], fit["adj_r2"])], n,
                     *[None if v is None else float(v) for v in (fit["f"], fp)], fit["rank"] <= len(features), fit["rank"]))
    return df.sparkSession.createDataFrame(rows, schema)


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MSE, RMSE, MAE, R^2 (``1 - SSE/SST`` about the mean of y; NULL for a constant y)."""
    e = F.col(y).cast("double") - F.col(pred).cast("double")
    d = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    a = d.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
              F.var_pop(F.col(y).cast("double")).alias("_vy"), F.count(F.lit(1)).alias("n"))
    return a.select("mse", F.sqrt("mse").alias("rmse"), "mae",
                    (F.lit(1.0) - F.try_divide("mse", "_vy")).alias("r2"), "n")


def _linear_on_train(df: DataFrame, features: Sequence[str], target: str, key: str, seed: int, test_size: float):
    """Complete rows with ``is_test`` and ``<f>_z`` (train moments, ddof 0), and the model fitted on the train rows."""
    from ratelens.operators.derive import add_feature_columns, apply_standardization
    d = df.select(key, *features, target).na.drop()
    d = d.withColumn("is_test", split_flag(d, key, seed, test_size))
    _, meta = add_feature_columns(d.where(~F.col("is_test")), interaction=False, columns_to_standardize=features)
    z = apply_standardization(d, meta, "_z")
    model, _ = fit_linear(z.where(~F.col("is_test")), [f"{f}_z" for f in features], target)
    return z, model


def _linear_prediction(model, features: Sequence[str]) -> Column:
    out = F.lit(float(model.intercept))
    for f, c in zip(features, model.coefficients.toArray()):
        out = out + F.lit(float(c)) * F.col(f"{f}_z")
    return out


def _fit_forest(df: DataFrame, features: Sequence[str], target: str, seed: int, rf_params: Mapping | None):
    # each row's node in every tree is kept from level to level; without that a level walks all trees from their roots
    params = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all", "maxBins": 64, "cacheNodeIds": True}
    params.update(rf_params or {})
    return RandomForestRegressor(featuresCol="_features", labelCol=target, seed=seed, **params).fit(_assemble(df, features, target))


def holdout_predictions(df: DataFrame, features: Sequence[str], target: str, key: str, seed: int = 42,
                        test_size: float = 0.2, rf_params: Mapping | None = None, forest: bool = True) -> DataFrame:
    """The test rows with what either model says of them: ``key, actual,
    pred_linear, pred_forest`` (NULL without ``forest``) and the features.

    T15's and T16's models, fitted on the same train rows; the extracts of
    T18, T19, T20 and T22 all come from this one table.
    """
    z, model = _linear_on_train(df, features, target, key, seed, test_size)
    test = z.where("is_test").select(key, F.col(target).alias("actual"),
                                     _linear_prediction(model, features).alias("pred_linear"), *features)
    if not forest:
        return test.withColumn("pred_forest", F.lit(None).cast("double"))
    rf = _fit_forest(z.where(~F.col("is_test")), features, target, seed, rf_params)
    ready = VectorAssembler(inputCols=list(features), outputCol="_features").transform(
        test.select(*[c if c not in features else F.col(c).cast("double").alias(c) for c in test.columns]))
    return rf.transform(ready).withColumnRenamed("prediction", "pred_forest").drop("_features")


def prediction_metrics(preds: DataFrame, target: str = "target") -> DataFrame:
    """T17 for both models of :func:`holdout_predictions`: ``target, model, rmse, mae, r2, n_test``."""
    out = None
    for model, c in (("linear_regression", "pred_linear"), ("random_forest", "pred_forest")):
        m = regression_metrics(preds, "actual", c).where("n > 0").select(
            F.lit(target).alias("target"), F.lit(model).alias("model"), "rmse", "mae", "r2", F.col("n").alias("n_test"))
        out = m if out is None else out.unionByName(m)
    return out


def prediction_residuals(preds: DataFrame, key: str, x: str) -> DataFrame:
    """T18 / T22 extracts, all test rows: ``key, model, x, actual, prediction, residual``."""
    return preds.selectExpr(f"`{key}`", f"`{x}` as x", "actual", "stack(2, 'linear_regression', pred_linear, "
                            "'random_forest', pred_forest) as (model, prediction)") \
        .where("prediction IS NOT NULL").withColumn("residual", F.col("actual") - F.col("prediction")) \
        .select(key, "model", "x", "actual", "prediction", "residual")


def prediction_examples(preds: DataFrame, key: str, n: int = 5, seed: int = 7) -> DataFrame:
    """``n`` test rows with the real value, both predictions and the features."""
    return seeded_sample(preds, n, key, seed)


def holdout_linear(df: DataFrame, features: Sequence[str], target: str, key: str,
                   seed: int = 42, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Z-scores fitted on train only (ddof 0), OLS on the scaled train
    rows, metrics on the test rows.  Returns ``(metrics, coefficients)``."""
    z, model = _linear_on_train(df, features, target, key, seed, test_size)
    m = regression_metrics(z.where("is_test").withColumn("pred", _linear_prediction(model, features)), target, "pred")
    ntr = z.where(~F.col("is_test")).agg(F.count(F.lit(1)).alias("n_train"))
    metrics = m.crossJoin(ntr).select(F.lit(target).alias("target"), F.lit("linear_regression").alias("model"),
                                      "rmse", "mae", "r2", F.col("n").alias("n_test"), "n_train",
                                      F.lit(float(model.intercept)).alias("intercept"))
    coefs = df.sparkSession.createDataFrame(
        [(target, f, float(c)) for f, c in zip(features, model.coefficients.toArray())],
        "target string, feature string, coef double")
    return metrics, coefs


def holdout_forest(df: DataFrame, features: Sequence[str], target: str, key: str, seed: int = 42,
                   test_size: float = 0.2, rf_params: Mapping | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Random forest on unscaled features; test metrics and importances
    (sorted descending).  MLlib bins continuous features and caps depth at 30."""
    d = df.select(key, *features, target).na.drop()
    train, test = train_test_split(d, key, seed, test_size)
    model = _fit_forest(train, features, target, seed, rf_params)
    pred = model.transform(_assemble(test, features, target)).withColumnRenamed("prediction", "pred")
    m = regression_metrics(pred, target, "pred")
    ntr = train.agg(F.count(F.lit(1)).alias("n_train"))
    metrics = m.crossJoin(ntr).select(F.lit(target).alias("target"), F.lit("random_forest").alias("model"),
                                      "rmse", "mae", "r2", F.col("n").alias("n_test"), "n_train")
    imp = df.sparkSession.createDataFrame(
        [(target, f, float(v)) for f, v in zip(features, model.featureImportances.toArray())],
        "target string, feature string, importance double").orderBy(F.desc("importance"), "feature")
    return metrics, imp


def qq_points(df: DataFrame, c: str, points: int = 100, method: str = "auto") -> DataFrame:
    """Normal QQ — sample quantiles at ``(i-0.5)/m`` against standard-normal
    quantiles, with the standardised line (``slope = std``, ``intercept = mean``)."""
    probs = [(i - 0.5) / points for i in range(1, points + 1)]
    q = quantiles(df, c, probs, names=[f"_s{i}" for i in range(points)], method=method)
    st = df.agg(F.avg(F.col(c).cast("double")).alias("_m"), F.stddev_samp(F.col(c).cast("double")).alias("_sd"))
    nd = NormalDist()
    parts = ", ".join(f"{i}, {probs[i]!r}D, {nd.inv_cdf(probs[i])!r}D, _s{i}" for i in range(points))
    long = q.selectExpr(f"stack({points}, {parts}) as (point, prob, theoretical, sample)")
    return long.crossJoin(st).select("point", "prob", "theoretical", "sample",
                                     (F.col("_m") + F.col("_sd") * F.col("theoretical")).alias("line"))


def compare_models(metrics: DataFrame, by: str = "target") -> DataFrame:
    """Best model per target by R^2, its RMSE and the share of variance it explains (percent)."""
    best = F.max_by(F.struct("model", "rmse", "r2"), F.col("r2"))
    return metrics.groupBy(by).agg(best.alias("_b")).select(
        by, F.col("_b.model").alias("best_model"), F.col("_b.r2").alias("best_r2"), F.col("_b.rmse").alias("best_rmse"),
        (F.col("_b.r2") * 100.0).alias("variance_pct"))


def coefficient_table(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``target, term, coef, std_err, t_value, p_value`` of every target's OLS, sorted by (target, term)."""
    out = None
    for t in targets:
        o = ols(df, features, t).where("term <> 'const'").select("target", "term", "coef", "std_err", "t_value", "p_value")
        out = o if out is None else out.unionByName(o)
    return out.orderBy("target", "term")


def _long(df: DataFrame, model: str, names: Sequence[str], term: str | None = None) -> DataFrame:
    """``target, model, metric, term, value`` from one column a metric."""
    parts = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    return df.selectExpr("target", f"'{model}' AS model", f"{term or 'CAST(NULL AS STRING)'} AS term",
                         f"stack({len(names)}, {parts}) AS (metric, value)").select("target", "model", "metric", "term", "value")


def run_models(df: DataFrame, key: str, features: Sequence[str] = DEFAULT_MODEL_FEATURES,
               targets: Sequence[str] = DEFAULT_MODEL_TARGETS, test_size: float = 0.2,
               seed: int = 42, rf_params: Mapping | None = None, forest: bool = True) -> DataFrame:
    """Per target: available features, complete rows, linear + forest
    hold-out and OLS with its inference; long result ``target, model, metric,
    term, value`` (no target or no feature: no rows)."""
    feats = [f for f in features if f in df.columns]
    out = []
    for t in [t for t in targets if t in df.columns and feats]:
        lm, lc = holdout_linear(df, feats, t, key, seed, test_size)
        out += [_long(lm, "linear_regression", ["rmse", "mae", "r2", "n_train", "n_test", "intercept"]),
                _long(lc, "linear_regression", ["coef"], "feature")]
        if forest:
            fm, fi = holdout_forest(df, feats, t, key, seed, test_size, rf_params)
            out += [_long(fm, "random_forest", ["rmse", "mae", "r2", "n_train", "n_test"]),
                    _long(fi, "random_forest", ["importance"], "feature")]
        o = ols(df, feats, t).withColumn("nobs", F.col("n"))
        out += [_long(o, "ols", ["coef", "std_err", "t_value", "p_value"], "term"),
                _long(o.limit(1), "ols", ["r2", "adj_r2", "nobs", "f_stat", "f_p_value"])]
    if not out:
        return df.sparkSession.createDataFrame([], "target string, model string, metric string, term string, value double")
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
