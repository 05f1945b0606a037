"""Profiling and distribution operators.

Wide summaries are one ``agg`` over all requested columns (one scan), then
``stack`` to long form.  Exact quantiles go through ``operators.quantiles``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.expr import unbiased_kurt, unbiased_skew
from ratelens.operators.quantiles import multi_quantiles, quantiles


def _stack(row: DataFrame, cols: Sequence[str], fields: Sequence[str], prefix: str = "_") -> DataFrame:
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"'{c}'")
        parts += [f"`{prefix}{f}_{i}`" for f in fields]
    names = ", ".join(["column", *fields])
    return row.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) as ({names})")


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column plus row, column and total counts.

    Long output: ``column, n_missing, n_rows, n_columns, total_missing``.
    Works on an empty input (all counts 0).
    """
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m_{i}") for i, c in enumerate(cols)])
    total = " + ".join(f"_m_{i}" for i in range(len(cols))) or "0"
    row = row.withColumn("_tot", F.expr(total))
    parts = ", ".join(f"'{c}', _m_{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {parts}) as (column, n_missing)",
                          "_rows as n_rows", f"{len(df.columns)} as n_columns",
                          "_tot as total_missing") \
              .withColumn("n_columns", F.col("n_columns").cast("long"))


def seven_number(df: DataFrame, c: str = "minutes", method: str = "auto") -> DataFrame:
    """Mean, median, min, max, q1, q3, std (sample) of one column."""
    q = quantiles(df, c, [0.5, 0.25, 0.75], names=["median", "q1", "q3"], method=method)
    x = F.col(c).cast("double")
    m = df.agg(F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
               F.stddev_samp(x).alias("std"))
    return m.crossJoin(q).select("mean", "median", "min", "max", "q1", "q3", "std")


def describe(df: DataFrame, cols: Sequence[str], extended: bool = False,
             method: str = "auto") -> DataFrame:
    """Count, mean, std, min, 25/50/75 %, max (exact quantiles) per
    column; ``extended`` adds variance, bias-corrected skewness and kurtosis.
    Long output, one row per column.  One aggregate for the moments and one
    for the quantiles of all columns.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_count_{i}"), F.avg(x).alias(f"_mean_{i}"),
                 F.stddev_samp(x).alias(f"_std_{i}"), F.min(x).alias(f"_min_{i}"), F.max(x).alias(f"_max_{i}")]
        if extended:
            aggs += [F.var_samp(x).alias(f"_var_{i}"), F.skewness(x).alias(f"_g1_{i}"),
                     F.kurtosis(x).alias(f"_g2_{i}")]
    m = df.agg(*aggs)
    q = multi_quantiles(df, {c: ([0.25, 0.5, 0.75], [f"_p25_{i}", f"_p50_{i}", f"_p75_{i}"])
                             for i, c in enumerate(cols)}, method)
    row = m.crossJoin(q)
    fields = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if extended:
        extra = []
        for i, _ in enumerate(cols):
            n = F.col(f"_count_{i}").cast("double")
            extra += [unbiased_skew(F.col(f"_g1_{i}"), n).alias(f"_skew_{i}"),
                      unbiased_kurt(F.col(f"_g2_{i}"), n).alias(f"_kurt_{i}")]
        row = row.select("*", *extra)
        fields += ["var", "skew", "kurt"]
    return _stack(row, cols, fields)


def shape_moments(df: DataFrame, cols: Sequence[str], skew_threshold: float = 2.0) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis; ``is_skewed`` = skew > 2."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n_{i}"), F.skewness(x).alias(f"_g1_{i}"),
                 F.kurtosis(x).alias(f"_g2_{i}")]
    row = df.agg(*aggs)
    sel = []
    for i, _ in enumerate(cols):
        n = F.col(f"_n_{i}").cast("double")
        sk = unbiased_skew(F.col(f"_g1_{i}"), n)
        sel += [sk.alias(f"_skew_{i}"), unbiased_kurt(F.col(f"_g2_{i}"), n).alias(f"_kurt_{i}"),
                F.coalesce(sk > F.lit(skew_threshold), F.lit(False)).alias(f"_is_skewed_{i}")]
    return _stack(row.select(*sel), cols, ["skew", "kurt", "is_skewed"])


def _mode(df: DataFrame, c: str) -> DataFrame:
    """Most frequent value, smallest on ties — via a (value, count) table."""
    vc = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return vc.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("mode"))


def count_summary(df: DataFrame, cols: Sequence[str] = ("n_steps", "n_ingredients"),
                  method: str = "auto") -> DataFrame:
    """Mean, median, min, max, mode (smallest on ties) per count column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"_mean_{i}"), F.min(x).alias(f"_min_{i}"), F.max(x).alias(f"_max_{i}")]
    row = df.agg(*aggs).crossJoin(
        multi_quantiles(df, {c: ([0.5], [f"_median_{i}"]) for i, c in enumerate(cols)}, method))
    for i, c in enumerate(cols):
        row = row.crossJoin(_mode(df, c).select(F.col("mode").cast("double").alias(f"_mode_{i}")))
    return _stack(row, cols, ["mean", "median", "min", "max", "mode"])


def multi_stats(df: DataFrame, cols: Sequence[str], method: str = "auto") -> DataFrame:
    """Mean, median, min, max, std per existing column (absent ones skipped)."""
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"_mean_{i}"), F.min(x).alias(f"_min_{i}"), F.max(x).alias(f"_max_{i}"),
                 F.stddev_samp(x).alias(f"_std_{i}")]
    row = df.agg(*aggs).crossJoin(
        multi_quantiles(df, {c: ([0.5], [f"_median_{i}"]) for i, c in enumerate(cols)}, method))
    return _stack(row, cols, ["mean", "median", "min", "max", "std"])


def extreme_row(df: DataFrame, c: str, key: str, which: str = "min") -> DataFrame:
    """The full row holding the minimum (or maximum); ties -> smallest key."""
    o = F.asc(c) if which == "min" else F.desc(c)
    return df.where(F.col(c).isNotNull()).orderBy(o, F.asc(key)).limit(1)


def top_k(df: DataFrame, by: str, k: int = 5, key: str | None = None, ascending: bool = False,
          absolute: bool = False) -> DataFrame:
    """Top-k rows (TakeOrderedAndProject: per-partition top-k, then merge)."""
    e = F.abs(F.col(by)) if absolute else F.col(by)
    orders = [e.asc_nulls_last() if ascending else e.desc_nulls_last()]
    if key:
        orders.append(F.asc(key))
    return df.orderBy(*orders).limit(k)


def kpi_row(df: DataFrame, cols: Sequence[str] = ("effort_score", "bayes_mean", "wilson_lb"),
            digits: int | None = None) -> DataFrame:
    """Row count and the mean of a few columns, one row."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        e = F.avg(F.col(c).cast("double"))
        aggs.append((F.round(e, digits) if digits is not None else e).alias(f"mean_{c}"))
    return df.agg(*aggs)


def fd_bins(df: DataFrame, c: str, lo: int = 10, hi: int = 100, method: str = "auto") -> DataFrame:
    """Freedman–Diaconis bin count, ``ceil(range / (2 IQR n^-1/3))``;
    IQR 0 -> ``ceil(sqrt(n))``; clamped to [lo, hi]."""
    q = quantiles(df, c, [0.25, 0.75], names=["_q1", "_q3"], method=method)
    m = df.agg(F.count(F.col(c)).cast("double").alias("_n"),
               F.min(F.col(c).cast("double")).alias("_mn"), F.max(F.col(c).cast("double")).alias("_mx"))
    r = m.crossJoin(q)
    iqr = F.col("_q3") - F.col("_q1")
    width = F.lit(2.0) * iqr / F.pow(F.col("_n"), F.lit(1.0 / 3.0))
    raw = F.when(iqr == 0, F.ceil(F.sqrt(F.col("_n")))).otherwise(
        F.ceil((F.col("_mx") - F.col("_mn")) / width))
    return r.select(F.least(F.lit(hi), F.greatest(F.lit(lo), raw)).cast("long").alias("bins"),
                    F.col("_n").cast("long").alias("n"), iqr.alias("iqr"))


def hist_code(x, lo, hi, bins: int):
    """numpy histogram bin (left-closed, last bin closed) against edges ``lo + i*step``."""
    step = (hi - lo) / F.lit(float(bins))
    i0 = F.least(F.lit(bins - 1), F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)).cast("int"))
    edge = lambda k: lo + k.cast("double") * step
    dec = F.when(x < edge(i0), i0 - 1).otherwise(i0)
    return F.when((dec < F.lit(bins - 1)) & (x >= edge(dec + 1)), dec + 1).otherwise(dec)


def histogram(df: DataFrame, c: str, bins: int = 30, edges: Sequence[float] | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] (or explicit edges), every bin
    listed, empty ones with 0.  Output: ``bin, lower, upper, count``."""
    spark = df.sparkSession
    x = F.col(c).cast("double")
    if edges is not None:
        e = [float(v) for v in edges]
        nb = len(e) - 1
        code = F.lit(0)
        for v in e[1:-1]:
            code = code + F.when(x >= F.lit(v), 1).otherwise(0)
        inside = (x >= F.lit(e[0])) & (x <= F.lit(e[-1]))
        counts = df.where(inside).groupBy(code.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        frame = spark.createDataFrame([(i, e[i], e[i + 1]) for i in range(nb)],
                                      "bin int, lower double, upper double")
        return frame.join(counts, "bin", "left").select(
            "bin", "lower", "upper", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx")).select(
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    j = df.where(x.isNotNull()).crossJoin(F.broadcast(mm))
    code = hist_code(x, F.col("_lo"), F.col("_hi"), bins)
    counts = j.groupBy(code.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(mm))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    frame = frame.select("bin", (F.col("_lo") + F.col("bin").cast("double") * step).alias("lower"),
                         (F.col("_lo") + (F.col("bin") + 1).cast("double") * step).alias("upper"))
    return frame.join(counts, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("count", F.lit(0)).cast("long").alias("count")) \
        .where(F.col("lower").isNotNull())


def box_stats(df: DataFrame, c: str, by: Sequence[str] = (), whisker: float = 1.5,
              method: str = "auto") -> DataFrame:
    """q1, median, q3, whiskers (extreme data within 1.5 IQR), outlier count.

    Pass 1: quantiles per group; pass 2: conditional min/max/count after
    joining the per-group fences (one row per group).
    """
    by = list(by)
    q = quantiles(df, c, [0.25, 0.5, 0.75], by=by, names=["q1", "median", "q3"], method=method)
    q = q.withColumn("_lof", F.col("q1") - F.lit(whisker) * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hif", F.col("q3") + F.lit(whisker) * (F.col("q3") - F.col("q1")))
    x = F.col(c).cast("double")
    src = df.where(x.isNotNull())
    for k in by:
        src = src.where(F.col(k).isNotNull())
    if by:
        j = src.join(q, by, "inner")
    else:
        j = src.crossJoin(F.broadcast(q))
    inside = (x >= F.col("_lof")) & (x <= F.col("_hif"))
    agg = j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return agg


#: Bandwidths beyond which a Gaussian kernel adds nothing that a double holds (exp(-36.1) < 2.2e-16).
KERNEL_REACH = 8.5


def kde(df: DataFrame, c: str, grid: int = 200, bw: float | None = None) -> DataFrame:
    """Gaussian kernel density on ``grid`` points over [min, max], Scott
    bandwidth ``std * n^(-1/5)``.

    Equal values are collapsed first; a value then meets only the grid points
    within ``KERNEL_REACH`` bandwidths, whose numbers follow from the even
    spacing, so the work shrinks with the bandwidth as the table grows.  A
    constant column has no bandwidth: NULL densities; no value: no rows.
    """
    x = F.col(c).cast("double")
    vc = df.where(x.isNotNull()).groupBy(x.alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    h = F.lit(float(bw)) if bw else F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    st = df.agg(F.count(x).cast("double").alias("_n"), F.stddev_samp(x).alias("_sd"),
                F.min(x).alias("_mn"), F.max(x).alias("_mx")).where("_n > 0").withColumn("_h", F.when(h > 0, h))
    at = F.col("_mn") + F.col("point").cast("double") * (F.col("_mx") - F.col("_mn")) / F.lit(float(max(grid - 1, 1)))
    pts = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("point")).crossJoin(F.broadcast(st)) \
        .select("point", at.alias("x"), "_h", "_n")
    step = (F.col("_mx") - F.col("_mn")) / F.lit(float(max(grid - 1, 1)))

    def number(edge: Column, rounded) -> Column:  # of a grid point; one step is spare on either side
        return F.least(F.greatest(rounded(F.try_divide(edge - F.col("_mn"), step)), F.lit(0)), F.lit(grid - 1)).cast("int")
    reach = F.lit(KERNEL_REACH) * F.col("_h")
    near = vc.crossJoin(F.broadcast(st.where("_h IS NOT NULL AND _mx > _mn"))).withColumn("point", F.explode(F.sequence(
        number(F.col("_v") - reach - step, F.floor), number(F.col("_v") + reach + step, F.ceil))))
    z = (at - F.col("_v")) / F.col("_h")
    sums = near.groupBy("point").agg(F.sum(F.col("_k") * F.exp(F.lit(-0.5) * z * z)).alias("_s"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return pts.join(F.broadcast(sums), "point", "left").select(  # one row a grid point
        "point", "x", F.try_divide(F.coalesce("_s", F.lit(0.0)), norm).alias("density"))


def kde2d_grid(df: DataFrame, x: str, y: str, bins: int = 20, hue: str | None = None) -> DataFrame:
    """2-D binned density (counts per equal-width cell) and mean hue per cell."""
    from ratelens.operators.derive import cut_code
    mm = df.agg(F.min(F.col(x).cast("double")).alias("_xmn"), F.max(F.col(x).cast("double")).alias("_xmx"),
                F.min(F.col(y).cast("double")).alias("_ymn"), F.max(F.col(y).cast("double")).alias("_ymx"))
    j = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).crossJoin(F.broadcast(mm))
    bx = cut_code(F.col(x).cast("double"), F.col("_xmn"), F.col("_xmx"), bins)
    by_ = cut_code(F.col(y).cast("double"), F.col("_ymn"), F.col("_ymx"), bins)
    aggs = [F.count(F.lit(1)).alias("count")]
    if hue:
        aggs.append(F.avg(F.col(hue).cast("double")).alias(f"mean_{hue}"))
    return j.groupBy(bx.alias("bin_x"), by_.alias("bin_y")).agg(*aggs)


def kde2d(df: DataFrame, x: str, y: str, grid: int = 50, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of two columns on ``grid`` x ``grid`` points, ``cut`` bandwidths beyond the data.

    The kernel has the covariance of the complete rows times Scott's factor
    ``n^(-1/6)`` squared.  Each row is shared out linearly among the four grid
    points around it, so rows collapse map-side to at most ``grid``^2 masses;
    those are then smoothed, work that the table's size does not change.
    Output: ``point_x, point_y, x, y, density``.  Columns without spread or on
    one line have no kernel: NULL densities; without complete rows no rows.
    """
    d = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop()
    f = F.pow(F.col("_n"), F.lit(-1.0 / 6))
    st = d.agg(F.count("_x").cast("double").alias("_n"), *[g for c in ("_x", "_y") for g in (
        F.min(c).alias(f"{c}mn"), F.max(c).alias(f"{c}mx"), F.var_samp(c).alias(f"{c}v"))], F.covar_samp("_x", "_y").alias("_cov")).where("_n > 0")
    for c in ("_x", "_y"):
        reach = F.lit(cut) * F.coalesce(F.sqrt(f"{c}v"), F.lit(0.0)) * f
        st = st.withColumn(f"{c}lo", F.col(f"{c}mn") - reach).withColumn(f"{c}st", (F.col(f"{c}mx") + reach - F.col(f"{c}lo")) / F.lit(float(grid - 1)))
    # the inverse of the kernel's covariance
    det = F.col("_xv") * F.col("_yv") - F.col("_cov") * F.col("_cov")
    st = st.withColumn("_det", F.when(det > 1e-12 * F.col("_xv") * F.col("_yv"), det * F.pow(f, 4)))
    st = st.withColumn("_a", F.col("_yv") * f * f / F.col("_det")).withColumn("_b", F.col("_cov") * f * f / F.col("_det")) \
           .withColumn("_c", F.col("_xv") * f * f / F.col("_det"))
    st = F.broadcast(st)

    def place(c: str) -> tuple[Column, Column]:
        at = (F.col(c) - F.col(f"{c}lo")) / F.col(f"{c}st")
        low = F.least(F.greatest(F.floor(at), F.lit(0)), F.lit(grid - 2))
        return low, at - low
    (ix, wx), (iy, wy) = place("_x"), place("_y")
    shares = F.array(*[F.struct((ix + i).cast("int").alias("i"), (iy + j).cast("int").alias("j"),
                                ((wx if i else 1 - wx) * (wy if j else 1 - wy)).alias("w")) for i in (0, 1) for j in (0, 1)])
    mass = (d.crossJoin(st.where("_det IS NOT NULL")).select(F.inline(shares)).where("w > 0")
            .groupBy("i", "j").agg(F.sum("w").alias("w")))
    axis = df.sparkSession.range(grid)
    points = (axis.select(F.col("id").cast("int").alias("point_x")).crossJoin(F.broadcast(axis.select(F.col("id").cast("int").alias("point_y")))).crossJoin(st))
    dx, dy = (F.col("point_x") - F.col("i")) * F.col("_xst"), (F.col("point_y") - F.col("j")) * F.col("_yst")
    kernel = F.exp(-0.5 * (F.col("_a") * dx * dx - 2 * F.col("_b") * dx * dy + F.col("_c") * dy * dy))
    # at most grid^2 masses meet grid^2 points
    sums = points.crossJoin(F.broadcast(mass)).groupBy("point_x", "point_y").agg(F.sum(F.col("w") * kernel).alias("s"))
    norm = 2 * math.pi * F.sqrt("_det") * F.col("_n")
    return points.join(sums, ["point_x", "point_y"], "left").select(
        "point_x", "point_y", (F.col("_xlo") + F.col("point_x") * F.col("_xst")).alias("x"), (F.col("_ylo") + F.col("point_y") * F.col("_yst")).alias("y"),
        (F.col("s") / norm).alias("density"))
