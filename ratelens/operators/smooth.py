"""LOWESS (T8): Cleveland's locally weighted linear regression with tricube
weights and bisquare robustness iterations, over all points.

The curve is fitted at a bounded number of anchors, spread by rank over the
distinct x, and joined by straight lines between them (``delta`` of the
classical routine does the same).  With as many anchors as distinct x it is
the fit at every point.

* rows collapse to the distinct x (count, weighted sums): a hot x is one row;
* an anchor's bandwidth is its exact distance to the k-th nearest point: the
  least ``max(|a - x_i|, |x_(i+k-1) - a|)`` over windows of k neighbouring
  ranks.  One window starts at each distinct x; its end is found by an equal
  join on blocks of ranks;
* anchors are a table of at most ``anchors`` rows, so the broadcast has a
  known bound; each distinct x adds to the power sums of the anchors in whose
  band it lies, and those are summed map-side;
* residuals, their exact median and the bisquare weights are DataFrame
  expressions; each robustness round is written to the shared checkpoint
  folder, so a lost executor never replays earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.operators.quantiles import quantiles, value_offsets
from ratelens.sources.sinks import stage

#: Blocks of ranks in the window join (a value of many rows stands in as many of them as it fills).
RANK_BLOCKS = 4096


def _bandwidths(ranks: DataFrame, at: DataFrame, k: int, n: int) -> DataFrame:
    """``a, h``: each anchor with the distance to its k-th nearest point."""
    size = max(1, -(-n // RANK_BLOCKS))
    ends = ranks.select(F.col("x").alias("hi"), F.col("before").alias("_b"), F.col("n").alias("_n"), F.explode(F.sequence(
        F.call_function("div", "before", F.lit(size)), F.call_function("div", F.col("before") + F.col("n") - 1, F.lit(size)))).alias("_blk"))
    starts = ranks.select(F.col("x").alias("lo"), (F.col("before") + (k - 1)).alias("_last")).where(F.col("_last") < n) \
        .withColumn("_blk", F.call_function("div", "_last", F.lit(size)))
    spans = starts.join(ends, "_blk").where("_last >= _b AND _last < _b + _n").select("lo", "hi")
    far = F.greatest(F.abs(F.col("a") - F.col("lo")), F.abs(F.col("hi") - F.col("a")))
    return spans.crossJoin(F.broadcast(at)).groupBy("a").agg(F.min(far).alias("h"))


def _fits(sums: DataFrame, bands: DataFrame) -> DataFrame:
    """``a, fit`` from ``x, s0, sy`` (weights and weighted y of each distinct x)."""
    u = F.col("x") - F.col("a")  # centred at the anchor, so the line's value there is its intercept
    near = sums.join(F.broadcast(bands), (F.abs(u) < F.col("h")) | (u == 0))
    r = F.when(F.col("h") > 0, F.abs(u) / F.col("h")).otherwise(F.lit(0.0))
    w = F.pow(1 - r * r * r, 3)
    g = near.select("a", "h", w.alias("w"), u.alias("u"), "s0", "sy").groupBy("a").agg(
        F.sum(F.col("w") * F.col("s0")).alias("p0"), F.sum(F.col("w") * F.col("s0") * F.col("u")).alias("p1"),
        F.sum(F.col("w") * F.col("s0") * F.col("u") * F.col("u")).alias("p2"), F.sum(F.col("w") * F.col("sy")).alias("q0"),
        F.sum(F.col("w") * F.col("sy") * F.col("u")).alias("q1"), F.first("h").alias("h"))
    det = F.col("p0") * F.col("p2") - F.col("p1") * F.col("p1")
    line = F.try_divide(F.col("p2") * F.col("q0") - F.col("p1") * F.col("q1"), det)
    level = F.try_divide("q0", "p0")
    # no spread of x in the band: the weighted mean
    return g.select("a", F.when(det > F.lit(1e-12) * F.col("p0") * F.col("p0") * F.col("h") * F.col("h"), line).otherwise(level).alias("fit"))


def _interpolated(pts: DataFrame, fits: DataFrame) -> DataFrame:
    """Each row with the line between its two neighbouring anchors."""
    nxt = Window.orderBy("a")  # one row an anchor
    segments = (fits.where("fit IS NOT NULL").withColumn("a2", F.lead("a").over(nxt)).withColumn("fit2", F.lead("fit").over(nxt))
                .agg(F.array_sort(F.collect_list(F.struct("a", "fit", "a2", "fit2"))).alias("seg")))
    j = pts.crossJoin(F.broadcast(segments)).withColumn("at", F.filter("seg", lambda s: s["a"] <= F.col("x"))[F.size(
        F.filter("seg", lambda s: s["a"] <= F.col("x"))) - 1])
    t = F.try_divide(F.col("x") - F.col("at.a"), F.col("at.a2") - F.col("at.a"))
    fit = F.when(F.col("at.a2").isNull() | (F.col("x") == F.col("at.a")), F.col("at.fit")).otherwise(
        F.col("at.fit") + t * (F.col("at.fit2") - F.col("at.fit")))
    return j.withColumn("fit", fit).drop("seg", "at")


def lowess(df: DataFrame, x: str, y: str, frac: float = 0.3, iterations: int = 3, anchors: int = 300) -> DataFrame:
    """Smoothed curve of ``y`` on ``x``: rows ``x, y, fit``, one for each complete row.

    NULL pairs are dropped; no other row is.  ``anchors`` bounds the places
    where the regression is evaluated (first and last distinct x included).
    Empty input raises.
    """
    if anchors < 2:
        raise ValueError("at least two anchors")
    pts = stage(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop(), "lowess") \
        .withColumn("rw", F.lit(1.0))
    n = pts.count()
    if n == 0:
        raise ValueError("no point left for LOWESS")
    k = max(1, int(frac * n + 1e-10))
    ranks = stage(value_offsets(pts, "x").select("x", "n", "before"), "lowess")
    wanted = [i * (n - 1) // (anchors - 1) for i in range(anchors)]
    # the values at at most ``anchors`` ranks
    at = ranks.where(F.exists(F.array(*[F.lit(r) for r in sorted(set(wanted))]),
                              lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))).select(F.col("x").alias("a"))
    bands = stage(_bandwidths(ranks, at, k, n), "lowess")
    for it in range(iterations + 1):
        sums = pts.groupBy("x").agg(F.sum("rw").alias("s0"), F.sum(F.col("rw") * F.col("y")).alias("sy"))
        fitted = _interpolated(pts.drop("rw"), _fits(sums, bands))
        if it == iterations:
            return fitted.select("x", "y", "fit")
        res = stage(fitted.withColumn("_ares", F.abs(F.col("y") - F.col("fit"))), "lowess")
        med = quantiles(res, "_ares", [0.5], names=["_s"])
        r = F.try_divide(F.col("_ares"), F.lit(6.0) * F.col("_s"))
        bis = F.when(F.col("_s") <= 0, F.lit(1.0)).when(r < 1.0, (1 - r * r) * (1 - r * r)).otherwise(0.0)
        pts = res.crossJoin(F.broadcast(med)).select("x", "y", bis.alias("rw"))
    return pts
