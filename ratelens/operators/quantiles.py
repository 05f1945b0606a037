"""Exact order statistics at any scale: quantiles (numpy ``linear`` rule) and
average ranks over ties (W2).

Two physical strategies behind one call:

* ``map``  — Spark's ``percentile`` aggregate.  Each partial buffer is a
  value -> count map, so its memory is bounded by the number of distinct
  values.  Used when a cheap ``approx_count_distinct`` says that number is
  at most ``MAP_LIMIT``.
* ``rank`` — rank selection.  Rows collapse to (value, count) with map-side
  combine (a hot value costs one row), the distinct values are cut into
  ordered buckets by sampled bounds, a cumulative count runs per bucket
  (a window partitioned by bucket, never one global task), bucket offsets
  come from a table with one row per bucket, and the wanted order
  statistics are picked with conditional aggregates.  Nothing grows on one
  task or on the driver except the bucket bounds (at most ``MAX_BUCKETS``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAP_LIMIT = 200_000          # distinct values up to which ``percentile`` is used
ROWS_PER_BUCKET = 1_000_000  # distinct values per window partition in ``rank``
MAX_BUCKETS = 4096


def _estimate_distinct(df: DataFrame, x: str) -> int:
    return int(df.agg(F.approx_count_distinct(F.col(x), 0.05)).first()[0] or 0)


def _default_method(df: DataFrame, method: str) -> str:
    if method != "auto":
        return method
    return df.sparkSession.conf.get("ratelens.quantiles.method", "auto") or "auto"


def choose_methods(df: DataFrame, cols, method: str = "auto") -> dict[str, str]:
    """Strategy per column; ``auto`` runs one HLL estimate job for all columns."""
    method = _default_method(df, method)
    cols = list(dict.fromkeys(cols))
    if method != "auto":
        return {c: method for c in cols}
    row = df.agg(*[F.approx_count_distinct(F.col(c), 0.05).alias(f"_d{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: ("map" if (row[i] or 0) <= MAP_LIMIT else "rank") for i, c in enumerate(cols)}


def choose_method(df: DataFrame, x: str, method: str = "auto") -> str:
    return choose_methods(df, [x], method)[x]


def _bucket_of(x: Column, bounds: Sequence[float]) -> Column:
    """Number of bounds strictly below ``x`` by binary search (O(log B) per row)."""
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    steps = max(1, math.ceil(math.log2(len(bounds) + 1)))
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.shiftright(lo + hi, 1)
        right = F.struct((mid + 1).alias("lo"), hi.alias("hi"))
        left = F.struct(lo.alias("lo"), mid.alias("hi"))
        return F.when(lo < hi, F.when(F.element_at(arr, mid + 1) < x, right).otherwise(left)) \
                .otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def value_offsets(df: DataFrame, x: str, by: Sequence[str] = (), buckets: int | None = None,
                  weight: str | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL values with their multiplicity and position.

    Returns ``by..., x, n, before, total``: ``before`` = rows of the group with
    a smaller value, ``total`` = non-NULL rows of the group.  With ``weight``
    each input row stands for that many rows (pre-aggregated input); every
    column in ``more`` is a further such weight ``w``, placed along the same
    order as ``n_w, before_w, total_w``.
    """
    by = list(by)
    cnt = F.sum(F.col(weight)).cast("long") if weight else F.count(F.lit(1))
    src = df.select(*by, F.col(x).cast("double").alias(x), *([weight] if weight else []), *more)
    dc = src.where(F.col(x).isNotNull()).groupBy(*by, x).agg(cnt.alias("n"), *[F.sum(w).cast("long").alias(f"n_{w}") for w in more])
    ends = ["", *[f"_{w}" for w in more]]
    if buckets is None:
        est = _estimate_distinct(df, x)
        buckets = 1 if est <= ROWS_PER_BUCKET else min(MAX_BUCKETS, math.ceil(est / ROWS_PER_BUCKET))
    if buckets <= 1:
        w_local = Window.partitionBy(*by).orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
        return dc.select("*", *[F.coalesce(F.sum(f"n{e}").over(w_local), F.lit(0)).alias(f"before{e}") for e in ends],
                         *[F.sum(f"n{e}").over(Window.partitionBy(*by)).alias(f"total{e}") for e in ends])
    probs = [i / buckets for i in range(1, buckets)]
    # bucket bounds: a bounded array (< MAX_BUCKETS values) fixed once as a literal
    bounds = dc.agg(F.percentile_approx(x, probs, 10 * buckets)).first()[0] or []
    b = dc.withColumn("_b", _bucket_of(F.col(x), sorted(bounds)))
    w_local = Window.partitionBy(*by, "_b").orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    b = b.select("*", *[F.coalesce(F.sum(f"n{e}").over(w_local), F.lit(0)).alias(f"_before{e}") for e in ends])
    totals = b.groupBy(*by, "_b").agg(*[F.sum(f"n{e}").alias(f"_bt{e}") for e in ends])
    w_off = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*by, "_b", *[F.coalesce(F.sum(f"_bt{e}").over(w_off), F.lit(0)).alias(f"_off{e}") for e in ends],
                         *[F.sum(f"_bt{e}").over(Window.partitionBy(*by)).alias(f"total{e}") for e in ends])
    if not by:
        offs = F.broadcast(offs)  # at most MAX_BUCKETS rows
    out = b.join(offs, [*by, "_b"], "inner")
    return out.select(*by, x, *[f"n{e}" for e in ends], *[(F.col(f"_off{e}") + F.col(f"_before{e}")).alias(f"before{e}") for e in ends],
                      *[f"total{e}" for e in ends])


def quantiles(df: DataFrame, x: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, method: str = "auto", buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``x`` per group (NULLs skipped).

    Returns ``by..., names...``; a group with no value gives NULLs.
    """
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    m = choose_method(df, x, method)
    if m == "map":
        arr = F.percentile(F.col(x).cast("double"), F.array(*[F.lit(float(p)) for p in probs]))
        agg = df.groupBy(*by).agg(arr.alias("_q"))
        return agg.select(*by, *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])
    vo = value_offsets(df, x, by) if buckets is None else value_offsets(df, x, by, buckets)
    n1 = F.col("total") - 1
    lo_hi = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * n1
        lo, hi = F.floor(pos), F.ceil(pos)
        hit_lo = (lo >= F.col("before")) & (lo < F.col("before") + F.col("n"))
        hit_hi = (hi >= F.col("before")) & (hi < F.col("before") + F.col("n"))
        lo_hi += [F.max(F.when(hit_lo, F.col(x))).alias(f"_lo{i}"),
                  F.max(F.when(hit_hi, F.col(x))).alias(f"_hi{i}")]
    agg = vo.groupBy(*by).agg(F.max("total").alias("_total"), *lo_hi)
    outs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        a, b = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.when((hi == lo) | (a == b), a)
                     .otherwise((hi - pos) * a + (pos - lo) * b).alias(names[i]))
    return agg.select(*by, *outs)


def multi_quantiles(df: DataFrame, spec, method: str = "auto") -> DataFrame:
    """One row of exact quantiles for several columns: ``spec = {col: (probs, names)}``.

    Columns on the ``map`` strategy share one aggregate (one pass); columns
    on the ``rank`` strategy get their own rank selection.
    """
    methods = choose_methods(df, list(spec), method)
    maps = [c for c in spec if methods[c] == "map"]
    row = None
    if maps:
        aggs = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in spec[c][0]]))
                .alias(f"_mq{i}") for i, c in enumerate(maps)]
        sel = [F.col(f"_mq{i}")[k].alias(nm) for i, c in enumerate(maps)
               for k, nm in enumerate(spec[c][1])]
        row = df.agg(*aggs).select(*sel)
    for c in spec:
        if methods[c] != "rank":
            continue
        q = quantiles(df, c, spec[c][0], names=spec[c][1], method="rank")
        row = q if row is None else row.crossJoin(q)
    return row


def average_rank(df: DataFrame, x: str, by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """1-based average rank of ``x`` over ties, per group; NULL x keeps NULL rank.

    The ranks come from the (value, count) table and are joined back on the
    value, so a hot value is one row on the ranking side.
    """
    by = list(by)
    out = out or f"{x}_rank"
    vo = value_offsets(df, x, by)
    r = vo.select(*[F.col(c).alias(f"_rk_{c}") for c in by], F.col(x).alias("_rv"),
                  (F.col("before") + (F.col("n") + 1) / 2.0).alias(out))
    cond = [F.col(c).eqNullSafe(F.col(f"_rk_{c}")) for c in by]
    cond.append(F.col(x).cast("double") == F.col("_rv"))
    ranked = df.where(F.col(x).isNotNull()).join(r, cond, "left").drop("_rv", *[f"_rk_{c}" for c in by])
    # rows without a value never meet in one partition of the join
    return ranked.unionByName(df.where(F.col(x).isNull()).withColumn(out, F.lit(None).cast("double")))
