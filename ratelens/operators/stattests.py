"""Correlation grids, group tests (T1–T7) and the average-rank tool.

Every statistic is an aggregate: one ``agg`` for all Pearson pairs, a
(value, count) rank table for Spearman and Kruskal–Wallis, a per-group
``agg`` then a second one-row ``agg`` for ANOVA.  p-values are evaluated on
the few aggregated rows (``functions.pvalues``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.expr import nan_to_null
from ratelens.functions.pvalues import chi2_sf_col, f_sf_col, pearson_p_col
from ratelens.operators.quantiles import value_offsets

# fixed values: default variables and Pearson column mapping of the study
DEFAULT_EFFORT_VARS = ("log_minutes", "n_steps", "n_ingredients", "effort_score")
DEFAULT_POPULARITY_VARS = ("bayes_mean", "wilson_lb", "interactions_per_month")
PEARSON_MAP_EFFORT = {"log_minutes": "log_minutes", "n_steps": "n_steps",
                      "n_ingredients": "log_n_ingredients", "effort_score": "effort_score"}
PEARSON_MAP_POPULARITY = {"bayes_mean": "bayes_mean", "wilson_lb": "wilson_lb",
                          "interactions_per_month": "log1p_interactions_per_month_w"}


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson for every pair (one ``agg``), long form
    ``x, y, coef, n`` with both orders of every pair and 1.0 on the diagonal
    (NULL for a column with fewer than 2 values)."""
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j <= i:
                continue
            k = len(pairs)
            pairs.append((a, b))
            xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
            aggs += [F.corr(xa, xb).alias(f"_r{k}"), F.count_if(xa.isNotNull() & xb.isNotNull()).alias(f"_n{k}")]
    for i, a in enumerate(cols):
        x = F.col(a).cast("double")
        aggs += [F.count(x).alias(f"_dn{i}"), F.stddev_pop(x).alias(f"_ds{i}")]
    row = df.agg(*aggs)
    parts = []
    for k, (a, b) in enumerate(pairs):
        parts += [f"'{a}', '{b}', _r{k}, _n{k}", f"'{b}', '{a}', _r{k}, _n{k}"]
    for i, a in enumerate(cols):
        parts.append(f"'{a}', '{a}', CASE WHEN _dn{i} >= 2 AND _ds{i} > 0 THEN 1.0D END, _dn{i}")
    return row.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (x, y, coef, n)")


def pearson_grid(df: DataFrame, effort_vars: Sequence[str] = DEFAULT_EFFORT_VARS,
                 popularity_vars: Sequence[str] = DEFAULT_POPULARITY_VARS,
                 effort_map: Mapping[str, str] | None = None,
                 popularity_map: Mapping[str, str] | None = None,
                 with_p: bool = True) -> DataFrame:
    """Pearson r, p and n for every (effort, popularity) label pair.

    Labels are first mapped to transformed columns; a pair with fewer than
    3 complete rows gets NULL r and p (n kept); an absent column gives NULLs.
    """
    emap = effort_map if effort_map is not None else PEARSON_MAP_EFFORT
    pmap = popularity_map if popularity_map is not None else PEARSON_MAP_POPULARITY
    aggs, rows = [], []
    for e in effort_vars:
        for p in popularity_vars:
            ec, pc = emap.get(e, e), pmap.get(p, p)
            k = len(rows)
            rows.append((e, p, ec, pc))
            if ec in df.columns and pc in df.columns:
                xa, xb = F.col(ec).cast("double"), F.col(pc).cast("double")
                aggs += [F.corr(xa, xb).alias(f"_r{k}"),
                         F.count_if(xa.isNotNull() & xb.isNotNull()).alias(f"_n{k}")]
            else:
                aggs += [F.lit(None).cast("double").alias(f"_r{k}"), F.lit(None).cast("long").alias(f"_n{k}")]
    row = df.agg(*aggs)
    parts = [f"'{e}', '{p}', '{ec}', '{pc}', CASE WHEN _n{k} >= 3 THEN _r{k} END, _n{k}"
             for k, (e, p, ec, pc) in enumerate(rows)]
    out = row.selectExpr(
        f"stack({len(rows)}, {', '.join(parts)}) as (effort, popularity, x_col, y_col, coef, n)")
    if with_p:
        out = out.withColumn("p_value", pearson_p_col(F.col("coef"), F.col("n")))
    return out


def _partner_ranks(rows: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """``col, value, ranks, means``: for each value of a column its average rank, and the mean rank, among the rows in which
    each partner column is there (the others of the grid, in their order).

    Each row brings one value a column, and those collapse map-side to counts
    of (column, value, which columns the row holds).
    """
    names = [*xs, *ys]
    held = sum((F.when(F.col(f"`{c}`").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(names)), F.lit(0))
    parts = ", ".join(f"{i}, `{c}`" for i, c in enumerate(names))
    per = rows.withColumn("_held", held).selectExpr("_held", f"stack({len(names)}, {parts}) as (col, value)") \
        .where("value IS NOT NULL").groupBy("col", "value", "_held").agg(F.count(F.lit(1)).alias("c"))
    # partner p of an effort column is popularity column p, and the other way round
    partners = max(len(xs), len(ys))

    def there(p: int):
        mine = F.col("col") < len(xs)
        bit = F.when(mine & F.lit(p < len(ys)), F.lit(1 << (len(xs) + min(p, len(ys) - 1)))).when(~mine & F.lit(p < len(xs)), F.lit(1 << min(p, len(xs) - 1)))
        return F.when(F.col("_held").bitwiseAND(bit) > 0, F.col("c")).otherwise(F.lit(0))
    weights = [f"w{p}" for p in range(partners)]
    vo = value_offsets(per.select("col", "value", "c", *[there(p).alias(w) for p, w in enumerate(weights)]), "value", by=["col"], weight="c", more=weights)
    return vo.select("col", "value", F.array(*[F.col(f"before_{w}") + (F.col(f"n_{w}") + 1) / 2.0 for w in weights]).alias("ranks"),
                     F.array(*[(F.col(f"total_{w}") + 1) / 2.0 for w in weights]).alias("means"))


def spearman_grid(df: DataFrame, effort_vars: Sequence[str] = DEFAULT_EFFORT_VARS,
                  popularity_vars: Sequence[str] = DEFAULT_POPULARITY_VARS,
                  with_p: bool = True) -> DataFrame:
    """Spearman rho (average ranks within each pair's complete rows), p, n.

    Values are ranked once a column, with one rank for each partner column (a
    row without the partner's value counts for the others only); each row
    looks its ranks up, and one aggregate holds all pairs.
    """
    xs = [c for c in effort_vars if c in df.columns]
    ys = [c for c in popularity_vars if c in df.columns]
    parts = []
    if not xs or not ys:
        row = df.sparkSession.range(1)
    else:
        names = list(dict.fromkeys([*xs, *ys]))
        rows = df.select(*[nan_to_null(F.col(f"`{c}`").cast("double")).alias(c) for c in names])
        ranks = _partner_ranks(rows, xs, ys)
        for i, c in enumerate([*xs, *ys]):
            own = ranks.where(F.col("col") == i).select(F.col("value").alias(f"_v{i}"), F.col("ranks").alias(f"_r{i}"), F.col("means").alias(f"_m{i}"))
            rows = rows.join(own, F.col(f"`{c}`") == F.col(f"_v{i}"), "left")
        aggs = []
        for i in range(len(xs)):
            for j in range(len(ys)):
                y = len(xs) + j
                dx, dy = F.get(f"_r{i}", F.lit(j)) - F.get(f"_m{i}", F.lit(j)), F.get(f"_r{y}", F.lit(i)) - F.get(f"_m{y}", F.lit(i))
                both = F.col(f"_v{i}").isNotNull() & F.col(f"_v{y}").isNotNull()
                aggs += [F.sum(F.when(both, v)).alias(f"_{n}{i}_{j}") for n, v in (("xy", dx * dy), ("xx", dx * dx), ("yy", dy * dy))] + [
                    F.count_if(both).alias(f"_n{i}_{j}")]
        row = rows.agg(*aggs)
    for e in effort_vars:
        for p in popularity_vars:
            if e in xs and p in ys:
                k = f"{xs.index(e)}_{ys.index(p)}"
                parts.append(f"'{e}', '{p}', CASE WHEN _n{k} >= 3 AND _xx{k} > 0 AND _yy{k} > 0 THEN _xy{k} / sqrt(_xx{k} * _yy{k}) END, _n{k}")
            else:  # absent columns: NULL n, as in the reference (the whole cell stays empty)
                parts.append(f"'{e}', '{p}', CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)")
    res = row.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (effort, popularity, coef, n)")
    if with_p:
        res = res.withColumn("p_value", pearson_p_col(F.col("coef"), F.col("n")))
    return res


def nonlinearity(df: DataFrame, x: str, ys: Sequence[str], factor: float = 1.1) -> DataFrame:
    """Pearson and Spearman of x against each y on the listwise-complete
    rows; ``nonlinear`` when ``|spearman| > 1.1 |pearson|``."""
    clean = df.select(x, *ys).na.drop()
    pe = pearson_grid(clean, [x], ys, {}, {}, with_p=False).select(
        "popularity", F.col("coef").alias("pearson"))
    sp = spearman_grid(clean, [x], ys, with_p=False).select(
        "popularity", F.col("coef").alias("spearman"))
    j = pe.join(sp, "popularity")
    return j.select(F.lit(x).alias("x"), F.col("popularity").alias("y"), "pearson", "spearman",
                    (F.abs("spearman") > F.lit(factor) * F.abs("pearson")).alias("nonlinear"))


def pivot_matrix(long: DataFrame, index: str = "effort", columns: str = "popularity",
                 values: str = "coef", order: Sequence[str] | None = None,
                 fmt: str | None = None, digits: int | None = 3) -> DataFrame:
    """Long -> matrix (rows = index, columns = known values), rounded or
    formatted (``fmt='%.3g'`` for p-values)."""
    from ratelens.functions.expr import general_format, round_half_even
    v = F.col(values)
    if fmt:
        general = re.fullmatch(r"%\.(\d+)g", fmt)
        v = general_format(v, int(general[1])) if general else F.format_string(fmt, v)
    elif digits is not None:
        v = round_half_even(v, digits)
    src = long.select(index, columns, v.alias("_v"))
    keys = list(order) if order is not None else None
    return src.groupBy(index).pivot(columns, keys).agg(F.first("_v"))


def _group_frame(df: DataFrame, group_col: str, metrics: Sequence[str], na: str) -> DataFrame:
    if group_col not in df.columns:
        raise KeyError(f"column '{group_col}' not found")
    missing = [m for m in metrics if m not in df.columns]
    if missing and na == "listwise":
        raise KeyError(f"columns {missing} not found")
    clean = df.where(F.col(group_col).isNotNull())
    if na == "listwise":
        for m in metrics:
            clean = clean.where(F.col(m).isNotNull())
    return clean


def anova(df: DataFrame, group_col: str, metrics: Sequence[str], na: str = "listwise",
          with_p: bool = True) -> DataFrame:
    """T4: one-way ANOVA F per metric; groups with no value are ignored.

    ``na='listwise'`` drops rows with NULL group or any NULL metric (the
    library); ``'per_metric'`` drops per metric (study B).  Centred sums:
    ``SSB = sum n_i (m_i - m)^2``, ``SSW = sum (n_i - 1) v_i``.
    """
    clean = _group_frame(df, group_col, metrics, na)
    present = [m for m in metrics if m in df.columns]
    # one grouping of the rows for all metrics, then one small row a group and metric
    aggs = []
    for i, m in enumerate(present):
        x = F.col(m).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"), F.var_samp(x).alias(f"_v{i}")]
    parts = ", ".join(f"'{m}', _n{i}, _m{i}, _v{i}" for i, m in enumerate(present))
    g = clean.groupBy(group_col).agg(*aggs).selectExpr(f"stack({len(present)}, {parts}) as (metric, _ni, _mi, _vi)").where("_ni > 0")
    tot = g.groupBy("metric").agg(F.sum("_ni").alias("_N"), (F.sum(F.col("_ni") * F.col("_mi")) / F.sum("_ni")).alias("_gm"),
                                  F.count(F.lit(1)).alias("_k"))  # one row a metric
    s = g.join(F.broadcast(tot), "metric").groupBy("metric", "_N", "_k").agg(
        F.sum(F.col("_ni") * (F.col("_mi") - F.col("_gm")) * (F.col("_mi") - F.col("_gm"))).alias("_ssb"),
        F.sum((F.col("_ni") - 1) * F.coalesce(F.col("_vi"), F.lit(0.0))).alias("_ssw"))
    # no spread inside the groups, one group, or one row a group: NULL
    out = s.select("metric", F.lit("anova").alias("method"),
                   F.try_divide(F.try_divide("_ssb", F.col("_k") - 1), F.try_divide("_ssw", F.col("_N") - F.col("_k"))).alias("statistic"),
                   F.col("_k").cast("long").alias("n_groups"), F.col("_N").cast("long").alias("n_total"),
                   (F.col("_k") - 1).alias("_d1"), (F.col("_N") - F.col("_k")).alias("_d2"))
    if with_p:
        out = out.withColumn("p_value", f_sf_col(F.col("statistic"), F.col("_d1"), F.col("_d2")))
    return out.drop("_d1", "_d2")


def kruskal(df: DataFrame, group_col: str, metrics: Sequence[str], na: str = "listwise",
            with_p: bool = True, buckets: int | None = None) -> DataFrame:
    """T5: Kruskal–Wallis H with tie correction; chi-square p with k-1 df.

    Rows collapse to (group, value, count); pooled average ranks come from
    the value table; rank sums per group are a weighted aggregate.
    """
    clean = _group_frame(df, group_col, metrics, na)
    out = None
    for m in [m for m in metrics if m in df.columns]:
        x = F.col(m).cast("double")
        gv = clean.where(x.isNotNull()).groupBy(group_col, x.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
        vt = gv.groupBy("_v").agg(F.sum("_c").alias("_c"))
        vo = value_offsets(vt, "_v", weight="_c", buckets=buckets).select(
            F.col("_v").alias("_rv"), (F.col("before") + (F.col("n") + 1) / 2.0).alias("_rank"),
            F.col("n").alias("_t"), F.col("total").alias("_N"))
        j = gv.join(vo, gv._v == vo._rv)
        per = j.groupBy(group_col).agg(F.sum(F.col("_c") * F.col("_rank")).alias("_R"),
                                       F.sum("_c").alias("_ni"), F.first("_N").alias("_N"),
                                       # t^3 - t of each value, shared out over its t rows
                                       F.sum(F.col("_c") * (F.pow(F.col("_t").cast("double"), 2) - 1)).alias("_tg"))
        s = per.groupBy().agg(F.sum(F.col("_R") * F.col("_R") / F.col("_ni")).alias("_sr"),
                              F.count(F.lit(1)).alias("_k"), F.first("_N").alias("_N"), F.sum("_tg").alias("_tt"))
        n = F.col("_N").cast("double")
        h = (F.try_divide(F.lit(12.0), n * (n + 1)) * F.col("_sr") - F.lit(3.0) * (n + 1))
        corr = F.lit(1.0) - F.try_divide(F.col("_tt"), n * n * n - n)
        r = s.select(F.lit(m).alias("metric"), F.lit("kruskal").alias("method"),
                     F.try_divide(h, corr).alias("statistic"), F.col("_k").cast("long").alias("n_groups"),
                     F.col("_N").cast("long").alias("n_total"))
        out = r if out is None else out.unionByName(r)
    if with_p:
        out = out.withColumn("p_value", chi2_sf_col(F.col("statistic"), F.col("n_groups") - 1))
    return out


def group_tests(df: DataFrame, group_col: str, metrics: Sequence[str],
                methods: Sequence[str] = ("anova", "kruskal"), na: str = "listwise") -> DataFrame:
    """T4 + T5 as the library's ``run_group_tests``: one row per metric and method;
    fewer than 2 groups -> the job fails.  Sizes: :func:`group_test_sizes`."""
    for mth in methods:
        if mth not in ("anova", "kruskal"):
            raise ValueError(f"test '{mth}' not supported")
    parts = []
    if "anova" in methods:
        parts.append(anova(df, group_col, metrics, na))
    if "kruskal" in methods:
        parts.append(kruskal(df, group_col, metrics, na))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("statistic", F.when(F.col("n_groups") >= 2, F.col("statistic"))
                          .otherwise(F.raise_error(F.lit("at least two groups are required")).cast("double")))


def group_test_sizes(df: DataFrame, group_col: str, metrics: Sequence[str], na: str = "listwise") -> DataFrame:
    """``metric, group, size``: the rows that each group brings to each test, one row each."""
    clean = _group_frame(df, group_col, metrics, na)
    present = [m for m in metrics if m in df.columns]
    counts = clean.groupBy(F.col(group_col).cast("string").alias("group")).agg(
        *[F.count(F.col(m).cast("double")).alias(f"_n{i}") for i, m in enumerate(present)])
    parts = ", ".join(f"'{m}', _n{i}" for i, m in enumerate(present))
    return counts.selectExpr("group", f"stack({len(present)}, {parts}) as (metric, size)").select("metric", "group", "size")
