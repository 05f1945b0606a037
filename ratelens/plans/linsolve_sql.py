"""SQL text for least squares on centred cross-products (oracle side).

Gaussian elimination without pivoting on the symmetric positive definite
normal equations, unrolled into CTEs over a single row.  Used to check the
MLlib fits independently on DuckDB.
"""

from __future__ import annotations

from collections.abc import Sequence


def ols_sql(src: str, features: Sequence[str], target: str, prefix: str = "ls") -> tuple[str, str]:
    """Return ``(ctes, final_select)`` computing ``term, coef, r2, n`` rows."""
    p = len(features)
    x = [f'CAST("{f}" AS DOUBLE)' for f in features]
    y = f'CAST("{target}" AS DOUBLE)'
    nn = " AND ".join([f'"{f}" IS NOT NULL' for f in features] + [f'"{target}" IS NOT NULL'])
    ctes = [f"{prefix}_d AS (SELECT {', '.join(f'{x[i]} AS x{i}' for i in range(p))}, {y} AS y "
            f"FROM {src} WHERE {nn})",
            f"{prefix}_m AS (SELECT {', '.join(f'avg(x{i}) AS mx{i}' for i in range(p))}, avg(y) AS my, "
            f"count(*) AS n FROM {prefix}_d)"]
    a = [f"sum((x{i} - mx{i}) * (x{j} - mx{j})) AS a{i}_{j}" for i in range(p) for j in range(p)]
    b = [f"sum((x{i} - mx{i}) * (y - my)) AS b{i}" for i in range(p)]
    keep = [f"any_value(mx{i}) AS mx{i}" for i in range(p)] + ["any_value(my) AS my", "any_value(n) AS n"]
    ctes.append(f"{prefix}_s0 AS (SELECT {', '.join(a + b + keep)}, sum((y - my) * (y - my)) AS syy, "
                f"{', '.join(f'sum((x{i} - mx{i}) * (y - my)) AS ob{i}' for i in range(p))} "
                f"FROM {prefix}_d, {prefix}_m)")
    for k in range(p - 1):
        cols = ["*"]
        for i in range(k + 1, p):
            for j in range(k + 1, p):
                cols.append(f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS n{k}x{i}_{j}")
            cols.append(f"b{i} - a{i}_{k} * b{k} / a{k}_{k} AS n{k}b{i}")
        ren = ", ".join([f"n{k}x{i}_{j} AS a{i}_{j}" for i in range(k + 1, p) for j in range(k + 1, p)]
                        + [f"n{k}b{i} AS b{i}" for i in range(k + 1, p)])
        excl = ", ".join([f"a{i}_{j}" for i in range(k + 1, p) for j in range(k + 1, p)]
                         + [f"b{i}" for i in range(k + 1, p)]
                         + [f"n{k}x{i}_{j}" for i in range(k + 1, p) for j in range(k + 1, p)]
                         + [f"n{k}b{i}" for i in range(k + 1, p)])
        ctes.append(f"{prefix}_e{k} AS (SELECT * EXCLUDE ({excl}), {ren} FROM "
                    f"(SELECT {', '.join(cols)} FROM {prefix}_{'s0' if k == 0 else f'b{k - 1}'}))")
        ctes.append(f"{prefix}_b{k} AS (SELECT * FROM {prefix}_e{k})")
    last = f"{prefix}_{'s0' if p == 1 else f'b{p - 2}'}"
    for i in reversed(range(p)):
        rest = " - ".join([f"b{i}"] + [f"a{i}_{j} * beta{j}" for j in range(i + 1, p)])
        ctes.append(f"{prefix}_k{i} AS (SELECT *, ({rest}) / a{i}_{i} AS beta{i} FROM {last})")
        last = f"{prefix}_k{i}"
    icpt = " - ".join(["my"] + [f"beta{i} * mx{i}" for i in range(p)])
    sse = " - ".join(["syy"] + [f"beta{i} * ob{i}" for i in range(p)])
    ctes.append(f"{prefix}_f AS (SELECT *, {icpt} AS intercept, 1.0 - ({sse}) / syy AS r2 FROM {last})")
    rows = [f"SELECT 'intercept' AS term, intercept AS coef, r2, n FROM {prefix}_f"]
    rows += [f"SELECT '{f}' AS term, beta{i} AS coef, r2, n FROM {prefix}_f" for i, f in enumerate(features)]
    return ",\n".join(ctes), " UNION ALL ".join(rows)


def inference_sql(src: str, features: Sequence[str], target: str, prefix: str = "inf") -> tuple[str, str]:
    """Return ``(ctes, final_select)`` of ``term, coef, std_err, t_value, df, r2, f_stat, n`` by inverting the centred cross-products.

    Gauss-Jordan steps, unrolled into CTEs over one row that holds the matrix
    beside the unit matrix.
    """
    p = len(features)
    base, _ = ols_sql(src, features, target, prefix)
    first = [f"a{i}_{j}" for i in range(p) for j in range(p)]
    unit = [f"{1.0 if i == j else 0.0}::DOUBLE AS v{i}_{j}" for i in range(p) for j in range(p)]
    ctes = [base, f"{prefix}_g0 AS (SELECT {', '.join(first + unit)} FROM {prefix}_s0)"]
    for k in range(p):
        cols = []
        for m in ("a", "v"):
            for i in range(p):
                for j in range(p):
                    pivot = f"{m}{k}_{j} / a{k}_{k}"
                    cols.append(f"{pivot} AS {m}{i}_{j}" if i == k else f"{m}{i}_{j} - a{i}_{k} * {pivot} AS {m}{i}_{j}")
        ctes.append(f"{prefix}_g{k + 1} AS (SELECT {', '.join(cols)} FROM {prefix}_g{k})")
    quad = " + ".join(f"mx{i} * mx{j} * v{i}_{j}" for i in range(p) for j in range(p))
    ctes.append(f"{prefix}_i AS (SELECT *, (1 - r2) * syy / (n - {p} - 1) AS s2, n - {p} - 1 AS df, (r2 / {p}) / ((1 - r2) / (n - {p} - 1)) AS f_stat "
                f"FROM {prefix}_f, (SELECT {', '.join(f'v{i}_{j}' for i in range(p) for j in range(p))} FROM {prefix}_g{p}))")
    rows = [("const", "intercept", f"1.0 / n + {quad}")] + [(f, f"beta{i}", f"v{i}_{i}") for i, f in enumerate(features)]
    sel = " UNION ALL ".join(f"SELECT '{t}' AS term, {c} AS coef, sqrt(s2 * ({v})) AS std_err, {c} / sqrt(s2 * ({v})) AS t_value, df, r2, f_stat, n "
                             f"FROM {prefix}_i" for t, c, v in rows)
    return ",\n".join(ctes), sel


# --- tail probabilities (base forms; a correlation of a table this side of 10**6 rows needs no others)

def betainc_sql(a: str, b: str, x: str, y: str) -> str:
    """I_x(a, b) with ``y = 1 - x``, by its continued fraction from the last term back."""
    def part(a, b, x, y):
        m = "(j // 2)"
        d = (f"CASE WHEN j % 2 = 1 THEN -({a} + {m}) * ({a} + {b} + {m}) * {x} / (({a} + 2 * {m}) * ({a} + 2 * {m} + 1)) "
             f"ELSE {m} * ({b} - {m}) * {x} / (({a} + 2 * {m} - 1) * ({a} + 2 * {m})) END")
        folds = f"list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(CAST(100 + 10 * sqrt(greatest({a}, {b})) AS BIGINT), 0, -1), lambda j: CAST({d} AS DOUBLE))), lambda t, d: 1 + d / t)"
        return f"exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln({x}) + {b} * ln({y})) / {a} / {folds}"
    return (f"list_transform([{{'a': CAST({a} AS DOUBLE), 'b': CAST({b} AS DOUBLE), 'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}], lambda s: "
            f"CASE WHEN s.x IS NULL THEN NULL WHEN s.x <= 0 THEN 0.0 WHEN s.y <= 0 THEN 1.0 WHEN s.x > (s.a + 1) / (s.a + s.b + 2) THEN 1 - {part('s.b', 's.a', 's.y', 's.x')} "
            f"ELSE {part('s.a', 's.b', 's.x', 's.y')} END)[1]")


def t_two_sided_sql(t: str, df: str) -> str:
    return betainc_sql(f"({df}) / 2.0", "0.5", f"({df}) / (({df}) + ({t}) * ({t}))", f"({t}) * ({t}) / (({df}) + ({t}) * ({t}))")


def pearson_p_sql(r: str, n: str) -> str:
    return (f"CASE WHEN {n} >= 3 AND {r} IS NOT NULL THEN CASE WHEN abs({r}) >= 1 THEN 0.0 ELSE "
            f"{t_two_sided_sql(f'({r}) * sqrt(({n} - 2) / (1 - ({r}) * ({r})))', f'{n} - 2')} END END")


def f_sf_sql(f: str, d1: str, d2: str) -> str:
    return f"CASE WHEN {f} <= 0 THEN 1.0 ELSE {betainc_sql(f'({d2}) / 2.0', f'({d1}) / 2.0', f'({d2}) / (({d2}) + ({d1}) * ({f}))', f'({d1}) * ({f}) / (({d2}) + ({d1}) * ({f}))')} END"


def chi2_sf_sql(x: str, k: str) -> str:
    """Q(k/2, x/2) for whole k by its finite sums: from k = 2 (an exponential) or k = 1 (a normal tail, by the series of erf or its fraction) on."""
    z = f"(({x}) / 2.0)"
    steps = f"list_sum(list_transform(range(0, CAST(floor(({k}) / 2.0) AS BIGINT)), lambda i: exp((i + CASE WHEN ({k}) % 2 = 1 THEN 0.5 ELSE 0.0 END) * ln({z}) - {z} - lgamma(i + 1 + CASE WHEN ({k}) % 2 = 1 THEN 0.5 ELSE 0.0 END))))"
    erf = f"2 / sqrt(pi()) * sqrt({z}) * exp(-{z}) * list_sum(list_transform(range(0, 200), lambda i: exp(i * ln(2 * {z}) - list_sum(list_transform(range(0, i + 1), lambda m: ln(2.0 * m + 1))))))"
    tail = f"sqrt({z} / pi()) * exp(-{z}) / list_reduce(list_prepend({z} + 400.5, list_transform(range(200, 0, -1), lambda j: CAST(j AS DOUBLE))), lambda t, j: {z} + 2 * j - 1.5 - j * (j - 0.5) / t)"
    normal = f"CASE WHEN {z} < 4 THEN 1 - {erf} ELSE {tail} END"
    return f"CASE WHEN {x} <= 0 THEN 1.0 ELSE coalesce({steps}, 0.0) + CASE WHEN ({k}) % 2 = 1 THEN {normal} ELSE 0.0 END END"
