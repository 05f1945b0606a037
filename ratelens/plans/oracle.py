"""DuckDB twins of the Spark plans, used as the independent correctness oracle.

The fragments start from the driver's pre-registered views and rebuild the
adapters, cleaning, metrics and analysis table in plain SQL.  Every output
goes through ``normalize_sql`` (doubles rounded half-even to 6 decimals,
integers as BIGINT), mirrored on the Spark side by ``normalize_df``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.lists import WHITESPACE_CLASS

AS_OF = "2000-01-01"
DIGITS = 6


def parse_spec(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split(","):
        name, kind = part.strip().rsplit(":", 1)
        out.append((name.strip(), kind.strip()))
    return out


def normalize_df(df: DataFrame, spec: str) -> DataFrame:
    """Spark side of the comparison contract (see module doc)."""
    cols = []
    scale = float(10 ** DIGITS)
    for name, kind in parse_spec(spec):
        c = F.col(f"`{name}`")
        if kind == "d":
            c = F.rint(c.cast("double") * F.lit(scale)) / F.lit(scale)
        elif kind == "i":
            c = c.cast("long")
        elif kind == "s":
            c = c.cast("string")
        elif kind == "b":
            c = c.cast("boolean")
        cols.append(c.alias(name))
    return df.select(*cols)


def normalize_sql(inner: str, spec: str, ctes: str = "") -> str:
    sel = []
    for name, kind in parse_spec(spec):
        q = f'"{name}"'
        if kind == "d":
            sel.append(f"round_even(CAST({q} AS DOUBLE), {DIGITS}) AS {q}")
        elif kind == "i":
            sel.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == "s":
            sel.append(f"CAST({q} AS VARCHAR) AS {q}")
        elif kind == "b":
            sel.append(f"CAST({q} AS BOOLEAN) AS {q}")
    with_ = f"WITH {ctes}\n" if ctes else ""
    return f"{with_}SELECT {', '.join(sel)} FROM (\n{inner}\n) AS _q"


# --- adapters ---------------------------------------------------------------

RAW_INTERACTIONS = """
raw_i AS (
  SELECT o_custkey AS user_id, l_partkey AS recipe_id, CAST(o_orderdate AS DATE) AS date,
         CAST(l_quantity AS INTEGER) % 6 AS rating,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE o_orderpriority || ' ' || l_returnflag || l_linestatus END AS review
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

RAW_RECIPES = """
raw_r AS (
  SELECT p_name AS name, p_partkey AS id,
         CASE WHEN p_partkey % 97 = 0 THEN 0
              WHEN p_partkey % 89 = 0 THEN 100000 + p_partkey
              ELSE p_size * 8 END AS minutes,
         CAST(substr(p_brand, 7) AS INTEGER) AS contributor_id,
         CAST(o.submitted AS VARCHAR) AS submitted,
         '[''' || replace(lower(p_type), ' ', ''', ''') || ''']' AS tags,
         '[' || CAST(p_size * 10 AS VARCHAR) || '.5, ' || CAST(p_size AS VARCHAR) || '.0, '
             || CAST(p_partkey % 50 AS VARCHAR) || '.0, 2.0, 15.0, 3.0, 20.0]' AS nutrition,
         CASE WHEN p_partkey % 101 = 0 THEN 0
              ELSE length(text) - length(replace(text, chr(10), '')) + 1 END AS n_steps,
         '[''' || replace(replace(replace(replace(text, chr(92), ' '), '''', ' '), chr(13), ' '),
                          chr(10), ''', ''') || ''']' AS steps,
         CASE WHEN p_partkey % 50 = 1 THEN NULL ELSE lang || ' ' || source END AS description,
         '[''' || replace(p_name, ' ', ''', ''') || ''']' AS ingredients,
         1 + p_partkey % 20 AS n_ingredients
  FROM part JOIN documents ON doc_id = p_partkey
  LEFT JOIN (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS submitted
             FROM lineitem GROUP BY 1) o ON l_partkey = p_partkey
)"""


def awkward_raw_sql() -> str:
    """``raw_r`` with the step lists of the awkward adapter, each written plainly (NULL: no list)."""
    cut = "substr(steps, 1, length(steps) - 1)"
    plain = (f"CASE id % 7 WHEN 1 THEN regexp_replace(steps, ''', ''', '') WHEN 2 THEN {cut} || ', ''None'']' "
             f"WHEN 3 THEN '[''A\u00e9B' || substr(steps, 3) WHEN 4 THEN NULL "
             f"WHEN 6 THEN '[''' || chr(10) || chr(1) || substr(steps, 3) ELSE steps END")
    return RAW_RECIPES.replace("raw_r AS", "raw_0 AS", 1) + f", raw_r AS (SELECT * REPLACE ({plain} AS steps) FROM raw_0)"


def list_sql(col: str) -> str:
    """Oracle parse of an adapter list literal: strip the brackets, split on ', '."""
    return f"string_split(substr({col}, 3, length({col}) - 4), ''', ''')"


def words_sql(item: str) -> str:
    return (f"len(list_filter(regexp_split_to_array({item}, '{WHITESPACE_CLASS}'), "
            f"lambda w: w <> ''))")


def avg_words_sql(arr: str, skip_empty: bool = True) -> str:
    items = f"list_filter({arr}, lambda s: s <> '')" if skip_empty else arr
    return (f"CASE WHEN coalesce(len({items}), 0) > 0 THEN "
            f"CAST(list_sum(list_transform({items}, lambda s: {words_sql('s')})) AS DOUBLE) / len({items}) "
            f"ELSE 0.0 END")


def _esc(s: str) -> str:
    return s.replace("'", "''")


def bucket_sql_esc(x: str, bounds, labels, closed: str = "right") -> str:
    op = "<=" if closed == "right" else "<"
    parts = [f"WHEN {x} {op} {b} THEN '{_esc(lab)}'" for b, lab in zip(bounds, labels)]
    return f"CASE {' '.join(parts)} ELSE '{_esc(labels[-1])}' END"


# fixed values, written out here so that the twins do not take them from the operators they check
STEPS_BOUNDS, STEPS_LABELS = (5, 10, 20), ("Simple", "Modéré", "Complexe", "Très complexe")
WORDS_BOUNDS, WORDS_LABELS = (10, 20), ("Étapes courtes", "Étapes moyennes", "Étapes longues")
INGR_BOUNDS, INGR_LABELS = (5, 10), ("Peu d'ingrédients", "Ingrédients modérés", "Beaucoup d'ingrédients")
EFFORT_BOUNDS, EFFORT_LABELS = (15, 20, 25, 30), ("Très Facile", "Facile", "Modéré", "Difficile", "Très Difficile")


def _recipes_clean() -> str:
    return f"""
rc0 AS (
  SELECT * REPLACE (CASE WHEN minutes <> 0 THEN minutes END AS minutes) FROM raw_r
),
rc1 AS (
  SELECT * EXCLUDE (submitted), TRY_CAST(submitted AS DATE) AS submitted,
         {list_sql('steps')} AS _steps_arr
  FROM rc0
  WHERE minutes IS NOT NULL AND minutes > 0 AND minutes <= 360
    AND coalesce(n_steps, 0) > 0 AND steps IS NOT NULL
),
rc2 AS (
  SELECT * EXCLUDE (_steps_arr),
         ln(CAST(minutes AS DOUBLE)) AS log_minutes,
         CASE WHEN minutes < 30 THEN 'Rapide' WHEN minutes <= 90 THEN 'Moyenne' ELSE 'Longue' END
           AS category_minutes,
         {avg_words_sql('_steps_arr')} AS avg_words_per_step,
         CASE WHEN n_ingredients IS NOT NULL THEN ln(greatest(CAST(n_ingredients AS DOUBLE), 1.0)) END
           AS log_n_ingredients
  FROM rc1 WHERE len(_steps_arr) > 0
),
rc3 AS (
  SELECT *,
         {bucket_sql_esc('avg_words_per_step', WORDS_BOUNDS, WORDS_LABELS, 'left')} AS step_length_category,
         {bucket_sql_esc('n_steps', STEPS_BOUNDS, STEPS_LABELS)} AS complexity,
         {bucket_sql_esc('n_ingredients', INGR_BOUNDS, INGR_LABELS)} AS category_n_ingredients
  FROM rc2
),
rc_mm AS (
  SELECT min(log_minutes) AS mn0, max(log_minutes) AS mx0,
         min(CAST(n_steps AS DOUBLE)) AS mn1, max(CAST(n_steps AS DOUBLE)) AS mx1,
         min(avg_words_per_step) AS mn2, max(avg_words_per_step) AS mx2,
         min(log_n_ingredients) AS mn3, max(log_n_ingredients) AS mx3
  FROM rc3
),
rc4 AS (
  SELECT rc3.*,
    CASE WHEN mn0 IS NULL OR mx0 IS NULL OR mx0 = mn0 THEN 0.0 ELSE (log_minutes - mn0) / (mx0 - mn0) END AS log_minutes_scaled,
    CASE WHEN mn1 IS NULL OR mx1 IS NULL OR mx1 = mn1 THEN 0.0 ELSE (n_steps - mn1) / (mx1 - mn1) END AS n_steps_scaled,
    CASE WHEN mn2 IS NULL OR mx2 IS NULL OR mx2 = mn2 THEN 0.0 ELSE (avg_words_per_step - mn2) / (mx2 - mn2) END AS avg_words_per_step_scaled,
    CASE WHEN mn3 IS NULL OR mx3 IS NULL OR mx3 = mn3 THEN 0.0 ELSE (log_n_ingredients - mn3) / (mx3 - mn3) END AS log_n_ingredients_scaled
  FROM rc3, rc_mm
),
rc5 AS (
  SELECT *, (0.3::DOUBLE * log_minutes_scaled + 0.25::DOUBLE * n_steps_scaled
             + 0.2::DOUBLE * avg_words_per_step_scaled + 0.25::DOUBLE * log_n_ingredients_scaled)
            * 100.0::DOUBLE AS effort_score
  FROM rc4
),
rc AS (
  SELECT *, {bucket_sql_esc('effort_score', EFFORT_BOUNDS, EFFORT_LABELS)} AS effort_category FROM rc5
)"""


RECIPES_CLEAN = _recipes_clean()

INTERACTIONS_RAW_CLEAN = """
ic0 AS (
  SELECT user_id, recipe_id, TRY_CAST(CAST(date AS VARCHAR) AS DATE) AS date,
         CASE WHEN rating <> 0 THEN rating END AS rating, review,
         length(coalesce(review, '')) AS review_length
  FROM raw_i
)"""

INTERACTIONS_CLEAN = """
ic AS (
  SELECT * FROM ic0 WHERE recipe_id IN (SELECT id FROM rc)
)"""

Z = "(1.96::DOUBLE * 1.96::DOUBLE)"

def metrics_sql(src: str = "ic", out: str = "met") -> str:
    """G1+G2+G3 over the interaction CTE ``src`` into CTE ``out``."""
    return f"""
{out}0 AS (
  SELECT recipe_id, count(rating) AS n_interactions,
         round_even(avg(CAST(rating AS DOUBLE)), 3) AS avg_rating,
         round_even(quantile_cont(CAST(rating AS DOUBLE), 0.5), 3) AS median_rating,
         round_even(stddev_samp(CAST(rating AS DOUBLE)), 3) AS std_rating,
         count(DISTINCT user_id) AS n_unique_users,
         count(review) AS n_reviews_text,
         count(*) FILTER (WHERE CAST(rating AS DOUBLE) >= 4.0) AS _pos
  FROM {src} WHERE recipe_id IS NOT NULL GROUP BY recipe_id
),
{out}_gm AS (SELECT avg(CAST(rating AS DOUBLE)) AS _gm FROM {src}),
{out}1 AS (
  SELECT {out}0.*, CAST(_pos AS DOUBLE) / CAST(n_interactions AS DOUBLE) AS _p,
         1.0::DOUBLE + {Z} / CAST(n_interactions AS DOUBLE) AS _den, _gm
  FROM {out}0, {out}_gm
),
{out} AS (
  SELECT recipe_id, n_interactions, avg_rating, median_rating, std_rating, n_unique_users,
         n_reviews_text,
         (avg_rating * n_interactions + _gm * 10.0::DOUBLE) / (n_interactions + 10.0::DOUBLE) AS bayes_mean,
         CASE WHEN n_interactions = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE,
           (_p + {Z} / (2.0::DOUBLE * n_interactions)) / _den
           - 1.96::DOUBLE * sqrt((_p * (1.0::DOUBLE - _p) + {Z} / (4.0::DOUBLE * n_interactions))
                                 / n_interactions) / _den) END AS wilson_lb
  FROM {out}1
)"""


METRICS = metrics_sql("ic", "met")

ANALYSIS = f"""
an0 AS (
  SELECT rc.*, met.* EXCLUDE (recipe_id),
         round_even(CASE WHEN submitted IS NOT NULL THEN
            greatest(CAST(date_diff('day', submitted, DATE '{AS_OF}') AS DOUBLE), 0.0) END / 30.44, 1)
           AS age_months
  FROM rc JOIN met ON rc.id = met.recipe_id
),
an1 AS (
  SELECT * REPLACE (ln(CAST(minutes AS DOUBLE)) AS log_minutes),
         CASE WHEN age_months IS NOT NULL THEN n_interactions / greatest(1.0, age_months) END
           AS interactions_per_month
  FROM an0 WHERE minutes > 0
),
an2 AS (
  SELECT *,
    CASE WHEN n_interactions IS NOT NULL THEN ln(1.0 + greatest(CAST(n_interactions AS DOUBLE), 0.0)) END AS log1p_n_interactions,
    CASE WHEN interactions_per_month IS NOT NULL THEN ln(1.0 + greatest(CAST(interactions_per_month AS DOUBLE), 0.0)) END AS log1p_interactions_per_month,
    CASE WHEN n_unique_users IS NOT NULL THEN ln(1.0 + greatest(CAST(n_unique_users AS DOUBLE), 0.0)) END AS log1p_n_unique_users
  FROM an1
),
an_q AS (
  SELECT quantile_cont(log_minutes, 0.05) AS l0, quantile_cont(log_minutes, 0.99) AS h0,
         quantile_cont(log1p_n_interactions, 0.05) AS l1, quantile_cont(log1p_n_interactions, 0.99) AS h1,
         quantile_cont(log1p_interactions_per_month, 0.05) AS l2, quantile_cont(log1p_interactions_per_month, 0.99) AS h2,
         quantile_cont(log1p_n_unique_users, 0.05) AS l3, quantile_cont(log1p_n_unique_users, 0.99) AS h3
  FROM an2
),
analysis AS (
  SELECT an2.*,
    least(greatest(log_minutes, l0), h0) AS log_minutes_w,
    least(greatest(log1p_n_interactions, l1), h1) AS log1p_n_interactions_w,
    least(greatest(log1p_interactions_per_month, l2), h2) AS log1p_interactions_per_month_w,
    least(greatest(log1p_n_unique_users, l3), h3) AS log1p_n_unique_users_w,
    5 - avg_rating AS rating_gap, 5 - bayes_mean AS bayes_gap, 1 - wilson_lb AS wilson_gap
  FROM an2, an_q
)"""


def ctes(*names: str) -> str:
    """Comma-joined CTE text for the named stages (dependencies included)."""
    order = ["raw_i", "raw_r", "ic0", "rmet", "rc", "ic", "met", "analysis"]
    frag = {"raw_i": RAW_INTERACTIONS, "raw_r": RAW_RECIPES, "ic0": INTERACTIONS_RAW_CLEAN,
            "rmet": metrics_sql("ic0", "rmet"), "rc": RECIPES_CLEAN,
            "ic": INTERACTIONS_CLEAN, "met": METRICS, "analysis": ANALYSIS}
    deps = {"raw_i": [], "raw_r": [], "ic0": ["raw_i"], "rmet": ["ic0"], "rc": ["raw_r"],
            "ic": ["ic0", "rc"], "met": ["ic"], "analysis": ["rc", "met"]}
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in deps[n]:
            add(d)
    for n in names:
        add(n)
    return ",".join(frag[n] for n in order if n in need)
