"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the text; nothing leaves the row,
so the plan is a scan and a projection without exchange or user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import SPACE_CLASS, WORD_CLASS, id_text, once

SYMBOLS = "#*$%&|<>"
ELLIPSIS = r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z"
BULLET = r"^[\x20\x09-\x0D]*[-*\x{2022}]"
#: The very frequent function words of the languages the rules are meant for.
STOP_WORDS = ("the be to of and that have with in is it for on as was by "
              "der die und das von zu mit den im ist des auf für nicht eine "
              "le la les de et des un une que pour dans est sur par en au "
              "el los las y una por con para del se su al como").split()


@dataclass(frozen=True)
class Rule:
    """A document fails if ``100 * measure`` lies outside ``[low, high] * base`` (None: open)."""
    name: str
    measure: str
    base: str | None
    low: int | None
    high: int | None


#: Ratios are in hundredths so that every engine compares integers.
RULES = (
    Rule("length", "n_words", None, 50 * 100, None),
    Rule("repetition", "n_repeat_words", "n_words", None, 50),
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 50),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
)
#: The rules that the contract fixes; the rest are the method's own.
BASE_RULES = ("length", "repetition")


def _repeat_words(words: Column, width: int) -> Column:
    """Words covered by ``width``-word windows that occur twice or more in the text.

    The windows are sorted by hash and words (the words settle equal hashes),
    neighbours that are equal mark both starts, and sorted starts cover
    ``min(width, distance to the next start)`` words each.
    """
    names = [f"w{i}" for i in range(width)]

    def windows(w):
        n = F.size(w) - (width - 1)
        return F.array_sort(F.transform(
            F.arrays_zip(F.sequence(F.lit(0), n - 1).alias("at"), *[F.slice(w, i + 1, n).alias(c) for i, c in enumerate(names)]),
            lambda z: F.struct(F.xxhash64(*[z[c] for c in names]).alias("h"), *[z[c].alias(c) for c in names], z["at"].alias("at"))))

    def equal(a, b):
        same = a["h"] == b["h"]
        for c in names:
            same = same & (a[c] == b[c])
        return same

    def repeated_starts(s):
        pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), equal)
        none = F.array(F.lit(False))
        return once(pairs, lambda p: F.sort_array(F.filter(
            F.zip_with(s, F.zip_with(F.concat(none, p), F.concat(p, none), lambda a, b: a | b),
                       lambda x, m: F.when(m, x["at"])), lambda x: x.isNotNull())))

    def covered(d):
        steps = F.zip_with(F.slice(d, 1, F.size(d) - 1), F.slice(d, 2, F.size(d) - 1), lambda a, b: F.least(F.lit(width), b - a))
        return F.when(F.size(d) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(width), lambda a, x: a + x))

    # two windows at least, or nothing can repeat
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(
        once(windows(words), lambda s: once(repeated_starts(s), covered)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id and the counts that the rules read (bigint).

    A null or empty text has no words and no lines, so every count is 0.
    Lines are split at line feeds and count only if they hold a word.
    """
    text = F.col("text")
    words = F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CLASS))

    def counted(w):
        return F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
                        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
                        _repeat_words(w, 3).alias("n_repeat_words"))

    def lined(x):
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
                        F.size(F.filter(x, lambda y: y.rlike(ELLIPSIS))).alias("n_ellipsis_lines"),
                        F.size(F.filter(x, lambda y: y.rlike(BULLET))).alias("n_bullet_lines"))

    counts = id_text(docs, id_col, text_col).select(
        "doc_id", once(words, counted).alias("w"), once(lines, lined).alias("l"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).alias("n_symbols"))
    names = ["w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_stop_words",
             "l.n_lines", "l.n_ellipsis_lines", "l.n_bullet_lines"]
    return counts.select("doc_id", *[F.col(c).cast("bigint").alias(c.split(".")[-1]) for c in names])


def _broken(rule: Rule) -> str:
    base = rule.base or "1"
    sides = [f"100 * {rule.measure} < {rule.low} * {base}"] if rule.low is not None else []
    sides += [f"100 * {rule.measure} > {rule.high} * {base}"] if rule.high is not None else []
    return "(" + " OR ".join(sides) + ")"


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures with ``base_failed``, ``kept`` and ``failed_rules`` (names, comma-joined).

    One row a row of ``docs``, repeated rows included; null ids stay null.
    """
    base = [r for r in rules if r.name in BASE_RULES]
    return measures(docs, id_col, text_col).select(
        "*", F.expr(" OR ".join(map(_broken, base)) or "false").alias("base_failed"),
        F.expr(f"NOT ({' OR '.join(map(_broken, rules)) or 'false'})").alias("kept"),
        F.concat_ws(",", *[F.when(F.expr(_broken(r)), F.lit(r.name)) for r in rules]).alias("failed_rules"))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB twin of :func:`judge` over ``documents``, with window functions for the repeats."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    named = " || ".join(f"CASE WHEN {_broken(r)} THEN ',{r.name}' ELSE '' END" for r in rules)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{WORD_CLASS}+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD_CLASS}')) AS lines FROM d),
    p AS (SELECT r, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM w),
    t AS (SELECT r, i, x, lead(x, 1) OVER q AS y, lead(x, 2) OVER q AS z FROM p WINDOW q AS (PARTITION BY r ORDER BY i)),
    s AS (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) > 1 AS rep FROM t WHERE z IS NOT NULL),
    c AS (SELECT DISTINCT r, i + o.o AS at FROM s, (VALUES (0), (1), (2)) o(o) WHERE rep),
    n AS (SELECT r, count(*) AS n FROM c GROUP BY r),
    m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                 length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n.n, 0) AS n_repeat_words,
                 len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS n_stop_words, len(lines) AS n_lines,
                 len(list_filter(lines, lambda x: regexp_matches(x, '{ELLIPSIS}'))) AS n_ellipsis_lines,
                 len(list_filter(lines, lambda x: regexp_matches(x, '{BULLET}'))) AS n_bullet_lines
          FROM w LEFT JOIN n USING (r))
    SELECT *, {' OR '.join(_broken(r) for r in rules if r.name in BASE_RULES)} AS base_failed,
           NOT ({' OR '.join(map(_broken, rules))}) AS kept, ltrim({named}, ',') AS failed_rules FROM m"""
