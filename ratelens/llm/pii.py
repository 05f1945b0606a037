"""Personal data: patterns propose spans, checksums confirm, context words adjust the score.

All of it is a projection of built-in expressions.  A kind's pattern cuts the
text into gaps and matches; running lengths over the two give positions in
code points.  The patterns are written so that the regular-expression engine
passes over each run once (a run is entered only at its start and never given
back), which keeps a text of one very long run linear.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import id_text, once

#: Code points before a span in which context words count.
CONTEXT = 40
#: Points that a context word adds, and points from which a span of a kind beside the base is reported.
CONTEXT_POINTS, REPORT_POINTS = 20, 60


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str                      # Java: leftmost non-overlapping, each run once
    plain: str                        # the same matches, without look-behind (RE2); iban: of runs that nothing follows
    needs: str | None                 # a text without this holds no match
    valid: Callable[[Column], Column]
    valid_sql: str                    # DuckDB, of a match m
    points: int
    context: str
    base: bool = True


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled (nines cast out), all summed: a multiple of ten."""
    def digit(c, i):
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), digit), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(compact: Column) -> Column:
    """Country and check digits moved behind, letters as 10 to 35, the number modulo 97 is one."""
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    def step(a, c):
        v = F.when(c <= "9", c.cast("string").try_cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))


def _iban(m: Column) -> Column:
    c = F.regexp_replace(m, " ", "")
    return F.when(F.length(c).between(15, 34), mod97(c)).otherwise(F.lit(False))


_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_PARTS = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
SSN_PARTS = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
_SQL_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_SQL_LUHN = (f"""length({_SQL_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(regexp_extract_all(reverse({_SQL_DIGITS}), '.'),
  lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0""")
_SQL_IBAN = """length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(
  regexp_extract_all(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), '.'),
  lambda c: CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
  lambda a, v: CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END % 97) = 1"""

#: Characters of an IBAN by country (the registry's); other codes are read up to the end of their run.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
                26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
                30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_COUNTRY = "(?:" + "|".join(c for cs in IBAN_LENGTHS.values() for c in cs.split()) + ")"
#: A listed country's length ends the match, so what follows after a space stays out; a run of another code stops before a listed one.
_IBAN = "(?=[A-Z][A-Z][0-9][0-9])(?:" + "|".join(
    rf"(?:{cs.replace(' ', '|')})[0-9][0-9](?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Z0-9])" for n, cs in IBAN_LENGTHS.items()
) + rf"|(?!{_COUNTRY})[A-Z][A-Z][0-9][0-9](?:(?!\x20{_COUNTRY}[0-9][0-9])\x20?[A-Z0-9])++)"

KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "@",
         lambda m: F.lit(True), "true", 90, "mail|contact|kontakt|correo|courriel|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", ".",
         lambda m: m.rlike(IP_PARTS), f"regexp_matches(m, '{IP_PARTS}')", 60, "(^|[^a-z])ip([^a-z]|$)|address|host|server|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])++", r"[0-9]([\x20-]?[0-9])+", None,
         _card, _SQL_LUHN, 80, "card|visa|credit|karte|carte|tarjeta|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
         lambda m: F.length(_digits(m)).between(8, 15), f"length({_SQL_DIGITS}) BETWEEN 8 AND 15", 70,
         "phone|tel|call|fax|mobil|handy"),
    # beside the base: reported only from REPORT_POINTS on
    Kind("iban", _IBAN, r"[A-Z][A-Z][0-9][0-9](\x20?[A-Z0-9])+", None,
         _iban, _SQL_IBAN, 90, "iban|bank|account|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9])[0-9]++-[0-9]++-[0-9]++", r"[0-9]+-[0-9]+-[0-9]+", "-",
         lambda m: m.rlike(SSN_PARTS), f"regexp_matches(m, '{SSN_PARTS}')", 40, "ssn|social", base=False),
)


def _positions(parts: Column) -> Column:
    """Add the running start to (gap, match) pairs, block by block: the array that grows stays short."""
    width = 128
    def grow(acc, x):
        at = acc["at"] + F.length(x["gap"])
        return F.struct((at + F.length(x["match"])).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(at.alias("start"), x["gap"].alias("gap"), x["match"].alias("match")))).alias("out"))
    def block(acc, b):
        size = F.aggregate(b, F.lit(0), lambda a, x: a + F.length(x["gap"]) + F.length(x["match"]))
        return F.struct((acc["at"] + size).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), b.alias("b")))).alias("out"))
    empty = F.expr("cast(array() as array<struct<start:int,gap:string,match:string>>)")
    none = F.expr("cast(array() as array<struct<at:int,b:array<struct<gap:string,match:string>>>>)")
    def all_blocks(p):
        cut = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(p) - 1, F.lit(width)).cast("int")),
                          lambda k: F.slice(p, k * width + 1, width))
        placed = F.aggregate(cut, F.struct(F.lit(0).alias("at"), none.alias("out")), block)["out"]
        return F.flatten(F.transform(placed, lambda b: F.aggregate(
            b["b"], F.struct(b["at"].alias("at"), empty.alias("out")), grow)["out"]))
    return F.when(F.size(parts) == 0, empty).otherwise(once(parts, all_blocks))


def _kind_spans(text: Column, k: Kind) -> Column:
    gaps, matches = F.split(text, k.pattern, -1), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
    parts = F.filter(F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match"))),
                     lambda x: x["match"].isNotNull())

    def span(x):
        said = F.lower(F.substring(x["gap"], -CONTEXT, CONTEXT)).rlike(k.context)
        points = F.least(F.lit(100), F.lit(k.points) + F.when(said, CONTEXT_POINTS).otherwise(0))
        return F.struct(F.lit(k.name).alias("kind"), x["start"].alias("start"),
                        (x["start"] + F.length(x["match"])).alias("end"), points.alias("points"), F.lit(k.base).alias("base"))

    spans = F.transform(F.filter(_positions(parts), lambda x: k.valid(x["match"])), span)
    if not k.base:
        spans = F.filter(spans, lambda x: x["points"] >= REPORT_POINTS)
    holds = text.rlike(k.pattern) if k.needs is None else text.contains(k.needs) & text.rlike(k.pattern)
    return F.when(holds, spans).otherwise(
        F.expr("cast(array() as array<struct<kind:string,start:int,end:int,points:int,base:boolean>>)"))


def _spans(text: Column, kinds: tuple[Kind, ...]) -> Column:
    """array<struct<kind, start, end, points, base>>, by kind as listed, then start."""
    return F.concat(*[_kind_spans(text, k) for k in kinds])


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, text and ``spans``.

    ``spans`` is an array of (kind, start, end, points, base): code points, end
    exclusive, by kind as listed and then start.  A kind's matches are leftmost
    and don't overlap each other; those that their validator refuses are
    dropped without a second try.  Points (0 to 100) start at the kind's value
    and rise if a context word stands in the ``CONTEXT`` code points between
    the span and the match of its kind before it.  Spans of base kinds are all reported, those of
    other kinds from ``REPORT_POINTS`` on.  A null text is an empty one and has
    no spans; repeated rows are judged row by row; null ids stay null.
    """
    return id_text(docs, id_col, text_col).select("doc_id", "text", _spans(F.col("text"), kinds).alias("spans"))


def redact(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, each span in ``text_col`` replaced by its kind in brackets.

    Spans that overlap are replaced together by the kind of the first (by
    start, then the longer one).  A text without spans - null and empty ones
    among them - comes back unchanged.
    """
    def step(acc, x):
        gap = F.array(F.col("text").substr(acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= acc["at"], F.concat(acc["out"], gap)).otherwise(acc["out"]).alias("out"))
    placed = F.array_sort(F.transform("spans", lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("neg"), x["kind"].alias("kind"), x["end"].alias("end"))))
    done = F.aggregate(placed, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")), step,
                       lambda acc: F.concat(F.array_join(acc["out"], ""),
                                            F.col("text").substr(acc["at"] + 1, F.length("text"))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = rows.select("row", "text", _spans(F.col("text"), kinds).alias("spans"))
    return found.select(*[F.when(F.size("spans") == 0, F.col("row").getField(c)).otherwise(done).alias(c) if c == text_col
                          else F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(found: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The contract's columns of :func:`find`, and ``points`` of the listed spans."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    def count(k):
        return F.size(F.filter("spans", lambda x: x["kind"] == k.name)).cast("bigint").alias(f"n_{k.name}")
    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("spans", lambda x: x["base"])), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda x: x["points"].cast("string")), ",").alias("points"))


def oracle(kinds: tuple[Kind, ...] = KINDS) -> str:
    """DuckDB twin of ``digest(find(documents))``, from the plain patterns."""
    each = " UNION ALL ".join(f"""
      SELECT r, {n} AS k, '{k.name}' AS kind, {k.base} AS base, s, s + length(m) AS e,
             least(100, {k.points} + CASE WHEN regexp_matches(lower(right(gap, {CONTEXT})), '{k.context}') THEN {CONTEXT_POINTS} ELSE 0 END) AS points
      FROM (SELECT r, m, gap, sum(length(gap)) OVER q + coalesce(sum(length(m)) OVER p, 0) AS s
            FROM (SELECT r, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i
                  FROM (SELECT r, regexp_extract_all(text, '{k.plain}') AS ms, string_split_regex(text, '{k.plain}') AS gaps FROM d)) u
            WINDOW q AS (PARTITION BY r ORDER BY i), p AS (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      WHERE CASE WHEN {k.valid_sql} THEN true ELSE false END""" for n, k in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k.name}') AS n_{k.name}" for k in kinds)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    f AS (SELECT * FROM ({each}) WHERE base OR points >= {REPORT_POINTS}),
    g AS (SELECT doc_id, {counts},
                 coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY k, s) FILTER (WHERE base), '') AS b,
                 coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY k, s), '') AS spans,
                 coalesce(string_agg(points::VARCHAR, ',' ORDER BY k, s), '') AS points
          FROM d LEFT JOIN f USING (r) GROUP BY r, doc_id)
    SELECT * EXCLUDE (b), sha256(b) AS base_sha256 FROM g"""
