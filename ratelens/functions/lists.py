"""List-literal columns (A1–A6): Python list text -> ``array<string>``.

Parsing (:mod:`ratelens.functions.literals`) uses built-in expressions and
never leaves the JVM.  Anything that is not a list (malformed text, a bare
string, a tuple, NULL) becomes NULL, which the callers turn into "no items" —
never an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ratelens.functions.expr import col, nan_to_null
from ratelens.functions.literals import python_list

# Python's ``str.split()`` splits on every character for which
# ``str.isspace()`` is true.  The class is built from that rule so the word
# counts agree with the study's ``len(step.split())``.
WHITESPACE_CLASS = "[" + "".join(
    "\\x{%x}" % cp for cp in range(0x3001) if chr(cp).isspace()) + "]+"


def parse_list(c: str | Column) -> Column:
    """A1: Python list literal (as text) -> ``array<string>`` of its items; NULL if not a list, NULL items for None."""
    return python_list(c)


def list_or_empty(df: DataFrame, c: str) -> Column:
    """A2: the items' ``str()`` (so None is ``'None'``), or ``[]`` for NULL/malformed; array input passes through."""
    if c not in df.columns:
        raise ValueError(f"column '{c}' not found")
    if isinstance(df.schema[c].dataType, ArrayType):
        arr = F.col(c).cast("array<string>")
    else:
        arr = python_list(c, none="None")
    return F.coalesce(arr, F.array().cast("array<string>"))


# The same set for Java's regex engine, written with the Unicode White_Space
# property (fast) plus the four separators Python also treats as space.
WORD_PATTERN = "(?U)[^\\s\\x{1c}-\\x{1f}]+"


def word_count(s: Column) -> Column:
    """Number of whitespace-separated words (``len(s.split())``): regex match count."""
    return F.regexp_count(s, F.lit(WORD_PATTERN))


def avg_words_per_step(arr: Column, skip_empty: bool = True) -> Column:
    """Mean word count per step.

    ``skip_empty=True`` (pipeline) ignores ``''`` items; ``False`` (study)
    counts them as 0 words.  An empty list, or no counted item, gives 0.0.
    Joining the items with a space never merges two words, so the total is
    one regex count over the joined text — no per-item lambda.
    """
    items = F.array_remove(arr, "") if skip_empty else arr
    n = F.size(items)
    total = word_count(F.array_join(arr, " "))
    return F.when(F.coalesce(n, F.lit(0)) > 0, total / n).otherwise(F.lit(0.0))


NUTRITION_COLUMNS = (
    # fixed values: output names of the seven nutrition parts, in order
    "calories", "total_fat_pct", "sugar_pct", "sodium_pct",
    "protein_pct", "saturated_fat_pct", "carbohydrates_pct",
)


def _try_double(c: Column) -> Column:
    return nan_to_null(F.trim(c).try_cast("double"))


def split_fixed_list(df: DataFrame, c: str = "nutrition",
                     names: Sequence[str] = NUTRITION_COLUMNS,
                     require_width: bool = False) -> DataFrame:
    """A4: split a fixed-width list text into numeric columns.

    Part i is the i-th comma-separated piece; ``[`` is removed from the first
    and ``]`` from the last named part only, then coerced with C12.  With
    ``require_width=True`` the columns are only produced when the widest
    row has at least ``len(names)`` parts (one extra aggregate; the
    reference's data-dependent schema).
    """
    if require_width:
        widest = df.agg(F.max(F.size(F.split(F.col(c), ",")))).first()[0]
        if widest is None or widest < len(names):
            return df
    parts = F.split(F.col(c), ",")
    out = []
    for i, name in enumerate(names):
        p = F.get(parts, i)
        if i == 0:
            p = F.replace(p, F.lit("["), F.lit(""))
        if i == len(names) - 1:
            p = F.replace(p, F.lit("]"), F.lit(""))
        out.append(_try_double(p).alias(name))
    return df.select("*", *out)


def text_length(c: str | Column, null_as_zero: bool = True) -> Column:
    """A5: character length; pipeline maps NULL to 0, study keeps NULL."""
    x = col(c)
    return F.length(F.coalesce(x, F.lit(""))) if null_as_zero else F.length(x)
