"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int) -> Column:
    """pandas/numpy ``round``: scale, round half to even on the double, unscale.

    This is what ``Series.round(d)`` does (``rint(x*10**d)/10**d``), and what
    DuckDB's ``round_even`` does, so both engines agree bit for bit.
    """
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def py_round(c: str | Column, digits: int) -> Column:
    """Python's built-in ``round``: exact decimal half-even (``bround``)."""
    return F.bround(col(c), digits)


def nan_to_null(c: str | Column) -> Column:
    """NaN means missing in pandas; make it SQL NULL."""
    x = col(c)
    return F.when(~F.isnan(x), x)


def bucketize(c: str | Column, bounds: Sequence[float], labels: Sequence[str],
              closed: str = "right") -> Column:
    """Rule-based category: ``len(labels) == len(bounds) + 1``.

    ``closed='right'`` tests ``x <= b`` per bound, ``'left'`` tests ``x < b``.
    NULL fails every test and lands in the last label, which is what the
    chained ``if`` categorisers of the study do with NaN.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    x = col(c)
    out = None
    for b, lab in zip(bounds, labels):
        cond = (x <= F.lit(b)) if closed == "right" else (x < F.lit(b))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(labels[-1])) if out is not None else F.lit(labels[-1])


def log_floor(c: str | Column, floor: float = 1.0) -> Column:
    """``ln(max(x, floor))`` keeping NULL (``greatest`` would skip a NULL)."""
    x = col(c)
    return F.when(x.isNotNull(), F.ln(F.greatest(x.cast("double"), F.lit(float(floor)))))


def log1p_clipped(c: str | Column) -> Column:
    """``log(1 + max(x, 0))`` keeping NULL.

    Written as ``ln(1 + x)`` rather than ``log1p``: the inputs are counts and
    rates (x >= 0, never tiny), where both agree to an ulp, and ``ln`` gives
    the same bits on every engine, so equal values (ties, which drive the
    rank statistics downstream) stay equal everywhere.
    """
    x = col(c)
    return F.when(x.isNotNull(), F.ln(F.lit(1.0) + F.greatest(x.cast("double"), F.lit(0.0))))


def clip(c: str | Column, lo: Column | float | None, hi: Column | float | None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL; a NULL bound means no bound."""
    x = col(c)
    out = x
    if lo is not None:
        lo_c = lo if isinstance(lo, Column) else F.lit(lo)
        out = F.when(lo_c.isNotNull() & (out < lo_c), lo_c).otherwise(out)
    if hi is not None:
        hi_c = hi if isinstance(hi, Column) else F.lit(hi)
        out = F.when(hi_c.isNotNull() & (out > hi_c), hi_c).otherwise(out)
    return F.when(x.isNotNull(), out)


def unbiased_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected sample skewness from Spark's population ``skewness``."""
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def unbiased_kurt(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis from Spark's population ``kurtosis``."""
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def general_format(c: str | Column, digits: int = 3) -> Column:
    """U4: the text of C's ``%.<digits>g``: that many significant digits, no
    trailing zeros, an exponent below 1e-4 and from ten to the digits on."""
    v = col(c).cast("double")
    size = F.floor(F.log10(F.abs(v))).cast("int")
    # rounding may carry into the next power of ten
    exp = F.when(v == 0, 0).otherwise(F.floor(F.log10(F.abs(F.format_string(f"%.{digits - 1}e", v).try_cast("double")))).cast("int"))
    exp = F.when(v == 0, 0).otherwise(F.greatest(exp, size))

    def bare(s: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    fixed = F.lit(None).cast("string")
    for e in range(-4, digits):
        fixed = F.when(exp == e, bare(F.format_string(f"%.{digits - 1 - e}f", v))).otherwise(fixed)
    mantissa = bare(F.regexp_extract(F.format_string(f"%.{digits - 1}e", v), r"^(.*)e", 1))
    power = F.concat(F.when(exp < 0, F.lit("e-")).otherwise(F.lit("e+")), F.format_string("%02d", F.abs(exp)))
    return F.when(v.isNull(), F.lit(None)).when(F.isnan(v), F.lit("nan")).when(exp.between(-4, digits - 1), fixed).otherwise(F.concat(mantissa, power))
