"""Tail probabilities of the t, F and chi-square distributions.

Incomplete beta and gamma functions by their continued fractions, evaluated
from the tail with a number of terms that is doubled until the value stands
still; for very many degrees of freedom, where logarithms of gamma functions
lose their digits against each other, by the limit distributions with their
first corrections.

The same formulas twice: as functions of numbers, for statistics that a model
fit has on the driver, and as column expressions (``*_col``) whose fractions
are folds over a sequence of terms, so grids and group tests stay in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of freedom from which the limit forms are used.
MANY = 1e6
_MOST_TERMS = 1 << 20


def _settled(value: Callable[[int], float]) -> float:
    """``value(terms)`` with terms doubled until two results agree to 14 digits."""
    terms, last = 64, value(32)
    while terms <= _MOST_TERMS:
        now = value(terms)
        if abs(now - last) <= 1e-14 * abs(now):
            return now
        terms, last = 2 * terms, now
    raise ArithmeticError("the continued fraction does not settle")


def _beta_fraction(a: float, b: float, x: float, terms: int) -> float:
    """1 / (1 + d1 / (1 + d2 / ...)) of the incomplete beta function, from the last term back."""
    tail = 1.0
    for j in range(terms, 0, -1):
        m = j // 2
        if j % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        tail = 1.0 + d / tail
    return 1.0 / tail


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):  # the fraction settles fast below the mean
        return 1.0 - betainc(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / a * _settled(lambda n: _beta_fraction(a, b, x, n))


def _gamma_fraction(a: float, x: float, terms: int) -> float:
    """1 / (x + 1 - a - 1 (1 - a) / (x + 3 - a - ...)), from the last term back."""
    tail = x + 2 * terms + 1 - a
    for j in range(terms, 0, -1):
        tail = x + 2 * j - 1 - a - j * (j - a) / tail
    return 1.0 / tail


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    if a >= MANY / 2:  # uniform expansion about x = a: normal tail and its first correction
        ratio = x / a
        if abs(ratio - 1) < 1e-4:
            r = ratio - 1
            half = r * r / 2 - r ** 3 / 3 + r ** 4 / 4  # ratio - 1 - log(ratio), without cancellation
        else:
            half = ratio - 1 - math.log(ratio)
        eta = math.copysign(math.sqrt(2 * max(half, 0.0)), ratio - 1)
        first = 1 / (ratio - 1) - 1 / eta if abs(eta) > 1e-3 else -1 / 3 + eta / 12
        return 0.5 * math.erfc(eta * math.sqrt(a / 2)) + math.exp(-a * half) * first / math.sqrt(2 * math.pi * a)
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - math.exp(log_front) * total
    return math.exp(log_front) * _settled(lambda n: _gamma_fraction(a, x, n))


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if df >= MANY:  # normal tail at the corrected point
        return math.erfc(abs(t) * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df)) / math.sqrt(2))
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    if d2 >= 10 * MANY:  # d1 f follows chi-square; first correction in 1 / d2
        x = d1 * f
        return chi2_sf(x - x * (x - d1 + 2) / (2 * d2), d1)
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    if x is None or math.isnan(x) or k <= 0:
        return float("nan")
    return gammaincc(k / 2.0, x / 2.0)


def pearson_p(r: float, n: float) -> float:
    """Two-sided p of a correlation coefficient; |r| = 1 -> 0, n < 3 -> NaN."""
    if r is None or n is None or math.isnan(r) or n < 3:
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    df = n - 2.0
    return t_two_sided(r * math.sqrt(df / (1.0 - r * r)), df)


# --- the same as column expressions -------------------------------------------

def _let(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of doubles that are computed once per row."""
    return F.transform(F.array(F.struct(*[v.cast("double").alias(k) for k, v in values.items()])), body)[0]


def _terms(least: float, per_root: float, size: Column) -> Column:
    """The terms from ``least + per_root * sqrt(size)`` down to 1; the fractions settle within some square root of their parameter."""
    return F.sequence((least + per_root * F.sqrt(size)).cast("int"), F.lit(1), F.lit(-1))


def _log_gamma(z: Column) -> Column:
    """Stirling's series eight steps further on, where four terms give some 11 digits."""
    def at(v: Column) -> Column:
        w, far = v["z"], v["z"] + 8
        steps = w
        for i in range(1, 8):
            steps = steps * (w + i)
        series = 1 / (12 * far) - 1 / (360 * F.pow(far, 3)) + 1 / (1260 * F.pow(far, 5)) - 1 / (1680 * F.pow(far, 7))
        return (far - 0.5) * F.ln(far) - far + 0.5 * math.log(2 * math.pi) + series - F.ln(steps)
    return _let(at, z=z)


def _beta_part(a: Column, b: Column, x: Column, y: Column) -> Column:
    """I_x(a, b) for x below the mean, ``y = 1 - x``."""
    def term(j: Column) -> Column:
        m = F.floor(j / 2)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 1, odd).otherwise(m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)))
    fraction = F.aggregate(_terms(64, 8, F.greatest(a, b)), F.lit(1.0), lambda tail, j: 1 + term(j) / tail)
    return F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.ln(x) + b * F.ln(y)) / a / fraction


def betainc_col(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Regularised incomplete beta I_x(a, b); ``y`` is 1 - x, given apart to keep its digits."""
    def at(v: Column) -> Column:
        part = _let(lambda w: _beta_part(w["a"], w["b"], w["x"], w["y"]), a=F.when(v["up"] > 0, v["b"]).otherwise(v["a"]),
                    b=F.when(v["up"] > 0, v["a"]).otherwise(v["b"]), x=F.when(v["up"] > 0, v["y"]).otherwise(v["x"]),
                    y=F.when(v["up"] > 0, v["x"]).otherwise(v["y"]))
        return F.when(v["x"] <= 0, F.lit(0.0)).when(v["y"] <= 0, F.lit(1.0)).when(v["up"] > 0, 1 - part).otherwise(part)
    return _let(at, a=a, b=b, x=x, y=y, up=(x > (a + 1) / (a + b + 2)).cast("int"))


def gammaincc_col(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x), for a below ``MANY / 2``."""
    def at(v: Column) -> Column:
        a_, x_ = v["a"], v["x"]
        front = a_ * F.ln(x_) - x_ - _log_gamma(a_)
        start = F.struct((1 / a_).alias("term"), (1 / a_).alias("sum"))

        def add(acc: Column, n: Column) -> Column:
            term = acc["term"] * x_ / (a_ + n)
            return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))
        below = F.aggregate(F.reverse(_terms(100, 12, a_)), start, add)["sum"]
        terms = (64 + 8 * F.sqrt(a_)).cast("int")
        above = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), x_ + 2 * terms + 1 - a_,
                            lambda tail, j: x_ + 2 * j - 1 - a_ - j * (j - a_) / tail)
        return (F.when(x_ <= 0, F.lit(1.0)).when(x_ < a_ + 1, 1 - F.exp(front) * below).otherwise(F.exp(front) / above))
    return _let(at, a=a, x=x)


def _erfc(y: Column) -> Column:
    tail = gammaincc_col(F.lit(0.5), y * y)
    return F.when(y >= 0, tail).otherwise(2 - tail)


def t_two_sided_col(t: Column, df: Column) -> Column:
    """Two-sided tail of Student's t; NULL without a value or degrees of freedom."""
    def at(v: Column) -> Column:
        t2, n = v["t"] * v["t"], v["n"]
        far = _erfc(F.abs(v["t"]) * (1 - 1 / (4 * n)) / F.sqrt(1 + t2 / (2 * n)) / math.sqrt(2))
        return F.when(n >= MANY, far).otherwise(betainc_col(n / 2, F.lit(0.5), n / (n + t2), t2 / (n + t2)))
    return F.when((df > 0) & ~F.isnan(t), F.when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(_let(at, t=t, n=df)))


def pearson_p_col(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation coefficient; |r| = 1 -> 0, n < 3 -> NULL."""
    df = n - F.lit(2.0)
    return F.when((n >= 3) & ~F.isnan(r), F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(t_two_sided_col(r * F.sqrt(F.try_divide(df, 1 - r * r)), df)))


def chi2_sf_col(x: Column, k: Column) -> Column:
    """Upper tail of chi-square; from ``MANY`` degrees of freedom on the normal tail with its first correction."""
    def at(v: Column) -> Column:
        a, ratio = v["a"], v["x"] / v["a"]
        d = ratio - 1
        half = F.when(F.abs(d) < 1e-4, d * d / 2 - F.pow(d, 3) / 3 + F.pow(d, 4) / 4).otherwise(d - F.ln(ratio))
        eta = F.signum(d) * F.sqrt(2 * F.greatest(half, F.lit(0.0)))
        first = F.when(F.abs(eta) > 1e-3, 1 / d - 1 / eta).otherwise(eta / 12 - 1 / 3)
        far = 0.5 * _erfc(eta * F.sqrt(a / 2)) + F.exp(-a * half) * first / F.sqrt(2 * math.pi * a)
        return F.when(v["x"] <= 0, F.lit(1.0)).when(a >= MANY / 2, far).otherwise(gammaincc_col(a, v["x"]))
    return F.when((k > 0) & ~F.isnan(x), _let(at, a=k / 2, x=x / 2))


def f_sf_col(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of F; NULL without a value or degrees of freedom."""
    def at(v: Column) -> Column:
        x = v["p"] * v["f"]
        far = chi2_sf_col(x - x * (x - v["p"] + 2) / (2 * v["q"]), v["p"])
        return F.when(v["q"] >= 10 * MANY, far).otherwise(betainc_col(v["q"] / 2, v["p"] / 2, v["q"] / (v["q"] + x), x / (v["q"] + x)))
    return F.when((d1 > 0) & (d2 > 0) & ~F.isnan(f), F.when(f <= 0, F.lit(1.0)).when(f == float("inf"), F.lit(0.0)).otherwise(_let(at, f=f, p=d1, q=d2)))
