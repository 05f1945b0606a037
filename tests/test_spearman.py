"""Spearman's grid from shared ranks, with values missing in patterns, against ranks made for each pair."""

import math
import random

import pytest

from ratelens.operators import quantiles as Q
from ratelens.operators import stattests as T

RNG = random.Random(9)


def _ranks(v):
    order = sorted(v)
    first = {}
    for i, x in enumerate(order):
        first.setdefault(x, [i, 0])[1] += 1
    return [first[x][0] + (first[x][1] + 1) / 2 for x in v]


def _rho(rows):
    rows = [(a, b) for a, b in rows if a is not None and b is not None]
    if len(rows) < 3:
        return None, len(rows)
    x, y = _ranks([a for a, _ in rows]), _ranks([b for _, b in rows])
    m = (len(rows) + 1) / 2
    xx, yy = sum((a - m) ** 2 for a in x), sum((b - m) ** 2 for b in y)
    return (sum((a - m) * (b - m) for a, b in zip(x, y)) / math.sqrt(xx * yy) if xx and yy else None), len(rows)


def test_missing_values_in_patterns(spark):
    names = ["a", "b", "c", "p", "q"]
    rows = [tuple(None if RNG.random() < 0.3 else float(RNG.randint(0, 12)) for _ in names) for _ in range(300)]
    rows = [(*r[:2], math.nan if r[2] == 3.0 else r[2], *r[3:]) for r in rows]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    clean = [tuple(None if v is not None and math.isnan(v) else v for v in r) for r in rows]
    got = {(r.effort, r.popularity): r for r in T.spearman_grid(df, ["a", "b", "c", "none"], ["p", "q"]).collect()}
    assert len(got) == 8
    for e in "abc":
        for p in "pq":
            rho, n = _rho([(r[names.index(e)], r[names.index(p)]) for r in clean])
            assert got[e, p].n == n and got[e, p].coef == pytest.approx(rho, abs=1e-12)
    assert got["none", "p"].n is None and got["none", "p"].coef is None


def test_few_rows_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (None, 4.0, 5.0)], "a double, p double, q double")
    got = {(r.effort, r.popularity): (r.coef, r.n) for r in T.spearman_grid(df, ["a"], ["p", "q"], with_p=False).collect()}
    assert got == {("a", "p"): (None, 2), ("a", "q"): (None, 3)}
    empty = T.spearman_grid(df.where("false"), ["a"], ["p"], with_p=False).collect()
    assert [(r.coef, r.n) for r in empty] == [(None, 0)]


def test_same_column_on_both_sides(spark):
    df = spark.createDataFrame([(float(i % 7), float(i)) for i in range(20)], "a double, b double")
    got = {(r.effort, r.popularity): r.coef for r in T.spearman_grid(df, ["a", "b"], ["a", "b"], with_p=False).collect()}
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "b"] == pytest.approx(got["b", "a"])


@pytest.mark.parametrize("buckets", [1, 5])
def test_offsets_along_further_weights(spark, buckets):
    rows = [(RNG.choice("gh"), float(RNG.randint(0, 30)), RNG.randint(0, 3), RNG.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, x double, c long, w long")
    for r in Q.value_offsets(df, "x", ["g"], buckets=buckets, weight="c", more=["w"]).collect():
        mine = [t for t in rows if t[0] == r.g]
        assert (r.n, r.before, r.total) == (sum(t[2] for t in mine if t[1] == r.x), sum(t[2] for t in mine if t[1] < r.x), sum(t[2] for t in mine))
        assert (r.n_w, r.before_w, r.total_w) == (sum(t[3] for t in mine if t[1] == r.x), sum(t[3] for t in mine if t[1] < r.x), sum(t[3] for t in mine))
