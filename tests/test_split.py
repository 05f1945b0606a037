"""The test set's size and members at every number of rows."""

import hashlib
import math

import pytest

from ratelens.operators import models as M


def _expected(keys, seed, share):
    ranked = sorted((hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k) for k in keys if k is not None)
    return {k for _, k in ranked[:math.ceil(share * len(keys))]}


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 35, 101, 3000])
def test_size_and_members(spark, n):
    df = spark.createDataFrame([(i * 7 - 50,) for i in range(n)], "id bigint")
    train, test = M.train_test_split(df, "id", 42, 0.2)
    got = {r.id for r in test.collect()}
    assert got == _expected([i * 7 - 50 for i in range(n)], 42, 0.2) and len(got) == math.ceil(0.2 * n)
    assert train.count() == n - len(got)


def test_awkward_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "k string")
    train, test = M.train_test_split(df, "k", 1, 0.2)
    assert train.count() + test.count() == 5 and {r.k for r in test.collect()} <= {"a", "b"}
    assert M.train_test_split(df, "k", 1, 0.9)[1].count() == 3
    assert M.train_test_split(df, "k", 1, 0.0)[1].count() == 0
