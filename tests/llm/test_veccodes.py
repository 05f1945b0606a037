"""Vector codes against a plain scan of the codebooks."""

import hashlib
import math
import random

import numpy as np
import pytest

from ratelens.llm import queries, veccodes
from tests.llm.helpers import CLASHING, SMALL, same

RNG = random.Random(5)


def test_masks_hold_every_nearest_entry():
    gen = np.random.default_rng(3)
    for size, width, spread in ((1, 4, 9), (64, 4, 200), (64, 1, 3), (17, 7, 2), (64, 2, 1 << 26)):
        entries = gen.integers(-spread, spread, (size, width))
        x = np.concatenate([gen.integers(-2 * spread + 1, 2 * spread - 1, (500, width)) // 2, entries])
        d = ((x[:, None, :] - entries[None]) ** 2).sum(-1)
        index = veccodes.PartIndex(entries)
        found, dist = index.nearest(x)
        assert (found == d.argmin(1)).all() and (dist == d.min(1)).all()
    mask = veccodes.PartIndex(gen.integers(-200, 200, (64, 4))).candidates(gen.integers(-200, 200, (500, 4)))
    assert np.bitwise_count(mask).mean() < 40  # the slices do cut entries away
    with pytest.raises(ValueError):
        veccodes.PartIndex(np.zeros((65, 2)))


def _brute(rows, parts, entries, rounds, scale):
    whole = [(i, lab, tuple(math.floor(scale * x) for x in v)) for i, v, lab in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [r for r in whole if r[2] and len(r[2]) % parts == 0]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    size = len(min(whole, key=key)[2])
    whole = [r for r in whole if len(r[2]) == size]
    seeds = {}
    for r in sorted(whole, key=key):
        seeds.setdefault(r[0], r[2])
    w = size // parts
    books = [[list(v[p * w:(p + 1) * w]) for v in list(seeds.values())[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        sums = {}
        for _, _, v in whole:
            for p in range(parts):
                sums.setdefault((p, near(v, p)[1]), []).append(v[p * w:(p + 1) * w])
        for (p, i), vs in sums.items():
            books[p][i] = [sum(c) // len(vs) for c in zip(*vs)]
    out = [(i, lab, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)), sum(near(v, p)[0] for p in range(parts))) for i, lab, v in whole]
    total = {}
    for _, lab, _, e in out:
        total[lab] = total.get(lab, 0) + e
    text = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(((i, lab, c, e, total[lab]) for i, lab, c, e in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def test_awkward_vectors(spark):
    rows = [(i, [RNG.gauss(0, 1) for _ in range(8)], RNG.choice([1, 2, None])) for i in range(200)]
    rows += [(None, [0.5] * 8, 1), (3, rows[7][1], 2), rows[9], rows[9], (900, None, 1), (901, [None] * 8, 1), (902, [math.nan] * 8, 1),
             (903, [math.inf] + [0.0] * 7, 1), (-5, [], 1), (-6, [1.0] * 7, None), (904, [1.0] * 16, 2)]
    extra = [f"{c.strip().split(' ')[0]}" for c in CLASHING.split(",")]
    docs = spark.createDataFrame([(*r, *[None] * len(extra)) for r in rows], f"vec_id bigint, embedding array<double>, label int, {CLASHING}")
    docs = docs.withColumn("key", docs["vec_id"]).withColumn("none", docs["label"])
    for parts, entries, rounds in ((4, 16, 2), (2, 64, 1), (8, 3, 0)):
        codes, books = veccodes.compress(docs, parts, entries, rounds, 16)
        want, digest = _brute(rows, parts, entries, rounds, 16)
        assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in codes.collect()), key=repr) == want
        assert veccodes.digest(books) == digest


def test_nothing_to_code(spark):
    none = spark.createDataFrame([(1, None, 2)], "vec_id bigint, embedding array<float>, label int")
    codes, books = veccodes.compress(none)
    assert codes.collect() == [] and books is None and codes.columns == ["vec_id", "label", "code", "error", "label_error"]
    same_ = spark.createDataFrame([(i, [1.0] * 16, None) for i in range(5)], "vec_id bigint, embedding array<float>, label int")
    codes, books = veccodes.compress(same_)
    assert {(r.code, r.error, r.label_error) for r in codes.collect()} == {("00" * 16, 0, 0)} and books.shape == (16, 5, 1)


def test_query_against_sql(spark):
    same(queries.op13_vector_codes(spark, SMALL), queries.ORACLE_SQL["op13_vector_codes"])
