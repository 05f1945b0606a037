"""MinHash near-duplicates against brute force over full shingle sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm import minhash, queries
from ratelens.llm.common import id_text, staged, text_hash
from tests.llm.helpers import SMALL, awkward, same

RNG = random.Random(7)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def _expected(rows, width, percent):
    sets = [_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def _words(n):
    return [RNG.choice("abcdefghijk") + RNG.choice("rstuvw") + RNG.choice("12345") for _ in range(n)]


def test_awkward_tables(spark):
    base = [_words(RNG.randint(1, 90)) for _ in range(20)]
    near = [[*b[:-1], "other"] for b in base] + [b[1:] for b in base if len(b) > 1]
    texts = ["One two", "one TWO", None, "", " \t\r\n", "É one", "é one", "a b c d", "A\tb\x0bC d", *(" ".join(b) for b in base + near), "word " * 9000]
    docs = awkward(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _got(minhash.near_duplicates(docs, 4, 80)) == _expected(rows, 4, 80)
    assert minhash.near_duplicates(docs.where("false")).count() == 0
    no_ids = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "")], "doc_id bigint, text string")
    assert [(r.component_id, r.kept) for r in minhash.near_duplicates(no_ids).collect()] == [(None, True)] * 3
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs, 4, 70)


def test_chains_within_buckets(spark, monkeypatch):
    """Families that drift apart step by step: buckets hold several components, and blocks are small."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "STAR", 3)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(minhash, "COLUMNS", 64)
    rows = []
    for _ in range(6):
        words = _words(70)
        for step in range(14):
            rows.append((len(rows) + 1, " ".join(words)))
            for _ in range(RNG.randint(1, 3)):
                words[RNG.randrange(len(words))] = f"new{len(rows)}{step}{RNG.random()}"
    RNG.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = _expected(rows, 4, 80)
    assert len({c for _, _, c, _ in want}) > 6
    assert _got(minhash.near_duplicates(docs, 4, 80)) == want


def test_open_members_lose_no_link(spark, monkeypatch):
    """With one bucket for all and nothing linked yet, members of similar pairs are open, and settling links just those."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100)
    rows = [(i + 1, " ".join(_words(40 if i < 3 else 200))) for i in range(5)]
    rows += [(10 + i, rows[0][1] + f" tail{i}") for i in range(9)]
    docs = id_text(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text").withColumn("text_hash", text_hash(F.col("text")))
    sets = staged(minhash.signatures(docs, 4), "sets")
    members = sets.select(F.lit(1).cast("bigint").alias("key"), "node", F.lit(0).cast("bigint").alias("centre"))
    none = spark.createDataFrame([], "node bigint, root bigint")
    near = staged(minhash.open_members(members, sets, none, 80), "near")
    doc = {r.node: r.doc_id for r in sets.collect()}
    assert {1, *range(10, 19)} <= {doc[r.a] for r in near.where("NOT joins").collect()} <= {1, 2, 3, *range(10, 19)}
    root = {d: d for d, _ in rows}
    for r in minhash.settle(docs, sets, near, 4, 80).collect():
        a, b = root[doc[r.a]], root[doc[r.b]]
        root = {d: (a if x == b else x) for d, x in root.items()}
    assert len({root[d] for d in [1, *range(10, 19)]}) == 1 and len(set(root.values())) == 5


def test_overlaps_of_sets(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 5)
    gen = np.random.default_rng(8)
    left, right = ([np.unique(gen.integers(0, 60, n, dtype=np.uint64)) for n in gen.integers(0, 50, 12)] for _ in range(2))
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert minhash.overlaps(left, right).tolist() == want
    assert not minhash.overlaps(left, [np.empty(0, np.uint64)]).any()


def test_signatures_estimate_similarity():
    """Filled bins hold their least hash; agreement estimates the similarity, for small sets too."""
    gen = np.random.default_rng(5)
    for n in (1, 3, 20, 200, 5000):
        near = []
        for _ in range(30):
            own = np.unique(gen.integers(0, 1 << 63, 10 * n, dtype=np.uint64) * np.uint64(2))
            a, b = np.sort(own[:9 * n]), np.sort(own[n:])
            near.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(near) - 0.8) < (0.12 if n < 20 else 0.04)
    one = minhash.signature(np.array([77], np.uint64))
    assert (one == 77).all()
    full = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100000, dtype=np.uint64) << np.uint64(1))
    sig = minhash.signature(full)
    assert all(sig[i] == full[(full >> np.uint64(57)) == i].min() for i in range(minhash.BINS))


def test_long_texts_in_parts(monkeypatch):
    from ratelens.llm import common
    text = " ".join(_words(3000))
    whole = minhash.Shingles(4).of(text)
    cut = common.cut_text
    monkeypatch.setattr(minhash, "cut_text", lambda t: cut(t, 50))
    assert (minhash.Shingles(4).of(text) == whole).all() and len(whole) == len(_set(text, 4))
    assert len(minhash.Shingles(4).of("a b")) == 1 and len(minhash.Shingles(4).of(" ")) == 0


def test_query_against_sql(spark):
    same(queries.op11_minhash(spark, SMALL), queries.ORACLE_SQL["op11_minhash"])


def test_a_task_of_tiles_names_each_member_and_join_once(monkeypatch):
    def part(nodes, joins):
        n, (a, b) = np.array(nodes, np.int64), np.array(joins, np.int64).reshape(-1, 2).T
        return n, n // 10, a, b
    parts = [part([30, 10, 11], [(1, 3)]), part([], []), *[part([10, 30, 20], [(3, 1), (2, 3)]) for _ in range(50)]]

    def told(parts):
        got = [(a, b, j) for x in minhash.told_once(iter(parts)) for a, b, j in zip(*(c.to_pylist() for c in x.columns))]
        return sorted((a, b) for a, b, j in got if not j), sorted((a, b) for a, b, j in got if j)
    members, joins = told(parts)
    assert members == [(10, 1), (11, 1), (20, 2), (30, 3)]
    assert joins == [(1, 3), (2, 3)]
    assert told([]) == ([], [])
    monkeypatch.setattr(minhash, "TOLD", 8)  # handed on in several parts
    assert [sorted(set(x)) for x in told(parts)] == [members, joins]


def test_blocks_meet_once(spark):
    """Each pair of blocks, one of them outside the largest component, in one row, whichever of the two leads."""
    lying = [(b, True) for b in range(5)] + [(0, False), (2, False)]
    blocks = spark.createDataFrame([(1, 5, b, out, [10 * b + out]) for b, out in lying], "key bigint, blocks bigint, block bigint, outside boolean, rows array<bigint>")
    met = sorted(tuple(sorted((r.left[0], r.right[0]))) for r in minhash._met(blocks).collect())
    names = [10 * b + out for b, out in lying]
    want = {tuple(sorted((x, y))) for x in names for y in names if x % 10 or y % 10}
    assert met == sorted(want) and len(met) == 25
