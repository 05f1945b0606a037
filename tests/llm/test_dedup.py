"""SimHash components, repeated passages and exact top-k against brute force."""

import random

import numpy as np
import pytest
import xxhash

from ratelens.llm import queries, simhash, substring, topk
from tests.llm.helpers import SMALL, awkward

RNG = random.Random(11)


def _fingerprint(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    if not sh:
        return 0
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _components(rows, fps, radius):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append(min(ids, default=None))
    return out


def test_simhash_awkward(spark):
    base = [" ".join(RNG.choice("abcdefgh") + RNG.choice("xyz") for _ in range(RNG.randint(1, 80))) for _ in range(25)]
    texts = [None, "", "One two", "one TWO", "É one", "é one", *base, *(b + " zz" for b in base), *base[:5], "word " * 5000]
    docs = awkward(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [_fingerprint(t) for _, t in rows]
    for radius in (0, 2):
        got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs, 3, radius).collect()), key=repr)
        assert got == sorted(((r[0], f, c) for r, f, c in zip(rows, fps, _components(rows, fps, radius))), key=repr)
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    no_ids = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id bigint, text string")
    assert [r.component_id for r in simhash.near_duplicates(no_ids).collect()] == [None, None]


def test_links_of_dense_fingerprints(spark, monkeypatch):
    """Chains, stars and random neighbours around hubs, with tiles cut into small blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    fps = set()
    for _ in range(12):
        hub = RNG.getrandbits(64)
        for _ in range(40):
            x = hub
            for b in RNG.sample(range(64), RNG.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    for i in range(60):
        fps.add((1 << i) - 1)                   # a chain of single bits
    fps = sorted(fps)
    frame = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id bigint, fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, 2)).collect()}
    signed = {i: (f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)}
    want = _components([(i,) for i in range(len(fps))], fps, 2)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(roots.get(signed[i], signed[i]), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_forest_is_small():
    a = np.array([RNG.getrandbits(1) for _ in range(300)], np.uint64)
    left, _ = simhash.forest(a, a, 2)
    assert len(left) <= 1


def _removed(rows, m):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = (t or "").encode().split()
        cover = [False] * len(w)
        for i in range(len(w) - m + 1):
            k = tuple(w[i:i + m])
            if k in seen:
                cover[i:i + m] = [True] * m
            seen.add(k)
        out.append((d, len(w), sum(cover), b" ".join(x for x, c in zip(w, cover) if not c).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("m,size,shared", [(1, 400, 64), (2, 400, 2), (5, 200, 64), (6, 150, 2), (20, 300, 64), (70, 500, 64)])
def test_repeats(spark, m, size, shared):
    hot = " ".join(f"hot{i}" for i in range(90))
    texts = [" ".join(RNG.choice("ab") for _ in range(RNG.randint(0, 60))) for _ in range(60)]
    texts += [f"u{i} {hot} v{i}" for i in range(30)] + [hot, hot, None, "", " \n\t", "é  x " * 40, "q " * 3000]
    docs = awkward(spark, texts).repartition(5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs, m, chunk_bytes=size, shared_from=shared).collect()), key=repr)
    want = _removed([(r.doc_id, r.text) for r in docs.collect()], m)
    assert got == want


def test_repeats_spans_and_empty(spark):
    docs = spark.createDataFrame([(2, "a b c d e"), (1, "x b c d y")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in substring.remove_repeats(docs, 3).collect()}
    assert [(s.start, s.end) for s in rows[2].removed] == [(1, 4)] and rows[2].kept_text == "a e" and rows[1].removed == []
    assert substring.remove_repeats(docs.where("false"), 3).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(docs, 0)


def _search(cands, asks, k):
    out = []
    for q, v in asks:
        best = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in cands if i != q and len(c) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_topk_awkward(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.125 * rng.random(), 0.0]) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)] + [(2000, [0.0] * 6), (2001, [1.0, 2.0]), (2002, [])]
    bad = [(3000, None), (3001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3002, [float("nan")] * 6), (3003, [float("inf")] * 6), (None, [9.0] * 6), rows[0]]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], "vec_id bigint, embedding array<double>, score int, block string")
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    asks = [r for r in whole if r[0] % 10 == 0]
    got = sorted(tuple(r) for r in topk.search(frame, frame.where("vec_id % 10 = 0"), 5).collect())
    assert got == _search(whole, asks, 5)
    assert topk.search(frame.where("false"), frame).count() == 0 and topk.search(frame, frame.where("false")).count() == 0


@pytest.mark.parametrize("scale", [0.01, 1.0, 1e6, 1e300])
def test_topk_block(monkeypatch, scale):
    rng = np.random.default_rng(0)
    x, ids = topk.scaled(rng.normal(size=(400, 8)) * scale, 256), np.arange(400)
    limit = (1 << 63) - 1
    for q, found, score in topk.top(x, ids, x[:9], ids[:9], 5):
        exact = sorted((-max(-limit, min(limit, sum(int(a) * int(b) for a, b in zip(x[q].tolist(), r)))), i) for i, r in enumerate(x.tolist()) if i != q)[:5]
        assert list(zip((-score.astype(object)).tolist(), found.tolist())) == exact


def test_queries_run(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    rows = queries.op10_simhash(spark, SMALL).collect()
    assert len(rows) == n and all(len(r.fingerprint) == 16 for r in rows)


def test_fingerprint_of_parts(monkeypatch):
    from ratelens.llm.common import cut_text
    text = " ".join(RNG.choice("abc") + RNG.choice("xyz") for _ in range(500))
    monkeypatch.setattr(simhash, "cut_text", lambda t: cut_text(t, 20))
    for t in (text, "a b", "a", "", "  ", "ab " * 7):
        assert simhash.fingerprint(t) == _fingerprint(t)
