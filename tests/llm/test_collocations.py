"""Phrase collocations against a brute-force count."""

import random
import re
from collections import Counter

import numpy as np

from ratelens.llm import collocations, common, queries
from tests.llm.helpers import SMALL, awkward, same

RNG = random.Random(3)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _expected(rows, order, least, top, share=100):
    out = []
    for lang in {lang or "und" if lang is None else lang for lang, _ in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if (own if own is not None else "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, order + 1):
                    f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for q, a in found.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    inside[q[i:i + k]] = max(inside[q[i:i + k]], a)
        scored = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= share * a:
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def _got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def _texts(n):
    words = [RNG.choice("abcdeABCDE") + RNG.choice("xyé") for _ in range(9)]
    return ["".join(RNG.choice(words) + RNG.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", " the end of it "]) for _ in range(RNG.randint(0, 60))) for _ in range(n)]


def test_brute_force(spark):
    rows = [(RNG.choice(["en", "en", "de", None, "und", ""]), t) for t in [*_texts(60), None, "", "...", "one", "a b c d e f g"]]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for order, least, top, share in ((5, 4, 2000, 100), (3, 3, 4, 60), (2, 1, 2000, 100)):
        assert _got(collocations.mine(docs, order, least, top, share)) == _expected(rows, order, least, top, share)


def test_awkward_tables(spark):
    texts = ["the end of it, " * 4, None, "", "the end", "word " * 3000, "a-b\x00c a-b\x00c"]
    docs = awkward(spark, texts).selectExpr("*", "if(doc_id % 2 = 0, 'fr', null) AS lang", "1 AS grp", "2 AS n", "3 AS w1", "4 AS l")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert _got(collocations.mine(docs, 5, 2, 2000)) == _expected(rows, 5, 2, 2000)
    assert collocations.mine(docs.where("false")).collect() == []


def test_long_texts_in_parts(spark, monkeypatch):
    """Windows and pairs across the cuts of a long text are counted once, and slices of a batch change nothing."""
    cut = common.cut_text
    monkeypatch.setattr(collocations, "cut_text", lambda t: cut(t, 20))
    rows = [("en", t) for t in _texts(30)]
    for order in (2, 4):
        words, groups = collocations._Words(), ["en"]
        pieces, total = collocations._Pieces(words, order), Counter()
        for _, t in rows:
            pieces.add(t, 0)
        ids, left, leads, _ = pieces.arrays()
        for i in range(len(ids)):
            if leads[i]:
                total[tuple(words.names[w] for w in ids[i:i + min(order, left[i])])] += 1
        want = Counter()
        for _, t in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(LOWER)):
                w = [x.encode() for x in re.findall(r"[^\x20\x09]+", piece)]
                want.update(tuple(w[i:i + order]) for i in range(len(w)))
        assert total == want


def test_bitmaps_keep_every_frequent_run(spark):
    rows = [("en", t) for t in _texts(40)]
    docs = spark.createDataFrame(rows, "grp string, text string")
    bitmaps = collocations.frequent_runs(docs, 5)
    assert len(bitmaps) == 3
    for known, bitmap in (([], bitmaps[0]), (bitmaps[:2], bitmaps[2])):
        for r in collocations.run_counts(docs, known).groupBy("run").sum("n").collect():
            held = collocations._held(bitmap, np.array([r.run], np.int64).view(np.uint64))[0]
            assert held or r["sum(n)"] < 5


def test_query_against_sql(spark):
    same(queries.op12_collocations(spark, SMALL), queries.ORACLE_SQL["op12_collocations"])
