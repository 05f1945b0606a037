"""The block-max index against all cosines, the fold, held-out accuracy, and the pipeline's stages."""

import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from ratelens.llm import queries, simhash, toxicity
from ratelens.llm.common import staged
from tests.llm.helpers import awkward

RNG = random.Random(13)
BAD = ["vermin", "scoundrel", "imbecile"]


def _corpus(spark, n=600):
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"w{RNG.randint(0, 400)}" for _ in range(RNG.randint(5, 60))]
        for _ in range(3 if toxic else 0):
            words[RNG.randrange(len(words))] = RNG.choice(BAD).title()
        docs.append((i, " ".join(words), "en", f"s{i}", 0))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_index_is_exact():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(500):
        ix = np.sort(rng.choice(30, rng.integers(1, 5), replace=False))
        w = rng.integers(1, 4, len(ix)).astype(float)
        vectors.append((ix, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(vectors)
    dense = np.zeros((500, 30))
    for i, (ix, w) in enumerate(vectors):
        dense[i, ix] = w
    for i in range(0, 500, 7):
        score = dense @ dense[i]
        want = sorted(((round(float(s), 12), j) for j, s in enumerate(score) if s > 0 and j != i), key=lambda x: (-x[0], x[1]))[:10]
        got = index.nearest(*vectors[i], 10, but=i)
        assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]


def _brute(docs, labels):
    """Scores of (id, text) by definition: every weight, every cosine, all votes; the increasing map is the module's own."""
    label = {i: y for i, y in labels if i is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    counts = [Counter(re.findall(r"\w+", t.lower())) for _, t in docs]
    train = [k for k, (i, _) in enumerate(docs) if i in label]
    y = {k: label[docs[k][0]] for k in train}
    n, pos = len(train), sum(y.values())
    base = pos / n
    df = Counter(w for c in counts for w in c)
    of, toxic = Counter(w for k in train for w in counts[k]), Counter(w for k in train if y[k] for w in counts[k])

    def weight(w):
        if w not in of:
            return (math.log(1 + len(docs)) + 1) * 0.02
        chi2 = (toxic[w] - of[w] * base) ** 2 / (of[w] * base * (1 - base))
        return (math.log((1 + len(docs)) / (1 + df[w])) + 1) * min(1.0, max(0.02, (chi2 - 4) / (chi2 + 20)))
    vectors = []
    for c in counts:
        v = {w: (1 + math.log(k)) * weight(w) for w, k in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({w: x / norm for w, x in v.items()})

    def vote(k, but=None):
        near = sorted(((sum(x * vectors[e].get(w, 0.0) for w, x in vectors[k].items()), e) for e in train if e != but), reverse=True)[:10]
        near = [(s, e) for s, e in near if s > 0]
        return (0.04 * base + sum(s * s * y[e] for s, e in near)) / (0.04 + sum(s * s for s, _ in near))
    raw, fitted = toxicity.increasing(np.array([vote(e, e) for e in train]), np.array([float(y[e]) for e in train]))
    return {docs[k][0]: float(np.interp(vote(k), raw, fitted)) for k in range(len(docs))}


def test_scores_by_brute_force(spark):
    docs, labels = _corpus(spark, 200)
    want = _brute([(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.toxic) for r in labels.collect()])
    got = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    # votes lie close together where the map is steep
    assert got.keys() == want.keys() and sum(abs(got[i] - want[i]) < 1e-6 for i in want) >= 0.98 * len(want)


def test_one_bad_word_in_a_long_clean_text(spark):
    """The norm covers the whole text, and clean words have a say: the long text is not the short insult."""
    docs, labels = _corpus(spark, 400)
    held = [i for i in range(1000, 1040) if zlib.crc32(str(i).encode()) % 4 != 2]
    long = " ".join(f"w{RNG.randint(0, 400)}" for _ in range(5000)) + " vermin"
    more = spark.createDataFrame([(held[0], "what a vermin", "en", "s", 0), (held[1], long, "en", "s", 0)], docs.schema)
    by = {r.doc_id: r for r in toxicity.score(docs.unionByName(more), labels).collect()}
    assert by[held[0]].predicted == 1 and by[held[1]].score < by[held[0]].score
    cosine = [float(by[i].evidence.split(",")[0].rsplit(":", 1)[1]) for i in held[:2]]
    assert cosine[1] < cosine[0]


def test_rows_that_share_an_id(spark):
    """The text of least hash teaches; both are scored, alike in every order of the rows."""
    docs, labels = _corpus(spark, 100)
    twin = docs.where("doc_id < 40").selectExpr("doc_id", "concat(text, ' twin') AS text", "lang", "source", "n_chars")
    both = docs.unionByName(twin)
    one = sorted((r.doc_id, r.text_hash, r.score) for r in toxicity.score(both, labels).collect())
    two = sorted((r.doc_id, r.text_hash, r.score) for r in toxicity.score(both.repartition(7).orderBy("text"), labels).collect())
    assert len(one) == 140 and [r[:2] for r in one] == [r[:2] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two])


def test_held_out_accuracy_and_fold(spark):
    docs, labels = _corpus(spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    # held-out labels teach nothing: turned round, the scores stay
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {(r.doc_id, r.score) for r in toxicity.score(docs, turned).collect()} == {(r.doc_id, r.score) for r in rows}


def _rows(spark, texts):
    """Documents and labels of (text, label), with ids of their own that aren't held out; no label: not labelled."""
    ids = [i for i in range(20 * len(texts)) if zlib.crc32(str(i).encode()) % 4 != 2][:len(texts)]
    return (spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts)], "doc_id bigint, text string"),
            spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, texts) if y is not None], "doc_id bigint, toxic int"))


def test_words_of_few_examples_and_of_a_minority_count(spark):
    plain = [(" ".join(f"w{RNG.randint(0, 400)}" for _ in range(8)), 0) for _ in range(600)]
    few = [(f"zounds zounds w{i}", 1) for i in range(4)]
    part = [(f"blighter blighter w{i}", int(i % 5 < 2)) for i in range(40)]
    docs, labels = _rows(spark, plain + few + part + [("zounds zounds w7", None), ("blighter blighter w9", None)])
    by = {r.text: r for r in docs.join(toxicity.score(docs, labels), "doc_id").collect()}
    assert by["zounds zounds w7"].predicted == 1
    assert by["blighter blighter w9"].score >= 0.3


def test_toxicity_awkward(spark):
    docs, labels = _corpus(spark, 300)
    odd = awkward(spark, [None, "", "  ", "vermin " * 5000, "é"])
    known = docs.select("doc_id", "text")
    more = odd.selectExpr("doc_id + 100000 AS doc_id", "text")
    said = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (1, None), (2, 7), (999999, 1)], "doc_id bigint, toxic int"))
    rows = toxicity.score(known.unionByName(more), said).collect()
    assert len(rows) == 300 + 7 and all(r.score is not None for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[100004].predicted == 1 and by[100001].predicted == 0
    assert toxicity.score(odd, said.where("false")).where("score <> 0").count() == 0
    assert toxicity.score(odd.where("false"), said).count() == 0
    assert toxicity.score(known, said, limit=50).count() == 300


def _write(spark, tmp_path, docs, labels):
    path = str(tmp_path / "in")
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_on_planted_cases(spark, tmp_path):
    docs, labels = _corpus(spark, 300)
    passage = " ".join(f"shared{i}" for i in range(60))
    clean = " ".join(f"c{i}" for i in range(80))
    planted = [(1000, clean, "en", "s", 1), (1001, clean, "en", "t", 1), (1002, f"one two {passage} three", "en", "s", 1),
               (1003, f"four {passage} five six", "en", "s", 1), (1004, "write to joe@x.org now", "en", "s", 1), (None, clean, "en", "s", 1),
               (1005, None, None, None, None), (1004, "write to joe@x.org now", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    path = _write(spark, tmp_path, docs, labels)
    before, at = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        at[name] = staged(stage(spark, before, path), name)
        if name != "best_fit_packing":
            assert at[name].columns == docs.columns and at[name].schema.simpleString() == docs.schema.simpleString()
        before = at[name]
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    after = {r.doc_id for r in at["toxicity"].collect()}
    assert not after & toxic and len(after) == 300 - len(toxic) + 7
    near = at["simhash_near_dedup"]
    groups = {r.component for r in simhash.near_duplicates(at["toxicity"]).collect()}
    assert near.count() == len(groups)
    kept = {r.doc_id: r for r in near.collect()}
    assert 1000 in kept and 1001 not in kept and None not in kept and 1004 in kept
    texts = {r.doc_id: r for r in at["substring_dedup"].collect()}
    assert len(texts) == near.count()
    assert texts[1002].text == kept[1002].text and texts[1003].text == "four five six" and texts[1003].n_chars == 13
    redacted = {r.doc_id: r for r in at["pii"].collect()}
    assert redacted[1004].text == "write to [EMAIL] now" and redacted[1000].text == clean and redacted[1000].n_chars == 1
    packed = at["best_fit_packing"].collect()
    assert {r.doc_id for r in packed} == set(redacted) and all(r.offset + r.length <= 4096 for r in packed)
    whole = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, path).collect()} == whole


def test_stages_on_nothing(spark, tmp_path):
    docs, labels = _corpus(spark, 5)
    path = _write(spark, tmp_path, docs.where("false"), labels)
    assert corpus_pipeline.run(spark, path).count() == 0


def test_stages_keep_clashing_columns(spark, tmp_path):
    docs, labels = _corpus(spark, 60)
    more = {c: f"coalesce(length(text), 0) AS `{c}`" for c in ("text_hash", "hash", "id", "row", "spans", "key", "kept", "component", "chunk", "fp", "ids")}
    docs = docs.selectExpr("*", *more.values())
    path = _write(spark, tmp_path, docs, labels)
    now = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = staged(stage(spark, now, path), name)
        assert now.columns == docs.columns
        assert now.where("hash <> length(text) OR text_hash <> hash OR id <> row").count() == 0 and now.count() > 0
    assert corpus_pipeline.pack_sequences(spark, now, path).count() == now.count()


def test_query_runs(spark):
    assert queries.op3_toxicity(spark, "/root/testdata/sf0.001").count() == 200


def test_an_index_travels_without_its_noughts():
    gen = np.random.default_rng(3)
    vectors = [(np.unique(np.append(gen.integers(0, 400, 20), gen.integers(400, 90000, 9))), ) for _ in range(700)]
    vectors = [(v, np.full(len(v), 1 / np.sqrt(len(v)))) for v, in vectors]
    index = toxicity.BlockMaxIndex(vectors, 90000)
    sent = pickle.dumps(index)
    back = pickle.loads(sent)
    assert len(index.rows) > 300 and (back.rows == index.rows).all()
    assert len(sent) < index.rows.nbytes
    for ix, w in vectors[:20]:
        assert back.nearest(ix, w, 10) == index.nearest(ix, w, 10)
