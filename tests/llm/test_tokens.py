"""BPE against the tokenizers library and a plain merge loop; packing against its rules and a brute force."""

import random
import unicodedata
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ratelens.llm import bpe, common, packing, queries
from tests.llm.helpers import SMALL, awkward

V = queries.vocabulary()
RNG = random.Random(7)
LETTERS = "abcdeéèßÀΣσς İ́̈ \n\t\x1c\x1f\x85 \xa0'\"stremd129²½٣%$!<|>中文字𝒳🙂_."
TEXTS = ["It's they'RE ΑΣ", None, "", " \n ", "a<|endoftext|>b<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "x" * 5000 + "y", "ab" * 2500,
         *("".join(RNG.choice(LETTERS) for _ in range(RNG.randint(0, 70))) for _ in range(300)), "the cat " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(V)


def test_encoder_equals_library(library):
    merges, encoder = bpe.tree_encoder(V)
    for text, ids in zip(TEXTS, encoder.encode([t or "" for t in TEXTS])):
        want = library.encode(text or "", add_special_tokens=False).ids
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == want
        assert merges.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_tree_equals_merge_loop():
    merges, _ = bpe.tree_encoder(V)
    words = ["".join(RNG.choice("antheriolsgé") for _ in range(n)) for n in [1, 2, 3, 4, 5, 8, 9, 16, 17, 18, 33, 70] * 20]

    def plain(word):
        raw = word.encode()
        sym = [int(merges.inner[b]) for b in raw[:-1]] + [int(merges.last[raw[-1]])]
        while len(sym) > 1:
            ranks = merges.rank(np.array(sym[:-1]), np.array(sym[1:]))
            i = int(ranks.argmin())
            if ranks[i] == bpe.INF:
                break
            sym[i:i + 2] = [int(merges.merged[ranks[i]])]
        return sym
    got = merges.encode_words(words)
    for w, ids in zip(words, got):
        assert np.frombuffer(ids, "<u4").tolist() == plain(w)
        leaves = max(1, 1 << max(0, len(w.encode()) - 2).bit_length())
        assert merges._one(w.encode(), leaves) == ids


def test_small_tables_forget(monkeypatch, library):
    monkeypatch.setattr(bpe, "CHUNKS", 3)
    monkeypatch.setattr(bpe, "WORDS", 3)
    merges = bpe.Merges(V)
    encoder = bpe.Encoder(merges.special, merges.encode_words)
    texts = ["a few words of text", "a few other words", "text of words"]
    for _ in range(2):
        for t, ids in zip(texts, [encoder.encode([t])[0] for t in texts]):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_encode_frame(spark, library):
    docs = awkward(spark, TEXTS)
    rows = bpe.encode(docs, V).collect()
    assert len(rows) == len(TEXTS) + 2
    want = {i + 1: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == want[r.doc_id or 1] and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs.where("false"), V).count() == 0


def _pieces(library, rows, capacity):
    out = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out += [(doc, n // capacity, n, len(ids[n:n + capacity]), zlib.crc32(np.array(ids[n:n + capacity], "<u4").tobytes()))
                for n in range(0, len(ids), capacity)]
    return sorted(out, key=repr)


def _sound(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_packing_awkward(spark, library, capacity):
    docs = awkward(spark, TEXTS[:80])
    rows = packing.pack(docs, V, capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == _pieces(
        library, [(r.doc_id, r.text) for r in docs.collect()], capacity)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    used, least = _sound(rows, capacity), -(-sum(r.length for r in rows) // capacity)
    assert used <= least * 1.05 + 1
    assert packing.pack(docs.where("false"), V, capacity).count() == 0


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rng = random.Random(3)
    lengths = [rng.randint(1, 100) for _ in range(900)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "key bigint, length bigint")
    got = {r.key: r for r in packing.assign(items, 100).collect()}
    assert sorted(got) == list(range(900))
    seqs = {}
    for k, r in got.items():
        seqs.setdefault(r.sequence_id, []).append((r.offset, lengths[k]))
    for s in seqs.values():
        assert [o for o, _ in sorted(s)] == [sum(n for _, n in sorted(s)[:i]) for i in range(len(s))]
        assert sum(n for _, n in s) <= 100
    gaps = []  # best fit decreasing over all at once
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((fit or 100) - n)
    assert len(seqs) <= len(gaps) * 1.04


def test_place_follows_the_rule():
    """Every placement against the definition: the sum of squared counts after each possible choice."""
    rng, capacity = random.Random(5), 30
    for _ in range(30):
        lengths = sorted((rng.randint(1, capacity) for _ in range(25)), reverse=True)
        seq, offset, _ = packing.place(np.array(lengths), capacity)
        gaps = {}
        for s, b, at in zip(lengths, seq.tolist(), offset.tolist()):
            def after(g):
                left = [*gaps.values()]
                left.remove(g)
                left.append(g - s)
                return sum(left.count(x) ** 2 for x in set(left) if x)
            fits = sorted({g for g in gaps.values() if g >= s})
            if fits and s < capacity:
                best = min(fits, key=lambda g: (after(g), g))
                assert gaps[b] == best and at == capacity - best
            else:
                assert b not in gaps and at == 0
                gaps[b] = capacity
            gaps[b] -= s


def test_queries_run(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert queries.op7_bpe(spark, SMALL).count() == n
    assert queries.op2_best_fit_packing(spark, SMALL).select("doc_id").distinct().count() == n


def test_long_texts_in_parts(monkeypatch, library):
    from ratelens.llm.common import cut_text
    text = "some words\nof a text " * 40 + "x" * 300 + " end  of\n\nit" + "y" * 500
    for size in (1, 7, 50, 10_000):
        parts = list(cut_text(text, size))
        assert "".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
    monkeypatch.setattr(bpe, "SLICE", 64)
    _, encoder = bpe.tree_encoder(V)
    for t, ids in zip([text, "", "short", text * 2], encoder.encode([text, "", "short", text * 2])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_chunks_are_normalised_as_one_text():
    """Composed and lower-cased together, chunks come out as they do one by one."""
    chunks = ["Été", "́a", "ΟΔΟΣ", "ᄀ", "ᅡᆨ", "İx", "plain", "Å", "\ud800Z", "x" * 100]
    want = [unicodedata.normalize("NFC", c).replace("Σ", "σ").lower() for c in chunks]
    assert bpe.Encoder.lowered(chunks) == want
    assert bpe.Encoder.lowered([]) == []


def test_long_keys_do_not_outlive_a_generation():
    table = bpe.Recent(1)
    for keys in ({"a", "b", "y" * 100}, {"a", "c"}, {"d"}):
        new = table.missing(keys)
        table.now.update(dict.fromkeys(new, b""))
    assert set(table.old) == {"a", "c"} and set(table.now) == {"d"}
    table = bpe.Recent(1)
    table.now.update(dict.fromkeys(table.missing({"a", "b", "y" * 100}), b""))
    assert table.missing({"a", "y" * 100}) == {"y" * 100} and table.now == {"a": b""}


def test_encoders_leave_the_worker_with_other_stages():
    made = []

    @common.kept
    def first(path):
        made.append(path)
        return path
    try:
        for keeps, times in ((first, 1), (first, 1), (None, 1), (first, 2)):
            list(common.released(lambda batches, keeps=keeps: (first("v") for _ in batches if keeps), keeps)(iter([1, 2])))
            assert len(made) == times
    finally:
        common._KEPT.remove(first)
    assert packing.round_encoder in common._KEPT and bpe.tree_encoder in common._KEPT
