"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The examples are a bounded sample of labelled rows.  Cosines are taken over
whole texts: every word counts in a text's norm, those of the examples of
either label also in the products.  A word's weight is its TF-IDF, with
document counts from all documents, times how much it tells of the label (its
chi-square among the examples, for or against, never below ``FLOOR``).
A document's neighbours are found exactly: blocks of examples carry the
largest weight of each term, so the blocks are visited from the best bound
down and the rest is skipped once it cannot reach the k-th best.  Neighbours
vote with weights that fall with their distance, and an increasing map fitted
on the examples, each without itself, turns votes into probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_text, id_text, released, staged, text_hash

#: Labelled rows that make the index, at most; chosen by a hash of their id.
MAX_EXAMPLES = 3_000
#: Neighbours that vote and examples in a block.
NEIGHBOURS, BLOCK = 10, 64
#: Terms of more than one example in so many are kept as rows.
COMMON = 40
#: Least weight of a term that tells nothing, and the chi-squares at which one begins to tell and is halfway there.
FLOOR, BEGIN, HALF = 0.02, 4.0, 24.0
#: Exponent of the similarity in a vote, and the base rate's weight in it.
SHARPNESS, PRIOR = 2, 0.04
THRESHOLD = 0.3
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """The contract's fold: crc32 of the id as text leaves 2 modulo 4 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and how many each has."""
    n = end - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


class BlockMaxIndex:
    """Vectors of at most unit length in blocks; a term's postings lie by block, each run with its largest weight.

    Terms of more than one vector in ``COMMON`` are rows of a matrix instead (fewer than ``COMMON`` times the
    terms of a vector): their part of all products is a few rows added up, and it enters the bounds as it is.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms_: int | None = None):
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK)
        term = np.concatenate([v[0] for v in vectors]).astype(np.int64)
        at = np.repeat(np.arange(self.size, dtype=np.int32), [len(v[0]) for v in vectors])
        weight = np.concatenate([v[1] for v in vectors])
        n = terms_ if terms_ is not None else int(term.max(initial=-1)) + 1
        often = np.flatnonzero(np.bincount(term, minlength=n) * COMMON > self.size)
        self.row = np.full(n, -1, np.int64)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), self.blocks * BLOCK))
        held = self.row[term] >= 0
        self.rows[self.row[term[held]], at[held]] = weight[held]
        term, at, weight = term[~held], at[~held], weight[~held]
        by = np.argsort(term, kind="stable")  # by term, then example
        term, self.at, self.weight = term[by], at[by], weight[by]
        run = term * self.blocks + self.at // BLOCK
        first = np.flatnonzero(np.append(np.ones(min(1, len(run)), bool), run[1:] != run[:-1]))
        self.first = np.append(first, len(run))                      # postings of each run
        self.block = (self.at[first] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.runs = np.searchsorted(term[first], np.arange(n + 1))   # runs of each term

    def __getstate__(self) -> dict:
        """Few weights of the rows differ from 0, and only those travel to the tasks."""
        at = np.flatnonzero(self.rows)
        return {**self.__dict__, "rows": (self.rows.shape, at.astype(np.int32 if self.rows.size < 1 << 31 else np.int64), self.rows.ravel()[at])}

    def __setstate__(self, state: dict) -> None:
        shape, at, weight = state["rows"]
        self.__dict__.update(state, rows=np.zeros(shape))
        self.rows.ravel()[at] = weight

    def nearest(self, ix: np.ndarray, w: np.ndarray, k: int, but: int = -1) -> list[tuple[float, int]]:
        """The ``k`` vectors of largest product (above 0), ties to the smaller number, ``but`` left out.

        Blocks are visited from the best bound down, a few more each time;
        the rest is skipped once its best bound is below the k-th best score.
        """
        row = self.row[ix]
        common = w[row >= 0] @ self.rows[row[row >= 0]]
        ix, w = ix[row < 0], w[row < 0]
        runs, n = _ranges(self.runs[ix], self.runs[ix + 1])
        x, block = np.repeat(w, n), self.block[runs]
        bound = np.bincount(block, x * self.most[runs], self.blocks) + common.reshape(-1, BLOCK).max(1)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best_at, best = np.empty(0, np.int64), np.empty(0)
        start, width = 0, 4
        while start < len(order):
            # bounds and scores are rounded sums: skip only what is clearly below
            if len(best) >= k and bound[order[start]] < best[-1] - 1e-9:
                break
            visited = np.zeros(self.blocks, bool)
            visited[order[start:start + width]] = True
            held = np.flatnonzero(visited[block])
            posts, n = _ranges(self.first[runs[held]], self.first[runs[held] + 1])
            score = np.bincount(self.at[posts], np.repeat(x[held], n) * self.weight[posts], self.size) + common[:self.size]
            found = np.flatnonzero((score > 0) & np.repeat(visited, BLOCK)[:self.size])
            found = found[found != but]
            best_at = np.concatenate([best_at, found])
            best = np.concatenate([best, np.round(score[found], 12)])
            top = np.lexsort((best_at, -best))[:k]
            best_at, best = best_at[top], best[top]
            start, width = start + width, width * 2
        return list(zip(best.tolist(), best_at.tolist()))


@dataclass
class Model:
    """Everything a score needs; its size is bounded by the examples."""
    vocabulary: dict[str, int]
    weight: np.ndarray          # idf times what the term tells
    unknown: float              # the same for a term of no example
    index: BlockMaxIndex | None
    count: np.ndarray           # examples with each distinct vector
    toxic: np.ndarray           # toxic ones among them
    named: list[int]            # the smallest doc_id of each
    rate: float                 # rate among all examples
    raw: np.ndarray             # knots of the increasing map
    fitted: np.ndarray

    def vector(self, ix: np.ndarray, tf: np.ndarray, other: float) -> np.ndarray:
        """Weights of the known terms over the norm of the whole text; ``other`` sums the squares of the other words' counts."""
        w = (1 + np.log(tf)) * self.weight[ix]
        return w / np.sqrt((w * w).sum() + other * self.unknown ** 2)

    def vote(self, found: list[tuple[float, int]], minus: tuple[int, int] | None = None) -> float:
        """Share of toxic among the neighbours, each weighing its similarity to the power of ``SHARPNESS``."""
        top, bottom = PRIOR * self.rate, PRIOR
        for s, i in found:
            w = min(1.0, s) ** SHARPNESS
            n, t = self.count[i], self.toxic[i]
            if minus is not None and minus[0] == i:
                n, t = n - 1, t - minus[1]
            top, bottom = top + w * t, bottom + w * n
        return top / bottom

    def score(self, ix: np.ndarray, tf: np.ndarray, other: float) -> tuple[float, list[tuple[float, int]]]:
        found = self.index.nearest(ix, self.vector(ix, tf, other), NEIGHBOURS) if len(ix) and self.index is not None else []
        return float(np.interp(self.vote(found), self.raw, self.fitted)), found


def increasing(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step fit of y on x (pool adjacent violators), joined by lines."""
    blocks: list[list[float]] = []                                   # mean of x, mean of y, weight
    for i in np.argsort(x, kind="stable"):
        blocks.append([float(x[i]), float(y[i]), 1.0])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][0] == blocks[-1][0]):
            b, a = blocks.pop(), blocks.pop()
            n = a[2] + b[2]
            blocks.append([(a[0] * a[2] + b[0] * b[2]) / n, (a[1] * a[2] + b[1] * b[2]) / n, n])
    # half an example on either side keeps the ends off 0 and 1
    return (np.array([b[0] for b in blocks]), np.array([(b[1] * b[2] + 0.5 * y.mean()) / (b[2] + 0.5) for b in blocks]))


def examples(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``doc_id, toxic`` of at most ``limit`` labelled training rows, one an id (toxic if any of its rows says so)."""
    labelled = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    present = labelled.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return staged(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "examples")


def telling(a: np.ndarray, df: np.ndarray, pos: int, n: int) -> np.ndarray:
    """What a term that ``a`` of ``pos`` toxic examples and ``df`` of all ``n`` hold tells of the label, either way: ``FLOOR`` to 1."""
    if not 0 < pos < n:
        return np.full(len(df), FLOOR)
    base = pos / n
    chi2 = (a - df * base) ** 2 / (df * base * (1 - base))
    return np.clip((chi2 - BEGIN) / (chi2 - BEGIN + HALF), FLOOR, 1.0)


def term_counts(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, text_hash, ``ix`` (terms of the vocabulary in the text, rising), ``tf`` and ``other`` (``(1 + ln tf)**2`` summed over all other words)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = vocabulary.get
        for b in batches:
            ixs, tfs, others = [], [], []
            for t in b["text"]:
                count: Counter[str] = Counter()
                for part in cut_text(t.as_py() or ""):
                    count.update(terms(part))
                known = sorted((i, n) for i, n in zip(map(look, count), count.values()) if i is not None)
                ixs.append([i for i, _ in known])
                tfs.append([n for _, n in known])
                others.append(sum((1 + math.log(n)) ** 2 for w, n in count.items() if w not in vocabulary))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(ixs, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32())),
                                              pa.array(others, pa.float64())], names=["doc_id", "text_hash", "ix", "tf", "other"])
    return docs.select("doc_id", "text", text_hash(F.col("text")).alias("text_hash")).mapInArrow(
        released(each), "doc_id bigint, text_hash bigint, ix array<int>, tf array<int>, other double")


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> tuple[Model, DataFrame]:
    """The model and the term counts of all ``docs`` (doc_id, text) that it was made from.

    Of documents that share an id the one with the least text hash is the example.
    """
    chosen = examples(docs, labels, limit)
    n, pos = chosen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = pos / n if n else 0.0

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, t in zip(b["toxic"], b["text"]):
                w = list(set().union(*(terms(part) for part in cut_text(t.as_py()))))
                for k in range(0, len(w), 50_000):
                    part = w[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([y.as_py()] * len(part), pa.int32())], names=["term", "toxic"])
    # at most ``limit`` ids, so the broadcast side is bounded by the parameter
    sample = (docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
              .agg(F.min_by("text", text_hash(F.col("text"))).alias("text")))
    known = sample.select("toxic", "text").mapInArrow(released(words), "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("df")).orderBy("term").toArrow()  # the words of ``limit`` texts at most
    names = known["term"].to_pylist()
    vocabulary = {t: i for i, t in enumerate(names)}
    counted = staged(term_counts(docs, vocabulary), "term-counts")
    total = counted.count()
    df = np.zeros(len(names))
    seen = counted.select(F.explode("ix").alias("i")).groupBy("i").agg(F.count("*").alias("n")).toArrow()  # one row a term
    df[seen["i"].to_numpy()] = seen["n"].to_numpy()
    tells = telling(known["a"].to_numpy().astype(float), known["df"].to_numpy().astype(float), pos, n)
    weight = (np.log((1 + total) / (1 + df)) + 1) * tells
    distinct: dict[tuple, list] = {}
    own = counted.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by(F.struct("ix", "tf", "other"), "text_hash").alias("v"))
    for r in own.select("doc_id", "toxic", "v.*").collect():
        distinct.setdefault((tuple(r.ix), tuple(r.tf), r.other), []).append((r.doc_id, r.toxic))
    # examples with the same telling terms share blocks, so a block's largest weights say much about it
    keys = sorted(distinct, key=lambda k: (sorted(k[0], key=lambda i: (-weight[i], i))[:8], k))
    model = Model(vocabulary, weight, (math.log(1 + total) + 1) * FLOOR, None, np.array([len(distinct[k]) for k in keys]),
                  np.array([sum(y for _, y in distinct[k]) for k in keys]), [min(distinct[k])[0] for k in keys], base, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if keys:
        arrays = [(np.array(ix, np.int64), model.vector(np.array(ix, np.int64), np.array(tf, float), other)) if ix else (np.empty(0, np.int64), np.empty(0))
                  for ix, tf, other in keys]
        model.index = BlockMaxIndex(arrays, len(names))
        x, y = [], []
        for i, (k, (ix, w)) in enumerate(zip(keys, arrays)):
            found = model.index.nearest(ix, w, NEIGHBOURS + 1) if len(ix) else []
            for label in (0, 1):  # each example without itself
                same = sum(t == label for _, t in distinct[k])
                if same:
                    raw = model.vote([f for f in found if f[1] != i or model.count[i] > 1][:NEIGHBOURS], (i, label))
                    x += [raw] * same
                    y += [label] * same
        model.raw, model.fitted = increasing(np.array(x), np.array(y, float))
    return model, counted


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``held_out``, ``score``, ``predicted``, ``evidence`` and ``text_hash``, one row a document.

    ``score`` lies between 0 and 1, ``predicted`` is 1 from ``THRESHOLD`` on,
    ``evidence`` lists up to three nearest examples as ``doc_id:toxic of
    examples with its vector:cosine``.  Labels (doc_id, toxic) come from rows
    whose fold is not held out; ids without a document, and labels that are
    null or neither 0 nor 1, teach nothing.  ``limit`` bounds the labelled rows that the
    index is made of.  A text without a word of any example - null and empty ones
    among them - has no neighbours, and its vote is the base rate; without labels all scores are
    0.  Repeated rows score alike; null ids stay null and are not held out.
    """
    model, counted = fit(id_text(docs, id_col, text_col), labels.select("doc_id", "toxic"), limit)
    model = replace(model, vocabulary={})  # the terms are numbers by now

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[float, str]] = {}  # equal texts score alike
        for b in batches:
            rows = []
            for text, ix, tf, other in zip(b["text_hash"].to_pylist(), b["ix"], b["tf"], b["other"].to_pylist()):
                if text not in known:
                    if len(known) > 20_000:
                        known.clear()
                    s, found = model.score(ix.values.to_numpy().astype(np.int64), tf.values.to_numpy().astype(float), other)
                    known[text] = (s, ",".join(f"{model.named[i]}:{model.toxic[i]}/{model.count[i]}:{c:.4f}" for c, i in found[:3]))
                rows.append(known[text])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_hash"], pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.string())],
                names=["doc_id", "text_hash", "score", "evidence"])
    scored = counted.mapInArrow(released(each), "doc_id bigint, text_hash bigint, score double, evidence string")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "text_hash")
