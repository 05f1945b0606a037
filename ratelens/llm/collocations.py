"""Phrase collocations by top-order marginalisation.

Only windows of the longest order are counted: each word of a piece leads one
window, its columns the word and those that follow, padded at the end of the
piece.  Equal windows are summed, and a Spark ROLLUP over the columns sums ever
shorter prefixes, so the counts of all shorter phrases (and the number of words
per group) come from one table instead of one n-gram explosion a length.

A phrase is frequent only if each word, pair and triple of neighbours in it is.
Those are therefore counted first, as hashes (triples only between frequent
pairs), and bitmaps of fixed greatest size say which may be frequent; a window
is padded from its first infrequent word, pair or triple on.  That drops no
phrase that can reach the least count: a collision in a bitmap only leaves a
window longer than need be.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_text, join_hot, released, staged

#: What ends a piece: fixed by the contract (., ; : ! ? and the line breaks 0A-0D).
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_LINES = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
#: Words a task remembers the numbers of before it starts anew.
VOCABULARY = 1 << 18
#: Words in one slice of a batch.
SLICE = 1 << 18
#: Neighbours counted beforehand: words and pairs at once, then triples.
DEPTH = 3
#: A bitmap has 64 bits for each frequent hash, but never more than 2**27 (16 MB).
MAX_BITS = 27
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Numbers of words in order of appearance, with their hashes."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _Pieces:
    """Word numbers of texts, laid end to end, with the number of words from each place to its piece's end.

    Long texts come in parts; the last words of a part are carried over to the
    next one and lead their windows only there.
    """

    def __init__(self, words: _Words, order: int):
        self.words, self.order = words, order
        self.ids: list[int] = []
        self.left: list[np.ndarray] = []
        self.leads: list[np.ndarray] = []
        self.groups: list[tuple[int, int]] = []  # group number, how many words

    def add(self, text: str, group: int) -> None:
        carried: list[bytes] = []
        parts = cut_text(text)
        part = next(parts)
        while part is not None:
            after = next(parts, None)
            pieces = [p.split() for p in part.encode("utf-8", "surrogatepass").lower().translate(_TO_LINES).split(b"\n")]
            pieces[0] = carried + pieces[0]
            carried = pieces[-1][1 - self.order:] if after is not None and self.order > 1 else []
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            total = int(sizes.sum())
            if total:
                self.ids.extend(map(self.words.__getitem__, chain.from_iterable(pieces)))
                self.left.append(np.repeat(np.cumsum(sizes), sizes) - np.arange(total))
                self.leads.append(np.arange(total) < total - len(carried))
                self.groups.append((group, total))
            part = after

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids = np.array(self.ids, np.int64)
        left = np.concatenate([np.empty(0, np.int64), *self.left])
        leads = np.concatenate([np.empty(0, bool), *self.leads])
        group = np.repeat([g for g, _ in self.groups], [n for _, n in self.groups]).astype(np.int64)
        return ids, left, leads, group


def _read(batch: pa.RecordBatch, words: _Words, groups: list[str], order: int):
    """Slices of a batch as arrays; names of groups are added to ``groups``."""
    number = {}
    pieces = _Pieces(words, order)
    for g, t in zip(batch["grp"], batch["text"]):
        name = g.as_py()
        if name not in number:
            number[name] = len(number)
            groups.append(name)
        pieces.add(t.as_py(), number[name])
        if len(pieces.ids) > SLICE:
            yield pieces.arrays()
            pieces = _Pieces(words, order)
    yield pieces.arrays()


def _group_hashes(groups: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), 7) for g in groups], np.uint64)


def _runs(ids: np.ndarray, left: np.ndarray, group: np.ndarray, words: _Words, groups: list[str], size: int) -> list[np.ndarray]:
    """For 1 to ``size`` words the 64-bit hash (the group's enters) of the run that starts at each place; 0 where the piece ends before."""
    word = np.array(words.hashes, np.uint64)[ids]
    out = [_mixed(word * _MIX + _group_hashes(groups)[group])]
    for k in range(2, size + 1):
        at = np.flatnonzero(left >= k)
        longer = np.zeros(len(ids), np.uint64)
        longer[at] = _mixed(out[-1][at] * _MIX + word[at + k - 1])
        out.append(longer)
    return out


def _held(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return (h != 0) & ((bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0)


def run_counts(docs: DataFrame, bitmaps: list[np.ndarray]) -> DataFrame:
    """``run`` (a hash as bigint) and ``n``, summed by slice; ``docs`` holds grp and text.

    Without bitmaps words and pairs of neighbours are counted; with those of
    all shorter runs the next longer ones whose two parts are held.
    """
    size = len(bitmaps) + 1 if bitmaps else 2

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            groups: list[str] = []
            for ids, left, leads, group in _read(b, words, groups, size):
                runs = _runs(ids, left, group, words, groups, size)
                if bitmaps:
                    part = np.append(_held(bitmaps[-1], runs[-2]), False)
                    found = runs[-1][leads & (runs[-1] != 0) & part[:-1] & part[1:]]
                else:
                    found = np.concatenate([r[leads & (r != 0)] for r in runs])
                h, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["run", "n"])
            if len(words) > VOCABULARY:
                words = _Words()
    return docs.mapInArrow(released(each), "run bigint, n bigint")


def frequent_runs(docs: DataFrame, least: int, depth: int = DEPTH) -> list[np.ndarray]:
    """For 1 to ``depth`` words the bitmap of runs with ``least`` occurrences or more: at most 2**MAX_BITS bits each, whatever their number."""
    bitmaps: list[np.ndarray] = []
    while len(bitmaps) < depth:
        often = staged(run_counts(docs, bitmaps).groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("run"), "runs")
        bits = min(MAX_BITS, max(16, (64 * often.count()).bit_length()))
        place = F.shiftrightunsigned("run", 64 - bits)
        words = (often.select(F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(run, {64 - bits}) & 63 as int))").alias("bit"))
                 .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
        bitmap = np.zeros(1 << (bits - 6), np.uint64)
        bitmap[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
        bitmaps += [bitmap] if bitmaps else [bitmap, bitmap]  # words and pairs share the first one
    return bitmaps


def windows(docs: DataFrame, order: int, bitmaps: list[np.ndarray]) -> DataFrame:
    """grp, ``w1`` to ``w<order>`` (padding: empty) and ``n``: the windows that the words of a piece lead, summed by slice.

    A window is padded from its first run outside the bitmaps on.
    """
    names = [f"w{i + 1}" for i in range(order)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            groups: list[str] = []
            for ids, left, leads, group in _read(b, words, groups, order):
                runs = _runs(ids, left, group, words, groups, len(bitmaps))
                held = [np.append(_held(m, r), np.zeros(order, bool)) for m, r in zip(bitmaps, runs)]
                run = np.ones(len(ids), bool)
                size = np.zeros(len(ids), np.int32)  # words of the window: grows while the run that ends there is held
                for k in range(1, order + 1):
                    last = min(k, len(held))
                    run = run & held[last - 1][k - last:k - last + len(ids)] & (left >= k)
                    size += run
                lead = np.flatnonzero(leads)
                key = np.zeros((len(lead), order + 1), np.int32)  # group, then words (0: padding)
                key[:, 0] = group[lead]
                for i in range(order):
                    held = np.flatnonzero(size[lead] > i)
                    key[held, i + 1] = ids[lead[held] + i] + 1
                mixed = key[:, 0].astype(np.uint64)
                for i in range(order):
                    mixed = _mixed(mixed * _MIX + key[:, i + 1].astype(np.uint64))
                key = key[np.argsort(mixed)]
                start = np.flatnonzero(np.append(np.ones(min(1, len(key)), bool), (key[1:] != key[:-1]).any(1)))
                n = np.diff(np.append(start, len(key)))
                key = key[start]
                text = pa.array([b"", *words.names], pa.binary())
                for s in range(0, len(key), 1 << 16):
                    k = key[s:s + (1 << 16)]
                    cols = [pa.array(groups, pa.string()).take(pa.array(k[:, 0]))]
                    cols += [text.take(pa.array(k[:, i + 1])).cast(pa.string()) for i in range(order)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(n[s:s + (1 << 16)], pa.int64())], names=["grp", *names, "n"])
            if len(words) > VOCABULARY:
                words = _Words()
    return docs.mapInArrow(released(each), f"grp string, {', '.join(f'{c} string' for c in names)}, n bigint")


def phrase_counts(docs: DataFrame, order: int, least: int) -> DataFrame:
    """grp, ``phrase``, ``size`` (words) and ``f`` of every phrase of 1 to ``order`` words with ``least`` occurrences; size 0 is the group's n.

    ``docs`` holds grp and text.  One ROLLUP over the counted windows gives all rows.
    """
    names = [f"w{i + 1}" for i in range(order)]
    counted = windows(docs, order, frequent_runs(docs, least, min(order, DEPTH))).groupBy("grp", *names).agg(F.sum("n").alias("n"))
    rolled = counted.rollup("grp", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    size = F.lit(None)
    for k in range(order + 1):  # the level's bits say which columns are summed away
        size = F.when(F.col("level") == (1 << (order - k)) - 1, k).otherwise(size)
    sized = rolled.where("grp IS NOT NULL").withColumn("size", size).where("size IS NOT NULL")
    # a prefix that ends in padding is a shorter phrase's row
    whole = F.lit(True)
    for k, c in enumerate(names):
        whole = whole & ((F.col("size") <= k) | (F.col(c) != ""))
    return sized.where(whole & ((F.col("f") >= least) | (F.col("size") == 0))).select(
        "grp", F.concat_ws(" ", *names).alias("phrase"), "size", "f")


def mine(docs: DataFrame, order: int = 5, least: int = 100, top: int = 2000, share: int = 100, scale: int = 1000,
         text_col: str = "text", group_col: str = "lang", no_group: str = "und") -> DataFrame:
    """The ``top`` phrases of each group: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is the least over its cuts of floor(scale * a * n / (l * r)),
    in decimals of 38 digits; a phrase inside a longer one with ``share`` percent
    of its count is left out.  Null texts are empty; a null group is
    ``no_group`` and merges with rows that say so; repeated rows count each;
    ties are ordered by count and phrase.  An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit(no_group)).alias("grp"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = staged(phrase_counts(rows, order, least), "phrases")
    totals = counts.where("size = 0").select("grp", F.col("f").alias("n"))
    known = counts.where("size > 0").select("grp", "phrase", "f")
    found = staged(join_hot(counts.where("size > 1"), totals, ["grp"]).select("grp", "phrase", "size", F.col("f").alias("a"), "n"), "candidates")
    words = F.split("phrase", " ")
    cut = staged(found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("w")).select(
        "grp", "phrase", "size", "a", "n", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
        F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("rest")), "cuts")
    lefts = staged(join_hot(cut, known.select("grp", F.col("phrase").alias("first"), F.col("f").alias("l")), ["grp", "first"]), "lefts")
    both = join_hot(lefts, known.select("grp", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["grp", "rest"])
    scored = both.withColumn(
        "score", F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    least_cut = scored.groupBy("grp", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inner = found.select("grp", F.col("a").alias("outer"), words.alias("w"), "size").select(
        "grp", "outer", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m")).where("m >= 2 AND m < size").select(
        "grp", "outer", "w", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i")).select(
        "grp", "outer", F.expr("array_join(slice(w, i, m), ' ')").alias("phrase"))
    around = inner.groupBy("grp", "phrase").agg(F.max("outer").alias("outer"))
    kept = least_cut.join(around, ["grp", "phrase"], "left").where(f"outer IS NULL OR 100 * outer < {share} * a")
    ranked = kept.selectExpr("grp AS lang", "phrase", "a", "m.l AS l", "m.r AS r", "n", "m.score AS score").withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
