"""Best-fit packing by sum of squares: documents into as few token sequences as possible.

A document goes where the squared counts of open sequences per residual gap
become smallest; a new sequence is opened only where no open one has room.
Groups of ``GROUP`` random pieces are packed apart from each other, long
pieces first.  What such a group leaves half empty is taken apart and packed
again together with what the other groups left, until one group holds the
rest (or a round no longer makes the groups fewer), so the loss does not grow
with the number of groups.  Token ids are
written once, beside the texts they came from; only keys and lengths move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.bpe import Encoder, Merges, small_batches
from ratelens.llm.common import id_text, kept, released, staged

#: Pieces in a group, so many groups at most are put together as the last one, and the gap
#: (as a part of the capacity) from which a sequence is packed again.
GROUP, LAST, SPARE = 2048, 8, 1 / 200


#: No rank: the pair does not merge.
_NONE = np.iinfo(np.int32).max


class PairRanks:
    """Ranks of pairs of symbols in hash tables of fixed size; what collides in one goes to the next."""

    def __init__(self, merges: Merges, bits: int = 18):
        self.base, self.shift = merges.base, np.uint64(64 - bits)
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        keys, ranks, factor = merges.keys, merges.ranks.astype(np.int32), 0x9E3779B97F4A7C15
        while len(keys):
            slot = self._slot(keys, np.uint64(factor))
            first = np.unique(slot, return_index=True)[1]
            key, rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
            key[slot[first]], rank[slot[first]] = keys[first], ranks[first]
            self.tables.append((np.uint64(factor), key, rank))
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, ranks, factor = keys[left], ranks[left], (factor * 6364136223846793005 + 1442695040888963407) % (1 << 64) | 1

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.astype(np.uint64) * factor) >> self.shift).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of (a, b), ``_NONE`` where they don't merge or one is missing (-1)."""
        want = np.where((a >= 0) & (b >= 0), a * self.base + b, -2)
        out = np.full(want.shape, _NONE, np.int32)
        for factor, key, rank in self.tables:
            slot = self._slot(want, factor)
            hit = key[slot] == want
            out[hit] = rank[slot[hit]]
        return out


def merge_rounds(merges: Merges, ranks: PairRanks, raw: list[bytes], width: int) -> list[bytes]:
    """The ids of words of at most ``width`` bytes, all words at a time: each round merges the lowest pair of every word that has one."""
    n = len(raw)
    size, rows = np.fromiter(map(len, raw), np.int64, n), np.arange(n)
    text, start = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size
    sym = np.full((n, width + 1), -1, np.int64)                  # a column of blanks ends every word
    sym[np.repeat(rows, size), np.arange(len(text)) - np.repeat(start, size)] = merges.inner[text]
    sym[rows, size - 1] = merges.last[text[start + size - 1]]
    rank = ranks.of(sym[:, :-1], sym[:, 1:])
    after, before = np.tile(np.arange(1, width + 2), (n, 1)), np.tile(np.arange(-1, width), (n, 1))
    live = rows
    while True:
        part = rank[live]
        p = part.argmin(1)                                        # the leftmost of the lowest
        low = part[np.arange(len(live)), p]
        on = low < _NONE
        live, p, low = live[on], p[on], low[on]
        if not len(live):
            break
        new, r, q = merges.merged[low], after[live, p], before[live, p]
        s = np.minimum(after[live, r], width)
        sym[live, p], sym[live, r] = new, -1
        after[live, p], before[live, s] = s, p
        right, left = np.split(ranks.of(np.concatenate([new, np.where(q >= 0, sym[live, q], -1)]), np.concatenate([sym[live, s], new])), 2)
        gone = r < width
        rank[live[gone], r[gone]] = _NONE
        rank[live, p] = right
        held = q >= 0
        rank[live[held], q[held]] = left[held]
    keep = sym >= 0
    ids, ends = sym[keep].astype("<u4").tobytes(), (4 * np.cumsum(keep.sum(1))).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


@kept
def round_encoder(path: str) -> Encoder:
    """Words not seen before are merged many at a time, behind bounded look-up tables; one a worker process."""
    merges = Merges(path)
    ranks = PairRanks(merges)

    def words(new: list[str]) -> list[bytes]:
        raw = "\n".join(new).encode("utf-8", "surrogatepass").split(b"\n")  # no word holds white space
        out: list[bytes] = [b""] * len(new)
        if not new:
            return out
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        for i in np.flatnonzero(size > 2048).tolist():  # one tree beats rounds over a long word
            out[i] = merges.encode_words([new[i]])[0]
        widths = np.where(size <= 16, size, np.where(size <= 64, -(-size // 8) * 8, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)))
        for width in np.unique(widths[(size > 0) & (size <= 2048)]).tolist():
            members = np.flatnonzero((widths == width) & (size <= 2048)).tolist()
            step = max(1, (1 << 18) // width)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                for i, ids in zip(part, merge_rounds(merges, ranks, [raw[i] for i in part], width)):
                    out[i] = ids
        return out
    return Encoder(merges.special, words)


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit): each document's ids and ``end_id``, cut at ``capacity``.

    ``key`` tells rows apart in one run of the job; write the rows down before using it twice.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = round_encoder(vocabulary)
        key, end = TaskContext.get().partitionId() << 40, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for b in small_batches(batch):
                rows = []
                for doc, ids in zip(b["doc_id"].to_pylist(), encoder.encode(b["text"])):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((key, doc, n, at // 4, len(part) // 4, part))
                        key += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["key", "doc_id", "piece", "start", "length", "ids"])
    return id_text(docs, id_col, text_col).mapInArrow(
        released(each, round_encoder), "key bigint, doc_id bigint, piece int, start bigint, length bigint, ids binary")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and the sequence's final gap of each length, taken from long to short.

    Putting s into a gap g changes the sum of squared counts N by
    ``2 (N[g - s] - N[g]) + 2`` (a gap that closes counts no more:
    ``1 - 2 N[g]``); of equal changes the smallest gap wins.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_: dict[int, list[int]] = {}
    gaps: list[int] = []
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        here = count[s:capacity]
        change = np.where(here > 0, 2 * (count[:capacity - s] - here) + 2, np.iinfo(np.int64).max)
        if s < capacity and here[0]:
            change[0] = 1 - 2 * here[0]
        best = int(change.argmin()) if s < capacity else 0
        if s < capacity and here[best]:
            g = best + s
            b = open_[g].pop()
            count[g] -= 1
        else:
            b, g = len(gaps), capacity
            gaps.append(capacity)
        seq[i], offset[i] = b, capacity - g
        gaps[b] = g = g - s
        if g:
            count[g] += 1
            open_.setdefault(g, []).append(b)
    return seq, offset, np.array(gaps, np.int64)[seq] if len(gaps) else seq


def assign(items: DataFrame, capacity: int) -> DataFrame:
    """``key, length`` (1 to capacity) to ``key, sequence_id, offset``; a sequence is named by the key of its first item."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        seq, offset, gap = place(group["length"].to_numpy(), capacity)
        first = np.zeros(seq.max() + 1, np.int64)
        first[seq[offset == 0]] = group["key"].to_numpy()[offset == 0]
        return pd.DataFrame({"key": group["key"], "length": group["length"], "sequence_id": first[seq], "offset": offset, "gap": gap})

    whole = items.where(F.col("length") == capacity).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    out, rest = whole, items.where(F.col("length") < capacity).select("key", "length")
    groups, n = None, 0
    while True:
        before, groups, n = groups, -(-rest.count() // GROUP), n + 1
        groups = groups if groups > LAST else 1
        packed = staged(rest.withColumn("group", F.pmod(F.xxhash64("key", F.lit(n)), F.lit(groups)))
                        .groupBy("group").applyInPandas(pack, "key bigint, length bigint, sequence_id bigint, offset bigint, gap bigint"), "packing")
        last = groups == 1 or (before is not None and groups >= before)
        done = packed if last else packed.where(F.col("gap") < capacity * SPARE)
        out = out.unionByName(done.select("key", "sequence_id", "offset"))
        if last:
            return out
        rest = packed.where(F.col("gap") >= capacity * SPARE).select("key", "length")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    A document's ids end with ``end_id``; only documents of more than
    ``capacity`` ids are cut, into pieces of ``capacity`` and a last one that
    may be shorter.  Sequences hold ``capacity`` ids at most and are gapless
    from offset 0.  A null or empty text is the one id ``end_id``; repeated
    rows are packed each; null ids stay null; an empty table has no pieces.
    Equal gaps are filled in the order of keys, so ties are settled within a run.
    ``vocabulary`` is a path that every executor can open.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    rows = staged(pieces(docs, vocabulary, capacity, end_id, id_col, text_col)
                  .withColumn("ids_crc32", F.crc32("ids")), "pieces")
    return rows.join(assign(rows.select("key", "length"), capacity), "key").drop("key")
