"""Substring dedup by exact windows of words, dealt to groups by their smallest-hashed run.

Every start of a window of ``min_words`` words is looked at.  Its group is its
anchor, the smallest-hashed run of ``ANCHOR`` words in the window, so equal
windows meet, and neighbouring windows share one anchor and travel as one
slice of text.  Groups that very many chunks share are split by a hash of the
whole window.  In a group the windows are taken in text order (document,
place) into a set of exact word sequences: one that is there already repeats
an earlier one.  This set stands in for a suffix tree cut at depth
``min_words``, of which no deeper nodes would be asked for; maximal repeats
are not listed, what is removed is the union of the covered words.

Before that, two steps keep windows at home that need no group: anchors seen
in one chunk of documents only, and windows that repeat inside their chunk,
of which only the first is sent.  Hashes choose anchors and propose; equality
is always that of the words.

Chunks are written once, bucketed by chunk id, so that what comes back to a
chunk is exchanged and the texts are not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import id_text, released, staged, text_hash
from ratelens.session import checkpoint_dir

#: Text bytes in a chunk (a longer document is a chunk of its own).
CHUNK = 2 << 20
#: Chunks with the same anchor from which its prefix is lengthened.
SHARED = 64

_R = np.uint64(0x9E3779B97F4A7C15)
_RI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n-1) modulo 2 ** 64, kept for the next call."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _POWERS[int(base)] = have
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a chunk: byte places, hashes, and the document of each; documents are lines of words."""

    def __init__(self, blob: bytes, min_words: int):
        self.blob, self.min_words = blob, min_words
        self.lines = blob.split(b"\n")
        text = b" ".join(x for x in self.lines if x)
        counts = np.fromiter((x.count(b" ") + 1 if x else 0 for x in self.lines), np.int64, len(self.lines))
        self.text, self.counts = text, counts
        self.first = np.cumsum(counts) - counts                     # of each document, as a word number
        data = np.frombuffer(text, np.uint8)
        gaps = np.flatnonzero(data == 32)
        n = len(gaps) + 1 if len(text) else 0
        self.n = n
        self.start = np.concatenate([[0], gaps + 1])[:n]
        self.end = np.concatenate([gaps, [len(text)]])[:n]
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.hash = np.empty(n, np.uint64)
        a = 0
        while a < n:                                                # blocks of whole words, so that power tables stay short
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + (1 << 18), side="right")))
            lo, hi = int(self.start[a]), int(self.end[b - 1])
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * _powers(_R, hi - lo), out=sums[1:])
            s, e = self.start[a:b] - lo, self.end[a:b] - lo
            self.hash[a:b] = _mix((sums[e] - sums[s]) * _powers(_RI, hi - lo + 1)[s])
            a = b
        left = counts[self.doc] - (np.arange(n) - self.first[self.doc])
        #: window starts: word numbers with min_words words of their document from there on
        self.windows = np.flatnonzero(left >= min_words)

    def grams(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each word on (those that cross a document's end included)."""
        m = self.n - width + 1
        if m <= 0:
            return np.empty(0, np.uint64)
        out = np.zeros(m, np.uint64)
        for j in range(width):
            out = out * _R + self.hash[j:j + m]
        return _mix(out)

    def window(self, i: int) -> bytes:
        return self.text[self.start[i]:self.end[i + self.min_words - 1]]

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The anchor's word number for each window, and all grams; of equal hashes the leftmost."""
        grams = self.grams(width)
        if not len(self.windows):
            return self.windows, grams
        at = np.empty(len(self.windows), np.int64)
        view = sliding_window_view(grams, self.min_words - width + 1)
        for k in range(0, len(at), 1 << 16):
            w = self.windows[k:k + (1 << 16)]
            lo, hi = int(w[0]), int(w[-1]) + 1
            at[k:k + (1 << 16)] = w + view[lo:hi].argmin(1)[w - lo]
        return at, grams

    def later(self, hashes: np.ndarray) -> np.ndarray:
        """For each window: does it repeat an earlier one of this chunk? ``hashes``: of the windows."""
        out = np.zeros(len(self.windows), bool)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        if not same.any():
            return out
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        seen: set[bytes] = set()
        which = np.sort(order[twice])
        text = self.text
        starts = self.start[self.windows[which]].tolist()
        ends = self.end[self.windows[which] + self.min_words - 1].tolist()
        for i, s, e in zip(which.tolist(), starts, ends):
            w = text[s:e]
            if w in seen:
                out[i] = True
            else:
                seen.add(w)
        return out


def _anchor_width(min_words: int) -> int:
    """Two fifths of the window, and enough that an anchor's windows fit the bits of a bigint."""
    return max(1, min_words * 2 // 5, min_words - 61)


def _chunks(docs: DataFrame, min_words: int, size: int) -> DataFrame:
    """chunk, doc_ids, text_hashes, blob (the documents' words, one document a line, compressed), grams (distinct anchor hashes)."""
    width = _anchor_width(min_words)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        held: list[tuple[int | None, bytes, int]] = []
        n = 0

        def pack() -> pa.RecordBatch:
            held.sort(key=lambda x: (x[0] is None, x[0] or 0))
            blob = b"\n".join(t for _, t, _ in held)
            words = Words(blob, min_words)
            at, grams = words.anchors(width)
            found = np.unique(grams[np.unique(at)]).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                 pa.array([[h for _, _, h in held]], pa.list_(pa.int64())),
                 pa.array([press.compress(blob)], pa.binary()), pa.array([found], pa.list_(pa.int64()))],
                names=["chunk", "doc_ids", "text_hashes", "blob", "grams"])
        for batch in batches:
            for d, t, h in zip(batch["doc_id"], batch["text"], batch["text_hash"]):
                words = b" ".join(t.as_buffer().to_pybytes().split())  # bytes part at ASCII white space alone
                held.append((d.as_py(), words, h.as_py()))
                n += len(words) + 1
                if n >= size:
                    yield pack()
                    chunk, n = chunk + 1, 0
                    held.clear()
        if held:
            yield pack()
    return id_text(docs, "doc_id", "text").withColumn("text_hash", text_hash(F.col("text"))).mapInArrow(
        released(each), "chunk bigint, doc_ids array<bigint>, text_hashes array<bigint>, blob binary, grams array<bigint>")


def _unpack(blob: bytes, min_words: int) -> Words:
    return Words(zstandard.ZstdDecompressor().decompress(blob), min_words)


def _slices(chunks: DataFrame, min_words: int, shared_from: int) -> DataFrame:
    """One row an anchor (and part of its windows): the suffixes that start there as one slice of words."""
    width = _anchor_width(min_words)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, blob, asked, shared in zip(*(batch[c] for c in ("chunk", "doc_ids", "blob", "hs", "ns"))):
                words = _unpack(blob.as_py(), min_words)
                ids = ids.as_py()
                at, grams = words.anchors(width)
                hs, ns = asked.values.to_numpy().view(np.uint64), shared.values.to_numpy()
                order = np.argsort(hs)
                hs, ns = hs[order], ns[order]
                own = grams[at]
                place = np.minimum(np.searchsorted(hs, own), len(hs) - 1)
                want = hs[place] == own
                hashes = words.grams(min_words)[words.windows]
                want &= ~words.later(hashes)
                # the windows of an anchor stand together; a shared anchor's are dealt by the whole window
                parts = -(-ns[place[want]] // shared_from)
                part = (hashes[want] % parts.astype(np.uint64)).astype(np.int64)
                window, anchor = words.windows[want], at[want]
                order = np.lexsort((window, part, anchor))
                window, anchor, part = window[order], anchor[order], part[order]
                cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
                begin = np.concatenate([[0], cut])[:len(cut) + (len(window) > 0)]
                stop = np.concatenate([cut, [len(window)]])[:len(begin)]
                if not len(begin):
                    continue
                lead = window[begin]
                bits = np.left_shift(np.int64(1), window - np.repeat(lead, stop - begin))
                masks = np.bitwise_or.reduceat(bits, begin)
                text = words.text
                tops = words.end[window[stop - 1] + min_words - 1].tolist()
                cuts = [text[a:b] for a, b in zip(words.start[lead].tolist(), tops)]
                doc = words.doc[lead]
                for k in range(0, len(begin), 20_000):
                    z = slice(k, k + 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grams[anchor[begin[z]]].view(np.int64)), pa.array(part[begin[z]].astype(np.int32)),
                         pa.array([chunk.as_py()] * len(begin[z]), pa.int64()), pa.array(lead[z].astype(np.int64)),
                         pa.array([ids[i] for i in doc[z].tolist()], pa.int64()), pa.array((lead[z] - words.first[doc[z]]).astype(np.int64)),
                         pa.array(masks[z]), pa.array(cuts[k:k + 20_000], pa.binary())],
                        names=["h", "part", "chunk", "lead", "doc_id", "pos", "mask", "slice"])
    return chunks.mapInArrow(released(each), "h bigint, part int, chunk bigint, lead bigint, doc_id bigint, pos bigint, mask bigint, slice binary")


def _repeats(slices: DataFrame, min_words: int) -> DataFrame:
    """chunk, lead, mask: the windows that repeat an earlier one of another chunk.

    A group's rows come in text order, so the tree holds each distinct suffix
    once, whatever the number of its occurrences.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, tree = None, set()
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for h, part, chunk, lead, mask, text in zip(*(batch[c].to_pylist() for c in ("h", "part", "chunk", "lead", "mask", "slice"))):
                if group != (h, part):
                    group, tree = (h, part), set()
                ends = [-1]
                at = text.find(b" ")
                while at >= 0:
                    ends.append(at)
                    at = text.find(b" ", at + 1)
                ends.append(len(text))
                found = 0
                for i in range(len(ends) - min_words):
                    if mask >> i & 1:
                        suffix = text[ends[i] + 1:ends[i + min_words]]
                        if suffix in tree:
                            found |= 1 << i
                        else:
                            tree.add(suffix)
                if found:
                    out.append((chunk, lead, found))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["chunk", "lead", "mask"])
    ordered = slices.repartition("h", "part").sortWithinPartitions(
        "h", "part", F.col("doc_id").asc_nulls_last(), "chunk", "pos")
    return ordered.mapInArrow(released(each), "chunk bigint, lead bigint, mask bigint")


def _result(chunks: DataFrame, min_words: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, hashes, blob, leads, masks in zip(*(batch[c] for c in ("doc_ids", "text_hashes", "blob", "leads", "masks"))):
                words = _unpack(blob.as_py(), min_words)
                gone = np.zeros(words.n + 1, np.int64)              # window starts to remove
                later = words.windows[words.later(words.grams(min_words)[words.windows])]
                gone[later] = 1
                if masks.is_valid:
                    lead, mask = leads.values.to_numpy(), masks.values.to_numpy()
                    for i in range(min_words - _anchor_width(min_words) + 1):
                        gone[lead[(mask >> i) & 1 == 1] + i] = 1
                begun = np.cumsum(gone[:words.n])
                before = np.concatenate([np.zeros(min_words, np.int64), begun])[:words.n]
                cover = begun > before                              # a removed window starts at one of the last min_words words
                removed = np.concatenate([[0], np.cumsum(cover)])
                texts, spans = [], []
                lost = removed[words.first + words.counts] - removed[words.first]
                for d, line in enumerate(words.lines):
                    if not lost[d]:
                        texts.append(line.decode("utf-8"))
                        spans.append([])
                        continue
                    a, b = int(words.first[d]), int(words.first[d] + words.counts[d])
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], cover[a:b], [0]]).astype(np.int8)))
                    runs = edge.reshape(-1, 2).tolist()
                    keep = [[0, *(e for _, e in runs)], [*(s for s, _ in runs), b - a]]
                    texts.append(b" ".join(words.text[words.start[a + s]:words.end[a + e - 1]]
                                           for s, e in zip(*keep) if e > s).decode("utf-8"))
                    spans.append([{"start": s, "end": e} for s, e in runs])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(ids.as_py(), pa.int64()), pa.array(words.counts), pa.array(lost.astype(np.int64)),
                     pa.array(texts, pa.string()), pa.array(spans, kind), pa.array(hashes.as_py(), pa.int64())],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "removed", "text_hash"])
                yield from (rows.slice(k, 1000) for k in range(0, rows.num_rows, 1000))
    return chunks.mapInArrow(released(each), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start:bigint,end:bigint>>, text_hash bigint")


def remove_repeats(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK,
                   shared_from: int = SHARED) -> DataFrame:
    """doc_id, ``n_words``, ``n_removed``, ``kept_text``, ``removed`` and ``text_hash``, one row a document.

    A word goes if a window of ``min_words`` consecutive words covers it whose
    words also start earlier: in a document of smaller id, or earlier in the
    same one; windows are judged on the input.  ``kept_text`` holds the kept
    words joined by one space, ``removed`` the stretches of removed words
    (first word, end exclusive).  A null or empty text has no words.  Documents
    without an id come after all others; rows that share an id count as
    documents of their own, of which the one read first is the earlier, so of
    repeated rows all but one lose their windows.  An empty table gives no rows.
    ``chunk_bytes`` and ``shared_from`` bound memory and change no result.
    """
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    name = f"chunks_{uuid.uuid4().hex}"
    (_chunks(source, min_words, chunk_bytes).write.format("parquet")
     .bucketBy(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "chunk")
     .option("path", checkpoint_dir(spark, "chunks")).saveAsTable(name))
    chunks = spark.table(name)
    grams = chunks.select("chunk", F.explode("grams").alias("h"))
    shared = grams.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1")
    asked = shared.groupBy("chunk").agg(F.collect_list("h").alias("hs"), F.collect_list("n").alias("ns")).hint("merge")
    sent = chunks.select("chunk", "doc_ids", "blob").join(asked, "chunk")
    found = _repeats(_slices(sent, min_words, shared_from), min_words)
    back = staged(found, "repeats").groupBy("chunk").agg(F.collect_list("lead").alias("leads"), F.collect_list("mask").alias("masks")).hint("merge")
    return _result(chunks.select("chunk", "doc_ids", "text_hashes", "blob").join(back, "chunk", "left"), min_words)
