"""BPE encoding with a segment tree over adjacent pair ranks, and decoding.

A word starts as its bytes; leaf i of the tree holds the rank of the pair that
starts at symbol i (infinite if it is no merge), joined with i, and each node
the smaller of its two children.  So the root is the leftmost pair of lowest
rank.  A merge changes three leaves and the nodes above them, and the word is
done when the root is infinite.  The trees of many words are one numpy array
and take their steps together; a word of great length has a tree of its own.

Texts reach the trees as words: white space parts a text into chunks, a chunk
is normalised and cut by the vocabulary's pattern, and what was seen before is
looked up in bounded tables.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from ratelens.llm.common import cut_text, id_text, kept, released

INF = np.iinfo(np.int64).max
#: White space of the vocabulary's patterns (Unicode, without the separators 28-31).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPLIT = regex.compile(f"[{_SPACE}]+")
#: Fixed by the vocabulary file (its pre-tokenizer's pattern, white space written out).
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Chunks and words that a look-up table takes before it becomes the old one, the greatest bytes of
#: a chunk that is kept, and characters encoded at a time.
CHUNKS, WORDS, KEPT, SLICE = 120_000, 100_000, 64, 1 << 22


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next free one from 256 on."""
    out, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class Merges:
    """Vocabulary, pair ranks and the segment-tree encoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.tokens: list[str | None] = [None] * size
        for t, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = t
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.base = size
        key = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b); INF where they don't merge or a symbol is missing (-1)."""
        want = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (a >= 0) & (b >= 0), self.ranks[at], INF)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list[bytes] = [b""] * len(raw)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if w:
                groups.setdefault(max(1, 1 << max(0, len(w) - 2).bit_length()), []).append(i)
        for leaves, members in groups.items():
            if leaves > 2048:
                for i in members:
                    out[i] = self._one(raw[i], leaves)
                continue
            step = max(1, (1 << 20) // leaves)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                for i, ids in zip(part, self._many([raw[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _many(self, raw: list[bytes], leaves: int) -> list[bytes]:
        n, width = len(raw), leaves + 2                                  # symbols 0..leaves, then a blank
        size = np.fromiter(map(len, raw), np.int64, n)
        rows = np.arange(n)
        text = np.frombuffer(b"".join(raw), np.uint8)
        at = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        sym = np.full((n, width), -1, np.int64)
        sym[np.repeat(rows, size), at] = self.inner[text]
        sym[rows, size - 1] = self.last[text[np.cumsum(size) - 1]]
        after = np.tile(np.arange(1, width + 1), (n, 1))
        after[rows, size - 1] = width - 1                                # the blank ends every word
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        place = np.arange(leaves)
        tree = np.full((n, 2 * leaves), INF, np.int64)
        rank = self.rank(sym[:, :leaves], sym[:, 1:leaves + 1])
        tree[:, leaves:] = np.where(rank < INF, rank * leaves + place, INF)
        level = leaves
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = rows
        while len(live := live[tree[live, 1] < INF]):
            root = tree[live, 1]
            p, new = root % leaves, self.merged[root // leaves]
            r = after[live, p]
            q, s = before[live, p], after[live, r]
            sym[live, p], sym[live, r] = new, -1
            after[live, p], before[live, s] = s, p
            right = self.rank(new, sym[live, s])
            left = self.rank(np.where(q >= 0, sym[live, q], -1), new)
            for leaf, value in ((r, INF), (p, np.where(right < INF, right * leaves + p, INF)),
                                (q, np.where(left < INF, left * leaves + q, INF))):
                use = (leaf >= 0) & (leaf < leaves)
                node, own = leaf[use] + leaves, live[use]
                tree[own, node] = value if np.isscalar(value) else value[use]
            for leaf in (r, p, q):
                use = (leaf >= 0) & (leaf < leaves)
                node, own = leaf[use] + leaves, live[use]
                for _ in range(leaves.bit_length() - 1):
                    node = node >> 1
                    tree[own, node] = np.minimum(tree[own, 2 * node], tree[own, 2 * node + 1])
        keep = sym >= 0
        ids = sym[keep].astype("<u4")
        ends = np.cumsum(keep.sum(1))
        return [ids[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]

    def _one(self, raw: bytes, leaves: int) -> bytes:
        """The same for one long word, with plain lists."""
        base, merged = self.base, self.merged
        table = self._table
        sym = self.inner[np.frombuffer(raw, np.uint8)].tolist()
        sym[-1] = int(self.last[raw[-1]])
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [INF] * (2 * leaves)

        def leaf(i: int) -> int:
            j = after[i]
            r = table.get(sym[i] * base + sym[j]) if j < n else None
            return INF if r is None else r * leaves + i
        for i in range(n - 1):
            tree[leaves + i] = leaf(i)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            node = leaves + i
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < INF:
            rank, p = divmod(tree[1], leaves)
            r = after[p]
            s = after[r]
            sym[p], sym[r], after[p] = int(merged[rank]), -1, s
            if s < n:
                before[s] = p
            if r < leaves:
                put(r, INF)
            if p < leaves:
                put(p, leaf(p))
            if before[p] >= 0:
                put(before[p], leaf(before[p]))
        return np.array([x for x in sym if x >= 0], "<u4").tobytes()

    @cached_property
    def _table(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings joined by one space; ids without a token give nothing."""
        tokens = self.tokens
        out = [tokens[i] for i in ids.tolist() if i < len(tokens)]
        return " ".join(t for t in out if t is not None) if None in out else " ".join(out)


class Recent:
    """A bounded look-up table in two generations: what is used again outlives a change of generation.

    ``now`` holds all keys of the slice at work; beyond ``limit`` keys it
    becomes the old generation, whose keys come back when they are asked for.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.long: list[str] = []   # long keys of ``now``

    def missing(self, keys: set[str]) -> set[str]:
        """Keys in neither generation; those of the old one are brought over."""
        if len(self.now) > self.limit:
            for k in self.long:  # they are rare and would make the bound in bytes void
                self.now.pop(k, None)
            self.old, self.now, self.long = self.now, {}, []
        # difference() with a dict walks the set alone; operators on key views walk the whole table
        keys = keys.difference(self.now)
        new = keys.difference(self.old)
        back = keys - new
        self.now.update(zip(back, map(self.old.__getitem__, back)))
        self.long += [k for k in new if len(k) > KEPT]
        return new


class Encoder:
    """Texts to ids, with bounded look-up tables of chunks and words seen before.

    A worker process keeps the tables from task to task: at most four tables
    of ``CHUNKS`` or ``WORDS`` short keys (about 80 MB) and what one slice of text adds.
    """

    def __init__(self, special: dict[str, int], encode_words: Callable[[list[str]], list[bytes]]):
        self.encode_words = encode_words
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.marks = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.words, self.chunks = Recent(WORDS), Recent(CHUNKS)

    @staticmethod
    def lowered(chunks: list[str]) -> list[str]:
        """Normalised: composed, lower-cased letter by letter (no final sigma); as one text, since no chunk holds white space."""
        text = "\n".join(chunks)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower().split("\n") if chunks else []

    @staticmethod
    def pieces(low: str) -> list[str]:
        """The pattern's pieces of a normalised chunk that is not letters alone."""
        if low[-1] in ".,;:" and low[:-1].isalpha():
            return [low[:-1], low[-1]]
        return _PIECES.findall(low)

    def _cut(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split would part there, the vocabulary doesn't
            return [c for c in _SPLIT.split(text) if c]
        return text.split()

    def _learn(self, chunks: set[str]) -> None:
        keys, pieces = list(chunks), self.pieces
        low = self.lowered(keys)
        one = [w.isalpha() for w in low]  # letters alone are one piece
        whole = list(compress(low, one))
        cut = {c: pieces(w) for c, w, letters in zip(keys, low, one) if not letters}
        new = list(self.words.missing(set(whole).union(*cut.values())))
        words = self.words.now
        words.update(zip(new, self.encode_words(new)))
        look = words.__getitem__
        self.chunks.now.update(zip(compress(keys, one), map(look, whole)))
        self.chunks.now.update(zip(cut, [look(ws[0]) if len(ws) == 1 else b"".join(map(look, ws)) for ws in cut.values()]))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text (little-endian unsigned 32-bit), a few texts at a time, a long text in parts."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        texts = texts.fill_null("")
        # marks, and controls that Arrow and the vocabulary tell apart as white space, go the longer way
        plain = pc.and_(pc.invert(pc.match_substring_regex(texts, "<\\||[\x1c-\x1f]")), pc.less_equal(pc.binary_length(texts), SLICE))
        if pc.all(plain).as_py() is not False:
            return self._columns(texts)
        out: list[bytes] = [b""] * len(texts)
        for held, way in ((plain, self._columns), (pc.invert(plain), lambda t: self._parts(t.to_pylist()))):
            at = np.flatnonzero(held.to_numpy(zero_copy_only=False))
            for i, ids in zip(at.tolist(), way(texts.filter(held))):
                out[i] = ids
        return out

    def _columns(self, texts: pa.Array) -> list[bytes]:
        """Texts cut, and their chunks told apart, by Arrow; only distinct chunks meet the look-up tables."""
        out: list[bytes] = []
        sizes = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            if b == a:
                continue
            lists = pc.utf8_split_whitespace(texts.slice(a, b - a))
            coded = lists.flatten().dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            unknown = self.chunks.missing(set(distinct))
            unknown.discard("")
            if unknown:
                self._learn(unknown)
            self.chunks.now[""] = b""
            ids = list(map(self.chunks.now.__getitem__, distinct))
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            start = np.cumsum(size) - size
            which = coded.indices.to_numpy()
            count = size[which]
            ends = np.concatenate([[0], np.cumsum(count)])
            take = np.repeat(start[which] - ends[:-1], count) + np.arange(ends[-1])
            raw = np.frombuffer(b"".join(ids), "<u4")[take].tobytes()
            bound = (4 * ends[np.asarray(lists.offsets) - lists.offsets[0].as_py()]).tolist()
            out += [raw[s:e] for s, e in zip(bound, bound[1:])]
        return out

    def _parts(self, texts: list[str]) -> list[bytes]:
        parts = [list(cut_text(t, SLICE)) for t in texts]
        ids = self._few([p for ps in parts for p in ps])
        ends = np.cumsum([len(ps) for ps in parts]).tolist()
        return [ids[e - 1] if len(ps) == 1 else b"".join(ids[e - len(ps):e]) for ps, e in zip(parts, ends)]

    def _few(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE):
                size += len(texts[j])
                j += 1
            # a text is chunks; where special tokens stand in it, chunks and marks in turn
            cut = [[self._cut(s) for s in self.marks.split(t)] if self.marks is not None and "<|" in t else [self._cut(t)]
                   for t in texts[i:j]]
            unknown = self.chunks.missing(set().union(*chain.from_iterable(cut)))
            if unknown:
                self._learn(unknown)
            look = self.chunks.now.__getitem__
            for segments in cut:  # every second segment is a mark
                out.append(b"".join([self.special[s[0]] if k % 2 else b"".join(map(look, s)) for k, s in enumerate(segments)]))
            i = j
        return out


@kept
def tree_encoder(path: str) -> tuple[Merges, Encoder]:
    """One encoder a worker process and vocabulary file."""
    merges = Merges(path)
    return merges, Encoder(merges.special, merges.encode_words)


def small_batches(batch: pa.RecordBatch, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` text characters, whole rows."""
    sizes = np.asarray(pc.binary_length(batch["text"]).fill_null(0), np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """doc_id, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``, one row a document.

    Special tokens of the vocabulary that stand in a text are one id each; none
    is added.  ``decoded`` is made from the ids (tokens joined by one space,
    special ones kept).  A null text is an empty one: no ids, empty ``decoded``.
    Repeated rows are encoded row by row; null ids stay null.  ``vocabulary``
    is a path that every executor can open.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, encoder = tree_encoder(vocabulary)
        for batch in batches:
            for b in small_batches(batch):
                ids = encoder.encode(b["text"])
                cols = [b["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array([merges.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids", *["decoded"] * decoded])
    return id_text(docs, id_col, text_col).mapInArrow(
        released(each, tree_encoder), "doc_id bigint, n_tokens bigint, ids binary" + ", decoded string" * decoded)
