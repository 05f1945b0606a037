"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

A document's set of word shingles is hashed once.  The hash range is cut into
``BINS`` bins, each with its least hash; an empty bin copies the bin that a
fixed sequence of random places, its own for each bin, first finds filled.
Bands of ``ROWS`` bins are the keys of the buckets.  At a similarity of 0.8
two sets miss each other in all 32 bands with probability 5e-8.

A bucket proposes a star, not all pairs: each member with one centre, and the
full sets confirm or refuse the pair.  Where a bucket then still holds several
components, the members outside its largest one meet all members of other
components in tiles of signatures.  A tile names the members that may be
similar to one of another component (never the pairs), and a spanning forest
over the components that they would join.  What would hang together then is a
cluster; in each cluster the members' full sets are compared, in tiles again
that hand on a forest of links between components.  So no link between two
members of a bucket is lost: pairs never compared are in one component
already.  Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_text, id_text, join_hot, released, staged, text_hash
from ratelens.llm.simhash import components

BINS_LOG = 7
BINS = 1 << BINS_LOG
ROWS = 4
#: Members in one block of a mixed bucket; a pair of blocks is compared at a time.
BLOCK = 256
#: Pairs of a star that go to one task of the confirming join.
STAR = 1024
#: Bins in which the signatures of similar sets agree at least, by the size of the smaller set: some five standard
#: deviations below 0.8 of them.  Smaller sets fill too few bins to be told apart by signatures.
AGREE = ((64, BINS // 2), (256, 80 * BINS // 128))
#: Shingles in one block of a cluster, and shared ones compared at a time.
BLOCK_SHINGLES, COLUMNS = 1 << 17, 2048
#: Nodes and joins that a task of the signature tiles holds at most before it hands on what is distinct.
TOLD = 1 << 20
_WORDS = 1 << 18


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _attempts(width: int = 1024) -> np.ndarray:
    """For each bin the places it tries in turn while empty."""
    return np.random.Generator(np.random.PCG64(11)).integers(0, BINS, (BINS, width))


_TRIES = _attempts()


class Shingles(dict):
    """Sets of shingle hashes of texts; remembers words' hashes, at most ``_WORDS`` of them between texts."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; a text with fewer words is one shingle, one without words none."""
        if len(self) > _WORDS:
            self.clear()
        found, words = [], []
        for part in cut_text(text):  # a long text in parts, the last words carried on
            words += part.encode("utf-8", "surrogatepass").lower().split()
            if len(words) >= self.width:
                found.append(self._hashes(words, self.width))
                words = words[len(words) - self.width + 1:]
        if not found:
            return self._hashes(words, len(words)) if words else np.empty(0, np.uint64)
        return np.unique(np.concatenate(found)) if len(found) > 1 else np.unique(found[0])

    def _hashes(self, words: list[bytes], width: int) -> np.ndarray:
        h = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        n = len(h) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
        return out


_BOUNDS = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS_LOG)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin (``hashes`` sorted, not empty), empty bins filled by optimal densification."""
    at = np.searchsorted(hashes, _BOUNDS)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    filled = (least >> np.uint64(64 - BINS_LOG)) == np.arange(BINS, dtype=np.uint64)
    empty = np.flatnonzero(~filled)
    for start in range(0, _TRIES.shape[1], 64):
        if not len(empty):
            return least
        tries = _TRIES[empty, start:start + 64]
        hit = filled[tries]
        found = hit.any(1)
        least[empty[found]] = least[tries[found, hit[found].argmax(1)]]
        empty = empty[~found]
    if len(empty):  # hardly ever: the next filled bin
        full = np.flatnonzero(filled)
        least[empty] = least[full[np.searchsorted(full, empty) % len(full)]]
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bands = signatures.reshape(len(signatures), -1, ROWS)
    out = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(ROWS):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, ``node`` (a hash of the set, null if empty), ``keys`` and ``sig`` (a byte a bin) of each document.

    ``docs`` holds doc_id, text and text_hash.  Nodes are 64 bits: two sets of
    a corpus of 10**9 distinct ones share a node with probability 3 percent.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for b in batches:
            size, node, sig = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint64), np.zeros((b.num_rows, BINS), np.uint64)
            for i, t in enumerate(b["text"]):
                s = shingles.of(t.as_py())
                size[i] = len(s)
                if len(s):
                    node[i] = xxhash.xxh64_intdigest(s.tobytes())
                    sig[i] = signature(s)
            keys = band_keys(sig).view(np.int64)
            none = size == 0
            yield pa.RecordBatch.from_arrays([
                b["doc_id"], b["text_hash"], pa.array(size), pa.array(node.view(np.int64), mask=none),
                pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel())),
                pa.array([r.tobytes() for r in (sig & np.uint64(255)).astype(np.uint8)], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "node", "keys", "sig"])
    return docs.mapInArrow(released(each), "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, keys array<bigint>, sig binary")


def buckets(rows: DataFrame) -> DataFrame:
    """Members (key, node, centre) of the buckets with several nodes; the centre is one of them."""
    dealt = rows.where("node IS NOT NULL").select("node", F.explode("keys").alias("key"))
    several = staged(dealt.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("high"), F.count("*").alias("n"))
                     .where("centre <> high").select("key", "centre", "n"), "buckets")
    return staged(join_hot(dealt, several.select("key", "centre"), ["key"], sizes=several.select("key", "n")).distinct(), "members")


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` of the wanted nodes, one row each.

    ``docs`` holds doc_id, text and text_hash; ``nodes`` the document that
    stands for a node (node, doc_id, text_hash).
    """
    none = F.lit(-(1 << 63))
    carriers = nodes.join(wanted, "node").select("node", F.coalesce("doc_id", none).alias("__id"), "text_hash")
    return (docs.select(F.coalesce("doc_id", none).alias("__id"), "text_hash", "text").join(carriers, ["__id", "text_hash"])
            .dropDuplicates(["node"]).select("node", "text"))


def confirm(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` (nodes) whose full sets are similar enough.

    The pairs of a frequent b are dealt to several tasks.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = staged(texts_of(docs, nodes, wanted), "texts")
    stars = staged(pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR).alias("parts")), "stars")
    spread = join_hot(pairs, stars, ["b"], sizes=stars.select("b", (F.col("parts") * STAR).alias("n")))
    left = spread.select("a", "b", F.pmod(F.xxhash64("a"), "parts").alias("part")).join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    right = texts.join(stars, F.col("node") == F.col("b")).select("b", F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, centre, other = Shingles(width), None, None
        for x in batches:
            a, b = x["a"].to_numpy(), x["b"].to_numpy()
            held = np.zeros(x.num_rows, bool)
            for i in range(x.num_rows):
                if other is None or b[i] != centre:
                    centre, other = b[i], shingles.of(x["text_b"][i].as_py())
                own = shingles.of(x["text_a"][i].as_py())
                if 100 * min(len(own), len(other)) < percent * max(len(own), len(other)):
                    continue
                both = len(np.intersect1d(own, other, assume_unique=True))
                held[i] = 100 * both >= percent * (len(own) + len(other) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[held]), pa.array(b[held])], names=["a", "b"])
    return left.join(right, ["b", "part"]).select("a", "b", "text_a", "text_b").mapInArrow(released(compared), "a bigint, b bigint")


def forest(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the pairs ``a[rows[i]], b[cols[i]]``: at most one fewer than there are nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = y
        return x
    left, right = [], []
    for x, y in zip(a[rows].tolist(), b[cols].tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            left.append(x)
            right.append(y)
    return np.array(left, np.int64), np.array(right, np.int64)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The intersection sizes of all pairs of two lists of sets, by products of slices of the incidence matrices."""
    out = np.zeros((len(left), len(right)), np.int64)
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    shared = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    held = []
    for value, row in sides:
        col = np.minimum(np.searchsorted(shared, value), max(0, len(shared) - 1))
        here = np.flatnonzero(shared[col] == value) if len(shared) else np.empty(0, np.int64)
        here = here[np.argsort(col[here], kind="stable")]
        held.append((col[here], row[here]))
    for start in range(0, len(shared), COLUMNS):
        slices = []
        for (col, row), n in zip(held, out.shape):
            a, b = np.searchsorted(col, [start, start + COLUMNS])
            m = np.zeros((n, COLUMNS), np.float32)
            m[row[a:b], col[a:b] - start] = 1
            slices.append(m)
        out += (slices[0] @ slices[1].T).astype(np.int64)
    return out


def _blocks(members: DataFrame, row) -> DataFrame:
    """``rows`` of a bucket in ``blocks`` blocks, those outside its largest component (``outside``) apart."""
    return (members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("row", row)
            .groupBy("key", "blocks", "block", (F.col("root") != F.col("main")).alias("outside")).agg(F.collect_list("row").alias("rows")))


def _met(blocks: DataFrame) -> DataFrame:
    """``left, right``: each block outside the largest component with every block of its bucket, each pair once, in its own row."""
    lead = blocks.where("outside").select("key", F.col("block").alias("at"), F.col("rows").alias("left"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # of two blocks that both lie outside either leads, so that each leads some half of its pairs
    turn = F.expr("NOT outside OR at = block OR ((at + block) % 2 = 0) = (at < block)")
    return lead.join(blocks.select("key", "block", F.col("rows").alias("right"), "outside"), ["key", "block"]).where(turn).select("left", "right")


def told_once(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """``a, b, joins`` of all (nodes, their roots, and pairs left, right of roots) of a task: each node and each join once.

    Held are the distinct nodes and a forest, which are handed on at the task's end or once they fill half of ``TOLD``.
    """
    none = tuple(np.empty(0, np.int64) for _ in range(4))

    def merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        node, root, left, right = (np.concatenate(part) for part in zip(*held))
        node, first = np.unique(node, return_index=True)
        return node, root[first], *forest(left, right, np.arange(len(left)), np.arange(len(left)))

    def rows(node, root, left, right) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([node, np.minimum(left, right)])), pa.array(np.concatenate([root, np.maximum(left, right)])),
            pa.array(np.arange(len(node) + len(left)) >= len(node))], names=["a", "b", "joins"])
    held, size = [none], 0
    for part in parts:
        held.append(part)
        size += len(part[0]) + len(part[2])
        if size >= TOLD:
            kept = merged(held)
            held, size = [kept], len(kept[0]) + len(kept[2])
            if 2 * size >= TOLD:
                yield rows(*kept)
                held, size = [none], 0
    yield rows(*merged(held))


def open_members(members: DataFrame, nodes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """``a, b`` twice: nodes (and their roots) that by sizes and signatures may be similar to one in another component of a bucket,
    and, where ``joins``, a forest over the roots that they would join.

    Only members outside a bucket's largest component lead comparisons.  The tiles name no roots: those that are joined count as named.
    """
    labelled = staged(members.select("key", "node").join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "labelled")
    mixed = staged(labelled.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), F.sum("n").alias("n")).where("roots > 1")
        .select("key", "main", F.ceil(F.col("n") / BLOCK).alias("blocks"), "n"), "mixed")
    dealt = join_hot(labelled, mixed.select("key", "main", "blocks"), ["key"], sizes=mixed.select("key", "n"))
    row = F.struct("node", "root", F.col("n_shingles").alias("size"), "sig")
    blocks = staged(_blocks(dealt.join(nodes.select("node", "n_shingles", "sig"), "node"), row), "bucket-blocks")

    def arrays(rows) -> tuple[np.ndarray, ...]:
        v = rows.values
        sig = np.frombuffer(b"".join(s.as_py() for s in v.field("sig")), np.uint8).reshape(-1, BINS)
        return v.field("node").to_numpy(), v.field("root").to_numpy(), v.field("size").to_numpy(), sig

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return told_once(map(similar, batches))

    def similar(x: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        named, edges = ([[np.empty(0, np.int64)], [np.empty(0, np.int64)]] for _ in range(2))
        for p, q in zip(x["left"], x["right"]):
            (n1, r1, s1, g1), (n2, r2, s2, g2) = arrays(p), arrays(q)
            low, high = np.minimum(s1[:, None], s2[None, :]), np.maximum(s1[:, None], s2[None, :])
            i, j = np.nonzero((r1[:, None] != r2[None, :]) & (100 * low >= percent * high))
            like = np.zeros(len(i), bool)
            for s in range(0, len(i), 1 << 15):
                k, m = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
                need = np.zeros(len(k), np.int64)
                for size, bins in AGREE:
                    need[low[k, m] >= size] = bins
                like[s:s + (1 << 15)] = (g1[k] == g2[m]).sum(1) >= need
            i, j = i[like], j[like]
            for side, part in zip(edges, forest(r1, r2, i, j)):
                side.append(part)
            for node, root, k in ((n1, r1, np.unique(i)), (n2, r2, np.unique(j))):
                k = k[node[k] != root[k]]
                named[0].append(node[k])
                named[1].append(root[k])
        return tuple(np.concatenate(part) for part in (*named, *edges))
    told = staged(_met(blocks).mapInArrow(released(compared), "a bigint, b bigint, joins boolean").distinct(), "told")
    roots = told.where("joins").select("a").union(told.where("joins").select("b")).distinct()
    return told.unionByName(roots.select("a", F.col("a").alias("b"), F.lit(False).alias("joins")))


def settle(docs: DataFrame, nodes: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` between the roots of open members (:func:`open_members`), that connect them as all similar pairs
    within a cluster would, on full sets."""
    key = components(members.where("joins").select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("key"))
    labelled = staged(members.where("NOT joins").select(F.col("a").alias("node"), F.col("b").alias("root")).join(key, "root")
                      .join(nodes.select("node", "n_shingles"), "node"), "clustered")
    groups = staged(labelled.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size")).groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("blocks"), F.sum("n").alias("n")), "clusters")
    dealt = join_hot(labelled, groups.select("key", "main", "blocks"), ["key"], sizes=groups.select("key", "n"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for x in batches:
            yield pa.RecordBatch.from_arrays([x["node"], pa.array([shingles.of(t.as_py()).tobytes() for t in x["text"]], pa.binary())], names=["node", "set"])
    sets = texts_of(docs, nodes, labelled.select("node")).mapInArrow(released(each), "node bigint, set binary")
    blocks = staged(_blocks(dealt.join(sets, "node"), F.struct("root", "set")), "open-blocks")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for p, q in zip(x["left"], x["right"]):
                (r1, s1), (r2, s2) = ((rows.values.field("root").to_numpy(), [np.frombuffer(s.as_py(), np.uint64) for s in rows.values.field("set")]) for rows in (p, q))
                both = overlaps(s1, s2)
                union = np.array([len(s) for s in s1])[:, None] + np.array([len(s) for s in s2])[None, :] - both
                left, right = forest(r1, r2, *np.nonzero((r1[:, None] != r2[None, :]) & (100 * both >= percent * union)))
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])
    return _met(blocks).mapInArrow(released(compared), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_hash, one row a document.

    Documents are linked whose sets of ``width``-word shingles share
    ``percent`` hundredths of their union (80 at least, for which the bands are made); A-Z count as a-z, words end at
    ASCII white space, a text with fewer words is one shingle.  component_id is
    the smallest doc_id reachable, ``kept`` says that it is the row's own.
    Null and empty texts have no shingles and stay alone.  A null id counts for
    no minimum (component_id is null where a component has no id, and its rows
    are kept); repeated rows are one node and keep their rows.  An empty
    table gives an empty result.
    """
    if width < 1 or not 80 <= percent <= 100:
        raise ValueError("width must be at least 1 and percent between 80 and 100")
    texts = id_text(docs, id_col, text_col).withColumn("text_hash", text_hash(F.col("text")))
    rows = staged(signatures(texts, width), "minhash-rows")
    full = rows.where("node IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = staged(full.groupBy("node").agg(first.alias("m"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
                   .select("node", "m.doc_id", "m.text_hash", "n", "n_shingles", "sig"), "nodes")
    members = buckets(rows)
    star = staged(members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "stars")
    links = staged(confirm(texts, nodes, star, width, percent), "star-links")
    found = staged(components(links), "components")
    rest = staged(open_members(members, nodes, found, percent), "open-members")
    merged = components(staged(settle(texts, nodes, rest, width, percent), "more-links")).select(F.col("node").alias("root"), F.col("root").alias("top"))
    named = staged(nodes.select("node", F.col("doc_id").alias("least"), "n").join(found, "node", "left")
                   .withColumn("root", F.coalesce("root", "node")).join(merged, "root", "left")
                   .select("node", "least", "n", F.coalesce("top", "root").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = staged(join_hot(named, least, ["root"]).select("node", "component_id", "n"), "known")
    out = join_hot(full.select("doc_id", "n_shingles", "text_hash", "node"), known.select("node", "component_id"), ["node"], sizes=known.select("node", "n"))
    alone = rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash")
    return out.select("doc_id", "n_shingles", "component_id", "text_hash").unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")
