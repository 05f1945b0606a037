"""SimHash near-duplicates by exact tiled comparison of fingerprints.

Distinct fingerprints are laid out in tiles.  A tile is named by the bit counts
of ``SEGMENTS`` parts of the fingerprint; the sum of the differences of two
such names is a lower bound of the bit distance, so tile pairs whose counts
differ beyond the radius are skipped and all others are compared whole, with
exclusive-or and bit counts in numpy.  Equal texts and equal fingerprints meet
before that, so a hot group of copies is one fingerprint.  A compared pair of
tiles hands on a spanning forest of the links it found, never all pairs, and
components grow from those links in rounds that are written down.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_text, id_text, released, staged, text_hash

SEED = 42
BITS = 64
#: Parts whose bit counts name a tile.  More parts skip more pairs and copy a fingerprint to more neighbour tiles.
SEGMENTS = 6
#: Fingerprints in one block of a tile; a pair of blocks is compared at a time.
BLOCK = 4096


def fingerprint(text: str, width: int = 3) -> int:
    """The SimHash of a text: A-Z lower-cased, words split at ASCII white space, shingles of ``width`` words.

    A text with fewer words is one shingle, a text without words has fingerprint zero.
    """
    counts, total, words = np.zeros(BITS, np.int64), 0, []
    for part in cut_text(text):  # a long text in parts, the last words carried on
        words += part.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters, ASCII spaces
        shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(width)))]
        counts += set_bits(shingles)
        total += len(shingles)
        words = words[len(words) - width + 1:] if len(words) >= width else words
    if not total and words:
        counts, total = set_bits([b" ".join(words)]), 1
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def set_bits(shingles: list[bytes]) -> np.ndarray:
    """How many of the shingles' hashes have each bit set, highest bit first; in slices, so memory stays small."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(shingles), 1 << 14):
        part = shingles[i:i + (1 << 14)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), np.uint64, len(part))
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and ``fp`` (the 64 bits as a signed bigint), one row a document, without an exchange."""
    if width < 1:
        raise ValueError("width must be at least 1")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py() or "", width) for t in b["text"]), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])
    return id_text(docs, id_col, text_col).withColumn("text_hash", text_hash(F.col("text"))).mapInArrow(
        released(each), "doc_id bigint, text_hash bigint, fp bigint")


def _edges() -> np.ndarray:
    return np.linspace(0, BITS, SEGMENTS + 1).astype(int)


def tile_names(fps: np.ndarray) -> np.ndarray:
    """One number a fingerprint: the bit counts of its parts, five bits each."""
    names = np.zeros(len(fps), np.int64)
    for a, b in zip(_edges()[:-1], _edges()[1:]):
        part = (fps >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1)
        names = names * 32 + np.bitwise_count(part).astype(np.int64)
    return names


def _steps(radius: int) -> np.ndarray:
    """Differences of tile names within the radius, of each pair of opposites the larger, and zero."""
    out = {0}
    for d in product(range(-radius, radius + 1), repeat=SEGMENTS):
        if sum(map(abs, d)) <= radius:
            n = 0
            for x in d:
                n = n * 32 + x
            out.add(abs(n))
    return np.array(sorted(out), np.int64)


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over all pairs (x of a, y of b) within the radius.

    Rows of ``a`` are compared in slices; a pair is a link only if it joins two
    trees, so at most ``len(a) + len(b) - 1`` links come back whatever the pairs.
    """
    none = np.empty(0, np.uint64)
    if len(a) * len(b) <= 1 << 16:  # most pairs of small tiles hold no link
        x = a[:, None] ^ b[None, :]
        if not ((np.bitwise_count(x) <= radius) & (x != 0)).any():
            return none, none
    both, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = index[:len(a)], index[len(a):]
    root = np.arange(len(both))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    left, right = [], []
    rows = max(1, (1 << 20) // max(1, len(b)))
    for i in range(0, len(a), rows):
        near = np.bitwise_count(a[i:i + rows, None] ^ b[None, :]) <= radius
        for r in np.flatnonzero(near.any(1)):
            x = ia[i + r]
            others = ib[np.flatnonzero(near[r])]
            for y in others[root[others] != root[x]]:
                p, q = find(x), find(y)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    left.append(both[x])
                    right.append(both[y])
    return np.array(left, np.uint64), np.array(right, np.uint64)


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a, b`` (bigint) that connect distinct ``fp`` exactly as all pairs within ``radius`` bits would.

    ``fps`` holds the column ``fp``; nulls and repeats are left out.
    """
    if not 0 <= radius <= 4:
        raise ValueError("radius must lie between 0 and 4")
    steps = _steps(radius)
    distinct = fps.select("fp").where("fp IS NOT NULL").distinct()

    def named(batches):
        for x in batches:
            f = x["fp"].to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([x["fp"], pa.array(tile_names(f.view(np.uint64)))], names=["fp", "tile"])
    tiles = distinct.mapInArrow(named, "fp bigint, tile bigint")
    # a dense tile becomes several blocks; a block is one row from here on
    sizes = tiles.groupBy("tile").agg(F.count("*").alias("n"))
    blocks = staged(tiles.join(sizes, "tile")
                    .withColumn("block", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / BLOCK)))
                    .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    # the higher side goes to its lower neighbours; a tile's own blocks meet once
    here = blocks.select("tile", F.col("block").alias("block_a"), F.col("fps").alias("fps_a"))
    there = blocks.select(F.col("tile").alias("from"), F.col("block").alias("block_b"), F.col("fps").alias("fps_b"),
                          F.explode(F.array(*[F.col("tile") - int(s) for s in steps])).alias("tile"))
    pairs = here.join(there, "tile").where("tile < `from` OR block_a <= block_b").select("fps_a", "fps_b")

    def compared(batches):
        for x in batches:
            left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for p, q in zip(x["fps_a"], x["fps_b"]):
                found = forest(p.values.to_numpy().view(np.uint64), q.values.to_numpy().view(np.uint64), radius)
                left.append(found[0])
                right.append(found[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(s).view(np.int64)) for s in (left, right)], names=["a", "b"])
    return pairs.mapInArrow(released(compared), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (root: the smallest node of the component) for every node of ``a, b``.

    Large-star and small-star rounds: each round hangs the neighbours of a node
    on the smallest of them; the links written by a round replace the ones before, and the
    number of rounds grows with the logarithm of the component's size.
    """
    def key(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    said = key(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        now = staged(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                     .unionByName(joined.select("a", F.col("m").alias("b"))).distinct(), "links")
        last, said = said, key(now)
        if last == said:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``fp``, ``component_id``, ``component`` (a fingerprint that names it) and ``text_hash``, one row a document.

    ``component_id`` is the smallest doc_id of all documents that can be
    reached over fingerprints ``radius`` bits apart or less, itself included.
    Null and empty texts have fingerprint zero and link like any other.  Null
    ids keep their row and count for no minimum (null if a component has no
    id); repeated rows are one node and keep their rows.  An empty table gives
    an empty result.
    """
    rows = staged(fingerprints(docs, width, id_col, text_col), "simhash-rows")
    own = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(links(own, radius))
    nodes = own.join(linked, own["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(smallest, "root").select("fp", "component_id", F.col("root").alias("component"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "component", "text_hash")
