"""Vector code compression: product codes of integer vectors, assigned through sliced bitmasks.

A vector is cut into equal parts; each part position has a codebook of at most
64 entries.  To find the entry next to a part, each codebook keeps, for every
dimension, its coordinates in order and for every place in that order the
entries before it as a 64-bit mask.  An entry guessed from the neighbours along
each dimension gives an initial radius; a slice of the sorted coordinates within
the radius is the exclusive-or of two prefix masks, and the masks of all
dimensions, ANDed, are the entries inside the box around the part.  The nearest
entry lies in that box, so the few candidates left are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import join_hot, staged

#: Integer components at or beyond this magnitude are refused: squared distances would pass 64 bits.
LIMIT = 1 << 27


class PartIndex:
    """The entries of one codebook (at most 64, integers) behind sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= 64:
            raise ValueError("a codebook holds 1 to 64 entries")
        self.entries = np.asarray(entries, np.int64)
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.before = np.concatenate([np.zeros((1, bits.shape[1]), np.uint64), np.bitwise_or.accumulate(bits, axis=0)])

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        d = x - self.entries[entry]
        return np.einsum("ij,ij->i", d, d)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """A mask of entries for each row of ``x``, among them every nearest one."""
        near = np.full(len(x), np.iinfo(np.int64).max)
        for j in range(x.shape[1]):  # the neighbour along each dimension; the closest of them sets the radius
            at = np.minimum(np.searchsorted(self.sorted[:, j], x[:, j]), len(self.entries) - 1)
            np.minimum(near, self.distance(x, self.order[at, j]), out=near)
        radius = np.ceil(np.sqrt(near.astype(np.float64))).astype(np.int64) + 1
        mask = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.before[high, j] ^ self.before[low, j]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, ties to the lower index."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        held = np.unpackbits(self.candidates(x).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(held)  # by row, then entry
        d = self.distance(x[row], entry)
        least = np.minimum.reduceat(d, np.searchsorted(row, np.arange(len(x))))
        hit = np.flatnonzero(d == least[row])
        first = hit[np.unique(row[hit], return_index=True)[1]]
        return entry[first], least


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
    if flat.size and (flat.max() >= LIMIT or flat.min() <= -LIMIT):
        raise ValueError(f"an integer component lies beyond {LIMIT}")
    return flat


def integer_vectors(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, label and ``v`` (floor(scale * x) of each component); vectors null or with null or non-finite ones are dropped."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("x").isNotNull() & finite).select(
        "vec_id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("v"))


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """(parts, entries, width) from the smallest ids, each with its least vector; rows without an id come last."""
    ids = [r[0] for r in rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    if not ids:
        return None
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        wanted = wanted | F.col("vec_id").isNull()
    found = {r["vec_id"]: r["v"] for r in rows.where(wanted).groupBy("vec_id").agg(F.min("v").alias("v")).collect()}
    start = np.array([found[i] for i in ids], np.int64)
    return start.reshape(len(ids), parts, -1).transpose(1, 0, 2).copy()


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts assigned to it; unused entries stay.

    A task hands on one row an entry (count and component sums), and at most
    parts * entries summed rows reach the driver.
    """
    parts, size, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [PartIndex(b) for b in books]
        total = np.zeros((parts, size, 1 + width), np.int64)
        for b in batches:
            x = _matrix(b["v"], parts * width).reshape(-1, parts, width)
            for p in range(parts):
                entry, _ = index[p].nearest(x[:, p])
                np.add.at(total[p], entry, np.column_stack([np.ones(len(entry), np.int64), x[:, p]]))
        part, entry = np.nonzero(total[:, :, 0])
        used = total[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(used.tolist(), pa.list_(pa.int64()))], names=["part", "entry", "sums"])
    found = (rows.select("v").mapInArrow(summed, "part int, entry int, sums array<bigint>").groupBy("part", "entry")
             .agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(1 + width)]).collect())
    out = books.copy()
    for r in found:
        out[r["part"], r["entry"]] = [r[f"s{i + 1}"] // r["s0"] for i in range(width)]
    return out


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, ``code`` (two hex digits a part) and ``error`` (squared distances summed) of each row."""
    parts, _, width = books.shape

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [PartIndex(b) for b in books]
        for b in batches:
            x = _matrix(b["v"], parts * width).reshape(-1, parts, width)
            found = [index[p].nearest(x[:, p]) for p in range(parts)]
            codes = np.column_stack([f[0] for f in found]).astype(np.uint8) if len(x) else np.empty((0, parts), np.uint8)
            error = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["label"], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])
    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(coded, f"vec_id bigint, label {label}, code string, error bigint")


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' decimal components by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all usable vectors, and the final codebooks (parts, entries, width).

    The frame holds vec_id, label, code, error and label_error (error summed
    over equal labels, nulls together).  Codebooks start with the smallest
    distinct ids (a repeated id counts once, with its least vector; null ids come last).  The length is that of
    the first vector in id order that ``parts`` divides; vectors of any other
    length take no part, like null ones and such with null or non-finite
    components.  Repeated rows are coded each.  Without a usable vector the
    frame is empty and there are no codebooks.  Components of 2**27 and more
    after scaling raise an error.
    """
    whole = integer_vectors(vectors, scale, id_col, vector_col, label_col).where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v")).first()
    rows = staged(whole.where(F.size("v") == (first[0] if first else parts)), "vectors")
    books = _first_codebooks(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error")), None
    for _ in range(rounds):
        books = refine(rows, books)
    coded = staged(assign(rows, books).select("*", F.col("label").isNull().alias("none"),
                                              F.coalesce(F.col("label").cast("string"), F.lit("")).alias("key")), "codes")
    sums = coded.groupBy("none", "key").agg(F.sum("error").alias("label_error"))
    return join_hot(coded, sums, ["none", "key"]).select("vec_id", "label", "code", "error", "label_error"), books
