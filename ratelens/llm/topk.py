"""Exact top-k by inner product, with bounds from the sorted values of each dimension.

Each block of candidates keeps the sorted values of a dimension; at three
depths (50, 75 and 90 percent) the value there, from the end that a query's
sign prefers, stands for what lies beyond.  That gives each candidate a lower
bound (parts beyond the depth at the worst value) and an upper bound (at the
depth's value).  A candidate whose upper bound is below the k-th best lower
bound is out; those that are left get their final scores.  Bounds of all
queries of a block come from matrix products over the whole candidate matrix,
so a depth reads every component, in order of rows: the lists hold values
without ids, are looked up and not read in step, and only the final scoring is
saved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates and queries in a block; depths to which the lists are read before the rest is resolved.
CANDIDATES, QUERIES = 8192, 512
DEPTHS = (0.5, 0.75, 0.9)


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exact: as doubles where they hold it, else as Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(x * scale)
    if np.isfinite(out).all():
        return out
    return np.array([[int(np.floor(v * scale)) if np.isfinite(v * scale) else int(v) * scale for v in r] for r in x.tolist()], object)


def top(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores) of the ``k`` best in this block, ties to the smaller id; a query's own id is left out."""
    n, dims = x.shape
    if not n or not len(q):
        return
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, dims)
    if x.dtype == object or q.dtype == object or most >= 2.0 ** 53:
        whole = [[int(v) for v in r] for r in x.tolist()]
        for j, row in enumerate([[int(v) for v in r] for r in q.tolist()]):  # too large for exact doubles
            limit = (1 << 63) - 1
            all_ = [(-max(-limit, min(limit, sum(a * b for a, b in zip(row, c)))), int(i)) for c, i in zip(whole, ids.tolist()) if i != qids[j]]
            best = sorted(all_)[:k]
            yield int(qids[j]), np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], np.int64)
        return
    lists = np.sort(x, axis=0)
    up, down = np.maximum(q, 0).T, np.minimum(q, 0).T
    own = ids[:, None] == qids[None, :]
    alive = ~own
    for depth in DEPTHS if n > 4 * k else ():
        read = max(1, int(n * depth))
        high, low = lists[n - read], lists[read - 1]
        upper = np.maximum(x, high) @ up + np.minimum(x, low) @ down
        lower = np.where(x >= high, x, lists[0]) @ up + np.where(x <= low, x, lists[-1]) @ down
        lower[own] = -np.inf
        bar = np.partition(lower, n - k, axis=0)[n - k]
        alive &= upper >= bar
        if alive.sum(axis=0).max() <= 4 * k:
            break
    for j in range(len(q)):
        left = np.flatnonzero(alive[:, j])
        score = x[left] @ q[j]
        if len(left) > k:
            cut = np.partition(score, len(left) - k)[len(left) - k]
            left, score = left[score >= cut], score[score >= cut]
        order = np.lexsort((ids[left], -score))[:k]
        yield int(qids[j]), ids[left][order], score[order].astype(np.int64)


def search(candidates: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, ``rank`` (from 1), vec_id and ``score``: the ``k`` candidates with the largest inner product.

    Components count as floor(scale * component), the score is their integer
    inner product (beyond a bigint: its largest or smallest value).  All rows
    of ``candidates`` are candidates but those with the query's own id; ties go
    to the smaller id.  Null vectors, vectors with null or non-finite
    components and rows without an id take no part; a query meets vectors of
    its own length only, and may get fewer than ``k`` rows or none.  Rows that
    repeat an id and a vector count once.

    Queries and candidates meet block by block on an equal key, each pair of
    blocks in one task; what leaves a task is ``k`` rows a query.
    """
    if k < 1:
        raise ValueError("k must be at least 1")

    def sound(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
        rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
        return (rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
                .withColumn("dim", F.size("v")).distinct())

    def blocks(df: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
        counts = df.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))  # one row a vector length
        dealt = df.join(F.broadcast(counts), "dim").withColumn("block", F.pmod(F.xxhash64("id"), "n"))
        return dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias(name)), counts

    cands, n_blocks = blocks(sound(candidates), CANDIDATES, "cands")
    asks, _ = blocks(sound(queries), QUERIES, "asks")
    spread = (asks.withColumnRenamed("block", "ask").join(F.broadcast(n_blocks), "dim")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1))))
    pairs = cands.join(spread, ["dim", "block"]).select("cands", "asks")

    def matrix(rows) -> tuple[np.ndarray, np.ndarray]:
        items = rows.values
        ids = items.field("id").to_numpy()
        return ids, scaled(items.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1), scale)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch["cands"], batch["asks"]):
                ids, x = matrix(a)
                qids, q = matrix(b)
                found = list(top(x, ids, q, qids, k))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                         pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                        names=["query_id", "vec_id", "score"])
    best = pairs.mapInArrow(each, "query_id bigint, vec_id bigint, score bigint").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
