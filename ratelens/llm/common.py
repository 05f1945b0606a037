"""Helpers shared by the operators: table reads, staged tables, input columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import checkpoint_dir

#: The word separators of every contract: space and the ASCII controls 9-13.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from any store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the rest of a job at most the
    tasks it ran, never the steps before the written table.
    """
    path = checkpoint_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (null: empty) alone, so that further columns can't clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_hash(text: Column) -> Column:
    """64 bits of a text (null: empty); with the id it finds a row's result again."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


_KEPT: list = []


def kept(make):
    """``make`` with its last results held in the worker process, from task to task of functions that keep it (:func:`released`)."""
    held = lru_cache(maxsize=2)(make)
    _KEPT.append(held)
    return held


def forget(but=None) -> None:
    """Drop what this process holds by :func:`kept` functions other than ``but``."""
    for held in _KEPT:
        if held is not but:
            held.cache_clear()


def released(each, keeps=None):
    """An Arrow function that hands its memory back when its task ends.

    Python workers wait for the next stage in a pool, of which any may get
    the next task; what they kept would add up over the stages of a pipeline.
    So a task also drops what earlier stages have kept, but for ``keeps`` (a :func:`kept` function).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keeps)
        try:
            yield from each(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim is not None:
                trim(0)
    return run


def cut_text(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before a space or line feed: words stay whole."""
    at = 0
    while len(text) - at > size:
        end = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if end < 0:  # one long run: to its end
            ends = [x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x >= 0]
            if not ends:
                break
            end = min(ends)
        yield text[at:end]
        at = end
    yield text[at:]


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that mentions an outer expression would compute it again for each
    element; bound as the element of a one-element array it is a variable.
    """
    return F.transform(F.array(value), body)[0]


def join_hot(many: DataFrame, one: DataFrame, on: list[str], how: str = "inner", sizes: DataFrame | None = None, share: int = 4096) -> DataFrame:
    """``many`` with the row of ``one`` (unique by ``on``, no null keys) of its key; hot keys never meet in one task.

    Keys that hold more than one in ``share`` of the rows of ``many`` are at
    most ``share`` in number: their rows of ``one`` are broadcast, and only
    the other keys are shuffled.  ``sizes`` (``on`` and ``n``) says how many
    rows a key has, where that is known.  ``many`` is read several times, so
    it should be a written table.
    """
    if sizes is None:
        sizes = many.groupBy(*on).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    few = F.broadcast(staged(sizes.where(F.col("n") * share > total).select(*on), "hot-keys"))
    left = many.join(few, on, "left_semi").join(F.broadcast(one.join(few, on, "left_semi")), on, how)
    return left.unionByName(many.join(few, on, "left_anti").join(one, on, how))
