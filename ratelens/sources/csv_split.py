"""Quoted multi-line CSV read by many tasks.

A line feed ends a record only outside quotes, and whether a byte range starts
inside quotes depends on all text before it.  So each line is run from both
states: what it leaves behind if it starts a record, and if it starts inside a
quoted field.  The lines of a byte range compose to one such pair, a prefix
scan over the ranges of a file gives each its true first state, and the ranges
are cut into records in a second pass.  Only records that cross the end of a
range are put together by a shuffle; there are at most two pieces a range.

The ranges are the splits of Spark's text reader, which cuts files at line feeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What a line does to the state, as ``after outside + 2 * after inside`` (1: inside quotes).
RESET, SWAP, KEEP, OPEN = 0, 1, 2, 3
#: Kinds of a range's pieces: a record, the end of one, the start of one, the middle of one.
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3

#: A field from its start to the next comma or the end of the line, in a line without doubled quotes.
_FIELD = r'\G(?:"[^"]*+"[^,]*+|(?!")[^,]*+)(?:,|\z)'


def _open_after(text: Column) -> Column:
    """Whether a line that starts a field ends inside quotes: something is left when all closed fields are gone."""
    return F.regexp_replace(text, F.lit(_FIELD), F.lit("")) != ""


def line_kind(line: Column) -> Column:
    """RESET, SWAP, KEEP or OPEN.  A doubled quote never changes the state, so it goes first."""
    text = F.replace(line, F.lit('""'), F.lit(""))
    quote = F.instr(text, '"')
    rest = F.regexp_replace(F.substring(text, quote + 1, F.length(text)), F.lit(r"^[^,]*+(?:,|\z)"), F.lit(""))
    inside = (quote == 0) | _open_after(rest)
    return F.when(~line.contains('"'), F.lit(KEEP)).otherwise(_open_after(text).cast("int") + 2 * inside.cast("int"))


def states(kinds: np.ndarray, first: int) -> np.ndarray:
    """The state before each line, and after the last, of a run of lines that starts in ``first``.

    After the last line that sets the state outright only the swaps count.
    """
    n = len(kinds)
    swaps = np.concatenate([[0], np.cumsum(kinds == SWAP)])
    fixed = np.where((kinds == RESET) | (kinds == OPEN), np.arange(1, n + 1), 0)
    last = np.concatenate([[0], np.maximum.accumulate(fixed)]) if n else np.zeros(1, np.int64)
    base = np.where(last > 0, np.concatenate([[0], kinds])[last] == OPEN, first)
    return (base.astype(np.int64) + swaps - swaps[last]) % 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      line_kind(F.col("value")).alias("kind"), F.col("value").alias("line"))


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """File, block, first and last row (exclusive) of the ranges in a batch; a task reads a range's lines in order."""
    file, block = batch["file"].to_numpy(), batch["block"].to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    ends = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(ends, ends[1:]):
        if b > a:
            yield int(file[a]), int(block[a]), a, b


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kind of a whole range, as of one long line."""
    out: list[tuple[int, int, int, int]] = []
    for batch in batches:
        kinds = batch["kind"].to_numpy()
        for file, block, a, b in _ranges(batch):
            ends = [0, 1]
            if out and out[-1][:2] == (file, block):
                ends = list(out.pop()[2:])
            out.append((file, block, *[int(states(kinds[a:b], e)[-1]) for e in ends]))
    cols = list(zip(*out)) or [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["file", "block", "outside", "inside"])


def first_states(spark: SparkSession, path: str) -> dict[tuple[int, int], int]:
    """The state in which each byte range starts: one entry a range, so some ten bytes for each 128 MB of input."""
    found = _lines(spark, path).select("file", "block", "kind").mapInArrow(
        _compose, "file bigint, block bigint, outside bigint, inside bigint").orderBy("file", "block").toArrow()
    out, last, state = {}, None, 0
    for file, block, outside, inside in zip(*[c.to_pylist() for c in found.columns]):
        state = 0 if file != last else state
        last = file
        out[file, block] = state
        state = inside if state else outside
    return out


def _pieces(first: dict[tuple[int, int], int]):
    """Records and pieces of records of the ranges, whose first states are given."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None          # the range at work
        held: list[str] = []   # lines of a record not yet ended
        head = False       # they belong to a record of an earlier range
        state, seen = 0, False
        rows: list[tuple[int, int, int, bool, str]] = []

        def close() -> None:
            if at is not None and held:
                rows.append((*at, MIDDLE if head else TAIL, at[1] == 0 and not seen, "\n".join(held)))
                held.clear()

        for batch in batches:
            kinds, lines = batch["kind"].to_numpy(), batch["line"]
            for file, block, a, b in _ranges(batch):
                if (file, block) != at:
                    close()
                    at, state, seen = (file, block), first[file, block], False
                    head = bool(state)
                s = states(kinds[a:b], state)
                state = int(s[-1])
                starts = np.flatnonzero(s[:-1] == 0)
                upto = int(starts[0]) if len(starts) else b - a
                if upto:
                    held += lines.slice(a, upto).to_pylist()
                if not len(starts):
                    continue
                if held:  # ended just before the first record that starts here
                    rows.append((*at, HEAD if head else WHOLE, block == 0 and not head and not seen, "\n".join(held)))
                    seen = seen or not head
                    held = []
                head = False
                ends = np.append(starts[1:], b - a)
                whole = len(starts) - state  # the last one goes on
                texts = lines.slice(a, b - a).to_pylist()
                for p, q in zip(starts[:whole].tolist(), ends[:whole].tolist()):
                    rows.append((*at, WHOLE, block == 0 and not seen, texts[p] if q == p + 1 else "\n".join(texts[p:q])))
                    seen = True
                if whole < len(starts):
                    held = texts[int(starts[-1]):]
            # a record that the next line may still go on is held, all others leave
            if len(rows) > 1 << 12:
                yield _table(rows)
                rows = []
        close()
        yield _table(rows)
    return each


def _table(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                                      names=["file", "block", "piece", "header", "record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (text without its last line break) and ``header`` (the first record of its file) of every record that is not empty."""
    pieces = _lines(spark, path).mapInArrow(_pieces(first_states(spark, path)), "file bigint, block bigint, piece int, header boolean, record string")
    whole = pieces.where(F.col("piece") == WHOLE).select("header", "record")
    order = Window.partitionBy("file").orderBy("block", "piece")
    crossing = (pieces.where(F.col("piece") != WHOLE)
                .withColumn("start", F.last(F.when(F.col("piece") == TAIL, F.col("block")), ignorenulls=True).over(order))
                .groupBy("file", "start").agg(F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("block", "piece", "record"))).alias("p"))
                .select("header", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    text = F.col("record")
    return whole.unionByName(crossing).withColumn("record", F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)).where("record <> ''")


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema`` of every record but each file's first, as Spark's own CSV reader reads them."""
    rows = records(spark, path).where(~F.col("header"))
    parsed = F.from_csv("record", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)),
                        {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("r")).select("r.*")
