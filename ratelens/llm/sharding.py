"""Contiguous shards of equal bytes from global prefix sums.

The rows are brought into one global order by a range exchange of their narrow
keys (id, size, checksum; no texts).  Per-partition totals give each partition
its offset, a running sum inside a partition adds the rest, and the global
byte positions are cut at equal targets.  Nothing but the per-partition totals
(one row a partition) and the per-shard starts (one row a shard) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import staged

#: Bytes that a row counts beside its text (contract value).
ROW_OVERHEAD = 16


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the row overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("bigint")


def shard_by_bytes(rows: DataFrame, n_shards: int, order_cols: list[str], size_col: str) -> DataFrame:
    """Add ``shard`` (0 to n_shards-1) and ``slot`` (gapless from 0 in a shard).

    ``rows`` should be narrow; its columns come back with ``shard`` and
    ``slot`` added (columns of these names are refused).  The global order is
    ``order_cols``, nulls first, then the remaining columns; rows that are
    equal in all columns take adjacent places, and even a table of one repeated
    row is spread over the partitions.  A row goes to the shard in whose byte
    interval its middle falls, so shards are contiguous and differ from the
    target by at most about one row.  A null size counts 0, an empty table
    gives no rows, a total of 0 bytes puts all into shard 0; a row larger than
    a target leaves later shards empty.
    """
    clash = {"shard", "slot"} & {c.lower() for c in rows.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are outputs of the sharding")
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    order = [*order_cols, *(c for c in rows.columns if c not in order_cols)]
    keys = [*(F.col("__row").getField(c) for c in order), F.col("__tie")]
    size = F.coalesce(F.col("__row").getField(size_col).cast("bigint"), F.lit(0))
    # spark_partition_id() holds only in the stage that dealt the rows: write it down.
    dealt = staged(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__row"), F.rand(11).alias("__tie"))
                   .repartitionByRange(*keys)
                   .withColumn("__part", F.spark_partition_id()), "shard-order")
    totals = dealt.groupBy("__part").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows0"))
    total = dealt.agg(F.coalesce(F.sum(size), F.lit(0)).alias("__total"))
    inside = Window.partitionBy("__part").orderBy(*keys)
    placed = (dealt
              .withColumn("__size", size)
              .withColumn("__upto", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("__nth", F.row_number().over(inside))
              .join(F.broadcast(offsets), "__part")          # one row a partition
              .crossJoin(F.broadcast(total))                  # one row
              .select("__row", F.expr("__rows0 + __nth - 1").alias("__at"),
                      # twice the middle of the row against twice the total: integers throughout
                      F.expr(f"""CASE WHEN __total = 0 THEN 0 ELSE least({n_shards - 1},
                              ((2 * (__bytes0 + __upto) - __size) * {n_shards}L) div (2 * __total)) END""")
                      .cast("int").alias("shard")))
    starts = placed.groupBy("shard").agg(F.min("__at").alias("__start"))
    return (placed.join(F.broadcast(starts), "shard")         # one row a shard
            .select("__row.*", "shard", (F.col("__at") - F.col("__start")).alias("slot")))


def write_shards(rows: DataFrame, path: str) -> None:
    """Write rows that carry ``shard`` as one folder a shard, ordered by ``slot`` in each file."""
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
