"""Sinks (S5) and staged write + re-read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratelens.session import checkpoint_dir


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None) -> None:
    """Overwrite a table.  CSV keeps a header and quotes multi-line text."""
    w = df if partitions is None else df.repartition(partitions)
    writer = w.write.mode("overwrite")
    if fmt == "csv":
        writer = (writer.option("header", "true").option("quote", '"')
                  .option("escape", '"').option("quoteAll", "false"))
    writer.format(fmt).save(path)


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write a step's result to the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor never recomputes earlier steps)
    and is the staged CSV-per-step of the study, done once and in Parquet.
    """
    spark = df.sparkSession
    target = path or checkpoint_dir(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def stage_by_key(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """:func:`stage` in ``parts`` buckets of ``key``: tables of as many buckets join on it where they lie.

    Rows that are dealt by the key into as many partitions give one file a
    partition.  0 parts: a plain stage.
    """
    if not parts:
        return stage(df, name)
    spark, target = df.sparkSession, checkpoint_dir(df.sparkSession, name)
    table = target.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(parts, key).option("path", target).format("parquet").saveAsTable(table)
    return spark.table(table)
