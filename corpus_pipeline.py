"""Corpus pipeline: toxicity, SimHash near-dedup, substring dedup, PII, best-fit packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.  A row is found again by its id and its text's hash,
so rows that share an id are told apart, and null ids are rows like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import packing, pii, queries, simhash, substring, toxicity
from ratelens.llm.common import staged, table, text_hash

# No stage but PII can be told in SQL.
ORACLE_SQL = None


def _id(c: Column) -> Column:
    return F.coalesce(c, F.lit(-(1 << 63)))


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns, whatever their names), ``id`` and ``hash``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _id(F.col("doc_id")).alias("id"), text_hash(F.col("text")).alias("hash"))


def _with_text(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The columns of ``row`` with a new text; where it differs, n_chars is counted again."""
    old = F.col("row").getField
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return rows.select(*[F.when(old("text").eqNullSafe(text), old(c)).otherwise(new[c]).alias(c) if c in new else old(c).alias(c)
                         for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; equal texts share a verdict."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    rejected = scored.where("predicted = 1").select(F.col("text_hash").alias("hash")).distinct()
    return _keyed(docs).join(rejected, "hash", "left_anti").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id (none: the smallest text hash), once."""
    found = simhash.near_duplicates(docs, width=3, radius=2)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m"))
    kept = first.select(_id(F.col("m.doc_id")).alias("id"), F.col("m.text_hash").alias("hash"))
    # repeated rows share both keys, which the join has already brought together
    return _keyed(docs).join(kept, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"]).select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 20 words that occur earlier; texts that lose none stay as they are.

    Of rows that repeat an id and a text one stays.
    """
    found = substring.remove_repeats(docs, min_words=20)
    changed = (found.select(_id(F.col("doc_id")).alias("id"), F.col("text_hash").alias("hash"), "n_removed",
                            F.when(F.col("n_removed") > 0, F.col("kept_text")).alias("kept_text"))
               .groupBy("id", "hash").agg(F.min_by("kept_text", "n_removed").alias("kept")))
    rows = _keyed(docs).join(changed, ["id", "hash"]).dropDuplicates(["id", "hash"])
    return _with_text(rows, docs.columns, F.coalesce(F.col("kept"), F.col("row").getField("text")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data replaced by their kind in brackets."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return _with_text(pii.redact(rows), docs.columns, F.col("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096 ids at most; one row a piece."""
    return packing.pack(docs, queries.vocabulary(), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written down before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
