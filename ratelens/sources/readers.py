"""Scans (S1–S3, S7, S8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)

from ratelens.functions.expr import nan_to_null
from ratelens.sources import csv_split

# fixed values: the text tokens pandas.read_csv reads as missing by default
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

RECIPES_SCHEMA = StructType([
    StructField("name", StringType()), StructField("id", LongType()),
    StructField("minutes", LongType()), StructField("contributor_id", LongType()),
    StructField("submitted", StringType()), StructField("tags", StringType()),
    StructField("nutrition", StringType()), StructField("n_steps", IntegerType()),
    StructField("steps", StringType()), StructField("description", StringType()),
    StructField("ingredients", StringType()), StructField("n_ingredients", IntegerType()),
])

INTERACTIONS_SCHEMA = StructType([
    StructField("user_id", LongType()), StructField("recipe_id", LongType()),
    StructField("date", StringType()), StructField("rating", IntegerType()),
    StructField("review", StringType()),
])


def normalize_missing(df: DataFrame, null_tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    """NaN -> NULL on floating columns, null tokens -> NULL on string columns."""
    toks = [t for t in null_tokens]
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = nan_to_null(c)
        elif isinstance(f.dataType, StringType) and toks:
            c = F.when(~c.isin(toks), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             null_tokens: Sequence[str] = PANDAS_NULL_TOKENS, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted multi-line text and doubled quotes.

    With a ``schema``, files whose fields hold line feeds are read by as many
    tasks as any text file (:mod:`ratelens.sources.csv_split`): a first pass,
    which runs when the frame is built, finds which byte ranges start inside
    quotes, a second one cuts the records.  Line breaks inside quotes stay as they are in the
    file.  Where no field holds one, ``multi_line=False`` saves the first pass.

    Without a schema the types are inferred, each multi-line file in one task;
    declare one for large inputs.
    """
    if schema is not None and multi_line:
        return normalize_missing(csv_split.read(spark, path, schema), null_tokens)
    r = (spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
         .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is not None:
        # numbers that fail to parse become NULL rather than failing the job
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return normalize_missing(r.csv(path), null_tokens)


def load_raw(spark: SparkSession, recipes_path: str, interactions_path: str,
             fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """The two raw tables."""
    if fmt == "csv":
        return (read_csv(spark, recipes_path, RECIPES_SCHEMA),
                read_csv(spark, interactions_path, INTERACTIONS_SCHEMA))
    return (normalize_missing(spark.read.format(fmt).load(recipes_path)),
            normalize_missing(spark.read.format(fmt).load(interactions_path)))


# fixed values: an analysis row without one of these says nothing about popularity
POPULARITY_REQUIRED = ("bayes_mean", "rating_gap", "bayes_gap")


def load_analysis(source: DataFrame | tuple[SparkSession, str], *, columns: Sequence[str] | None = None,
                  required: Sequence[str] = POPULARITY_REQUIRED) -> DataFrame:
    """S3: the analysis table, its ``columns`` (None: all), rows with a value in each of ``required``.

    ``source`` is a table or ``(spark, parquet_path)``.  Of ``required`` only
    what the chosen columns hold counts; an empty one keeps every row.  The
    projection and the conditions are declarative, so both reach the scan.
    """
    if not isinstance(source, DataFrame):
        spark, path = source
        source = spark.read.parquet(path)
    chosen = source.columns if columns is None else list(columns)
    known = F.lit(True)
    for name in set(required) & set(chosen):
        known = known & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    return source.select(*chosen).where(known)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | str = "id") -> DataFrame:
    """First ``n`` rows in key order (a top-k, not a full sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """Rows x columns as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long"))
