"""Adapters that shape the driver's star-schema tables into the two logical
tables of the study: ``interactions`` (who rated what, when, how) and
``recipes`` (items with list-valued text columns).

Both are plain joins/aggregates over whole tables, so their cost grows with
the data.  The SQL twins in ``ratelens.plans.oracle`` compute the same rows
on DuckDB.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import FEW_PARTS, input_bytes, partitions_for

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str, recipe_ids: DataFrame | None = None) -> DataFrame:
    """user_id, recipe_id, date, rating (0..5, 0 = none), review (NULL allowed).

    With ``recipe_ids`` (recipe_id) only the rows of those; the others are dropped before the join with the orders.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    n = partitions_for(li, od)
    if recipe_ids is not None:
        li = li.join(recipe_ids, li.l_partkey == recipe_ids.recipe_id, "left_semi")
    if n:
        li, od = li.repartition(n, "l_orderkey"), od.repartition(n, "o_orderkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("recipe_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        (F.col("l_quantity").cast("int") % 6).alias("rating"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" "),
                             F.col("l_returnflag"), F.col("l_linestatus")))
         .alias("review"),
    )


def _quote_list(expr_text: F.Column) -> F.Column:
    return F.concat(F.lit("['"), expr_text, F.lit("']"))


#: Bytes of the part table for one partition of recipes at most.
PART_SLICE = 64 << 10


def recipe_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of :func:`recipes`, in proportion to the documents, of which only those with a part stay; 0 for small tables.

    Not fewer than the session's shuffle partitions, which a join takes where its sides have less.
    """
    part = table(spark, sf_dir, "part")
    n = min(partitions_for(part, table(spark, sf_dir, "documents")), math.ceil(input_bytes(part) / PART_SLICE))
    return max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))) if n > FEW_PARTS else 0


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12-column raw recipe table, derived from part + documents + lineitem.

    Rows of large tables are dealt by the recipe's key, as :func:`recipe_parts` says.
    """
    part = table(spark, sf_dir, "part")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    first_ship = (table(spark, sf_dir, "lineitem")
                  .groupBy("l_partkey")
                  .agg(F.min("l_shipdate").cast("date").alias("submitted_d")))
    n = recipe_parts(spark, sf_dir)
    if n:
        part, docs, first_ship = part.repartition(n, "p_partkey"), docs.repartition(n, "doc_id"), first_ship.repartition(n, "l_partkey")
        docs = docs.hint("merge")
    base = (part.join(docs, docs.doc_id == part.p_partkey, "inner")
                .join(first_ship, first_ship.l_partkey == part.p_partkey, "left"))
    k = F.col("p_partkey")
    text = F.col("text")
    steps_body = F.replace(F.replace(F.replace(F.replace(
        text, F.lit("\\"), F.lit(" ")), F.lit("'"), F.lit(" ")), F.lit("\r"), F.lit(" ")),
        F.lit("\n"), F.lit("', '"))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return base.select(
        F.col("p_name").alias("name"),
        k.alias("id"),
        F.when(k % 97 == 0, F.lit(0).cast("long"))
         .when(k % 89 == 0, F.lit(100000) + k)
         .otherwise((F.col("p_size") * 8).cast("long")).alias("minutes"),
        F.substring(F.col("p_brand"), 7, 1 << 20).try_cast("int").alias("contributor_id"),
        F.col("submitted_d").cast("string").alias("submitted"),
        _quote_list(F.replace(F.lower(F.col("p_type")), F.lit(" "), F.lit("', '"))).alias("tags"),
        F.concat(F.lit("["), (F.col("p_size") * 10).cast("string"), F.lit(".5, "),
                 F.col("p_size").cast("string"), F.lit(".0, "),
                 (k % 50).cast("string"), F.lit(".0, 2.0, 15.0, 3.0, 20.0]")).alias("nutrition"),
        F.when(k % 101 == 0, F.lit(0)).otherwise(n_lines).cast("int").alias("n_steps"),
        _quote_list(steps_body).alias("steps"),
        F.when(k % 50 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("lang"), F.lit(" "), F.col("source"))).alias("description"),
        _quote_list(F.replace(F.col("p_name"), F.lit(" "), F.lit("', '"))).alias("ingredients"),
        (F.lit(1) + k % 20).cast("int").alias("n_ingredients"),
    )


def awkward_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`recipes` with step lists as Python also allows them, by id modulo 7: trailing comma, adjacent strings,
    None, escapes by number, a tuple (no list), double quotes, an escaped line feed and quote."""
    r = recipes(spark, sf_dir)
    s, k = F.col("steps"), F.col("id") % 7
    cut = F.instr(s, "', '")
    opened, body = F.substring(s, F.lit(1), F.length(s) - 1), F.substring(s, F.lit(3), F.length(s) - 2)
    return r.withColumn("steps", (
        F.when(k == 0, F.concat(opened, F.lit(" , ]")))
        .when((k == 1) & (cut > 0), F.concat(F.substring(s, F.lit(1), cut), F.lit("\n '"), F.substring(s, cut + 4, F.length(s))))
        .when(k == 2, F.concat(opened, F.lit(",None]"))).when(k == 3, F.concat(F.lit("['\\x41\\u00e9\\102"), body))
        .when(k == 4, F.concat(F.lit("("), F.substring(s, F.lit(2), F.length(s) - 2), F.lit(",)")))
        .when((k == 5) & ~s.contains('"'), F.replace(s, F.lit("'"), F.lit('"')))
        .when(k == 6, F.concat(F.lit("['\\n\\'"), body)).otherwise(s)))
