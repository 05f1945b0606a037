"""Queries on awkward raw texts: step lists that are Python literals but no JSON (A2, C8, C13, J2, E7), multi-line CSV."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.functions.lists import avg_words_per_step, list_or_empty
from ratelens.operators import clean as C
from ratelens.plans import catalog as Q
from ratelens.plans import oracle as O
from ratelens.plans.pipelines import effort_study, kept_interactions
from ratelens.sources import fixtures as FX
from ratelens.sources import readers as R

_RAW = O.awkward_raw_sql()
_RC = f"WITH {_RAW}, {O.RECIPES_CLEAN}"


@Q.register("a2_awkward_steps", "id:i, n_items:i, first:s, last:s, words:d",
            f"WITH {_RAW} SELECT id, coalesce(len(l), 0) AS n_items, replace(l[1], chr(1), '''') AS first, l[len(l)] AS last, words "
            f"FROM (SELECT id, {O.list_sql('steps')} AS l, {O.avg_words_sql(O.list_sql('steps'))} AS words FROM raw_r)")
def q_awkward_steps(spark, sf):
    r = FX.awkward_recipes(spark, sf)
    items = r.select("id", list_or_empty(r, "steps").alias("l"))
    # the mark of one case is a quote inside an item; a one-item list has it as first and last
    last = F.when(F.size("l") == 1, F.replace(F.element_at("l", -1), F.lit("\n'"), F.lit("\n\x01"))).when(F.size("l") > 0, F.element_at("l", -1))
    return items.select("id", F.size("l").alias("n_items"), F.get("l", F.lit(0)).alias("first"), last.alias("last"), avg_words_per_step(F.col("l")).alias("words"))


@Q.register("c8_awkward_steps", "id:i", f"WITH {_RAW} SELECT id FROM raw_r WHERE steps IS NOT NULL AND len({O.list_sql('steps')}) > 0")
def q_awkward_nonempty(spark, sf):
    return C.nonempty_list_filter(FX.awkward_recipes(spark, sf), "steps").select("id")


@Q.register("c13_awkward_steps", Q.RC_SPEC, f"{_RC} SELECT {Q._cols(Q.RC_SPEC)} FROM rc")
def q_awkward_prepare(spark, sf):
    return C.prepare_recipes(FX.awkward_recipes(spark, sf))


@Q.register("j2_awkward_steps", "user_id:i, recipe_id:i, rating:i",
            f"{_RC}, {O.RAW_INTERACTIONS}, {O.INTERACTIONS_RAW_CLEAN}, {O.INTERACTIONS_CLEAN} SELECT user_id, recipe_id, rating FROM ic")
def q_awkward_kept(spark, sf):
    return kept_interactions(FX.awkward_recipes(spark, sf), lambda ids: FX.interactions(spark, sf, ids)).select("user_id", "recipe_id", "rating")


@Q.register("e7_awkward_steps", Q.E7_SPEC, f"WITH {_RAW} {Q._e7_sql()}")
def q_awkward_effort(spark, sf):
    return effort_study(FX.awkward_recipes(spark, sf))


@Q.register("s1_csv_multiline", "doc_id:i, lang:s, n_chars:i, digest:s, tail:s",
            "SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS digest, 'a \"b\",' || chr(10) || doc_id || chr(10) || chr(10) AS tail FROM documents "
            "WHERE doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
def q_csv_multiline(spark, sf):
    """S1 on whole documents: line feeds, commas and doubled quotes in most records, a file a task, which many tasks read."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from ratelens.session import checkpoint_dir
    path = checkpoint_dir(spark, "csv-documents")
    docs = FX.table(spark, sf, "documents").where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # an asterisk in front keeps empty and NA-like texts apart from missing ones
    docs.select("doc_id", F.concat(F.lit("*"), "text").alias("text"), F.concat(F.lit('a "b",\n'), F.col("doc_id").cast("string"), F.lit("\n\n")).alias("tail"), "lang").write.option(
        "header", "true").option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("tail", StringType()), StructField("lang", StringType())])
    text = F.expr("substring(text, 2)")
    return R.read_csv(spark, path, schema).select("doc_id", "lang", F.length(text).alias("n_chars"), F.md5(text).alias("digest"), "tail")
