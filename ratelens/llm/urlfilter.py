"""URL filters by dated lists: entries become validity intervals, captures look up their fetch time.

A list is a history of dated entries (added or removed).  The entry in force
for a key until the next one of the same list and key gives an interval, and
an as-of join - equal key, fetch time inside the interval - evaluates every
capture against exactly the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SCHEME = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://"
HOST = _SCHEME + r"(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = _SCHEME + r"[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Host in lower case without user, port or closing dots; '' if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")


def keys_of(url: Column) -> Column:
    """All list keys that a URL answers to: ``h:host``, ``d:suffix`` for the host and
    each parent domain, ``p:host/first/second`` for each whole leading part of the path."""
    labels = F.split(url_host(url), r"\.")
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    host = url_host(url)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    paths = F.when(F.size(steps) == 0, F.expr("cast(array() as array<string>)")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))))
    return F.when(host == "", F.expr("cast(array() as array<string>)")).otherwise(
        F.array_distinct(F.concat(F.array(F.concat(F.lit("h:"), host)), domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, action, since`` to ``list, key, since, until`` (until null: still active).

    An ``add`` holds until the next entry of its list and key; of entries at
    the same time a ``remove`` comes last, so it wins.  Repeated entries give
    no second interval; entries with a null in any column, or an action that is
    neither ``add`` nor ``remove``, say nothing and are left out.
    """
    said = entries.select("list", "key", "action", "since").where(
        "list IS NOT NULL AND key IS NOT NULL AND since IS NOT NULL AND action IN ('add', 'remove')").distinct()
    after = Window.partitionBy("list", "key").orderBy("since", "action")
    return (said.withColumn("until", F.lead("since").over(after))
            .where("action = 'add' AND (until IS NULL OR since < until)").select("list", "key", "since", "until"))


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """All rows and columns of ``captures`` with ``host, n_entries, lists, kept`` added.

    ``n_entries`` counts the entries active at the fetch time that cover the
    URL, ``lists`` names their lists (sorted, comma-joined), ``kept`` is true
    if there are none.  A URL that is null or has no host, and a null fetch
    time, match nothing and are kept.  Repeated captures each keep their row;
    an empty list keeps all.  Columns of ``captures`` with the added names are
    refused.

    Each (URL, time) is looked up once, and the lookup table carries no other
    column, so a hot capture or a hot host adds keys, not copies of pages; the
    joins are on equal keys and Spark splits those that are skewed.
    """
    clash = {"host", "n_entries", "lists", "kept", "__url", "__at"} & {c.lower() for c in captures.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are outputs of the filter")
    rows = captures.withColumn("__url", F.col(f"`{url_col}`")).withColumn("__at", F.col(f"`{time_col}`"))
    asked = rows.where("__url IS NOT NULL AND __at IS NOT NULL").select("__url", "__at").distinct()
    wanted = asked.select("__url", "__at", F.explode(keys_of(F.col("__url"))).alias("key"))
    active = wanted.join(intervals(entries), "key").where("since <= __at AND (until IS NULL OR __at < until)")
    hits = active.groupBy("__url", "__at").agg(
        F.count("*").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    return (rows.join(hits, ["__url", "__at"], "left")
            .select(*[F.col(f"`{c}`") for c in captures.columns], F.coalesce(url_host(F.col("__url")), F.lit("")).alias("host"),
                    F.coalesce("n_entries", F.lit(0)).alias("n_entries"), F.coalesce("lists", F.lit("")).alias("lists"),
                    F.col("n_entries").isNull().alias("kept")))
