"""Shared by the operators' tests: awkward tables, and the same rows in DuckDB."""

import math

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "labels", "benchmark", "conversations")
#: Columns that operators use inside or give back, as further columns of the input.
CLASHING = ("spans string, fp bigint, chunk bigint, h bigint, key bigint, n int, row int, __id bigint, part int, "
            "score double, ix string, block int, tile bigint, size int, __part int, text_hash bigint")


def awkward(spark, texts, extra=True):
    """Documents of the given texts: ids from 1, the first text repeated under no id and as an equal row."""
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(None, texts[0]), (1, texts[0])]
    schema = "doc_id bigint, text string"
    if extra:
        width = CLASHING.count(",") + 1
        return spark.createDataFrame([(*r, *[None] * width) for r in rows], f"{schema}, {CLASHING}")
    return spark.createDataFrame(rows, schema)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def same(df, sql, **tables):
    """The frame's rows are those of the SQL over the given frames (others: the smallest given tables)."""
    con = duckdb.connect()
    for t in TABLES:
        if t in tables:
            con.register(t, tables[t].toArrow())
        else:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    cols = sorted(names)
    want = sorted((repr([_plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall()))
    got = sorted((repr([_plain(r[c]) for c in cols]) for r in df.collect()))
    assert len(got) == len(want)
    assert got == want
