"""The queries of this subpackage: each applies one operator to its whole table.

Parameters are those of production use; where a contract fixes the columns,
the query derives them from the operator's real output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import bpe, collocations, minhash, packing, pii, quality, sharding, simhash, substring, topk, toxicity, urlfilter, veccodes
from ratelens.llm.common import table


def vocabulary() -> str:
    """The public vocabulary file of the contracts; another path is a parameter of the operators."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary()).drop("ids")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


_OP5_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), min_words=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_OP6_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM p) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, i + o.o AS i FROM r, range(20) o(o)),
x AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda y, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)"""


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# --- op8: captures are the pages at a day told by their id; the lists are dated by their hosts' hashes

_DAY0 = "DATE'2024-01-01'"


def url_lists(pages: DataFrame) -> DataFrame:
    """Dated entries for hosts, parent domains and path prefixes of the given pages."""
    host = urlfilter.url_host(F.col("url"))
    first = F.regexp_extract(F.regexp_extract("url", urlfilter.PATH, 1), "^/+([^/]+)", 1)
    hosts = pages.select(host.alias("v")).where("v <> ''").distinct()
    parents = hosts.select(F.regexp_extract("v", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("v")).where("v <> ''").distinct()
    paths = pages.select(F.when((host != "") & (first != ""), F.concat(host, F.lit("/"), first)).alias("v")).where("v IS NOT NULL").distinct()
    named = (hosts.select(F.lit("h:").alias("scope"), "v")
             .unionByName(parents.select(F.lit("d:").alias("scope"), "v"))
             .unionByName(paths.select(F.lit("p:").alias("scope"), "v")))
    n = F.conv(F.substring(F.md5(F.concat("scope", "v")), 1, 4), 16, 10).cast("int")
    dated = named.select(F.concat("scope", "v").alias("key"), n.alias("n"),
                         F.when(F.col("v").contains("spam"), "spam").when(n % 3 == 0, "adult").otherwise("malware").alias("list"))
    said = [("n % 4 = 0 OR list = 'spam'", "add", "n % 300"), ("n % 8 = 0", "remove", "n % 300 + 45"), ("n % 16 = 0", "add", "n % 300 + 90")]
    out = None
    for when, action, days in said:
        part = dated.where(when).select("list", "key", F.lit(action).alias("action"),
                                        F.expr(f"date_add({_DAY0}, {days})").alias("since"))
        out = part if out is None else out.unionByName(part)
    return out


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr(f"date_add({_DAY0}, cast(page_id * 37 % 366 as int))"))
    return urlfilter.filter_urls(captures, url_lists(pages)).withColumn("fetched_at", F.col("fetched_at").cast("string"))


_OP8_SQL = r"""
WITH c AS (SELECT row_number() OVER () AS r, page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INT) AS DATE) AS fetched_at,
  regexp_replace(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]+)', 2)), '\.+$', '') AS host,
  list_filter(string_split(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS steps FROM pages),
v AS (SELECT DISTINCT 'h:' AS scope, host AS v FROM c WHERE host <> ''
  UNION SELECT 'd:', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM c WHERE regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) <> ''
  UNION SELECT 'p:', host || '/' || steps[1] FROM c WHERE host <> '' AND len(steps) > 0),
n AS (SELECT scope || v AS key, ('0x' || substr(md5(scope || v), 1, 4))::INT AS n, v FROM v),
l AS (SELECT key, n, CASE WHEN v LIKE '%spam%' THEN 'spam' WHEN n % 3 = 0 THEN 'adult' ELSE 'malware' END AS list FROM n),
e AS (SELECT list, key, 'add' AS action, DATE '2024-01-01' + n % 300 AS since FROM l WHERE n % 4 = 0 OR list = 'spam'
  UNION SELECT list, key, 'remove', DATE '2024-01-01' + (n % 300 + 45) FROM l WHERE n % 8 = 0
  UNION SELECT list, key, 'add', DATE '2024-01-01' + (n % 300 + 90) FROM l WHERE n % 16 = 0),
k AS (SELECT DISTINCT r, fetched_at, key FROM (
  SELECT r, fetched_at, 'h:' || host AS key FROM c WHERE host <> ''
  UNION ALL SELECT r, fetched_at, 'd:' || array_to_string(string_split(host, '.')[i:], '.') FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM c WHERE host <> '')
  UNION ALL SELECT r, fetched_at, 'p:' || host || '/' || array_to_string(steps[1:i], '/') FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM c WHERE host <> ''))),
s AS (SELECT r, list, k.key, arg_max(action, (since, action)) AS state FROM k JOIN e ON e.key = k.key AND e.since <= k.fetched_at GROUP BY r, list, k.key),
h AS (SELECT r, count(*) AS n_entries, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM s WHERE state = 'add' GROUP BY r)
SELECT page_id, url, CAST(fetched_at AS VARCHAR) AS fetched_at, host, coalesce(n_entries, 0) AS n_entries, coalesce(lists, '') AS lists, n_entries IS NULL AS kept FROM c LEFT JOIN h USING (r)"""


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.row_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shard_by_bytes(rows, 40, ["doc_id"], "size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_OP9_SQL = """
WITH RECURSIVE crc(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size FROM documents),
b AS (SELECT r, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda p: ('0x' || p)::BIGINT) AS bytes FROM d),
x AS (SELECT r, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, y: xor(a // 256, t[xor(a, y) % 256 + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, tab),
o AS (SELECT doc_id, size, text_crc32, sum(size) OVER q AS upto, sum(size) OVER () AS total, row_number() OVER q - 1 AS place
  FROM d JOIN x USING (r) WINDOW q AS (ORDER BY doc_id NULLS FIRST, size, text_crc32, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT *, least(39, ((2 * upto - size) * 40) // (2 * total))::INT AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard FROM s"""


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80).drop("text_hash")


_OP11_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
e AS (SELECT r, len(s) AS n, unnest(s) AS t FROM s),
k AS (SELECT a.r AS x, b.r AS y FROM e a JOIN e b ON a.t = b.t AND a.r < b.r GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
c(r, z) AS (SELECT r, r FROM s UNION SELECT c.r, l.y FROM c JOIN l ON l.x = c.z),
m AS (SELECT c.r, min(s.doc_id) AS component_id FROM c JOIN s ON s.r = c.z GROUP BY c.r)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s JOIN m USING (r)"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), order=5, least=100, top=2000)


_OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) s(k) WHERE len(w) >= k),
f AS (SELECT lang, w[i:i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY 1, 2 HAVING count(*) >= 100),
c AS (SELECT lang, p, f AS a, len(p) AS m FROM f WHERE len(p) >= 2),
x AS (SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r, t.n, (1000 * c.a * t.n) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:] JOIN t ON t.lang = c.lang),
s AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inn AS (SELECT lang, q[i:i + z - 1] AS p, max(a) AS outer_a FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT lang, p AS q, a, m, unnest(range(2, m)) AS z FROM c WHERE m > 2)) GROUP BY 1, 2),
o AS (SELECT s.*, array_to_string(s.p, ' ') AS phrase FROM s LEFT JOIN inn ON inn.lang = s.lang AND inn.p = s.p WHERE outer_a IS NULL OR 100 * outer_a < 100 * a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, CAST(rank AS INT) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE rank <= 2000"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = veccodes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return codes.select("vec_id", "code", "error", "label_error", F.lit(veccodes.digest(books)).alias("codebooks_sha256"))


def _op13_sql() -> str:
    near = "list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))"
    rounds = ""
    for i in (1, 2):
        rounds += f"""
a{i} AS (SELECT r, part, any_value(p.x) AS x, arg_min(e, ({near}, e)) AS e FROM p JOIN c{i - 1} c USING (part) GROUP BY r, part),
m{i} AS (SELECT part, e, j, sum(y) AS s, count(*) AS n FROM (SELECT part, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{i}) GROUP BY ALL),
u{i} AS (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM m{i} GROUP BY part, e),
c{i} AS (SELECT c.part, c.e, coalesce(u.x, c.x) AS x FROM c{i - 1} c LEFT JOIN u{i} u ON u.part = c.part AND u.e = c.e),"""
    return f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, vec_id, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS x FROM k, range(16) s(part)),
s AS (SELECT vec_id, min(v) AS v FROM k GROUP BY vec_id ORDER BY vec_id NULLS LAST LIMIT 64),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST) - 1 AS e, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS x FROM s, range(16) s(part)),{rounds}
b AS (SELECT r, part, min(({near}, e)) AS m FROM p JOIN c2 c USING (part) GROUP BY r, part),
q AS (SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM b GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN q USING (r), h"""


QUERIES = {
    "op1_pii": op1_pii,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_exact_topk": op5_exact_topk,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe": op7_bpe,
    "op8_url_filters": op8_url_filters,
    "op9_sharding": op9_sharding,
    "op10_simhash": op10_simhash,
    "op11_minhash": op11_minhash,
    "op12_collocations": op12_collocations,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL = {
    "op1_pii": pii.oracle(),
    "op4_quality_rules": quality.oracle(),
    "op5_exact_topk": _OP5_SQL,
    "op6_substring_dedup": _OP6_SQL,
    "op8_url_filters": _OP8_SQL,
    "op9_sharding": _OP9_SQL,
    "op11_minhash": _OP11_SQL,
    "op12_collocations": _OP12_SQL,
    "op13_vector_codes": _op13_sql(),
}
