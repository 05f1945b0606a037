"""PII, quality rules, URL filters and shards against their SQL twins, on given and awkward tables."""

import pytest

from ratelens.llm import pii, quality, queries, sharding, urlfilter
from tests.llm.helpers import SMALL, awkward, same

TEXTS = [
    "mail me: joe@x.org or a@b.c_x@d.e, ip 1.2.3.4.5.6.7.8 999.1.1.1 card 4111 1111-1111 1111, +1 (555) 555-0100 x",
    None, "", " \n\t\r\n ", "IBAN GB82WEST12345698765432 ssn 123-45-6789 no 123-45-6789",
    "é" * 50 + " a.b+c@d-e.f.g " + "9" * 3000 + " " + "a" * 20000,
    "@." * 3000 + "a@b." * 500 + "1." * 700, "1 2 3@4.5 +12345678 +1234567 00001.0002.255.256 1--23 " + "a@b.cd " * 700,
    "x\n\nx\n x\nx \n- one\n* two…\nthree...\r\n", "a b c a b c a b c d " * 30, "the of and to " * 20, "$$$ %%% |||",
    "l'été naïve ſ \x1c \x85 z " * 12,
]


@pytest.mark.parametrize("name", ["op1_pii", "op4_quality_rules", "op5_exact_topk", "op6_substring_dedup", "op8_url_filters", "op9_sharding"])
def test_given_tables(spark, name):
    same(queries.QUERIES[name](spark, SMALL), queries.ORACLE_SQL[name])


@pytest.mark.parametrize("extra", [False, True])
def test_pii_awkward(spark, extra):
    docs = awkward(spark, TEXTS, extra)
    same(pii.digest(pii.find(docs)), pii.oracle(), documents=docs.select("doc_id", "text"))
    empty = docs.where("false")
    assert pii.digest(pii.find(empty)).count() == 0


def test_pii_redaction(spark):
    docs = spark.createDataFrame([(1, "a joe@x.org b", 7), (2, None, 8), (3, "+1 (555) 555-0100 and 4111111111111111", 9)],
                                 "doc_id bigint, text string, spans int")
    got = {r.doc_id: (r.text, r.spans) for r in pii.redact(docs).collect()}
    assert got == {1: ("a [EMAIL] b", 7), 2: (None, 8), 3: ("[PHONE] and [CARD]", 9)}


def test_luhn_and_mod97(spark):
    rows = spark.createDataFrame([("4111111111111111", True), ("4111111111111112", False), ("0", True)], "d string, ok boolean")
    assert all(r.ok == r.got for r in rows.select("ok", pii.luhn(rows.d).alias("got")).collect())
    rows = spark.createDataFrame([("GB82WEST12345698765432", True), ("GB82WEST12345698765431", False), ("DE89370400440532013000", True)], "d string, ok boolean")
    assert all(r.ok == r.got for r in rows.select("ok", pii.mod97(rows.d).alias("got")).collect())


@pytest.mark.parametrize("extra", [False, True])
def test_quality_awkward(spark, extra):
    docs = awkward(spark, TEXTS, extra)
    same(quality.judge(docs), quality.oracle(), documents=docs.select("doc_id", "text"))
    assert quality.judge(docs.where("false")).count() == 0


def test_quality_keeps_prose(spark):
    prose = "it was the end of a day and the boats lay in the harbour with nets hung out to dry while gulls " \
            "called over the water that had not been so still for weeks as old men on the wall told each other " \
            "what they would do if the wind came back from the north in the night or by morning at least"
    got = quality.judge(spark.createDataFrame([(1, prose), (2, "%%% " * 60), (3, "buy now " * 40)], "doc_id int, text string"))
    assert {r.doc_id: r.kept for r in got.collect()} == {1: True, 2: False, 3: False}


def test_url_filter_times_and_scopes(spark):
    entries = spark.createDataFrame(
        [("l", "d:b.com", "add", 10), ("l", "d:b.com", "remove", 20), ("m", "h:a.b.com", "add", 15), ("m", "h:a.b.com", "remove", 15),
         ("n", "p:a.b.com/x", "add", 5), ("n", "p:a.b.com/x", "add", 7), (None, "h:a.b.com", "add", 0), ("o", "h:a.b.com", "other", 0), ("p", "h:z.org", "add", None)],
        "list string, key string, action string, since int")
    rows = [("http://a.b.com/q", 9), ("http://a.b.com/q", 10), ("http://a.b.com/q", 19), ("http://a.b.com/q", 20), ("HTTPS://u@A.B.com.:80/x/y?z", 12),
            ("http://a.b.com/xx", 6), (None, 12), ("nonsense", 12), ("http://a.b.com/q", None), ("http://a.b.com/q", 10), ("http://z.org", 3)]
    caps = spark.createDataFrame([(*r, "k") for r in rows], "url string, fetched_at int, key string")
    got = sorted(((r.url, r.fetched_at, r.lists, r.kept) for r in urlfilter.filter_urls(caps, entries).collect()), key=repr)
    want = ["", "l", "l", "", "l,n", "", "", "", "", "l", ""]
    assert got == sorted(((*r, w, w == "") for r, w in zip(rows, want)), key=repr)
    assert urlfilter.filter_urls(caps, entries.where("false")).where("kept").count() == len(rows)
    assert urlfilter.filter_urls(caps.where("false"), entries).count() == 0
    with pytest.raises(ValueError):
        urlfilter.filter_urls(caps.withColumnRenamed("key", "kept"), entries)


def _documents(rows, spark):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_shards_awkward(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, "x" * (i * i % 311)) for i in range(400)] + [(3, None)] * 50 + [(9, "y" * 90000)]
    docs = _documents(rows, spark)
    path = str(tmp_path / "in")
    docs.write.parquet(path + "/documents.parquet")
    same(queries.op9_sharding(spark, path), queries.ORACLE_SQL["op9_sharding"], documents=docs)


def test_shards_are_balanced_and_contiguous(spark):
    rows = spark.createDataFrame([(i, i * 37 % 101, "t") for i in range(5000)], "id int, bytes int, __upto string")
    got = sorted(sharding.shard_by_bytes(rows, 8, ["id"], "bytes").collect(), key=lambda r: r.id)
    assert [r.shard for r in got] == sorted(r.shard for r in got)
    sums = [sum(r.bytes for r in got if r.shard == s) for s in range(8)]
    assert max(sums) - min(sums) <= 2 * 101
    for s in range(8):
        assert [r.slot for r in got if r.shard == s] == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_by_bytes(rows.where("false"), 8, ["id"], "bytes").count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(rows.withColumnRenamed("bytes", "slot"), 8, ["id"], "slot")


def test_iban_ends_with_its_country_s_length(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"
    texts = [f"IBAN {de} BIC COBADEFF", f"Konto {de} Bank", f"iban {de} 12 Euro", f"iban {gb} 500", f"iban {de} {gb} {no} X",
             f"IBAN {de} und", f"AB12 {de} Bank", f"{de}", f"iban {de[:-1]}1 Bank", f"iban {de}7 x"]
    want = [[de], [de], [de], [gb], [de, gb, no], [de], [de], [de], [], []]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [r.text[x.start:x.end] for x in r.spans if x.kind == "iban"] for r in pii.find(docs).collect()}
    assert got == dict(enumerate(want))
    assert pii.redact(docs.where("doc_id = 1")).first().text == "Konto [IBAN] Bank"
