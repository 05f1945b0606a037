"""Python list literals as expressions, against Python's own reading."""

import ast
import random
import warnings

from pyspark.sql import functions as F

from ratelens.functions.lists import list_or_empty, parse_list
from ratelens.operators import aggregate as G
from ratelens.operators import clean as C
from ratelens.plans import catalog

CASES = [
    "['a','b',]", r"['\x41']", "['a', None]", "['a' 'b']", "('a', 'b')", "['it\\'s', \"x\"]", "[]", "['a'", "abc", None, "[1, 2]", "['é']", "[ ]", "[,]",
    "['']", "['', '']", "['a','b']", "[\"a', 'b\"]", "['a\"b', 'c']", "['a', \"b\", 'c']", "['a\\n']", "['a\nb']", "['\\u00e9\\101\\7x\\q\\\\']", "['\\U0001F600']",
    "['\\xZ']", "[1.0, 2.50, -3, +4, 1e5, 1e16, 1.5e-7, 0.0001, 123456789.5, 12345678.0, 00, 1_000]", "[007]", "[True, False, None,]", "\n['a']\n", "  ['a'] ",
    "['a'] ['b']", "[u'x', U\"y\"]", "['\x01', '\x011', '\x012']", "['a'b]", "[1 2]", "['a' 1]", "['' 'a']", "[1,,2]", "[1.5E300, 1e400, -0, 0, -0.0, 5., .5]",
    "['a\\\nb']", "['None']", "['a', 'b' , 'c'\t]", "['\"', '\\t']", "", "[", "]", "['a']x", "[--1]", "['a', '',]", "['\x00']",
    "[9999999.0, 10000000.0, 1e15, 9007199254740993, 123456789012345678901234567890123456789012345, 0.001, 0.00012, 1e22]",
]


def _python(t):
    try:
        v = ast.literal_eval(t.strip(" ")) if t is not None else None
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None
    return v if isinstance(v, list) else None


def test_literals_as_python_reads_them(spark):
    rng = random.Random(2)
    signs = ["'", '"', "\\", "a", "b", ",", "[", "]", " ", "n", "x41", "None", "1", ".5", "\t"]
    texts = ["a", "it's", 'say "x"', "tab\t", "back\\slash", "é", "\x01z", "line\n", "", "None", "x, y", "', '", 1, 2.5, None, True, -3]
    cases = [*CASES, *("[" + "".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) + "]" for _ in range(1500)),
             *(repr([rng.choice(texts) for _ in range(rng.randint(0, 6))]) for _ in range(300))]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [_python(t) for t in cases]
    # nested lists, bytes and raw strings are not in the grammar
    keep = [i for i, v in enumerate(want) if v is None or all(isinstance(x, (str, int, float, type(None))) for x in v)]
    df = spark.createDataFrame([(i, cases[i]) for i in keep], "i int, t string")
    got = {r.i: r for r in df.select("i", parse_list("t").alias("a1"), list_or_empty(df, "t").alias("a2")).collect()}
    for i in keep:
        assert got[i].a1 == (None if want[i] is None else [None if x is None else str(x) for x in want[i]]), cases[i]
        assert got[i].a2 == [str(x) for x in want[i] or []], cases[i]


def test_literals_outside_the_grammar_are_no_lists(spark):
    df = spark.createDataFrame([(t,) for t in ("['a', ['b']]", "[r'y']", "[b'y']", "['''a''']", "[0x1f]", "[1j]", "{'a': 1}", "['\\N{BULLET}']", "['\\ud83d']")], "t string")
    assert [r.v for r in df.select(parse_list("t").alias("v")).collect()] == [None] * 9


def test_long_lists_and_strings(spark):
    """Neither many items nor many escapes go deep into the regular expression engine."""
    items = [f"it's {i}" for i in range(20000)]
    quotes = "'" * 3000
    df = spark.createDataFrame([(repr(items),), (repr([quotes + '"']),)], "t string")
    a, b = [r.v for r in df.select(parse_list("t").alias("v")).collect()]
    assert a == items and b == [quotes + '"']


def test_recipes_keep_their_rows(spark):
    texts = ["['a', 'b',]", "['a' 'b']", "['a', None]", r"['\x41 b']", "[]", "broken", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, steps string")
    assert sorted(r.id for r in C.nonempty_list_filter(df, "steps").collect()) == [0, 1, 2, 3]
    words = {r.id: r.w for r in df.select("id", F.size(list_or_empty(df, "steps")).alias("w")).collect()}
    assert words == {0: 2, 1: 1, 2: 2, 3: 1, 4: 0, 5: 0, 6: 0}


def test_no_python_worker(spark):
    from tests.conftest import SMALL_DIR
    for name in ("g13_ingredients", "a1_parse_tags", "c13_awkward_steps"):
        plan = catalog.queries()[name](spark, SMALL_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert G.list_items(spark.createDataFrame([("['a' 'b', None,]",)], "tags string"), "tags").count() == 2
