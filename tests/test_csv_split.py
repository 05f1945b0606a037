"""Multi-line CSV cut into records by byte ranges, against Python's own reader and Spark's one-task scan."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ratelens.sources import csv_split, readers

SCHEMA = StructType([StructField("a", StringType()), StructField("b", LongType()), StructField("c", StringType())])
RNG = random.Random(4)


def _field():
    return "".join(RNG.choice(["x", "é", ",", '"', "\n", '""', " ", "'", "yy", '","', '"\n"', "\n\n"]) for _ in range(RNG.randint(0, 8)))


@pytest.fixture
def split(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _write(folder, texts):
    folder.mkdir()
    for i, t in enumerate(texts):
        (folder / f"f{i}.csv").write_text(t, encoding="utf-8", newline="")
    return str(folder)


def _rows(texts):
    out = []
    for t in texts:
        for r in list(csv.reader(io.StringIO(t, newline="")))[1:]:
            if r:
                out.append((r[0] or None, int(r[1]) if r[1].isdigit() else None, r[2] or None))
    return sorted(out, key=repr)


def test_records_whatever_the_ranges(spark, split, tmp_path):
    texts = []
    for n, end, quoting in ((60, "\n", csv.QUOTE_MINIMAL), (0, "\n", csv.QUOTE_ALL), (40, "\r\n", csv.QUOTE_ALL), (1, "\n", csv.QUOTE_MINIMAL)):
        f = io.StringIO(newline="")
        w = csv.writer(f, lineterminator=end, quoting=quoting)
        w.writerow(["a", "b\n1", "c"])
        for i in range(n):
            w.writerow([_field(), RNG.choice([i, "z", ""]), _field()])
        texts.append(f.getvalue() + RNG.choice(["", "\n\n", 'last,7,open']))
    path = _write(tmp_path / "in", texts)
    want = _rows(texts)
    for size in (97, 700, 1 << 27):
        split(size)
        assert sorted((tuple(r) for r in csv_split.read(spark, path, SCHEMA).collect()), key=repr) == want
    split(97)
    assert spark.read.text(path).select(F.spark_partition_id()).distinct().count() > 20


def test_one_large_record_over_many_ranges(spark, split, tmp_path):
    text = 'a,b,c\n1,2,"' + 'line "" of\n' * 50 + '"\n3,4,5\n"6\n",7,""\n'
    path = _write(tmp_path / "in", [text])
    split(64)
    assert sorted((tuple(r) for r in csv_split.read(spark, path, SCHEMA).collect()), key=repr) == _rows([text])


def test_same_as_the_one_task_scan(spark, split, tmp_path):
    f = io.StringIO(newline="")
    w = csv.writer(f, lineterminator="\n")
    w.writerow(["a", "b", "c"])
    for i in range(50):
        w.writerow([RNG.choice(["NA", "", "nan", _field()]), i, _field()])
    path = _write(tmp_path / "in", [f.getvalue()])
    plain = spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').schema(SCHEMA).csv(path)
    split(128)
    assert sorted(map(repr, readers.read_csv(spark, path, SCHEMA).collect())) == sorted(map(repr, readers.normalize_missing(plain).collect()))


def test_empty_files(spark, tmp_path):
    assert csv_split.read(spark, _write(tmp_path / "none", ["", "a,b,c", "a,b,c\n"]), SCHEMA).count() == 0


def test_kinds_compose(spark):
    """A line's kind says what it does to either state, and runs of kinds act as their composition."""
    lines = ["", "a,b", '"', '","', 'a"b', '"a",b', '"a""', '""', '"""', 'x,"y', 'y",z', 'y","z', '"a"b,"c', 'y"x"y', '"",""', '"","']

    def run(line, inside):
        """Character by character: a field start, an unquoted field, inside quotes."""
        state, i = ("in" if inside else "start"), 0
        while i < len(line):
            ch = line[i]
            if state == "in":
                if ch == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif ch == '"':
                    state = "plain"
            elif ch == ",":
                state = "start"
            elif state == "start":
                state = "in" if ch == '"' else "plain"
            i += 1
        return int(state == "in")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    kinds = {r.i: r.k for r in df.select("i", csv_split.line_kind(F.col("t")).alias("k")).collect()}
    for i, t in enumerate(lines):
        assert kinds[i] == run(t, 0) + 2 * run(t, 1), t
    for _ in range(50):
        seq = np.array([RNG.randrange(4) for _ in range(RNG.randint(0, 9))])
        for first in (0, 1):
            want = [first]
            for k in seq:
                want.append(int(k) >> want[-1] & 1)
            assert csv_split.states(seq, first).tolist() == want
