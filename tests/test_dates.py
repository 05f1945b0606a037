"""C11: dates that do not parse become NULL, or fail the job where that is asked for."""

import datetime

import pytest
from pyspark.sql import functions as F

from ratelens.operators import clean as C


def test_lenient_and_strict(spark):
    df = spark.createDataFrame([("2004-02-29",), ("2004-02-30",), ("soon",), (None,)], "d string")
    assert [r.x for r in df.select(C.coerce_date("d").alias("x")).collect()] == [datetime.date(2004, 2, 29), None, None, None]
    good = df.where("d = '2004-02-29' OR d IS NULL")
    assert [r.x for r in good.select(C.coerce_date("d", strict=True).alias("x")).collect()] == [datetime.date(2004, 2, 29), None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        df.select(C.coerce_date("d", strict=True).alias("x")).collect()


def test_formats(spark):
    df = spark.createDataFrame([("29/02/2004",), ("2004-02-29",)], "d string")
    assert [r.x for r in df.select(C.coerce_date("d", "dd/MM/yyyy").alias("x")).collect()] == [datetime.date(2004, 2, 29), None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(C.coerce_timestamp(F.col("d"), "dd/MM/yyyy", strict=True)).collect()
