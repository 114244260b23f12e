import math
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.functions.columns import is_missing, quoted, text
from tallyglass.functions.rounding import percentage, round_exact, round_scaled
from tallyglass.functions.time import readable_timestamp

SPELLINGS = [
    None, "", " ", "\t", "NaN", "nan", "NAN", "nAn", " NaN ", "\tnan\n", "\x00NaN", "+NaN", "-NaN",
    "+nan", "-nan", "- NaN", "NaN x", "xNaN", "NaNd", "NaNf", "NaN ", " NaN", "none", "new",
    "n", "N", "+", "-", "nano", "Infinity", "-inf", "12", "12d", "0x1p3", "1e400", "bad", "é", "日本",
    "!", " !", "\x1fnan", "\x7fnan", "na\nn",
]


def missing_texts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    ours = is_missing("c", T.StringType())
    cast = "c IS NULL OR coalesce(isnan(try_cast(c AS DOUBLE)), false)"
    return df.selectExpr("c", f"{ours} AS ours", f"{cast} AS by_cast").collect()


def test_missing_text_agrees_with_a_cast(spark):
    for row in missing_texts(spark, SPELLINGS):
        assert row.ours == row.by_cast, repr(row.c)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="nNaA+-. \t\x00\x1f!1 é", max_size=7), min_size=20, max_size=60))
def test_missing_text_agrees_with_a_cast_on_generated_text(spark, values):
    for row in missing_texts(spark, values):
        assert row.ours == row.by_cast, repr(row.c)


def test_missing_by_type(spark):
    schema = T.StructType(
        [
            T.StructField("d", T.DoubleType()),
            T.StructField("f", T.FloatType()),
            T.StructField("day", T.DateType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("ok", T.BooleanType()),
            T.StructField("dec", T.DecimalType(5, 2)),
            T.StructField("arr", T.ArrayType(T.IntegerType())),
        ]
    )
    rows = [
        (math.nan, math.nan, None, None, None, None, None),
        (1.0, 1.0, date(2024, 1, 1), datetime(2024, 1, 1), True, Decimal("1.00"), [1]),
        (None,) * 7,
    ]
    df = spark.createDataFrame(rows, schema)
    flags = df.selectExpr(*[is_missing(f.name, f.dataType) for f in schema]).collect()
    assert [list(r) for r in flags] == [[True] * 7, [False] * 7, [True] * 7]


def test_names_and_literals_are_quoted(spark):
    name = "a.b`c"
    df = spark.createDataFrame([(1,)], [name])
    assert df.selectExpr(f"{quoted(name)} AS v").first().v == 1
    for value in ["it's", "back\\slash", 'q"q', "línea\nnova"]:
        assert df.selectExpr(f"{text(value)} AS v").first().v == value


@pytest.mark.parametrize("digits", [1, 2])
def test_exact_rounding_is_the_language_rounding(spark, digits):
    values = [k / 1000 for k in range(0, 100_001, 5)]
    values += [a / b * 100 for a in range(150) for b in (640, 800, 1600, 8000, 20000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.selectExpr("v", f"{round_exact('v', digits)} AS r").collect()
    assert [r.v for r in rows if r.r != round(r.v, digits)] == []


def test_scaled_rounding_is_the_array_rounding(spark):
    values = [39.125, 2.675, 0.575, 0.285, 1.005, -39.125, 0.0, *np.arange(0, 100, 0.0625)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.selectExpr("v", f"{round_scaled('v', 2)} AS r").collect()
    assert [r.v for r in rows if r.r != float(np.round(r.v, 2))] == []
    assert rows[0].r == 39.12


def test_percentage_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (2, 3), (1, 1)], "p bigint, t bigint")
    got = [r[0] for r in df.selectExpr(percentage("p", "t")).collect()]
    assert got == [0.0, 33.33, 66.67, 100.0]


def test_readable_timestamp_follows_the_session_zone(spark):
    df = spark.createDataFrame([(1629563063,)], "e bigint")
    assert df.selectExpr(readable_timestamp("e")).first()[0] == "2021-08-21 16:24:23"
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert df.selectExpr(readable_timestamp("e")).first()[0] == "2021-08-21 13:24:23"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ascii_order_behind_the_first_byte_rule(spark):
    low = spark.range(33).select(F.char(F.col("id")).alias("c"))
    assert low.filter("c >= '!'").count() == 0
    assert spark.range(1).selectExpr("'!' >= '!'").first()[0]
