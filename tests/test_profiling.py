import math
from datetime import date, datetime

import pytest
from conftest import as_dicts

from tallyglass.operators import profiling
from tallyglass.schema import TXN_SCHEMA


def by_column(df):
    return {r["column"]: r for r in as_dicts(df)}


def test_null_profile(transactions):
    df = transactions({}, {"amount": None}, {"amount": math.nan}, {"risk_score": "NaN"})
    rows = by_column(profiling.null_profile(df))
    assert list(rows) == [f.name for f in TXN_SCHEMA]
    assert (rows["amount"]["null_count"], rows["amount"]["null_percentage"]) == (2, 50.0)
    assert rows["risk_score"]["null_count"] == 1
    assert rows["anomaly"]["null_count"] == 0
    assert profiling.columns_with_nulls(df).first()[0] == 2


def test_sentinel_text_is_not_missing(transactions):
    assert profiling.columns_with_nulls(transactions({"risk_score": "none"})).first()[0] == 0


def test_empty_table(transactions):
    empty = transactions({}).limit(0)
    assert {(r["null_count"], r["null_percentage"]) for r in as_dicts(profiling.null_profile(empty))} == {
        (0, 0.0)
    }
    stats = as_dicts(profiling.numeric_stats(empty))
    assert {r["count"] for r in stats} == {0}
    assert {(r["mean"], r["stddev"], r["min"], r["max"]) for r in stats} == {(None,) * 4}
    assert profiling.anomaly_checks(empty).count() == 0
    assert as_dicts(profiling.basic_metrics(empty)) == [{"total_records": 0, "total_columns": 13}]


def test_single_row_has_no_deviation(transactions):
    row = by_column(profiling.numeric_stats(transactions({})))["amount"]
    assert row == {"column": "amount", "count": 1, "mean": 10.0, "stddev": None, "min": 10.0, "max": 10.0}


def test_statistics_skip_other_number_types(spark):
    df = spark.sql(
        "SELECT 1 AS i, 2L AS l, CAST(0.1 AS FLOAT) AS f, 1.5D AS d, 1.5BD AS dec, "
        "CAST(1 AS SHORT) AS s, CAST(1 AS BYTE) AS b, 'x' AS t"
    )
    stats = by_column(profiling.numeric_stats(df))
    assert list(stats) == ["i", "l", "f", "d"]
    assert stats["f"]["min"] == stats["f"]["max"] == 0.1


def test_no_numeric_column(spark):
    df = spark.createDataFrame([("a",)], "t string")
    stats = profiling.numeric_stats(df)
    assert stats.columns == ["column", "count", "mean", "stddev", "min", "max"]
    assert stats.count() == 0


def test_temporal_and_boolean_columns(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), datetime(2024, 1, 1), None), (None, None, True)],
        "d date, t timestamp, b boolean",
    )
    assert [r["null_count"] for r in as_dicts(profiling.null_profile(df))] == [1, 1, 1]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, "it"), (None, None)], "`a.b` double, `it's` string")
    assert list(by_column(profiling.null_profile(df))) == ["a.b", "it's"]
    assert list(by_column(profiling.numeric_stats(df))) == ["a.b"]


@pytest.mark.parametrize("size", [1, 2, 5, 12, 13])
def test_wide_tables_split_into_several_aggregates(transactions, size):
    df = transactions({}, {"amount": -3.0}, {"timestamp": 1, "risk_score": None})
    rules = profiling.transaction_anomaly_rules()
    whole = as_dicts(profiling.table_metrics(df, anomaly_rules=rules))
    assert as_dicts(
        profiling.table_metrics(df, anomaly_rules=rules, columns_per_aggregate=size)
    ) == whole
    assert [r["ordinal"] for r in whole[0]["missing"]] == list(range(13))


def test_anomaly_thresholds_are_strict(transactions):
    df = transactions(
        *[{"timestamp": t} for t in (1383282473, 1383282474, 1730178474, 1730178475, None)],
        {"amount": -0.5},
        {"amount": 0.0},
    )
    rows = {r["type"]: r for r in as_dicts(profiling.anomaly_checks(df))}
    assert {k: (r["column"], r["count"]) for k, r in rows.items()} == {
        "negative_values": ("amount", 1),
        "old_timestamps": ("timestamp", 1),
        "future_timestamps": ("timestamp", 1),
    }


def test_reference_time_is_a_parameter(transactions):
    df = transactions({"timestamp": 1_600_000_000})
    late = profiling.transaction_anomaly_rules(reference_epoch=2_000_000_000)
    assert [r["type"] for r in as_dicts(profiling.anomaly_checks(df, late))] == ["old_timestamps"]


def test_checks_need_their_column(transactions):
    df = transactions({"amount": -1.0, "timestamp": 1}).drop("amount")
    assert [r["type"] for r in as_dicts(profiling.anomaly_checks(df))] == ["old_timestamps"]
    assert profiling.anomaly_checks(df.drop("timestamp")).count() == 0


def test_types(transactions):
    df = transactions({})
    assert [tuple(r) for r in profiling.schema_profile(df).collect()] == [(*d, 1) for d in df.dtypes]
    counts = {r["data_type"]: r["columns"] for r in as_dicts(profiling.type_distribution(df))}
    assert counts == {"bigint": 1, "string": 8, "double": 2, "int": 2}
