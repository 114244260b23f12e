import math

import pytest
from conftest import as_dicts

from tallyglass.fixed_values import CRITICAL_COLUMNS
from tallyglass.operators import cleaning


def test_sentinel_is_exact_and_case_sensitive(transactions):
    df = transactions(*[{"risk_score": v} for v in ("none", "None", " none", None, "5")])
    got = [r.risk_score for r in cleaning.sentinel_to_null(df).collect()]
    assert got == [None, "None", " none", None, "5"]


def test_risk_text_to_double(transactions):
    df = transactions(*[{"risk_score": v} for v in ("none", "bad", "31.25", " 7 ", "NaN", None, "")])
    got = [r.risk_score for r in cleaning.risk_to_double(df).collect()]
    assert got[:4] == [None, None, 31.25, 7.0]
    assert math.isnan(got[4])
    assert got[5:] == [None, None]


def test_risk_that_is_already_numeric(spark):
    df = spark.createDataFrame([(1,), (None,)], "risk_score int")
    got = cleaning.risk_to_double(df)
    assert got.dtypes == [("risk_score", "double")]
    assert [r.risk_score for r in got.collect()] == [1.0, None]


@pytest.mark.parametrize("column", CRITICAL_COLUMNS)
def test_every_critical_null_drops_the_row(transactions, column):
    df = transactions({}, {column: None})
    assert cleaning.filter_critical_not_null(df).count() == 1


def test_missing_risk_does_not_drop_the_row(transactions):
    assert cleaning.clean_transactions(transactions({"risk_score": None})).count() == 1


def test_positive_amount_keeps_nan(transactions):
    df = transactions(*[{"amount": v} for v in (1.0, 0.0, -0.0, -5.0, None, math.nan, math.inf)])
    got = [r.amount for r in cleaning.filter_positive_amount(df).collect()]
    assert got[0] == 1.0 and math.isnan(got[1]) and got[2] == math.inf and len(got) == 3


def test_text_columns_are_cast_only_where_present(spark):
    df = spark.createDataFrame([(1, 2)], "age_group int, other int")
    assert cleaning.cast_to_string(df).dtypes == [("age_group", "string"), ("other", "int")]


def test_cleaning_adds_one_column_and_keeps_order(transactions):
    df = transactions({"timestamp": 1629563063, "risk_score": "none"})
    cleaned = cleaning.clean_transactions(df)
    assert cleaned.columns == [*df.columns, "timestamp_readable"]
    row = cleaned.first()
    assert row.risk_score is None and row.timestamp_readable == "2021-08-21 16:24:23"


def test_cleaning_again_drops_nothing_more(transactions):
    df = transactions({}, {"amount": -1.0}, {"amount": None}, {"risk_score": "bad"})
    once = cleaning.clean_transactions(df)
    assert once.count() == 2
    assert cleaning.clean_transactions(once).count() == 2


def test_absent_critical_column_is_named(transactions):
    with pytest.raises(ValueError, match="amount"):
        cleaning.clean_transactions(transactions({}).drop("amount"))


def test_audit_counts_every_drop_once(transactions):
    df = transactions(
        {}, {"amount": None}, {"amount": -1.0}, {"amount": 0.0}, {"timestamp": None, "amount": -1.0}
    )
    assert as_dicts(cleaning.clean_audit(df)) == [
        {
            "initial_records": 5,
            "removed_malformed": 0,
            "removed_null_critical": 2,
            "removed_non_positive_amount": 2,
            "final_records": 1,
        }
    ]
    assert cleaning.clean_transactions(df).count() == 1


def test_audit_of_nothing(transactions):
    empty = transactions({}).limit(0)
    assert set(as_dicts(cleaning.clean_audit(empty))[0].values()) == {0}
