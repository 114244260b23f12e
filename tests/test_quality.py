import json

import pytest
from conftest import as_dicts
from pyspark.errors import PySparkException

from tallyglass.operators import quality
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.plans.report import quality_report, report_details
from tallyglass.schema import REPORT_DDL

STAMP = "2026-01-29T18:56:32.046394"


@pytest.fixture()
def report(spark):
    """One report row with the measures that matter here."""

    def make(score=100.0, null_columns=0, share=0.0, anomalies=0, name="cleaned_data", nulls=()):
        row = {
            "table_name": name,
            "timestamp": STAMP,
            "basic_metrics": {"total_records": 17, "total_columns": 14},
            "null_analysis": {
                "null_details": [
                    {"column": c, "null_count": 1, "null_percentage": p} for c, p in nulls
                ],
                "columns_with_nulls": null_columns,
            },
            "duplicate_analysis": {
                "total_records": 17,
                "unique_records": 17,
                "duplicate_count": 0,
                "duplicate_percentage": share,
            },
            "data_types_analysis": None,
            "statistical_analysis": None,
            "anomalies": [
                {"type": str(i), "column": "c", "count": 1, "description": ""}
                for i in range(anomalies)
            ],
            "quality_score": score,
        }
        return spark.createDataFrame([row], REPORT_DDL)

    return make


def test_report_of_the_known_sample(sample):
    raw = as_dicts(quality_report(sample, "raw_data", STAMP))[0]
    cleaned = as_dicts(quality_report(clean_transactions(sample), "cleaned_data", STAMP))[0]
    assert (raw["quality_score"], cleaned["quality_score"]) == (100.0, 95.0)
    assert raw["basic_metrics"] == {"total_records": 17, "total_columns": 13}
    assert cleaned["basic_metrics"] == {"total_records": 17, "total_columns": 14}
    assert raw["null_analysis"]["columns_with_nulls"] == 0
    missing = {d["column"]: d for d in cleaned["null_analysis"]["null_details"]}
    assert missing["risk_score"] == {
        "column": "risk_score",
        "null_count": 2,
        "null_percentage": 11.76,
    }
    statistic = cleaned["statistical_analysis"]["statistics"]["risk_score"]
    assert statistic["count"] == 15
    assert statistic["mean"] == pytest.approx(35.7)
    assert (statistic["min"], statistic["max"]) == (15.0, 62.5)
    assert cleaned["data_types_analysis"]["type_distribution"] == {
        "bigint": 1, "string": 8, "double": 3, "int": 2,
    }
    assert cleaned["duplicate_analysis"]["duplicate_count"] == 0
    assert cleaned["anomalies"] == []


def test_report_has_the_declared_schema(spark, transactions):
    for df in (transactions({}), transactions({}).select("anomaly"), transactions({}).limit(0)):
        report = quality_report(df, "t", STAMP)
        declared = spark.createDataFrame([], REPORT_DDL).schema
        assert report.schema.simpleString() == declared.simpleString()
        assert report.count() == 1


def test_report_time_defaults_to_now(transactions):
    stamp = quality_report(transactions({}), "t").first().timestamp
    assert len(stamp) == len(STAMP) and stamp[10] == "T"


def test_reports_of_several_tables(sample):
    both = quality_report(sample, "a", STAMP).unionByName(quality_report(sample, "b", STAMP))
    assert [r.table_name for r in both.collect()] == ["a", "b"]
    details = report_details(both)
    assert details.filter("section = 'overall' AND measure = 'quality_score'").count() == 2
    assert details.filter("section = 'nulls'").count() == 2 * 13 * 2


def test_score_floor(transactions):
    rows = [{"sending_address": None, "risk_score": None, "anomaly": None, "age_group": None,
             "amount": -1.0, "timestamp": 1}] * 5
    row = quality_report(transactions(*rows), "t", STAMP).first()
    assert row.duplicate_analysis.duplicate_percentage == 80.0
    assert row.quality_score == 30.0


def test_score_counts_kinds_of_anomaly_not_rows(transactions):
    df = transactions(*[{"amount": -1.0, "timestamp": 1_600_000_000 + i} for i in range(5)])
    assert quality_report(df, "t", STAMP).first().quality_score == 90.0


@pytest.mark.parametrize(
    "score, band",
    [(100.0, "perfect"), (99.99, "high"), (80.0, "high"), (79.99, "medium"), (60.0, "medium"), (59.99, "low")],
)
def test_bands(report, score, band):
    assert quality.quality_band(report(score)).first().band == band


def messages(df):
    return [(r.rule, r.message) for r in quality.quality_alerts(df).collect()]


def test_alert_limits_are_strict(report):
    assert messages(report(score=80.0, share=5.0)) == []
    assert messages(report(score=79.99, share=5.01)) == [
        ("low_score", "🚨 Score de qualidade baixo: 79.99/100"),
        ("duplicates", "🔄 5.0% de registros duplicados"),
    ]


def test_all_alerts(report):
    assert messages(report(score=72.9, null_columns=3, share=12.0, anomalies=2)) == [
        ("low_score", "🚨 Score de qualidade baixo: 72.9/100"),
        ("null_columns", "⚠️  3 colunas com valores nulos"),
        ("duplicates", "🔄 12.0% de registros duplicados"),
        ("anomalies", "🔍 2 tipos de anomalias detectadas"),
    ]


@pytest.mark.parametrize("share", [5.25, 5.35, 5.45, 9.95, 99.99, 10.05])
def test_share_in_alerts_is_formatted_from_the_binary_value(report, share):
    assert messages(report(share=share)) == [
        ("duplicates", f"🔄 {share:.1f}% de registros duplicados")
    ]


def test_gate(report):
    passed = quality.quality_gate(report(score=70.0)).first()
    assert (passed.quality_score, passed.threshold, passed.passed) == (70.0, 70.0, True)
    assert quality.quality_gate(report(score=69.99)).first().passed is False
    assert quality.quality_gate(report(name="raw_data")).count() == 0


def test_strict_gate(report):
    assert quality.quality_gate(report(score=70.0), strict=True).first().passed is True
    with pytest.raises(PySparkException, match="69.99"):
        quality.quality_gate(report(score=69.99), strict=True).collect()


def test_rules(report):
    rows = as_dicts(
        quality.threshold_rules(
            report(score=69.0, share=5.0, nulls=[("amount", 10.0), ("risk_score", 10.01), ("other", 90.0)])
        )
    )
    assert [(r["rule"], r["column"], r["value"], r["limit"], r["breached"]) for r in rows] == [
        ("min_quality_score", None, 69.0, 70.0, True),
        ("max_duplicate_percentage", None, 5.0, 5.0, False),
        ("max_null_percentage", "amount", 10.0, 10.0, False),
        ("max_null_percentage", "risk_score", 10.01, 10.0, True),
    ]


def test_summary_text(report):
    lines = quality.quality_summary(report(score=95.0, null_columns=1)).orderBy("line_number")
    assert [r.line for r in lines.collect()] == [
        "RELATÓRIO DE QUALIDADE DE DADOS",
        "==================================================",
        "",
        "Timestamp: 2026-01-29T18:56:32.046394",
        "Total de registros: 17",
        "Total de colunas: 14",
        "Score de qualidade: 95.0/100",
        "",
        "Colunas com nulos: 1",
        "Registros duplicados: 0",
        "Anomalias detectadas: 0",
    ]


def test_execution_report(report):
    row = json.loads(quality.execution_report(report(score=95.0), STAMP).toJSON().first())
    assert row == {
        "execution_date": STAMP,
        "job_id": "tallyglass",
        "status": "success",
        "tasks_completed": ["load", "profile", "clean", "analyse", "report"],
        "quality_summary": {"quality_score": 95.0, "total_records": 17},
    }
    assert quality.execution_report(report(score=69.9), STAMP).first().status == "failed"
    absent = quality.execution_report(report(name="raw_data"), STAMP).first()
    assert (absent.status, absent.quality_summary.total_records) == ("failed", 0)
    incomplete = quality.execution_report(report(score=95.0), STAMP, results_complete=False).first()
    assert (incomplete.status, "analyse" in incomplete.tasks_completed) == ("failed", False)
