import os

import pytest
from conftest import as_dicts
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tallyglass.__main__ import main
from tallyglass.operators.quality import Thresholds
from tallyglass.plans.run import RunOptions, full_run, run_history
from tallyglass.schema import TXN_SCHEMA
from tallyglass.sources import results


@pytest.fixture()
def source(sample, tmp_path):
    path = str(tmp_path / "input")
    results.write_csv(sample, path)
    return path


def test_everything_is_written_and_agrees(spark, source, tmp_path):
    root = str(tmp_path / "out")
    run = full_run(spark, source, root, RunOptions(report_time="T0"))
    assert sorted(os.listdir(root)) == [
        "clean_audit_parquet",
        "execution_report.json",
        "execution_reports",
        "location_risk_analysis.csv",
        "location_risk_analysis.json",
        "location_risk_analysis_parquet",
        "quality_report.json",
        "quality_report_parquet",
        "quality_summary.txt",
        "raw_data_parquet",
        "results_present_parquet",
        "top_sale_addresses.csv",
        "top_sale_addresses.json",
        "top_sale_addresses_parquet",
    ]
    assert {r["table_name"]: r["quality_score"] for r in as_dicts(run.reports)} == {
        "raw_data": 100.0,
        "cleaned_data": 95.0,
    }
    assert run.location_risk.count() == 5
    assert [r.amount for r in run.top_sales.orderBy("amount").collect()] == [57325.0, 66002.0, 67617.0]
    assert [(r["present"], r["columns_ok"]) for r in as_dicts(run.present)] == [(True, True)] * 2
    assert run.gate.first().passed is True
    assert [r.message for r in run.alerts.collect()] == ["⚠️  1 colunas com valores nulos"]
    breached = [r["column"] for r in as_dicts(run.rules) if r["breached"]]
    assert breached == ["risk_score"]
    report = spark.read.json(f"{root}/execution_report.json").first()
    assert (report.status, report.quality_summary.total_records) == ("success", 17)


def test_running_again_replaces_everything(spark, source, tmp_path):
    root = str(tmp_path / "out")
    full_run(spark, source, root)
    again = full_run(spark, source, root)
    assert again.reports.count() == 2 and again.location_risk.count() == 5
    history = run_history(spark, root).orderBy("run").collect()
    assert [r.status for r in history] == ["success"] * 2 and history[0].run < history[1].run


def test_results_are_exact_whatever_the_formats(spark, source, tmp_path):
    expected = None
    for i, formats in enumerate((["parquet"], ["csv"], ["json", "csv"])):
        run = full_run(spark, source, str(tmp_path / str(i)), RunOptions(formats=formats, quality_checks=False))
        rows = sorted(map(tuple, run.location_risk.collect())), sorted(map(tuple, run.top_sales.collect()))
        expected = rows if expected is None else expected
        assert rows == expected
        assert ("Africa", 39.125) in rows[0]


def test_options_are_checked_first(spark, tmp_path):
    for formats in ([], ["xlsx"]):
        with pytest.raises(ValueError):
            full_run(spark, str(tmp_path / "absent"), str(tmp_path / "out"), RunOptions(formats=formats))


def test_cleanup_removes_the_landed_input(spark, source, tmp_path):
    root = str(tmp_path / "out")
    before = dict(spark.conf.getAll)
    run = full_run(spark, source, root, RunOptions(cleanup=True, duplicates="hash"))
    assert "raw_data_parquet" not in os.listdir(root)
    assert run.cleaned.count() == 17 and run.audit.first().final_records == 17
    assert dict(spark.conf.getAll) == before  # the caller's settings stay


def test_text_among_numbers(spark, sample, tmp_path):
    source = str(tmp_path / "dirty")
    dirty = sample.withColumns(
        {
            "amount": F.expr("IF(amount = 110, 'abc', CAST(amount AS STRING))"),
            "timestamp": F.expr("IF(amount = 112, 'not_a_time', CAST(`timestamp` AS STRING))"),
        }
    )
    results.write_csv(dirty, source)
    for schema in (None, TXN_SCHEMA):
        run = full_run(spark, source, str(tmp_path / f"out{schema is None}"), RunOptions(schema=schema))
        audit = run.audit.first()
        assert (audit.initial_records, audit.removed_malformed, audit.final_records) == (17, 2, 15)
        assert run.cleaned.count() == 15


def test_without_quality_checks(spark, source, tmp_path):
    root = str(tmp_path / "out")
    run = full_run(spark, source, root, RunOptions(quality_checks=False, formats=("csv",)))
    assert run.reports is None and run.gate is None
    assert run.location_risk.dtypes == [("location_region", "string"), ("avg_risk_score", "double")]
    assert not [f for f in os.listdir(root) if f.startswith("quality")]


def test_keep_cleaned_and_columnar_input(spark, sample, tmp_path):
    source, root = str(tmp_path / "p"), str(tmp_path / "out")
    sample.write.parquet(source)
    run = full_run(spark, source, root, RunOptions(source_format="parquet", keep_cleaned=True))
    assert spark.read.parquet(f"{root}/cleaned_data_parquet").count() == run.cleaned.count() == 17
    assert "raw_data_parquet" not in os.listdir(root)


def test_hash_duplicates_and_inferred_schema(spark, source, tmp_path):
    options = RunOptions(schema=None, duplicates="hash")
    run = full_run(spark, source, str(tmp_path / "out"), options)
    types = {r["table_name"]: r["data_types_analysis"]["type_distribution"] for r in as_dicts(run.reports)}
    assert types == {
        "raw_data": {"string": 8, "int": 3, "double": 2},
        "cleaned_data": {"string": 8, "int": 3, "double": 3},
    }


def test_strict_gate_stops_the_reader(spark, source, tmp_path):
    options = RunOptions(thresholds=Thresholds(gate_score=95.5), strict_gate=True)
    run = full_run(spark, source, str(tmp_path / "out"), options)
    with pytest.raises(PySparkException, match="95.0"):
        run.gate.collect()
    assert spark.read.json(f"{tmp_path}/out/execution_report.json").first().status == "failed"


def test_missing_input(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        full_run(spark, str(tmp_path / "absent"), str(tmp_path / "out"))


def test_command_line(spark, source, transactions, tmp_path, capsys):
    assert main([source, str(tmp_path / "out"), "--formats", "csv"]) == 0
    assert "cleaned_data" in capsys.readouterr().out
    poor = str(tmp_path / "poor")
    bad = {"sending_address": None, "anomaly": None, "age_group": None, "risk_score": None}
    results.write_csv(transactions(*[bad] * 4), poor)
    assert main([poor, str(tmp_path / "out2"), "--duplicates", "hash"]) == 1
    assert main([poor, str(tmp_path / "out3"), "--no-quality-checks"]) == 0
