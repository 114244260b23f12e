import glob
import json
import math
import os

import pytest
from conftest import as_dicts
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyglass import session
from tallyglass.operators.analytics import highest_risk_first, location_risk, top_sale_addresses
from tallyglass.operators.cleaning import clean_audit, clean_transactions
from tallyglass.operators.quality import quality_gate
from tallyglass.plans.report import quality_report
from tallyglass.plans.run import EXPECTED_RESULTS
from tallyglass.schema import MALFORMED, TXN_SCHEMA
from tallyglass.sources import results
from tallyglass.sources.transactions import land, load_transactions


def parts(path, suffix):
    return glob.glob(f"{path}/part-*.{suffix}")


@pytest.fixture()
def csv_path(sample, tmp_path):
    path = str(tmp_path / "input")
    results.write_csv(sample, path)
    return path


def test_inferred_and_declared_types(spark, csv_path, sample):
    declared = load_transactions(spark, csv_path)
    assert declared.schema.simpleString() == sample.schema.simpleString()
    assert sorted(map(str, declared.collect())) == sorted(map(str, sample.collect()))
    inferred = dict(load_transactions(spark, csv_path, schema=None).dtypes)
    assert inferred["timestamp"] == "int" and inferred["ip_prefix"] == "double"
    assert inferred["risk_score"] == "string"


def test_prefixes_can_stay_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text("ip_prefix\n192.0\n10.10\n")
    text = load_transactions(spark, str(tmp_path / "in.csv"), schema="ip_prefix string")
    assert [r.ip_prefix for r in text.collect()] == ["192.0", "10.10"]


def test_reordered_columns_are_refused_not_misread(spark, sample, tmp_path):
    path = str(tmp_path / "in")
    results.write_csv(sample.select(*reversed(sample.columns)), path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        load_transactions(spark, path).collect()
    inferred = load_transactions(spark, path, schema=None)
    assert clean_transactions(inferred).count() == 17


def test_malformed_numbers_become_null(spark, sample, tmp_path):
    path = str(tmp_path / "in")
    results.write_csv(sample.withColumn("amount", F.lit("12,5")), path)
    assert load_transactions(spark, path).filter("amount IS NULL").count() == 17


def test_parquet_source(spark, sample, tmp_path):
    path = str(tmp_path / "p")
    sample.write.parquet(path)
    assert load_transactions(spark, path, source_format="parquet").count() == 17


def test_missing_input_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_transactions(spark, str(tmp_path / "absent.csv"))


def test_land_replaces(spark, sample, tmp_path):
    path = str(tmp_path / "landed")
    land(sample, path)
    assert land(sample.limit(3), path).count() == 3


def test_formats_hold_rounded_text_and_exact_parquet(spark, sample, tmp_path):
    risk = location_risk(clean_transactions(sample))
    results.write_result(risk, str(tmp_path), "r", rounded={"avg_risk_score": 2})
    csv = "".join(open(p).read() for p in parts(tmp_path / "r.csv", "csv"))
    assert csv.splitlines() == [
        "location_region,avg_risk_score",
        "North America,52.5",
        "Africa,39.12",
        "South America,38.36",
        "Asia,31.25",
        "Europe,17.5",
    ]
    lines = "".join(open(p).read() for p in parts(tmp_path / "r.json", "json")).splitlines()
    assert [json.loads(line) for line in lines][1] == {
        "location_region": "Africa",
        "avg_risk_score": 39.12,
    }
    exact = results.read_result(spark, str(tmp_path), "r")
    assert {r.location_region: r.avg_risk_score for r in exact.collect()}["Africa"] == 39.125


def test_rows_stay_in_order_over_several_files(spark, transactions, tmp_path):
    rows = [{"location_region": f"region-{'x' * (i % 5)}{i}", "risk_score": str(i)} for i in range(30)]
    risk = location_risk(clean_transactions(transactions(*rows)))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "4")
    try:
        results.write_result(risk, str(tmp_path), "r", order=highest_risk_first())
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = sorted(parts(tmp_path / "r.json", "json"))
    assert len(files) > 1
    scores = [json.loads(line)["avg_risk_score"] for p in files for line in open(p)]
    assert scores == [float(i) for i in reversed(range(30))]


@pytest.mark.parametrize("formats", [["csv"], ["json"], ["csv", "json"], ["parquet"]])
def test_chosen_formats_only(spark, sample, tmp_path, formats):
    top = top_sale_addresses(clean_transactions(sample))
    results.write_result(top, str(tmp_path), "t", formats=formats)
    assert sorted(os.listdir(tmp_path)) == sorted(
        os.path.basename(results.result_path("", "t", f)) for f in formats
    )
    for f in formats:
        back = results.read_result(spark, str(tmp_path), "t", f, top.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, top.collect()))


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    texts = ['a "q" b', "line\nbreak\r\nmore", " outer ", "", None, '""', '"', "a,b", "\\back\\", '\\"', "\r", "NaN", "#c"]
    df = spark.createDataFrame([(i, t, texts[-i]) for i, t in enumerate(texts)], "i int, a string, b string")
    results.write_result(df, str(tmp_path), "t", ["csv"])
    back = results.read_result(spark, str(tmp_path), "t", "csv", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_exact_copy_stays_where_asked(spark, sample, tmp_path):
    risk = location_risk(clean_transactions(sample))
    exact = str(tmp_path / "exact")
    results.write_result(risk, str(tmp_path), "r", ["csv"], rounded={"avg_risk_score": 2}, exact_path=exact)
    assert sorted(map(tuple, spark.read.parquet(exact).collect())) == sorted(map(tuple, risk.collect()))


def test_no_format(sample, tmp_path):
    with pytest.raises(ValueError, match="none given"):
        results.write_result(sample, str(tmp_path), "t", formats=[])


def test_malformed_cells_are_kept_and_counted(spark, tmp_path):
    header = ",".join(f.name for f in TXN_SCHEMA)
    good = "1,s,r,1.5,sale,Asia,1.0,1,1,p,a,2.0,low"
    bad = [good.replace("1.5", "abc"), good.replace("1,s", "x,s", 1), good.replace("1.5", "")]
    (tmp_path / "in.csv").write_text("\n".join([header, good, *bad]) + "\n")
    read = load_transactions(spark, str(tmp_path / "in.csv"), keep_malformed=True)
    audit = as_dicts(clean_audit(read))[0]
    assert list(audit.values()) == [4, 2, 1, 0, 1]
    assert clean_transactions(read).count() == 1 and MALFORMED not in clean_transactions(read).columns
    inferred = load_transactions(spark, str(tmp_path / "in.csv"), schema=None)
    assert list(as_dicts(clean_audit(inferred))[0].values()) == [4, 2, 1, 0, 1]


def test_unknown_format(sample, tmp_path):
    with pytest.raises(ValueError, match="xlsx"):
        results.write_result(sample, str(tmp_path), "t", formats=["xlsx"])


def test_single_file_on_request(spark, tmp_path):
    results.write_result(
        spark.range(100).repartition(4), str(tmp_path), "t", ["csv"], single_file=True
    )
    assert len(parts(tmp_path / "t.csv", "csv")) == 1


def test_empty_result_replaces_an_older_one(spark, sample, transactions, tmp_path):
    name = "top_sale_addresses"
    results.write_result(top_sale_addresses(clean_transactions(sample)), str(tmp_path), name)
    none = clean_transactions(transactions({"transaction_type": "transfer"}))
    results.write_result(top_sale_addresses(none), str(tmp_path), name)
    for f in results.FORMATS:
        schema = top_sale_addresses(none).schema
        assert results.read_result(spark, str(tmp_path), name, f, schema).count() == 0


def test_nulls_survive_json(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1.5, None)], "x double, y string")
    results.write_result(df, str(tmp_path), "n", ["json"])
    lines = "".join(open(p).read() for p in parts(tmp_path / "n.json", "json")).splitlines()
    assert sorted(lines) == ['{"x":1.5,"y":null}', '{"x":null,"y":"a"}']


def test_nan_becomes_null_in_text_only(spark, transactions, tmp_path):
    df = clean_transactions(transactions({"risk_score": "NaN"}))
    risk = location_risk(df)
    results.write_result(risk, str(tmp_path), "r", rounded={"avg_risk_score": 2}, nan_as_null=True)
    read = lambda f: "".join(open(p).read() for p in parts(tmp_path / f"r.{f}", f))
    assert read("csv").splitlines() == ["location_region,avg_risk_score", "Asia,"]
    assert json.loads(read("json")) == {"location_region": "Asia", "avg_risk_score": None}
    assert results.read_result(spark, str(tmp_path), "r").filter("isnan(avg_risk_score)").count() == 1


def test_results_present(spark, sample, tmp_path):
    cleaned = clean_transactions(sample)
    results.write_result(location_risk(cleaned), str(tmp_path), "location_risk_analysis", ["parquet"])
    rows = {r["result"]: r for r in as_dicts(results.results_present(spark, str(tmp_path), EXPECTED_RESULTS))}
    assert rows["location_risk_analysis"] == {
        "result": "location_risk_analysis", "present": True, "rows": 5, "columns_ok": True,
    }
    assert rows["top_sale_addresses"]["present"] is False
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        results.results_present(spark, str(tmp_path), EXPECTED_RESULTS, strict=True)
    wrong = {"location_risk_analysis": ["location_region"]}
    assert results.results_present(spark, str(tmp_path), wrong).first().columns_ok is False


def test_report_document_is_keyed_by_table(spark, sample, tmp_path):
    reports = quality_report(sample, "raw_data", "T0").unionByName(
        quality_report(clean_transactions(sample), "cleaned_data", "T1")
    )
    results.write_quality_report(reports, str(tmp_path))
    written = json.load(open(parts(tmp_path / "quality_report.json", "txt")[0]))
    assert set(written) == {"raw_data", "cleaned_data"}
    assert list(written["raw_data"]) == [
        "timestamp", "basic_metrics", "null_analysis", "duplicate_analysis", "data_types_analysis",
        "statistical_analysis", "anomalies", "quality_score",
    ]
    assert written["cleaned_data"]["quality_score"] == 95.0
    assert written["raw_data"]["statistical_analysis"]["statistics"]["amount"]["count"] == 17


def test_written_report_serves_a_later_gate(spark, sample, transactions, tmp_path):
    nan = transactions({"amount": math.nan})
    reports = quality_report(sample, "raw_data", "T0").unionByName(
        quality_report(clean_transactions(nan), "cleaned_data", "T1")
    )
    results.write_quality_report(reports, str(tmp_path))
    back = results.read_quality_report(spark, str(tmp_path))
    assert back.schema.simpleString() == reports.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, reports.collect()))
    assert quality_gate(back).first().passed is True
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        results.read_quality_report(spark, str(tmp_path / "absent"))


def test_summary_file_keeps_its_lines_in_order(sample, tmp_path):
    reports = quality_report(clean_transactions(sample), "cleaned_data", "T1")
    results.write_quality_summary(reports, str(tmp_path))
    lines = open(parts(tmp_path / "quality_summary.txt", "txt")[0]).read().splitlines()
    assert lines[3:7] == [
        "Timestamp: T1",
        "Total de registros: 17",
        "Total de colunas: 14",
        "Score de qualidade: 95.0/100",
    ]


class FakeSession:
    def __init__(self, **conf):
        self.conf = conf


def test_shared_folder_uses_the_configured_one():
    fake = FakeSession(**{"spark.checkpoint.dir": "hdfs://shared/ck/", "spark.master": "yarn"})
    first, second = session.shared_folder(fake), session.shared_folder(fake)
    assert first.startswith("hdfs://shared/ck/") and "//" not in first[7:] and first != second


def test_shared_folder_never_falls_back_to_local_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession(**{"spark.master": "yarn"}))
