from tallyglass.operators import quarantine
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.schema import TXN_SCHEMA
from tallyglass.sources.transactions import load_transactions

GOOD = dict(zip(TXN_SCHEMA.fieldNames(), "160 s r 10.5 sale Asia 192.168 3 40 focused new 20.5 low_risk".split()))


def written(spark, tmp_path, *changes):
    cells = spark.createDataFrame([], TXN_SCHEMA).selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in GOOD]).schema
    rows = [tuple({**GOOD, **change}.values()) for change in changes]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, cells).coalesce(1).write.option("header", True).csv(path)
    return path


def problems_of(df):
    return [[tuple(p) for p in r.problems] for r in df.collect()]


def test_every_cell_gets_its_reason(spark, tmp_path):
    changes = [
        {},
        {"amount": "abc"},
        {"amount": "-1"},
        {"amount": "0"},
        {"amount": "NaN"},
        {"amount": None, "timestamp": "soon"},
        {"login_frequency": "often", "ip_prefix": "x"},
        {"risk_score": "none"},
        {"risk_score": "bad"},
        {"location_region": None, "session_duration": "1.5"},
        {"sending_address": None},
    ]
    path = written(spark, tmp_path, *changes)
    records = quarantine.judged(quarantine.text_records(spark, path))
    assert problems_of(quarantine.kept_records(records)) == [
        [], [], [("ip_prefix", "malformed"), ("login_frequency", "malformed")], [], [("risk_score", "malformed")], [],
    ]
    assert problems_of(quarantine.rejected_records(records)) == [
        [("amount", "malformed")],
        [("amount", "not_positive")],
        [("amount", "not_positive")],
        [("timestamp", "malformed"), ("amount", "missing")],
        [("location_region", "missing"), ("session_duration", "malformed")],
    ]
    # What is kept here is what cleaning keeps.
    assert quarantine.kept_records(records).count() == clean_transactions(load_transactions(spark, path)).count()
    counts = {(r.column, r.reason, r.kept): r.cells for r in quarantine.problem_counts(records).collect()}
    assert counts[("amount", "not_positive", False)] == 2 and counts[("login_frequency", "malformed", True)] == 1
    assert sum(counts.values()) == 10


def test_one_scan_and_no_shuffle_of_records(spark, tmp_path):
    records = quarantine.judged(quarantine.text_records(spark, written(spark, tmp_path, {}, {"amount": "x"})))
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for part in (quarantine.kept_records(records), quarantine.rejected_records(records)):
        assert plan_of(part).count("FileScan") == 1 and "Exchange" not in plan_of(part)
    counted = plan_of(quarantine.problem_counts(records))
    assert counted.count("FileScan") == 1 and counted.index("Exchange") < counted.rindex("HashAggregate")


def test_no_records_and_a_column_named_problems(spark, tmp_path):
    records = quarantine.text_records(spark, written(spark, tmp_path, {"amount": "x"})).selectExpr("*", "1 AS problems")
    judged = quarantine.judged(records)
    assert judged.columns[-1] == "problems_" and quarantine.rejected_records(judged).first().problems == 1
    assert quarantine.problem_counts(quarantine.judged(records.limit(0))).count() == 0
