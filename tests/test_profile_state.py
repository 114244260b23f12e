import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyglass.operators import profiling
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.operators.profile_state import Measured, merge_states, states_by, table_states
from tallyglass.plans.report import quality_report, quality_report_pair, report_details

NUMBERS = [1.0, None, float("nan"), -3.5, 1e9, 0.0, 2.0, 1e9 + 1]


def measured(df, **options):
    return {"state": Measured([(f.name, f.dataType) for f in df.schema], **options)}


def flat(state):
    return [state.total, list(state.anomalies), [tuple(c) for c in state.columns]]


def close(a, b):
    if isinstance(a, (list, tuple)):
        return len(a) == len(b) and all(map(close, a, b))
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def shown(rows):
    """Rows as text with nine digits of every fraction."""
    return sorted(re.sub(r"-?\d+\.\d+(e[+-]?\d+)?", lambda m: f"{float(m.group()):.9g}", str(r)) for r in rows)


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(i % 5, v, None if i % 3 else i, str(v)) for i, v in enumerate(NUMBERS[3:] * 6)]
    rows += [(7, None, None, None), (8, 5.0, 2, "x")]
    return spark.createDataFrame(rows, "part int, d double, n bigint, t string")


def test_states_of_parts_merge_to_the_state_of_all(numbers):
    columns = numbers.drop("part")
    asked = measured(columns, violations=["n < 5", "d > 1"])
    whole = table_states(columns, asked).first().state
    parts = states_by(numbers, asked, "part")
    assert parts.count() == 7
    merged = merge_states(parts, ["state"]).first().state
    assert close(flat(merged), flat(whole))
    two_steps = table_states(columns.repartition(20), asked, most_partial_rows=0).first().state
    assert close(flat(two_steps), flat(whole))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(NUMBERS), max_size=6), min_size=1, max_size=5))
def test_any_split_gives_the_statistics_of_one_scan(spark, parts):
    rows = [(i, v) for i, part in enumerate(parts) for v in part]
    df = spark.createDataFrame(rows, "part int, d double")
    merged = merge_states(states_by(df, measured(df.drop("part")), "part"), ["state"])
    fields = [(0, df.schema["d"])]
    found = merged.selectExpr(*profiling.metrics_of_state("state", fields)).first()
    expected = df.selectExpr("count(1)", "count_if(d IS NULL OR isnan(d))", "count(d)", "avg(d)", "stddev_samp(d)", "min(d)", "max(d)").first()
    statistics = found.statistics[0]
    assert (found.total_records, found.missing[0].missing, statistics["count"]) == tuple(expected)[:3]
    assert close([statistics[k] for k in ("mean", "stddev", "min", "max")], list(expected)[3:])


def test_no_states(spark):
    df = spark.createDataFrame([], "d double, t string")
    for rows in (4096, 0):
        row = table_states(df, measured(df), most_partial_rows=rows)
        found = row.selectExpr(*profiling.metrics_of_state("state", list(enumerate(df.schema)))).first()
        assert found.total_records == 0 and [m.missing for m in found.missing] == [0, 0]
        assert found.statistics[0].stddev is None and found.statistics[0]["count"] == 0


def test_no_task_merges_all_of_very_many_states(spark):
    df = spark.range(100_000).selectExpr("id", "CAST(id % 100 AS DOUBLE) AS d")
    states = states_by(df, measured(df.select("d")), "id").repartition(16).persist()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("merge", "merge")
    merged = merge_states(states, ["state"]).first().state
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert merged.total == 100_000 and math.isclose(merged.columns[0].mean, 49.5)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("merge") for s in tracker.getJobInfo(j).stageIds]
    # The first merge has a task for about every root of the number of states.
    assert max(s.numTasks for s in stages if s) == math.ceil(math.sqrt(100_000))
    dealt = states.selectExpr("pmod(xxhash64(monotonically_increasing_id()), 317) AS b").groupBy("b").count()
    assert dealt.agg({"count": "max"}).first()[0] < 100_000 / 16
    states.unpersist()


@pytest.mark.parametrize("duplicates", ["rows", "hash"])
def test_pair_is_the_two_reports(spark, sample, tmp_path, duplicates):
    none = sample.filter("amount < 104").withColumn("risk_score", sample.anomaly)  # no number
    rows = sample.union(none).union(none).withColumn("amount", sample.amount - 105)
    rows.write.parquet(f"{tmp_path}/rows")
    raw = spark.read.parquet(f"{tmp_path}/rows")
    pair = report_details(quality_report_pair(raw, report_time="T0", duplicates=duplicates))
    apart = quality_report(raw, "raw_data", "T0", duplicates="rows").unionByName(
        quality_report(clean_transactions(raw), "cleaned_data", "T0", duplicates="rows")
    )
    assert shown(pair.collect()) == shown(report_details(apart).collect())


def test_pair_of_text_columns_and_no_rows(spark, transactions):
    text = transactions({}, {"amount": -1.0}, {"amount": None}, {"risk_score": "none"}).selectExpr(
        "*", "CAST(amount AS STRING) AS a", "CAST(`timestamp` AS STRING) AS t"
    ).drop("amount", "timestamp").withColumnsRenamed({"a": "amount", "t": "timestamp"})
    for raw in (text, text.limit(0)):
        pair = quality_report_pair(raw, report_time="T0", duplicates="rows").collect()
        apart = [
            quality_report(df, name, "T0", duplicates="rows").first()
            for df, name in ((raw, "raw_data"), (clean_transactions(raw), "cleaned_data"))
        ]
        assert shown(pair) == shown(apart)
