"""The physical plans that make the operators hold at scale."""

import re

import pytest

from tallyglass.operators import analytics, cleaning, duplicates, profiling
from tallyglass.operators.profile_state import Measured, table_states
from tallyglass.plans.report import PairMeasures, quality_report, quality_report_pair

import __spark_entry__ as registry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    names = ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields")
    for name in names:
        spark.conf.set(name, "10000")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory, sf_dir):
    path = str(tmp_path_factory.mktemp("plans") / "tx")
    registry._tx(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def read_columns(plan):
    return [set(re.findall(r"(\w+):\w+", s)) for s in re.findall(r"ReadSchema: struct<(.*)>", plan)]


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_risk_reads_six_columns_and_pushes_filters(table):
    plan = plan_of(analytics.location_risk(cleaning.clean_transactions(table)))
    assert read_columns(plan) == [
        {"timestamp", "receiving_address", "amount", "transaction_type", "location_region", "risk_score"}
    ]
    assert "IsNotNull(timestamp)" in plan and "GreaterThan(amount,0.0)" in plan
    assert plan.count("HashAggregate") == 2 and exchanges(plan) == ["rangepartitioning", "hashpartitioning"]


def test_latest_sale_limits_groups_before_the_shuffle(table):
    plan = plan_of(analytics.top_sale_addresses(cleaning.clean_transactions(table)))
    partial, final = plan.index("Partial"), plan.index("Final")
    shuffle = plan.index("Exchange hashpartitioning")
    assert final < shuffle < partial  # printed from the result down
    assert "TakeOrderedAndProject(limit=3" in plan
    assert "EqualTo(transaction_type,sale)" in plan
    assert "sending_address" not in read_columns(plan)[0]
    assert exchanges(plan) == ["hashpartitioning"]


def test_metrics_are_one_scan_and_one_aggregate(table):
    rules = profiling.transaction_anomaly_rules()
    plan = plan_of(profiling.table_metrics(table, anomaly_rules=rules))
    assert plan.count("FileScan") == 1
    assert plan.count("HashAggregate") == 2 and exchanges(plan) == ["SinglePartition"]


def test_statistics_and_counts_read_only_what_they_need(table):
    assert read_columns(plan_of(profiling.numeric_stats(table))) == [
        {"timestamp", "amount", "ip_prefix", "login_frequency", "session_duration"}
    ]
    assert read_columns(plan_of(profiling.anomaly_checks(table))) == [{"timestamp", "amount"}]
    assert "ReadSchema: struct<>" in plan_of(profiling.basic_metrics(table))
    assert "ReadSchema: struct<>" in plan_of(profiling.type_distribution(table))
    assert len(read_columns(plan_of(cleaning.clean_audit(table)))[0]) == 5


def test_wide_split_reads_each_column_once(table):
    plan = plan_of(profiling.table_metrics(table, statistics=False, columns_per_aggregate=5))
    scans = read_columns(plan)
    assert len(scans) == 3 and sum(map(len, scans)) == 13 and len(set.union(*scans)) == 13


def test_copies_collapse_before_the_shuffle(table):
    plan = plan_of(duplicates.duplicate_profile(table, method="rows"))
    assert exchanges(plan) == ["SinglePartition", "hashpartitioning"]
    assert plan.index("Exchange hashpartitioning") < plan.rindex("HashAggregate")


def test_hash_lookup_sends_short_lists_and_sorts_long_ones(spark, table, tmp_path):
    hashed = duplicates.with_hash(table, "h")
    hashed.select("h").distinct().write.parquet(f"{tmp_path}/listing")
    listing = spark.read.parquet(f"{tmp_path}/listing")
    compared = plan_of(duplicates.rows_with(hashed, listing, "h"))
    assert "BroadcastHashJoin" in compared and "hashpartitioning" not in compared
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        compared = plan_of(duplicates.rows_with(hashed, listing, "h"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in compared and "LeftSemi" in compared and "Broadcast" not in compared


def test_pair_of_reports_measures_in_one_scan(table, spark):
    plan = plan_of(quality_report_pair(table, report_time="T0", duplicates="rows"))
    assert plan.count("FileScan") == 2  # measures of both tables; identical rows of both
    measures = PairMeasures.of(table)
    states = table_states(measures.both.rows, measures.measured, measures.both.survives)
    plan = plan_of(measures.of_tables(states))
    assert plan.count("FileScan") == 1 and exchanges(plan) == ["SinglePartition", "hashpartitioning"]


def test_measures_of_many_tasks_are_merged_in_two_steps(table):
    fields = [(f.name, f.dataType) for f in table.schema]
    plan = plan_of(table_states(table, {"state": Measured(fields)}, most_partial_rows=0))
    assert plan.count("FileScan") == 1 and exchanges(plan) == ["SinglePartition", "hashpartitioning"]


def test_report_is_two_scans(table):
    assert plan_of(quality_report(table, "t", "T0", duplicates="rows")).count("FileScan") == 2


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if not re.match(r"full_run|op\d+_|pipeline", n)))
def test_no_query_leaves_the_engine_or_crosses_tables(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert bad not in plan
