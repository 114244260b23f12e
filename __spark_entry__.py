"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import contextlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass import fixed_values as fixed
from tallyglass.fixtures import dirty_transactions
from tallyglass.operators import analytics, cleaning, duplicates, profiling, quality, quarantine
from tallyglass.plans.report import quality_report, quality_report_pair, report_details
from tallyglass.plans.run import EXPECTED_RESULTS, RunOptions, RunResult, full_run
from tallyglass.schema import MALFORMED, TXN_SCHEMA
from tallyglass.session import input_bytes, prepare, shared_folder
from tallyglass.sources import publication, results
from tallyglass.sources.transactions import land, land_clustered, load_transactions
from tallyglass.streaming.scheduled import INPUT_FILE, RunState, scheduled_run

# The library works without that subpackage; a library that it lacks is no reason to go on.
try:
    has_corpus = all(map(importlib.util.find_spec, ("tallyglass.llm.queries", "corpus_pipeline")))
except ModuleNotFoundError:  # not even the package
    has_corpus = False
if has_corpus:
    import corpus_pipeline
    from tallyglass.llm import queries as corpus
else:
    corpus = corpus_pipeline = None

REPORT_TIME = "2024-01-01T00:00:00.000000"
CAST_COLUMNS = ("timestamp", "login_frequency", "session_duration", "age_group", "risk_score")
BAD_AMOUNT = "login_frequency = 8 AND session_duration % 7 = 0"
BAD_TIME = "login_frequency = 3 AND session_duration % 9 = 0"


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship query: mean risk per region of the cleaned transactions."""
    return queries()["location_risk_rounded"](spark, sf_dir)


# --------------------------------------------------------------------- inputs


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = dirty_transactions(prepare(spark), sf_dir)
    prepare(spark, input_bytes(tx))
    return tx


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_transactions(_tx(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    prepare(spark, input_bytes(df))
    return df


def _reports(spark: SparkSession, sf_dir: str, statistics: bool = False) -> DataFrame:
    return quality_report_pair(_tx(spark, sf_dir), report_time=REPORT_TIME, statistics=statistics)


def _reports_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports, each from scans of its own."""
    raw = _tx(spark, sf_dir)
    raw_report, cleaned_report = (
        quality_report(df, name, REPORT_TIME)
        for df, name in ((raw, fixed.RAW_TABLE), (cleaning.clean_transactions(raw), fixed.CLEANED_TABLE))
    )
    return raw_report.unionByName(cleaned_report)


def _six_digits(risk: DataFrame) -> DataFrame:
    return risk.withColumn("avg_risk_score", F.round("avg_risk_score", 6))


def _stable(stats: DataFrame) -> DataFrame:
    """Means and deviations depend on the order of addition in the last digits."""
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


# -------------------------------------------------------------------- queries


def _on_tx(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(_tx(spark, sf_dir))


def _on_cleaned(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(_cleaned(spark, sf_dir))


def _on_reports(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(_reports(spark, sf_dir))


def _on_table(name: str, operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, name))


def _csv_scan(schema):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark)
        results.write_csv(_tx(spark, sf_dir), path)
        return load_transactions(spark, path, schema=schema)

    return query


def _roundtrip(result_format: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = _cleaned(spark, sf_dir)
        root = shared_folder(spark)
        results.write_result(cleaned, root, "cleaned", formats=[result_format])
        return results.read_result(spark, root, "cleaned", result_format, cleaned.schema)

    return query


def _write_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result read back from each format it was written in."""
    root = shared_folder(spark)
    risk = analytics.location_risk(_cleaned(spark, sf_dir), drop_nan=True)
    results.write_result(
        risk, root, fixed.RISK_RESULT, rounded={"avg_risk_score": fixed.RISK_DIGITS}
    )
    parts = [
        results.read_result(spark, root, fixed.RISK_RESULT, f, risk.schema).select(
            F.lit(f).alias("format"),
            "location_region",
            F.round("avg_risk_score", 6).alias("avg_risk_score"),
        )
        for f in results.FORMATS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """The records as CSV with cells that are no number."""
    path = shared_folder(spark)
    dirty = _tx(spark, sf_dir).withColumns(
        {
            "amount": F.expr(f"IF({BAD_AMOUNT}, 'abc', CAST(amount AS STRING))"),
            "timestamp": F.expr(f"IF({BAD_TIME}, 'not_a_time', CAST(`timestamp` AS STRING))"),
        }
    )
    results.write_csv(dirty, path)
    return path


def _dirty_csv_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_transactions(load_transactions(spark, _dirty_csv(spark, sf_dir), schema=None))


def _dirty_csv_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = load_transactions(spark, _dirty_csv(spark, sf_dir), keep_malformed=True)
    return cleaning.clean_audit(declared)


def _judged(result: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return result(quarantine.judged(quarantine.text_records(spark, _dirty_csv(spark, sf_dir))))

    return query


def _with_problems(records: DataFrame) -> DataFrame:
    """Text columns, and the problems as text."""
    shown = F.array_join(F.transform("problems", lambda p: F.concat_ws(":", p["column"], p["reason"])), ",")
    return records.select("sending_address", "transaction_type", "purchase_pattern", "risk_score", shown.alias("problems"))


def _csv_roundtrip_of(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df, root = _table(spark, sf_dir, name), shared_folder(spark)
        results.write_result(df, root, name, formats=["csv"])
        return results.read_result(spark, root, name, "csv", df.schema)

    return query


def _quality_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    results.write_quality_report(_reports(spark, sf_dir, statistics=True), root)
    return results.read_quality_report(spark, root).select(
        "table_name",
        F.col("timestamp").alias("report_time"),
        "basic_metrics.total_records",
        "basic_metrics.total_columns",
        "null_analysis.columns_with_nulls",
        "duplicate_analysis.duplicate_count",
        F.size("statistical_analysis.statistics").alias("numeric_columns"),
        F.size("anomalies").alias("anomaly_types"),
        "quality_score",
    )


def _quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(_reports(spark, sf_dir))


def _execution_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.execution_report(_reports(spark, sf_dir), REPORT_TIME)
    return report.select(
        "execution_date",
        "job_id",
        "status",
        F.array_join("tasks_completed", ",").alias("tasks_completed"),
        F.col("quality_summary.quality_score").alias("quality_score"),
        F.col("quality_summary.total_records").alias("total_records"),
    )


def _results_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    cleaned = _cleaned(spark, sf_dir)
    results.write_result(
        analytics.location_risk(cleaned, drop_nan=True), root, fixed.RISK_RESULT, ["parquet"]
    )
    results.write_result(
        analytics.top_sale_addresses(cleaned), root, fixed.SALES_RESULT, ["parquet"]
    )
    return results.results_present(spark, root, EXPECTED_RESULTS)


def _full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture to CSV, the whole run over it, then everything the run returned as
    rows (section, table_name, item, measure, value)."""
    root = shared_folder(spark)
    source = f"{root}/input"
    results.write_csv(_tx(spark, sf_dir), source)
    return _run_rows(full_run(spark, source, f"{root}/results", RunOptions(report_time=REPORT_TIME)))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published runs, of all records and of those of one type, and a third that dies: what the
    manifest tells of the second, read back and verified (result, rows, intact, value)."""
    root = shared_folder(spark)
    cleaned = land(_cleaned(spark, sf_dir), f"{root}/cleaned_parquet")

    def write(folder: str, rows: DataFrame, whole: bool = True) -> None:
        results.write_result(analytics.location_risk(rows, drop_nan=True), folder, fixed.RISK_RESULT)
        if not whole:
            raise InterruptedError
        results.write_result(analytics.top_sale_addresses(rows), folder, fixed.SALES_RESULT)

    publication.publish(spark, root, lambda folder: write(folder, cleaned))
    publication.publish(spark, root, lambda folder: write(folder, analytics.filter_sales(cleaned)))
    with contextlib.suppress(InterruptedError):
        publication.publish(spark, root, lambda folder: write(folder, cleaned, whole=False))
    publication.remove_superseded(spark, root, keep=1)
    sums = None
    for name, value in ((fixed.RISK_RESULT, "avg_risk_score"), (fixed.SALES_RESULT, "amount")):
        read = publication.read_published(spark, root, name)
        part = read.agg(F.round(F.sum(value), 4).alias("value")).withColumn("result", F.lit(name))
        sums = part if sums is None else sums.unionByName(part)
    tables = publication.published_tables(spark, root).join(publication.verified(spark, root), "table_name")
    parquet = tables.filter("table_name LIKE '%_parquet'").withColumn("result", F.expr("replace(table_name, '_parquet')"))
    return parquet.join(sums, "result").select("result", "rows", "intact", "value")


def _top_sales_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a landed table of which scans for sales read little else."""
    landed = land_clustered(_tx(spark, sf_dir), f"{shared_folder(spark)}/clustered")
    return analytics.top_sale_addresses(cleaning.clean_transactions(landed))


def _in_three(spark: SparkSession, sf_dir: str, start: Callable[[str, int], None]) -> None:
    """The records as CSV files that arrive in three steps; ``start`` is called after each."""
    folder = shared_folder(spark)
    numbered = land(_tx(spark, sf_dir).withColumn("number", F.monotonically_increasing_id()), f"{folder}/all")
    for step in range(3):
        results.write_csv(numbered.filter(f"number % 3 = {step}").drop("number"), f"{folder}/in/part-{step}")
        start(f"{folder}/in/*", step)


def _scheduled_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``_full_run``, from three starts of which each reads new files only."""
    root, runs = shared_folder(spark), []
    options = RunOptions(report_time=REPORT_TIME)
    _in_three(spark, sf_dir, lambda source, _: runs.append(scheduled_run(spark, source, root, options)))
    return _run_rows(runs[-1])


def _from_parts(result: Callable[[RunState, SparkSession], DataFrame]):
    """A result from the states of three batches, the second of which comes twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_folder(spark)
        state = RunState(f"{folder}/out", RunOptions(drop_nan=True))
        numbered = land(_tx(spark, sf_dir).withColumn("number", F.monotonically_increasing_id()), f"{folder}/all")
        for batch in (0, 1, 1, 2):
            rows = numbered.filter(f"number % 3 = {batch}").drop("number")
            state.add(rows.withColumns({c: F.lit(None).cast("string") for c in (MALFORMED, INPUT_FILE)}), batch)
        return result(state, spark)

    return query


def _duplicates_of_state(state: RunState, spark: SparkSession) -> DataFrame:
    """Those of the raw table."""
    return state.reports(spark).filter(f"table_name = '{fixed.RAW_TABLE}'").select("duplicate_analysis.*")


def _run_rows(run: RunResult) -> DataFrame:
    audit = ("initial_records", "removed_malformed", "removed_null_critical", "removed_non_positive_amount", "final_records")
    parts = [
        (report_details(run.reports), "section", "table_name", "item", {"": ("measure", "value")}),
        (run.audit, "'audit'", "'raw_data'", "'table'", {m: (f"'{m}'", m) for m in audit}),
        (run.location_risk, "'location_risk'", "'cleaned_data'", "location_region", {"": ("'avg_risk_score'", "avg_risk_score")}),
        (run.top_sales, "'top_sales'", "'cleaned_data'", "receiving_address", {m: (f"'{m}'", m) for m in ("amount", "`timestamp`")}),
        (run.present, "'present'", "result", "'rows'", {"": ("IF(present AND columns_ok, 'whole', 'broken')", "rows")}),
        (run.gate, "'gate'", "table_name", "'table'", {"": ("IF(passed, 'passed', 'failed')", "quality_score")}),
        (run.alerts, "'alerts'", "table_name", "rule", {"": ("message", "1")}),
        (run.rules, "'rules'", "table_name", "coalesce(`column`, 'table')", {"": ("rule", "CAST(breached AS INT)")}),
    ]
    rows = None
    for df, section, table, item, measures in parts:
        for measure, value in measures.values():
            part = df.selectExpr(
                f"{section} AS section",
                f"{table} AS table_name",
                f"{item} AS item",
                f"{measure} AS measure".replace("`", ""),
                f"round(CAST({value} AS DOUBLE), 4) AS value",
            )
            rows = part if rows is None else rows.unionByName(part)
    return rows


def _details(reports: DataFrame) -> DataFrame:
    return report_details(reports).select(
        "table_name", "section", "item", "measure", F.round("value", 4).alias("value")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir)."""
    rounded_risk = lambda df: analytics.location_risk_rounded(df, drop_nan=True)
    by_hash = lambda df: duplicates.duplicate_profile(df, method="hash")
    return {
        **(corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {}),
        # sources and sinks
        "csv_scan_inferred": _csv_scan(None),
        "csv_scan_declared": _csv_scan(TXN_SCHEMA),
        "basic_metrics": _on_tx(profiling.basic_metrics),
        "schema_profile": _on_tx(profiling.schema_profile),
        "parquet_roundtrip": _roundtrip("parquet"),
        "csv_roundtrip": _roundtrip("csv"),
        "csv_roundtrip_documents": _csv_roundtrip_of("documents"),
        "csv_roundtrip_pages": _csv_roundtrip_of("pages"),
        "csv_roundtrip_conversations": _csv_roundtrip_of("conversations"),
        "dirty_csv_cleaned": _dirty_csv_cleaned,
        "dirty_csv_audit": _dirty_csv_audit,
        "rejected_rows": _judged(lambda records: _with_problems(quarantine.rejected_records(records))),
        "kept_rows": _judged(lambda records: _with_problems(quarantine.kept_records(records))),
        "problem_counts": _judged(quarantine.problem_counts),
        "json_roundtrip": _roundtrip("json"),
        "write_results": _write_results,
        "quality_report_json": _quality_report_json,
        "quality_summary": _quality_summary,
        # projections and filters
        "cast_to_string": _on_tx(lambda df: cleaning.cast_to_string(df, CAST_COLUMNS)),
        "sentinel_to_null": _on_tx(cleaning.sentinel_to_null),
        "risk_to_double": _on_tx(cleaning.risk_to_double),
        "add_readable_ts": _on_tx(cleaning.add_readable_ts),
        "project_result": _on_cleaned(lambda df: df.select(*fixed.SALES_RESULT_COLUMNS)),
        "filter_critical_not_null": _on_tx(cleaning.filter_critical_not_null),
        "filter_positive_amount": _on_tx(cleaning.filter_positive_amount),
        "filter_sales": _on_tx(analytics.filter_sales),
        "filter_valid_risk": _on_cleaned(analytics.filter_valid_risk),
        "null_or_nan": _on_tx(profiling.missing_flags),
        "anomaly_predicates": _on_tx(
            lambda df: profiling.anomalous_rows(df, ("timestamp", "receiving_address", "amount"))
        ),
        "clean_transactions": _on_tx(cleaning.clean_transactions),
        # aggregations, window, top-k, distinct
        "clean_audit": _on_tx(cleaning.clean_audit),
        "location_risk": _on_cleaned(lambda df: _six_digits(analytics.location_risk(df))),
        "location_risk_drop_nan": _on_cleaned(
            lambda df: _six_digits(analytics.location_risk(df, drop_nan=True))
        ),
        "location_risk_rounded": _on_cleaned(rounded_risk),
        "latest_sale_per_address": _on_cleaned(analytics.latest_sale_per_address),
        "top_sale_addresses": _on_cleaned(analytics.top_sale_addresses),
        "distinct_rows": _on_tx(duplicates.distinct_rows),
        # profile
        "null_profile": _on_tx(profiling.null_profile),
        "columns_with_nulls": _on_tx(profiling.columns_with_nulls),
        "duplicate_profile": _on_tx(duplicates.duplicate_profile),
        "duplicate_profile_hash": _on_tx(by_hash),
        "numeric_stats": _on_tx(lambda df: _stable(profiling.numeric_stats(df))),
        "type_distribution": _on_tx(profiling.type_distribution),
        "anomaly_checks": _on_tx(profiling.anomaly_checks),
        # the same profile over other tables
        "null_profile_documents": _on_table("documents", profiling.null_profile),
        "duplicate_profile_documents": _on_table("documents", duplicates.duplicate_profile),
        "duplicate_profile_hash_documents": _on_table("documents", by_hash),
        "null_profile_lineitem": _on_table("lineitem", profiling.null_profile),
        "numeric_stats_lineitem": _on_table(
            "lineitem", lambda df: _stable(profiling.numeric_stats(df))
        ),
        "duplicate_profile_lineitem": _on_table("lineitem", duplicates.duplicate_profile),
        "duplicate_profile_hash_lineitem": _on_table("lineitem", by_hash),
        "null_profile_conversations": _on_table("conversations", profiling.null_profile),
        "duplicate_profile_conversations": _on_table("conversations", duplicates.duplicate_profile),
        "null_profile_pages": _on_table("pages", profiling.null_profile),
        "duplicate_profile_hash_embeddings": _on_table("embeddings", by_hash),
        "numeric_stats_orders": _on_table(
            "orders", lambda df: _stable(profiling.numeric_stats(df))
        ),
        "numeric_stats_customer": _on_table(
            "customer", lambda df: _stable(profiling.numeric_stats(df))
        ),
        # quality
        "quality_score": _on_reports(quality.quality_score),
        "quality_band": _on_reports(quality.quality_band),
        "quality_alerts": _on_reports(quality.quality_alerts),
        "quality_gate": _on_reports(quality.quality_gate),
        "threshold_rules": _on_reports(quality.threshold_rules),
        "quality_report": lambda spark, sf_dir: _details(_reports_apart(spark, sf_dir)),
        "quality_report_pair": lambda spark, sf_dir: _details(_reports(spark, sf_dir, statistics=True)),
        "quality_report_details": lambda spark, sf_dir: _details(_reports(spark, sf_dir, statistics=True)),
        "execution_report": _execution_report,
        "results_present": _results_present,
        "full_run": _full_run,
        "published_results": _published,
        "top_sale_addresses_clustered": _top_sales_clustered,
        # scheduled runs
        "scheduled_run": _scheduled_run,
        "latest_sale_incremental": _from_parts(lambda state, spark: state.latest_sales(spark)),
        "location_risk_incremental": _from_parts(lambda state, spark: _six_digits(state.location_risk(spark))),
        "duplicate_profile_incremental": _from_parts(_duplicates_of_state),
        "clean_audit_incremental": _from_parts(lambda state, spark: state.clean_audit(spark)),
    }


# ----------------------------------------------------------------- oracle SQL

_TX = """
located AS (
  SELECT e.event_id, e.user_id, e.event_type, e.value, r.r_name,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS ep
  FROM events e
  JOIN nation n ON n.n_nationkey = e.user_id % 25
  JOIN region r ON r.r_regionkey = n.n_regionkey
), tx_once AS (
  SELECT event_id,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 71 = 0 THEN ep - 400000000
         WHEN event_id % 73 = 0 THEN ep + 100000000 ELSE ep END AS "timestamp",
    's' || user_id AS sending_address,
    CASE WHEN event_id % 59 = 0 THEN NULL ELSE 'r' || ((event_id * 7) % 97) END AS receiving_address,
    CASE WHEN event_id % 23 = 0 THEN -value WHEN event_id % 29 = 0 THEN 0.0
         WHEN event_id % 61 = 0 THEN NULL ELSE value END AS amount,
    CASE WHEN event_type = 'purchase' THEN 'sale' ELSE event_type END AS transaction_type,
    r_name AS location_region,
    CAST(172 + event_id % 21 AS DOUBLE) AS ip_prefix,
    CAST(1 + event_id % 8 AS INTEGER) AS login_frequency,
    CAST(20 + event_id % 140 AS INTEGER) AS session_duration,
    CASE event_id % 3 WHEN 0 THEN 'focused' WHEN 1 THEN 'random' ELSE 'high_value' END AS purchase_pattern,
    CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'veteran' END AS age_group,
    CASE WHEN event_id % 17 = 0 THEN 'none' WHEN event_id % 101 = 0 THEN 'bad'
         WHEN event_id % 211 = 0 AND r_name = 'ASIA' THEN 'NaN' ELSE ((event_id * 13) % 100) || '.25' END AS risk_score,
    CASE WHEN event_id % 5 = 0 THEN 'high_risk' ELSE 'low_risk' END AS anomaly
  FROM located
), tx AS (
  SELECT * EXCLUDE (event_id) FROM (
    SELECT * FROM tx_once
    UNION ALL SELECT * FROM tx_once WHERE event_id % 50 = 0
    UNION ALL SELECT * REPLACE (amount + 1.0 AS amount) FROM tx_once WHERE event_id % 70 = 0)
)"""

_CLEAN = """
clean AS (
  SELECT * REPLACE (TRY_CAST(NULLIF(risk_score, 'none') AS DOUBLE) AS risk_score),
         strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d %H:%M:%S') AS timestamp_readable
  FROM tx
  WHERE "timestamp" IS NOT NULL AND receiving_address IS NOT NULL AND amount IS NOT NULL
    AND transaction_type IS NOT NULL AND location_region IS NOT NULL AND amount > 0
)"""

_TYPES = {f.name: f.dataType.simpleString() for f in TXN_SCHEMA}
_CLEAN_TYPES = {**_TYPES, "risk_score": "double", "timestamp_readable": "string"}
_LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
_DOCUMENT_TYPES = {
    "doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint",
}
_CONVERSATION_TYPES = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
_PAGE_TYPES = {"page_id": "bigint", "url": "string", "html": "string"}


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _missing_sql(column: str, dtype: str) -> str:
    if dtype == "double":
        return f'("{column}" IS NULL OR isnan("{column}"))'
    if dtype == "string":
        return f'("{column}" IS NULL OR coalesce(isnan(TRY_CAST("{column}" AS DOUBLE)), false))'
    return f'("{column}" IS NULL)'


def _percent_sql(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN CAST(printf('%.2f', {part} / {total} * 100) AS DOUBLE) ELSE 0.0 END"


def _nulls_sql(table: str, types: dict[str, str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS total, "
        f"count(*) FILTER (WHERE {_missing_sql(c, t)}) AS null_count FROM {table}"
        for c, t in types.items()
    )
    return (
        f'SELECT "column", null_count, {_percent_sql("null_count", "total")} AS null_percentage '
        f"FROM ({counts})"
    )


def _duplicates_sql(table: str) -> str:
    return (
        "SELECT total_records, unique_records, total_records - unique_records AS duplicate_count, "
        f"{_percent_sql('(total_records - unique_records)', 'total_records')} AS duplicate_percentage "
        f"FROM (SELECT (SELECT count(*) FROM {table}) AS total_records, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS unique_records)"
    )


def _stats_sql(table: str, types: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(\"{c}\") AS \"count\", "
        f'round(avg("{c}"), 4) AS mean, round(stddev_samp("{c}"), 4) AS stddev, '
        f'CAST(min("{c}") AS DOUBLE) AS "min", CAST(max("{c}") AS DOUBLE) AS "max" FROM {table}'
        for c, t in types.items()
        if t in ("double", "int", "bigint")
    )


_OLD, _FUTURE = 1383282474, 1730178474


def _anomalies_sql(table: str) -> str:
    checks = (
        ("negative_values", "amount", "amount < 0", fixed.NEGATIVE_VALUES_TEXT),
        ("old_timestamps", "timestamp", f'"timestamp" < {_OLD}', fixed.OLD_TIMESTAMPS_TEXT),
        ("future_timestamps", "timestamp", f'"timestamp" > {_FUTURE}', fixed.FUTURE_TIMESTAMPS_TEXT),
    )
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS \"type\", '{column}' AS \"column\", count(*) AS \"count\", "
        f"'{text}' AS description FROM {table} WHERE {condition} HAVING count(*) > 0"
        for kind, column, condition, text in checks
    )


def _measures_cte(name: str, table: str, types: dict[str, str]) -> str:
    return (
        f"nulls_{table} AS ({_nulls_sql(table, types)}), "
        f"copies_{table} AS ({_duplicates_sql(table)}), "
        f"odd_{table} AS ({_anomalies_sql(table)}), "
        f"measures_{table} AS (SELECT '{name}' AS table_name, "
        f"CAST((SELECT count(*) FROM nulls_{table} WHERE null_count > 0) AS INTEGER) AS columns_with_nulls, "
        f"duplicate_percentage, duplicate_count, total_records, {len(types)} AS total_columns, "
        f"CAST((SELECT count(*) FROM odd_{table}) AS INTEGER) AS anomaly_types FROM copies_{table})"
    )


_SCORE = """
scored AS (
  SELECT *, greatest(0.0, CAST(printf('%.2f', 100.0 - least(20, columns_with_nulls * 5)
         - least(30.0, duplicate_percentage) - least(20, anomaly_types * 10)) AS DOUBLE)) AS quality_score
  FROM (SELECT * FROM measures_tx UNION ALL SELECT * FROM measures_clean)
)"""


def _scored() -> str:
    return _with(
        _TX,
        _CLEAN,
        _measures_cte(fixed.RAW_TABLE, "tx", _TYPES),
        _measures_cte(fixed.CLEANED_TABLE, "clean", _CLEAN_TYPES),
        _SCORE,
    )


def _details_sql() -> str:
    parts = []
    for name, table, types in (
        (fixed.RAW_TABLE, "tx", _TYPES),
        (fixed.CLEANED_TABLE, "clean", _CLEAN_TYPES),
    ):
        def rows(section, item, source, measures, name=name):
            for measure in measures:
                parts.append(
                    f"SELECT '{name}' AS table_name, '{section}' AS section, {item} AS item, "
                    f"'{measure}' AS measure, CAST(\"{measure}\" AS DOUBLE) AS value FROM {source}"
                )

        rows("nulls", '"column"', f"nulls_{table}", ("null_count", "null_percentage"))
        rows(
            "duplicates",
            "'rows'",
            f"copies_{table}",
            ("total_records", "unique_records", "duplicate_count", "duplicate_percentage"),
        )
        rows(
            "statistics",
            '"column"',
            f"({_stats_sql(table, types)})",
            ("count", "mean", "stddev", "min", "max"),
        )
        rows("anomalies", '"type"', f"odd_{table}", ("count",))
        rows(
            "overall",
            "'table'",
            f"(SELECT * FROM scored WHERE table_name = '{name}')",
            ("total_columns", "columns_with_nulls", "quality_score"),
        )
    return (
        f"{_scored()} SELECT table_name, section, item, measure, round(value, 4) AS value "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


_RISK = (
    "SELECT location_region, avg(risk_score) AS avg_risk_score FROM clean "
    "WHERE risk_score IS NOT NULL AND NOT isnan(risk_score) GROUP BY location_region"
)
_RISK_NAN = (
    "SELECT location_region, avg(risk_score) AS avg_risk_score FROM clean "
    "WHERE risk_score IS NOT NULL GROUP BY location_region"
)
_SALES_AND = "WHERE transaction_type = 'sale' AND"
_BAD = f"coalesce({BAD_AMOUNT}, false) OR coalesce({BAD_TIME}, false)"
_DIRTY = f"""
dirty AS (
  SELECT * REPLACE (CASE WHEN {BAD_AMOUNT} THEN NULL ELSE amount END AS amount,
                    CASE WHEN {BAD_TIME} THEN NULL ELSE "timestamp" END AS "timestamp")
  FROM tx
)"""
# Every record with the problems of its cells, in the order of the columns.
_JUDGED = f"""
judged AS (
  SELECT *, problems[1] IS NOT NULL AND len(list_filter(problems, lambda p: NOT starts_with(p, 'risk_score'))) > 0 AS rejected
  FROM (SELECT *, list_filter([
      CASE WHEN coalesce({BAD_TIME}, false) THEN 'timestamp:malformed' WHEN "timestamp" IS NULL THEN 'timestamp:missing' END,
      CASE WHEN receiving_address IS NULL THEN 'receiving_address:missing' END,
      CASE WHEN coalesce({BAD_AMOUNT}, false) THEN 'amount:malformed' WHEN amount IS NULL THEN 'amount:missing'
           WHEN NOT amount > 0 THEN 'amount:not_positive' END,
      CASE WHEN transaction_type IS NULL THEN 'transaction_type:missing' END,
      CASE WHEN location_region IS NULL THEN 'location_region:missing' END,
      CASE WHEN risk_score = 'bad' THEN 'risk_score:malformed' END], lambda p: p IS NOT NULL) AS problems FROM tx)
)"""
_PROBLEM_ROWS = (
    "SELECT sending_address, transaction_type, purchase_pattern, risk_score, array_to_string(problems, ',') AS problems FROM judged"
)
_LATEST = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY receiving_address "
    'ORDER BY "timestamp" DESC, amount DESC, sending_address, ip_prefix, login_frequency, session_duration, '
    "purchase_pattern, age_group, risk_score, anomaly, timestamp_readable) AS rn "
    "FROM clean WHERE transaction_type = 'sale') WHERE rn = 1"
)


def _full_run_sql(present: str) -> str:
    def rows(section, table, item, measure, value, source):
        return (
            f"SELECT '{section}' AS section, {table} AS table_name, {item} AS item, {measure} AS measure, "
            f"round(CAST({value} AS DOUBLE), 4) AS value FROM {source}"
        )

    details = _details_sql().removeprefix(_scored())
    clean, sales = f"'{fixed.CLEANED_TABLE}'", f"({_LATEST} ORDER BY amount DESC, receiving_address LIMIT 3)"
    dropped = {
        "initial_records": "true",
        "removed_malformed": "false",
        "removed_null_critical": f"NOT ({present})",
        "removed_non_positive_amount": f"({present}) AND NOT amount > 0",
        "final_records": f"({present}) AND amount > 0",
    }
    parts = [f"SELECT section, table_name, item, measure, value FROM ({details})"]
    parts += [
        rows("audit", f"'{fixed.RAW_TABLE}'", "'table'", f"'{m}'", f"count(*) FILTER (WHERE {c})", "tx")
        for m, c in dropped.items()
    ]
    parts.append(rows("location_risk", clean, "location_region", "'avg_risk_score'", "avg_risk_score", f"({_RISK_NAN})"))
    parts += [rows("top_sales", clean, "receiving_address", f"'{m}'", f'"{m}"', sales) for m in ("amount", "timestamp")]
    parts += [
        rows("present", f"'{name}'", "'rows'", "'whole'", n, f"({source})")
        for name, n, source in (
            (fixed.RISK_RESULT, "count(*)", _RISK_NAN),
            (fixed.SALES_RESULT, "least(3, count(*))", _LATEST),
        )
    ]
    passed = "CASE WHEN quality_score >= 70 THEN 'passed' ELSE 'failed' END"
    parts.append(rows("gate", "table_name", "'table'", passed, "quality_score", f"(SELECT * FROM scored WHERE table_name = {clean})"))
    parts.append(rows("alerts", "table_name", "rule", "message", "1", f"({_alerts_sql()})"))
    parts.append(rows("rules", "table_name", "coalesce(\"column\", 'table')", "rule", "CAST(breached AS INTEGER)", f"({_rules_sql()})"))
    return f"{_scored()} {' UNION ALL '.join(parts)}"


def _alerts_sql() -> str:
    def branch(rule, text, value, condition):
        before, after = text
        return (
            f"SELECT table_name, '{rule}' AS rule, '{before}' || {value} || '{after}' AS message "
            f"FROM scored WHERE {condition}"
        )

    return " UNION ALL ".join(
        (
            branch("low_score", fixed.ALERT_SCORE_TEXT, "CAST(quality_score AS VARCHAR)", "quality_score < 80"),
            branch("null_columns", fixed.ALERT_NULLS_TEXT, "columns_with_nulls", "columns_with_nulls > 0"),
            branch(
                "duplicates",
                fixed.ALERT_DUPLICATES_TEXT,
                "printf('%.1f', duplicate_percentage)",
                "duplicate_percentage > 5",
            ),
            branch("anomalies", fixed.ALERT_ANOMALIES_TEXT, "anomaly_types", "anomaly_types > 0"),
        )
    )


def _rules_sql() -> str:
    columns = ", ".join(f"'{c}'" for c in fixed.RULE_COLUMNS)
    per_column = " UNION ALL ".join(
        f"SELECT '{name}', 'max_null_percentage', \"column\", null_percentage, 10.0, "
        f'null_percentage > 10.0 FROM nulls_{table} WHERE "column" IN ({columns})'
        for name, table in ((fixed.RAW_TABLE, "tx"), (fixed.CLEANED_TABLE, "clean"))
    )
    return (
        "SELECT table_name, 'min_quality_score' AS rule, CAST(NULL AS VARCHAR) AS \"column\", "
        "quality_score AS value, CAST(70.0 AS DOUBLE) AS \"limit\", quality_score < 70 AS breached FROM scored "
        "UNION ALL SELECT table_name, 'max_duplicate_percentage', NULL, duplicate_percentage, 5.0, "
        f"duplicate_percentage > 5 FROM scored UNION ALL {per_column}"
    )


def _summary_sql() -> str:
    lines = (
        f"'{fixed.SUMMARY_TITLE}'",
        f"'{fixed.SUMMARY_RULER}'",
        "''",
        f"'{fixed.SUMMARY_TIMESTAMP}{REPORT_TIME}'",
        f"'{fixed.SUMMARY_RECORDS}' || total_records",
        f"'{fixed.SUMMARY_COLUMNS}' || total_columns",
        f"'{fixed.SUMMARY_SCORE[0]}' || CAST(quality_score AS VARCHAR) || '{fixed.SUMMARY_SCORE[1]}'",
        "''",
        f"'{fixed.SUMMARY_NULL_COLUMNS}' || columns_with_nulls",
        f"'{fixed.SUMMARY_DUPLICATES}' || duplicate_count",
        f"'{fixed.SUMMARY_ANOMALIES}' || anomaly_types",
    )
    return " UNION ALL ".join(
        f"SELECT {number} AS line_number, {text} AS line FROM scored "
        f"WHERE table_name = '{fixed.CLEANED_TABLE}'"
        for number, text in enumerate(lines, start=1)
    )


def oracle_sql() -> dict[str, str]:
    """The DuckDB statement for every query that has flat results."""
    tx = _with(_TX)
    clean = _with(_TX, _CLEAN)
    scored = _scored()
    risk_rounded = (
        "SELECT location_region, round_even(avg_risk_score * 100, 0) / 100 AS avg_risk_score "
        f"FROM ({_RISK})"
    )
    types_sql = ", ".join(f"('{c}', '{t}')" for c, t in _TYPES.items())
    csv_rows = f'{tx} SELECT * REPLACE (CAST("timestamp" AS INTEGER) AS "timestamp") FROM tx'
    flags = ", ".join(f"{_missing_sql(c, t)} AS {c}_missing" for c, t in _TYPES.items())
    dirty_clean = _with(_TX, _DIRTY, _CLEAN.replace("FROM tx", "FROM dirty"))
    present = ' AND '.join(f'"{c}" IS NOT NULL' for c in fixed.CRITICAL_COLUMNS)
    oracle = {
        "csv_scan_inferred": csv_rows,
        "csv_scan_declared": f"{tx} SELECT * FROM tx",
        "basic_metrics": f"{tx} SELECT count(*) AS total_records, {len(_TYPES)} AS total_columns FROM tx",
        "schema_profile": (
            f'{tx} SELECT t.*, (SELECT count(*) FROM tx) AS total_records '
            f'FROM (VALUES {types_sql}) AS t("column", data_type)'
        ),
        "parquet_roundtrip": f"{clean} SELECT * FROM clean",
        "csv_roundtrip": f"{clean} SELECT * FROM clean",
        "json_roundtrip": f"{clean} SELECT * FROM clean",
        "write_results": (
            f"{clean} SELECT 'parquet' AS format, location_region, "
            f"round(avg_risk_score, 6) AS avg_risk_score FROM ({_RISK}) "
            f"UNION ALL SELECT 'csv', * FROM ({risk_rounded}) "
            f"UNION ALL SELECT 'json', * FROM ({risk_rounded})"
        ),
        "quality_report_json": (
            f"{scored} SELECT table_name, '{REPORT_TIME}' AS report_time, total_records, total_columns, "
            "columns_with_nulls, duplicate_count, "
            f"CASE table_name WHEN '{fixed.RAW_TABLE}' THEN 5 ELSE 6 END AS numeric_columns, "
            "anomaly_types, quality_score FROM scored"
        ),
        "quality_summary": f"{scored} {_summary_sql()}",
        "cast_to_string": (
            f"{tx} SELECT * REPLACE ("
            + ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in CAST_COLUMNS)
            + ") FROM tx"
        ),
        "sentinel_to_null": f"{tx} SELECT * REPLACE (NULLIF(risk_score, 'none') AS risk_score) FROM tx",
        "risk_to_double": (
            f"{tx} SELECT * REPLACE (TRY_CAST(NULLIF(risk_score, 'none') AS DOUBLE) AS risk_score) FROM tx"
        ),
        "add_readable_ts": (
            f"{tx} SELECT *, strftime(make_timestamp(\"timestamp\" * 1000000), '%Y-%m-%d %H:%M:%S') "
            "AS timestamp_readable FROM tx"
        ),
        "project_result": (
            f'{clean} SELECT receiving_address, amount, "timestamp", timestamp_readable FROM clean'
        ),
        "filter_critical_not_null": f"{tx} SELECT * FROM tx WHERE {present}",
        "filter_positive_amount": f"{tx} SELECT * FROM tx WHERE amount > 0",
        "filter_sales": f"{tx} SELECT * FROM tx WHERE transaction_type = 'sale'",
        "filter_valid_risk": f"{clean} SELECT * FROM clean WHERE risk_score IS NOT NULL",
        "null_or_nan": f"{tx} SELECT {flags} FROM tx",
        "anomaly_predicates": (
            f'{tx} SELECT * FROM (SELECT "timestamp", receiving_address, amount, '
            "coalesce(amount < 0, false) AS negative_values, "
            f'coalesce("timestamp" < {_OLD}, false) AS old_timestamps, '
            f'coalesce("timestamp" > {_FUTURE}, false) AS future_timestamps FROM tx) '
            "WHERE negative_values OR old_timestamps OR future_timestamps"
        ),
        "clean_transactions": f"{clean} SELECT * FROM clean",
        "clean_audit": (
            f"{tx} SELECT count(*) AS initial_records, "
            f"CAST(0 AS BIGINT) AS removed_malformed, count(*) FILTER (WHERE NOT ({present})) AS removed_null_critical, "
            f"count(*) FILTER (WHERE {present} AND amount <= 0) AS removed_non_positive_amount, "
            f"count(*) FILTER (WHERE {present} AND amount > 0) AS final_records FROM tx"
        ),
        "location_risk": (
            f"{clean} SELECT location_region, round(avg_risk_score, 6) AS avg_risk_score FROM ({_RISK_NAN})"
        ),
        "location_risk_drop_nan": (
            f"{clean} SELECT location_region, round(avg_risk_score, 6) AS avg_risk_score "
            f"FROM ({_RISK}) ORDER BY avg_risk_score DESC, location_region"
        ),
        "csv_roundtrip_documents": "SELECT * FROM documents",
        "csv_roundtrip_pages": "SELECT * FROM pages",
        "csv_roundtrip_conversations": "SELECT * FROM conversations",
        "dirty_csv_cleaned": (
            f'{dirty_clean} SELECT * REPLACE (CAST("timestamp" AS BIGINT) AS "timestamp") FROM clean'
        ),
        "dirty_csv_audit": (
            f"{_with(_TX, _DIRTY)} SELECT count(*) AS initial_records, "
            f"count(*) FILTER (WHERE NOT ({present}) AND ({_BAD})) AS removed_malformed, "
            f"count(*) FILTER (WHERE NOT ({present}) AND NOT ({_BAD})) AS removed_null_critical, "
            f"count(*) FILTER (WHERE ({present}) AND NOT amount > 0) AS removed_non_positive_amount, "
            f"count(*) FILTER (WHERE ({present}) AND amount > 0) AS final_records FROM dirty"
        ),
        "rejected_rows": f"{_with(_TX, _JUDGED)} {_PROBLEM_ROWS} WHERE rejected",
        "kept_rows": f"{_with(_TX, _JUDGED)} {_PROBLEM_ROWS} WHERE NOT rejected",
        "problem_counts": (
            f"{_with(_TX, _JUDGED)} SELECT split_part(p, ':', 1) AS \"column\", split_part(p, ':', 2) AS reason, "
            "NOT rejected AS kept, count(*) AS cells FROM (SELECT unnest(problems) AS p, rejected FROM judged) GROUP BY ALL"
        ),
        "location_risk_rounded": (
            f"{clean} {risk_rounded} ORDER BY avg_risk_score DESC, location_region"
        ),
        "latest_sale_per_address": f"{clean} {_LATEST}",
        "top_sale_addresses": (
            f'{clean} SELECT receiving_address, amount, "timestamp", timestamp_readable '
            f"FROM ({_LATEST}) ORDER BY amount DESC, receiving_address LIMIT 3"
        ),
        "distinct_rows": f"{tx} SELECT DISTINCT * FROM tx",
        "null_profile": f"{tx} {_nulls_sql('tx', _TYPES)}",
        "columns_with_nulls": (
            f"{tx} SELECT CAST(count(*) AS INTEGER) AS columns_with_nulls "
            f"FROM ({_nulls_sql('tx', _TYPES)}) WHERE null_count > 0"
        ),
        "duplicate_profile": f"{tx} {_duplicates_sql('tx')}",
        "duplicate_profile_hash": f"{tx} {_duplicates_sql('tx')}",
        "numeric_stats": f"{tx} {_stats_sql('tx', _TYPES)}",
        "type_distribution": (
            f'{tx} SELECT data_type, count(*) AS "columns", (SELECT count(*) FROM tx) AS total_records '
            f"FROM (VALUES {types_sql}) AS t(c, data_type) GROUP BY data_type"
        ),
        "anomaly_checks": f"{tx} {_anomalies_sql('tx')}",
        "null_profile_documents": _nulls_sql("documents", _DOCUMENT_TYPES),
        "duplicate_profile_documents": _duplicates_sql("documents"),
        "duplicate_profile_hash_documents": _duplicates_sql("documents"),
        "null_profile_lineitem": _nulls_sql("lineitem", _LINEITEM_TYPES),
        "numeric_stats_lineitem": _stats_sql("lineitem", _LINEITEM_TYPES),
        "duplicate_profile_lineitem": _duplicates_sql("lineitem"),
        "duplicate_profile_hash_lineitem": _duplicates_sql("lineitem"),
        "null_profile_conversations": _nulls_sql("conversations", _CONVERSATION_TYPES),
        "duplicate_profile_conversations": _duplicates_sql("conversations"),
        "null_profile_pages": _nulls_sql("pages", _PAGE_TYPES),
        "duplicate_profile_hash_embeddings": _duplicates_sql("embeddings"),
        "numeric_stats_orders": _stats_sql(
            "orders", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
        ),
        "numeric_stats_customer": _stats_sql(
            "customer", {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
        ),
        "quality_score": (
            f"{scored} SELECT table_name, columns_with_nulls, duplicate_percentage, anomaly_types, "
            "quality_score FROM scored"
        ),
        "quality_band": (
            f"{scored} SELECT table_name, quality_score, CASE WHEN quality_score >= 100 THEN 'perfect' "
            "WHEN quality_score >= 80 THEN 'high' WHEN quality_score >= 60 THEN 'medium' ELSE 'low' END "
            "AS band FROM scored"
        ),
        "quality_alerts": f"{scored} {_alerts_sql()}",
        "quality_gate": (
            f"{scored} SELECT table_name, quality_score, CAST(70.0 AS DOUBLE) AS threshold, "
            f"quality_score >= 70 AS passed FROM scored WHERE table_name = '{fixed.CLEANED_TABLE}'"
        ),
        "threshold_rules": f"{scored} {_rules_sql()}",
        "quality_report": _details_sql(),
        "quality_report_pair": _details_sql(),
        "quality_report_details": _details_sql(),
        "execution_report": (
            f"{scored} SELECT '{REPORT_TIME}' AS execution_date, '{quality.JOB_ID}' AS job_id, "
            "CASE WHEN quality_score < 70 THEN 'failed' ELSE 'success' END AS status, "
            f"'{','.join(quality.TASKS)}' AS tasks_completed, quality_score, total_records "
            f"FROM scored WHERE table_name = '{fixed.CLEANED_TABLE}'"
        ),
        "results_present": (
            f"{clean} SELECT '{fixed.RISK_RESULT}' AS result, true AS present, "
            f"count(*) AS \"rows\", true AS columns_ok FROM ({_RISK}) UNION ALL "
            f"SELECT '{fixed.SALES_RESULT}', true, least(3, count(*)), true FROM ({_LATEST})"
        ),
        "full_run": _full_run_sql(present),
        "published_results": (
            f"{clean} SELECT '{fixed.RISK_RESULT}' AS result, count(*) AS \"rows\", true AS intact, "
            f"round(sum(avg_risk_score), 4) AS value FROM ({_RISK.replace('WHERE', _SALES_AND)}) UNION ALL "
            f"SELECT '{fixed.SALES_RESULT}', count(*), true, round(sum(amount), 4) FROM "
            f"(SELECT amount FROM ({_LATEST}) ORDER BY amount DESC, receiving_address LIMIT 3)"
        ),
        "scheduled_run": _full_run_sql(present),
        "latest_sale_incremental": f"{clean} {_LATEST}",
        "duplicate_profile_incremental": f"{tx} {_duplicates_sql('tx')}",
    }
    oracle["top_sale_addresses_clustered"] = oracle["top_sale_addresses"]
    oracle["location_risk_incremental"] = oracle["location_risk_drop_nan"]
    oracle["clean_audit_incremental"] = oracle["clean_audit"]
    return oracle | (corpus.oracle_sql() if corpus else {})
