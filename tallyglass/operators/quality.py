"""Score, bands, alerts, rules and gate over quality-report rows.

A report table has one row per profiled table, so everything here is a
projection of a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyglass.fixed_values import (
    ALERT_ANOMALIES_TEXT,
    ALERT_DUPLICATE_PERCENTAGE,
    ALERT_DUPLICATES_TEXT,
    ALERT_NULLS_TEXT,
    ALERT_SCORE,
    ALERT_SCORE_TEXT,
    BAND_HIGH,
    BAND_MEDIUM,
    CLEANED_TABLE,
    GATE_SCORE,
    MAX_ANOMALY_POINTS,
    MAX_DUPLICATE_PERCENTAGE,
    MAX_DUPLICATE_POINTS,
    MAX_NULL_PERCENTAGE,
    MAX_NULL_POINTS,
    POINTS_PER_ANOMALY_TYPE,
    POINTS_PER_NULL_COLUMN,
    RULE_COLUMNS,
    SUMMARY_ANOMALIES,
    SUMMARY_COLUMNS,
    SUMMARY_DUPLICATES,
    SUMMARY_NULL_COLUMNS,
    SUMMARY_RECORDS,
    SUMMARY_RULER,
    SUMMARY_SCORE,
    SUMMARY_TIMESTAMP,
    SUMMARY_TITLE,
)
from tallyglass.functions.columns import record, text
from tallyglass.functions.rounding import round_exact
from tallyglass.functions.time import NOW

NULL_COLUMNS = "null_analysis.columns_with_nulls"
DUPLICATE_SHARE = "duplicate_analysis.duplicate_percentage"
ANOMALY_TYPES = "size(anomalies)"

JOB_ID = "tallyglass"
ANALYSIS = "analyse"
TASKS = ("load", "profile", "clean", ANALYSIS, "report")


@dataclass(frozen=True)
class Thresholds:
    """Limits of alerts, gate and rules; every comparison is strict."""

    alert_score: float = ALERT_SCORE
    alert_duplicate_percentage: float = ALERT_DUPLICATE_PERCENTAGE
    gate_score: float = GATE_SCORE
    max_null_percentage: float = MAX_NULL_PERCENTAGE
    max_duplicate_percentage: float = MAX_DUPLICATE_PERCENTAGE
    rule_columns: Sequence[str] = RULE_COLUMNS


DEFAULT_THRESHOLDS = Thresholds()


def score(null_columns: str, duplicate_share: str, anomaly_types: str) -> str:
    """100 minus capped points for null columns, copies and anomaly types."""
    points = (
        f"100D - least({MAX_NULL_POINTS}, {null_columns} * {POINTS_PER_NULL_COLUMN})"
        f" - least({MAX_DUPLICATE_POINTS}D, {duplicate_share})"
        f" - least({MAX_ANOMALY_POINTS}, {anomaly_types} * {POINTS_PER_ANOMALY_TYPE})"
    )
    return f"greatest(0D, {round_exact(points, 2)})"


def quality_score(reports: DataFrame) -> DataFrame:
    """One row per table: the score and the three measures behind it."""
    return reports.selectExpr(
        "table_name",
        f"{NULL_COLUMNS} AS columns_with_nulls",
        f"{DUPLICATE_SHARE} AS duplicate_percentage",
        f"{ANOMALY_TYPES} AS anomaly_types",
        "quality_score",
    )


def quality_band(reports: DataFrame) -> DataFrame:
    """perfect at 100, high from 80, medium from 60, low below."""
    return reports.selectExpr(
        "table_name",
        "quality_score",
        f"CASE WHEN quality_score >= 100 THEN 'perfect' WHEN quality_score >= {BAND_HIGH} "
        f"THEN 'high' WHEN quality_score >= {BAND_MEDIUM} THEN 'medium' ELSE 'low' END AS band",
    )


def quality_alerts(reports: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """One row per alert (table_name, rule, message); none for a good table."""

    def alert(condition: str, rule: str, around: tuple[str, str], value: str) -> str:
        before, after = around
        message = f"concat({text(before)}, CAST({value} AS STRING), {text(after)})"
        return f"CASE WHEN {condition} THEN {record(rule=text(rule), message=message)} END"

    candidates = ", ".join(
        (
            alert(
                f"quality_score < {thresholds.alert_score}D",
                "low_score",
                ALERT_SCORE_TEXT,
                "quality_score",
            ),
            alert(f"{NULL_COLUMNS} > 0", "null_columns", ALERT_NULLS_TEXT, NULL_COLUMNS),
            alert(
                f"{DUPLICATE_SHARE} > {thresholds.alert_duplicate_percentage}D",
                "duplicates",
                ALERT_DUPLICATES_TEXT,
                round_exact(DUPLICATE_SHARE, 1),
            ),
            alert(f"{ANOMALY_TYPES} > 0", "anomalies", ALERT_ANOMALIES_TEXT, ANOMALY_TYPES),
        )
    )
    return reports.selectExpr("table_name", f"inline(array_compact(array({candidates})))")


def threshold_rules(reports: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """One row per rule (table_name, rule, column, value, limit, breached):
    lowest score, highest share of copies, and highest share of missing values
    for every critical column the table has."""

    def rule(name: str, column: str, value: str, limit: float, comparison: str) -> str:
        return record(
            rule=text(name),
            column=column,
            value=value,
            limit=f"{limit}D",
            breached=f"{value} {comparison} {limit}D",
        )

    no_column = "CAST(NULL AS STRING)"
    whole_table = ", ".join(
        (
            rule("min_quality_score", no_column, "quality_score", thresholds.gate_score, "<"),
            rule(
                "max_duplicate_percentage",
                no_column,
                DUPLICATE_SHARE,
                thresholds.max_duplicate_percentage,
                ">",
            ),
        )
    )
    per_column = rule(
        "max_null_percentage", "d.column", "d.null_percentage", thresholds.max_null_percentage, ">"
    )
    critical = ", ".join(text(c) for c in thresholds.rule_columns)
    details = f"filter(null_analysis.null_details, d -> d.column IN ({critical}))"
    return reports.selectExpr(
        "table_name",
        f"inline(concat(array({whole_table}), transform({details}, d -> {per_column})))",
    )


def quality_gate(
    reports: DataFrame,
    table_name: str = CLEANED_TABLE,
    threshold: float = GATE_SCORE,
    strict: bool = False,
) -> DataFrame:
    """One row (table_name, quality_score, threshold, passed) for the table.

    With ``strict`` any action on the result fails when the score is below the
    threshold. A report without the table gives no row and does not fail.
    """
    passed = f"quality_score >= {threshold}D"
    if strict:
        problem = text(f"quality score of {table_name} too low: ")
        passed = (
            f"CASE WHEN {passed} THEN true "
            f"ELSE CAST(raise_error(concat({problem}, quality_score)) AS BOOLEAN) END"
        )
    return reports.filter(f"table_name = {text(table_name)}").selectExpr(
        "table_name", "quality_score", f"{threshold}D AS threshold", f"{passed} AS passed"
    )


def quality_summary(reports: DataFrame, table_name: str = CLEANED_TABLE) -> DataFrame:
    """Text summary of one table as rows (line_number, line)."""

    def line(label: str, value: str, after: str = "") -> str:
        return f"concat({text(label)}, CAST({value} AS STRING), {text(after)})"

    before_score, after_score = SUMMARY_SCORE
    lines = ", ".join(
        (
            text(SUMMARY_TITLE),
            text(SUMMARY_RULER),
            "''",
            line(SUMMARY_TIMESTAMP, "timestamp"),
            line(SUMMARY_RECORDS, "basic_metrics.total_records"),
            line(SUMMARY_COLUMNS, "basic_metrics.total_columns"),
            line(before_score, "quality_score", after_score),
            "''",
            line(SUMMARY_NULL_COLUMNS, NULL_COLUMNS),
            line(SUMMARY_DUPLICATES, "duplicate_analysis.duplicate_count"),
            line(SUMMARY_ANOMALIES, ANOMALY_TYPES),
        )
    )
    chosen = reports.filter(f"table_name = {text(table_name)}")
    return chosen.selectExpr(f"posexplode(array({lines})) AS (position, line)").selectExpr(
        "position + 1 AS line_number", "line"
    )


def execution_report(
    reports: DataFrame,
    execution_date: str | None = None,
    table_name: str = CLEANED_TABLE,
    gate_score: float = GATE_SCORE,
    job_id: str = JOB_ID,
    tasks: Sequence[str] = TASKS,
    results_complete: bool = True,
) -> DataFrame:
    """One row about the run: date, job, status, tasks and the cleaned
    table's score and size (0 where the report lacks that table).

    ``status`` is ``success`` unless the score misses the gate, the report lacks
    the table, or a result is missing; then the analysis is no completed task.
    """
    tasks = [t for t in tasks if results_complete or t != ANALYSIS]
    chosen = f"table_name = {text(table_name)}"
    summary = reports.selectExpr(
        f"max(quality_score) FILTER (WHERE {chosen}) AS score",
        f"max(basic_metrics.total_records) FILTER (WHERE {chosen}) AS records",
    )
    done = ", ".join(text(task) for task in tasks)
    return summary.selectExpr(
        f"{NOW if execution_date is None else text(execution_date)} AS execution_date",
        f"{text(job_id)} AS job_id",
        f"IF(score >= {gate_score}D AND {str(results_complete).lower()}, 'success', 'failed') AS status",
        f"array({done}) AS tasks_completed",
        record(quality_score="coalesce(score, 0D)", total_records="coalesce(records, 0L)")
        + " AS quality_summary",
    )
