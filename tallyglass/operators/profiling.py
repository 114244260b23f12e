"""Profile of any table: missing values, types, statistics, anomalies.

``table_metrics`` computes everything one scan can give in a single aggregate.
Each task reduces its rows to one partial row, so only as many rows as there
are tasks are ever shuffled, and these are merged in two steps (``profile_state``).
The other functions ask it for the part they need
and lay the result out as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tallyglass.fixed_values import (
    FUTURE_AFTER_YEARS,
    FUTURE_TIMESTAMPS_TEXT,
    NEGATIVE_VALUES_TEXT,
    OLD_AFTER_YEARS,
    OLD_TIMESTAMPS_TEXT,
    REFERENCE_EPOCH,
    SECONDS_PER_YEAR,
)
from tallyglass.functions.columns import is_missing, quoted, record, text
from tallyglass.functions.rounding import percentage
from tallyglass.operators.cleaning import number
from tallyglass.operators.profile_state import (
    STATISTIC_TYPES,
    Measured,
    deviation,
    table_states,
)
from tallyglass.schema import ANOMALY

COLUMNS_PER_AGGREGATE = 100

MISSING_ROWS = "array<struct<ordinal:int,column:string,missing:bigint>>"
STATISTIC_ROWS = (
    "array<struct<ordinal:int,column:string,count:bigint,"
    "mean:double,stddev:double,min:double,max:double>>"
)
ANOMALY_ROWS = f"array<{ANOMALY}>"


@dataclass(frozen=True)
class AnomalyRule:
    """A range check on one column; skipped where the column does not exist.

    ``violated`` is the SQL condition of an offending row, ``{value}`` the value.
    """

    type: str
    column: str
    violated: str
    description: str


def transaction_anomaly_rules(reference_epoch: int = REFERENCE_EPOCH) -> tuple[AnomalyRule, ...]:
    """Negative amounts, and times too far before or after the reference."""
    oldest = reference_epoch - OLD_AFTER_YEARS * SECONDS_PER_YEAR
    newest = reference_epoch + FUTURE_AFTER_YEARS * SECONDS_PER_YEAR
    return (
        AnomalyRule("negative_values", "amount", "{value} < 0", NEGATIVE_VALUES_TEXT),
        AnomalyRule(
            "old_timestamps", "timestamp", f"{{value}} < {oldest}", OLD_TIMESTAMPS_TEXT
        ),
        AnomalyRule(
            "future_timestamps", "timestamp", f"{{value}} > {newest}", FUTURE_TIMESTAMPS_TEXT
        ),
    )


def applicable_rules(df: DataFrame, rules: Sequence[AnomalyRule]) -> list[AnomalyRule]:
    return [rule for rule in rules if rule.column in df.columns]


def violation(df: DataFrame, rule: AnomalyRule) -> str:
    """The rule's condition on a column that may hold its numbers as text."""
    return rule.violated.format(value=number(rule.column, df.schema[rule.column].dataType))


def missing_flags(df: DataFrame) -> DataFrame:
    """Per row and column whether the value is missing (``<column>_missing``)."""
    return df.selectExpr(
        *[f"{is_missing(f.name, f.dataType)} AS {quoted(f.name + '_missing')}" for f in df.schema]
    )


def anomalous_rows(
    df: DataFrame, columns: Sequence[str], rules: Sequence[AnomalyRule] | None = None
) -> DataFrame:
    """Rows that violate a rule: the given columns and one flag per rule."""
    rules = applicable_rules(df, transaction_anomaly_rules() if rules is None else rules)
    flags = [f"coalesce({violation(df, rule)}, false) AS {quoted(rule.type)}" for rule in rules]
    found = df.selectExpr(*map(quoted, columns), *flags)
    return found.filter(" OR ".join([quoted(rule.type) for rule in rules] or ["false"]))


def statistic_columns(df: DataFrame) -> list[str]:
    """Columns that get statistics: double, float, int and long only."""
    return [f.name for f in df.schema if isinstance(f.dataType, STATISTIC_TYPES)]


def table_metrics(
    df: DataFrame,
    missing: bool = True,
    statistics: bool = True,
    anomaly_rules: Sequence[AnomalyRule] = (),
    columns_per_aggregate: int = COLUMNS_PER_AGGREGATE,
) -> DataFrame:
    """One row: total_records and the arrays missing, statistics, anomalies.

    A wide table is split into several aggregates over disjoint columns, so
    generated code stays small and a columnar source still reads each column
    once. Array lengths depend on the number of columns, never on rows.
    """
    fields = list(enumerate(df.schema))
    if not missing:
        wanted = set(statistic_columns(df)) if statistics else set()
        fields = [(i, f) for i, f in fields if f.name in wanted]
    slices = [
        fields[start : start + columns_per_aggregate]
        for start in range(0, len(fields), columns_per_aggregate)
    ] or [[]]

    parts = []
    for number, part in enumerate(slices):
        rules = applicable_rules(df, anomaly_rules) if number == 0 else []
        measured = Measured(
            [(f.name, f.dataType) for _, f in part],
            [violation(df, rule) for rule in rules],
            missing=missing,
            statistics=statistics,
        )
        state = table_states(df, {"state": measured})
        parts.append(state.selectExpr(*metrics_of_state("state", part, rules, missing, statistics)))
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "max(total_records) AS total_records",
        "array_sort(flatten(collect_list(missing))) AS missing",
        "array_sort(flatten(collect_list(statistics))) AS statistics",
        "flatten(collect_list(anomalies)) AS anomalies",
    )


def metrics_of_state(
    state: str,
    fields: Sequence[tuple[int, StructField]],
    rules: Sequence[AnomalyRule] = (),
    missing: bool = True,
    statistics: bool = True,
) -> list[str]:
    """The columns of ``table_metrics`` as expressions of a state of these fields, null
    for a table without rows."""
    missing_rows, statistic_rows, anomaly_rows = [], [], []
    for place, (i, f) in enumerate(fields):
        column, label = f"{state}.columns[{place}]", {"ordinal": str(i), "column": text(f.name)}
        if missing:
            missing_rows.append(record(**label, missing=f"coalesce({column}.missing, 0)"))
        if statistics and isinstance(f.dataType, STATISTIC_TYPES):
            measures = {
                "count": f"coalesce({column}.count, 0)",
                "mean": f"{column}.mean",
                "stddev": deviation(column),
                "min": f"{column}.low",
                "max": f"{column}.high",
            }
            statistic_rows.append(record(**label, **measures))
    for place, rule in enumerate(rules):
        anomaly_rows.append(
            record(
                type=text(rule.type),
                column=text(rule.column),
                count=f"{state}.anomalies[{place}]",
                description=text(rule.description),
            )
        )
    anomalies = f"CAST({_array(anomaly_rows)} AS {ANOMALY_ROWS})"
    return [
        f"coalesce({state}.total, 0) AS total_records",
        f"CAST({_array(missing_rows)} AS {MISSING_ROWS}) AS missing",
        f"CAST({_array(statistic_rows)} AS {STATISTIC_ROWS}) AS statistics",
        f"filter({anomalies}, a -> a.count > 0) AS anomalies",
    ]


def _array(rows: Sequence[str]) -> str:
    return f"array({', '.join(rows)})"


def basic_metrics(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns. Reads no column."""
    return df.selectExpr(
        "count(1) AS total_records", f"{len(df.columns)} AS total_columns"
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many values are missing, and which share."""
    rows = table_metrics(df, statistics=False).selectExpr("total_records", "inline(missing)")
    return rows.selectExpr(
        "`column`",
        "missing AS null_count",
        f"{percentage('missing', 'total_records')} AS null_percentage",
    )


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """One row: number of columns with at least one missing value."""
    return table_metrics(df, statistics=False).selectExpr(
        "size(filter(missing, m -> m.missing > 0)) AS columns_with_nulls"
    )


def numeric_stats(df: DataFrame) -> DataFrame:
    """One row per numeric column: count, mean, sample deviation, min, max.

    Reads numeric columns only. A table without any gives no row; statistics
    without enough values are null.
    """
    return table_metrics(df, missing=False).selectExpr("inline(statistics)").drop("ordinal")


def anomaly_checks(
    df: DataFrame, rules: Sequence[AnomalyRule] | None = None
) -> DataFrame:
    """One row per violated rule with the number of offending rows."""
    rules = transaction_anomaly_rules() if rules is None else rules
    row = table_metrics(df, missing=False, statistics=False, anomaly_rules=rules)
    return row.selectExpr("inline(anomalies)")


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column with its type name and the number of records that
    have it. Reads no column."""
    return basic_metrics(df).selectExpr(f"inline({type_listing(df.dtypes)})", "total_records")


def type_listing(dtypes: Sequence[tuple[str, str]]) -> str:
    """Array of (column, data_type) as an expression."""
    rows = [record(column=text(name), data_type=text(dtype)) for name, dtype in dtypes]
    return f"CAST({_array(rows)} AS array<struct<column:string,data_type:string>>)"


def type_distribution(df: DataFrame) -> DataFrame:
    """Number of columns of every type, over that many records."""
    types = schema_profile(df).groupBy("data_type")
    return types.agg(F.count(F.lit(1)).alias("columns"), F.max("total_records").alias("total_records"))
