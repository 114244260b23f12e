"""Records judged cell by cell: what cleaning keeps, what it rejects, and why.

Input are records whose cells are still text, as a CSV is read without a schema that
nulls what does not parse. One projection adds the problems of every record as an
array of (column, reason); whether it is kept follows from these. A problem in a
critical column rejects the record, others only null the cell. All of it happens in
the scan; kept and rejected records are two filters of the same projection.

Reasons: ``missing`` (a critical cell is null), ``malformed`` (the text is no value of the
declared type; the sentinel of the risk score is none), ``not_positive`` (an amount).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyglass.fixed_values import CRITICAL_COLUMNS, RISK_SENTINEL
from tallyglass.functions.columns import quoted, record, text, unused
from tallyglass.schema import TXN_SCHEMA, require_columns

PROBLEMS = "problems"
RISK = "risk_score"


def text_records(spark: SparkSession, path: str, schema: StructType = TXN_SCHEMA) -> DataFrame:
    """Headered CSV with every cell as it is written."""
    cells = StructType([StructField(f.name, StringType()) for f in schema])
    return spark.read.schema(cells).option("header", True).option("enforceSchema", False).csv(path)


def _problem(name: str, dtype: str) -> str | None:
    """The first problem of a cell as an expression, null for none."""
    cell, cases = quoted(name), []
    if name in CRITICAL_COLUMNS:
        cases.append((f"{cell} IS NULL", "missing"))
    if dtype != "string":
        known = f" AND {cell} != {text(RISK_SENTINEL)}" if name == RISK else ""
        cases.append((f"{cell} IS NOT NULL{known} AND try_cast({cell} AS {dtype}) IS NULL", "malformed"))
    if name == "amount":
        cases.append((f"NOT try_cast({cell} AS {dtype}) > 0", "not_positive"))
    if not cases:
        return None
    whens = " ".join(f"WHEN {c} THEN {record(column=text(name), reason=text(r))}" for c, r in cases)
    return f"CASE {whens} END"


def judged(df: DataFrame, schema: StructType = TXN_SCHEMA) -> DataFrame:
    """``df`` and the column problems, in the order of the schema; columns that ``df`` lacks
    are not looked at, critical ones must be there."""
    require_columns(df, CRITICAL_COLUMNS)
    kinds = {f.name: "double" if f.name == RISK else f.dataType.simpleString() for f in schema}
    found = [p for c, kind in kinds.items() if c in df.columns and (p := _problem(c, kind))]
    return df.withColumn(unused(df, PROBLEMS), F.expr(f"array_compact(array({', '.join(found)}))"))


def _rejecting(df: DataFrame) -> str:
    critical = ", ".join(map(text, CRITICAL_COLUMNS))
    return f"exists({quoted(df.columns[-1])}, p -> p.column IN ({critical}))"


def kept_records(records: DataFrame) -> DataFrame:
    """Of ``judged``: those that cleaning keeps, with the cells it nulls as problems."""
    return records.filter(f"NOT {_rejecting(records)}")


def rejected_records(records: DataFrame) -> DataFrame:
    """Of ``judged``: those that cleaning drops."""
    return records.filter(_rejecting(records))


def problem_counts(records: DataFrame) -> DataFrame:
    """One row per column, reason and whether the record was kept: how many cells; from
    one scan, with one row a task and kind of problem in the shuffle."""
    problems = quoted(records.columns[-1])
    cells = records.selectExpr(f"NOT {_rejecting(records)} AS kept", f"explode({problems}) AS p")
    return cells.groupBy("p.column", "p.reason", "kept").agg(F.count(F.lit(1)).alias("cells"))
