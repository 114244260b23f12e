"""Cleaning of transaction tables.

All steps are row-wise, so the whole of ``clean_transactions`` is one
projection and one filter inside the stage that scans the table; its null and
sign predicates reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from tallyglass.fixed_values import (
    CRITICAL_COLUMNS,
    RISK_SENTINEL,
    STANDARD_TEXT_COLUMNS,
)
from tallyglass.functions.columns import field, quoted, unused
from tallyglass.functions.time import readable_timestamp
from tallyglass.schema import MALFORMED, require_columns


# What the checks compare; an inferred table may hold these as text.
NUMBERS = {"amount": "double", "timestamp": "bigint"}


def number(name: str, dtype: DataType) -> str:
    """Expression of a number that may be stored as text; malformed text is null."""
    if isinstance(dtype, StringType):
        return f"try_cast({quoted(name)} AS {NUMBERS.get(name, 'double')})"
    return quoted(name)


def numbers_typed(df: DataFrame) -> DataFrame:
    """Amounts and times that are text become numbers, malformed ones null."""
    texts = [c for c in NUMBERS if c in df.columns and isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: F.expr(number(c, df.schema[c].dataType)) for c in texts})


def sentinel_to_null(
    df: DataFrame, column: str = "risk_score", sentinel: str = RISK_SENTINEL
) -> DataFrame:
    """Null for the exact sentinel text, case-sensitive and untrimmed."""
    require_columns(df, [column])
    return df.withColumn(column, F.nullif(field(column).cast("string"), F.lit(sentinel)))


def risk_to_double(
    df: DataFrame, column: str = "risk_score", sentinel: str = RISK_SENTINEL
) -> DataFrame:
    """Sentinel and malformed text become null, everything else a double."""
    require_columns(df, [column])
    if isinstance(df.schema[column].dataType, NumericType):
        return df.withColumn(column, field(column).cast("double"))
    text = F.nullif(field(column).cast("string"), F.lit(sentinel))
    return df.withColumn(column, text.try_cast("double"))


def add_readable_ts(
    df: DataFrame, column: str = "timestamp", output: str = "timestamp_readable"
) -> DataFrame:
    """Append the epoch column as text and keep the epoch."""
    require_columns(df, [column])
    epoch = quoted(column)
    if isinstance(df.schema[column].dataType, StringType):
        epoch = f"try_cast({epoch} AS bigint)"
    return df.withColumn(output, F.expr(readable_timestamp(epoch)))


def cast_to_string(
    df: DataFrame, columns: Sequence[str] = STANDARD_TEXT_COLUMNS
) -> DataFrame:
    """Cast the listed columns that exist; no trimming, no case folding."""
    return df.withColumns({c: field(c).cast("string") for c in columns if c in df.columns})


def all_present(columns: Sequence[str]) -> str:
    """Every listed column is non-null (not-a-number counts as present)."""
    return " AND ".join(f"{quoted(c)} IS NOT NULL" for c in columns)


def filter_critical_not_null(
    df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS
) -> DataFrame:
    """Keep rows in which none of the listed columns is null."""
    require_columns(df, columns)
    return df.filter(all_present(columns))


def filter_positive_amount(df: DataFrame, column: str = "amount") -> DataFrame:
    """Keep values above zero; not-a-number sorts above all and is kept."""
    require_columns(df, [column])
    return df.filter(f"{number(column, df.schema[column].dataType)} > 0")


def _typed(df: DataFrame) -> DataFrame:
    require_columns(df, (*CRITICAL_COLUMNS, "risk_score"))
    return add_readable_ts(risk_to_double(numbers_typed(df.drop(MALFORMED))))


def clean_transactions(df: DataFrame) -> DataFrame:
    """Typed amount, time and risk score, readable time, rows without critical
    nulls or non-positive amounts, text columns as strings. Adds one column and
    drops that of malformed records."""
    valid = filter_positive_amount(filter_critical_not_null(_typed(df)))
    return cast_to_string(valid)


@dataclass(frozen=True)
class BothTables:
    """Every raw row beside what cleaning makes of it. ``raw`` and ``cleaned`` give for
    each column of these tables its name in ``rows``; ``survives`` names the flag of
    the rows that cleaning keeps, ``changed`` the cleaned columns with other values
    than the raw one of that name."""

    rows: DataFrame
    raw: dict[str, str]
    cleaned: dict[str, str]
    survives: str
    changed: frozenset[str]


def raw_and_cleaned(
    df: DataFrame, flags: dict[str, str] | None = None, carried: Sequence[str] = ()
) -> BothTables:
    """Row-wise, so one scan of ``df`` serves both tables. ``flags`` are further columns of
    the rows, by expressions of raw columns; ``carried`` are columns of neither table."""
    df = df.drop(MALFORMED)
    flags = {name: F.expr(value) for name, value in (flags or {}).items()}
    raw = {c: unused(df, f"raw {c}") for c in df.columns if c not in carried}
    typed = _typed(df.withColumns({**{new: field(c) for c, new in raw.items()}, **flags}))
    others = {*raw.values(), *flags, *carried}
    cleaned = [c for c in typed.columns if c not in others]
    survives = unused(typed, "survives cleaning")
    kept = f"({all_present(CRITICAL_COLUMNS)} AND {number('amount', typed.schema['amount'].dataType)} > 0)"
    rows = cast_to_string(typed.withColumn(survives, F.expr(f"coalesce({kept}, false)")))
    texts = {c for c in raw if isinstance(df.schema[c].dataType, StringType)}
    same = (texts | (set(raw) - {*STANDARD_TEXT_COLUMNS})) - (texts & set(NUMBERS)) - {"risk_score"}
    return BothTables(rows, raw, dict(zip(cleaned, cleaned)), survives, frozenset(cleaned) - same)


def clean_audit(df: DataFrame) -> DataFrame:
    """One row: how many rows the cleaning receives, drops per rule and keeps.

    ``removed_malformed`` counts rows with a malformed cell that lack a critical
    value; these are not among ``removed_null_critical``. It is 0 for a table that
    was read without the column of malformed records. One aggregate over the
    critical columns only; no shuffle beyond one partial row per task.
    """
    require_columns(df, CRITICAL_COLUMNS)
    unparsed = [
        f"({quoted(c)} IS NOT NULL AND {number(c, df.schema[c].dataType)} IS NULL)"
        for c in NUMBERS
        if isinstance(df.schema[c].dataType, StringType)
    ]
    if MALFORMED in df.columns:
        unparsed.append(f"{quoted(MALFORMED)} IS NOT NULL")
    malformed = f"({' OR '.join(unparsed or ['false'])})"
    present = f"({all_present(CRITICAL_COLUMNS)})"
    audited = numbers_typed(df.withColumn("malformed", F.expr(malformed)))
    return audited.selectExpr(
        "count(1) AS initial_records",
        f"count_if(NOT {present} AND malformed) AS removed_malformed",
        f"count_if(NOT {present} AND NOT malformed) AS removed_null_critical",
        f"count_if({present} AND NOT amount > 0) AS removed_non_positive_amount",
        f"count_if({present} AND amount > 0) AS final_records",
    )
