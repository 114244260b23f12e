"""Names, literals and value predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# Text that a cast to double reads as not-a-number. Control characters and
# spaces around it are ignored; a sign is allowed before the exact spelling.
NAN_TEXT = r"\A[\x00-\x20]*(?:[+-]?NaN|[nN][aA][nN])[\x00-\x20]*\z"


def quoted(name: str) -> str:
    """Identifier of a top-level column, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    return F.col(quoted(name))


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def record(**fields: str) -> str:
    """Struct with the given field names and expressions."""
    return f"named_struct({', '.join(f'{text(k)}, {v}' for k, v in fields.items())})"


def is_missing(name: str, dtype: DataType) -> str:
    """True where the value is null or not-a-number, never null itself.

    Text counts as missing when it spells NaN. Its first byte rules out almost
    every row without allocating anything, so neither a failing number parse
    nor a pattern match is paid for ordinary text.
    """
    value = quoted(name)
    if isinstance(dtype, (DoubleType, FloatType)):
        return f"({value} IS NULL OR isnan({value}))"
    if isinstance(dtype, StringType):
        may_spell = " OR ".join(f"startswith({value}, '{c}')" for c in ("n", "N", "+", "-"))
        return (
            f"(CASE WHEN {value} IS NULL THEN true "
            f"WHEN {value} >= '!' AND NOT ({may_spell}) THEN false "
            f"ELSE {value} RLIKE r'{NAN_TEXT}' END)"
        )
    return f"({value} IS NULL)"
