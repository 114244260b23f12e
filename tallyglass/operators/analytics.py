"""Risk per region and the addresses with the largest latest sale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tallyglass.fixed_values import (
    RISK_DIGITS,
    SALE_TYPE,
    SALES_RESULT_COLUMNS,
    TOP_ADDRESSES,
)
from tallyglass.functions.columns import field, quoted, unused
from tallyglass.functions.rounding import round_scaled
from tallyglass.schema import require_columns


def highest_risk_first() -> list[Column]:
    return [F.desc("avg_risk_score"), F.asc("location_region")]


def largest_sale_first() -> list[Column]:
    return [F.desc("amount"), F.asc("receiving_address")]


def filter_valid_risk(
    df: DataFrame, column: str = "risk_score", drop_nan: bool = False
) -> DataFrame:
    """Keep rows with a risk score; not-a-number stays unless ``drop_nan``."""
    require_columns(df, [column])
    valid = field(column).isNotNull()
    return df.filter(valid & ~F.isnan(field(column)) if drop_nan else valid)


def filter_sales(
    df: DataFrame, column: str = "transaction_type", value: str = SALE_TYPE
) -> DataFrame:
    require_columns(df, [column])
    return df.filter(field(column) == value)


def location_risk(
    df: DataFrame, risk: str = "risk_score", drop_nan: bool = False
) -> DataFrame:
    """Mean risk per region, highest first.

    Partial averages per task collapse a hot region before the shuffle, which
    then carries one row per region and task.
    """
    valid = filter_valid_risk(df, risk, drop_nan)
    means = valid.groupBy("location_region").agg(F.avg(field(risk)).alias("avg_risk_score"))
    return means.orderBy(*highest_risk_first())


def location_risk_rounded(
    df: DataFrame, digits: int = RISK_DIGITS, drop_nan: bool = False
) -> DataFrame:
    """``location_risk`` as the text sinks show it."""
    return location_risk(df, drop_nan=drop_nan).withColumn(
        "avg_risk_score", F.expr(round_scaled("avg_risk_score", digits))
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First whole row of every key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key in every task before
    the shuffle, so a key that holds a third of the table sends no more rows
    than there are tasks.
    """
    require_columns(df, keys)
    window = Window.partitionBy(*[field(k) for k in keys]).orderBy(*order)
    number = unused(df, "row_number_in_key")
    return df.withColumn(number, F.row_number().over(window)).filter(F.col(number) == 1).drop(number)


def latest_sale_per_address(df: DataFrame) -> DataFrame:
    """Most recent sale of every receiving address.

    Ties in time go to the larger amount, then to the smaller sender, then to
    the smaller value of every other column in order, so that the row does not
    depend on the order of the input.
    """
    decided = ("timestamp", "amount", "sending_address", "receiving_address")
    others = [
        F.asc(quoted(f.name))
        for f in df.schema
        if f.name not in decided and not _unordered(f.dataType)
    ]
    return latest_per_key(
        filter_sales(df),
        ["receiving_address"],
        [F.desc("timestamp"), F.desc("amount"), F.asc("sending_address"), *others],
    )


def _unordered(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _unordered(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_unordered(f.dataType) for f in dtype)
    return isinstance(dtype, (MapType, VariantType))


def top_sale_addresses(df: DataFrame, k: int = TOP_ADDRESSES) -> DataFrame:
    """The ``k`` addresses with the largest amount in their latest sale.

    Only result columns enter the window: time and amount already decide every
    one of them, so no other column is read or shuffled. Without any sale the
    result is empty with the same schema.
    """
    sales = filter_sales(df).select(*SALES_RESULT_COLUMNS)
    latest = latest_per_key(
        sales, ["receiving_address"], [F.desc("timestamp"), F.desc("amount")]
    )
    return latest.orderBy(*largest_sale_first()).limit(k)
