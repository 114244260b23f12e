"""Scheduled runs that read only files they have not seen.

The batch run is started every few hours and reads its whole input again. Here
each start cleans the files that arrived since the last one, adds them to the
cleaned table and stops; the analyses then read their few columns of that
table. Cleaning is row-wise, so the stream keeps no state, and the file sink
writes every row once even when a start is interrupted and repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyglass.fixed_values import CLEANED_TABLE, RISK_DIGITS, RISK_RESULT, SALES_RESULT
from tallyglass.operators.analytics import (
    highest_risk_first,
    largest_sale_first,
    location_risk,
    top_sale_addresses,
)
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.schema import TXN_SCHEMA
from tallyglass.session import input_bytes, own_session
from tallyglass.sources.results import write_result


def transaction_stream(
    spark: SparkSession, folder: str, schema: StructType | str = TXN_SCHEMA
) -> DataFrame:
    """Stream over the headered CSV files of a folder."""
    reader = spark.readStream.schema(schema).option("header", True)
    return reader.option("enforceSchema", False).csv(folder)


def add_new_files(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """Clean the files that are new since the last start. Runs jobs.

    Returns the whole cleaned table, in a session whose shuffles are sized by it. Progress is kept below ``root``, which
    must be a folder that every executor can reach.
    """
    base = root.rstrip("/")
    cleaned = clean_transactions(transaction_stream(spark, folder))
    query = (
        cleaned.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/_progress")
        .trigger(availableNow=True)
        .start(f"{base}/{CLEANED_TABLE}_parquet")
    )
    query.awaitTermination()
    path = f"{base}/{CLEANED_TABLE}_parquet"
    session = own_session(spark, input_bytes(spark.read.schema(cleaned.schema).parquet(path)))
    return session.read.schema(cleaned.schema).parquet(path)


def refresh_results(spark: SparkSession, folder: str, root: str, drop_nan: bool = False) -> DataFrame:
    """Add new files, then replace both analyses. Returns the cleaned table."""
    cleaned = add_new_files(spark, folder, root)
    write_result(
        location_risk(cleaned, drop_nan=drop_nan),
        root,
        RISK_RESULT,
        rounded={"avg_risk_score": RISK_DIGITS},
        nan_as_null=True,
        order=highest_risk_first(),
    )
    write_result(
        top_sale_addresses(cleaned),
        root,
        SALES_RESULT,
        nan_as_null=True,
        order=largest_sale_first(),
    )
    return cleaned
