"""Declared schemas of the input table and of the nested quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column that a declared CSV read can add: the whole text of a record with a cell
# that does not parse.
MALFORMED = "malformed_record"

# ``timestamp`` is a long because an int of epoch seconds ends in 2038.
TXN_SCHEMA = StructType(
    [
        StructField("timestamp", LongType()),
        StructField("sending_address", StringType()),
        StructField("receiving_address", StringType()),
        StructField("amount", DoubleType()),
        StructField("transaction_type", StringType()),
        StructField("location_region", StringType()),
        StructField("ip_prefix", DoubleType()),
        StructField("login_frequency", IntegerType()),
        StructField("session_duration", IntegerType()),
        StructField("purchase_pattern", StringType()),
        StructField("age_group", StringType()),
        StructField("risk_score", StringType()),
        StructField("anomaly", StringType()),
    ]
)

NULL_DETAIL = "struct<column:string,null_count:bigint,null_percentage:double>"
STATISTIC = "struct<count:bigint,mean:double,stddev:double,min:double,max:double>"
ANOMALY = "struct<type:string,column:string,count:bigint,description:string>"

# Report of one table; a table of reports has ``table_name`` in front.
REPORT_FIELDS = {
    "timestamp": "string",
    "basic_metrics": "struct<total_records:bigint,total_columns:int>",
    "null_analysis": f"struct<null_details:array<{NULL_DETAIL}>,columns_with_nulls:int>",
    "duplicate_analysis": "struct<total_records:bigint,unique_records:bigint,"
    "duplicate_count:bigint,duplicate_percentage:double>",
    "data_types_analysis": "struct<data_types:array<struct<column:string,data_type:string>>,"
    "type_distribution:map<string,int>>",
    "statistical_analysis": "struct<numeric_columns:array<string>,"
    f"statistics:map<string,{STATISTIC}>>",
    "anomalies": f"array<{ANOMALY}>",
    "quality_score": "double",
}
REPORT_STRUCT = f"struct<{','.join(f'{k}:{v}' for k, v in REPORT_FIELDS.items())}>"
REPORT_DDL = ", ".join(f"{k} {v}" for k, v in {"table_name": "string", **REPORT_FIELDS}.items())


def require_columns(df: DataFrame, names) -> None:
    """Fail while the plan is built, naming every column that is absent."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing column(s): {', '.join(absent)}")
