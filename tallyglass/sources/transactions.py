"""Reading transaction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tallyglass.functions.columns import field
from tallyglass.schema import MALFORMED, TXN_SCHEMA, require_columns


def load_transactions(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = TXN_SCHEMA,
    source_format: str = "csv",
    keep_malformed: bool = False,
) -> DataFrame:
    """Headered CSV with the declared schema, or any columnar source.

    Header names must match the schema; a file with other or reordered columns
    fails when it is read. ``schema=None`` takes names from the header and infers
    types, which costs one more pass over the text and reads values such as
    ``192.168`` as numbers. Cells that do not parse as declared are null;
    ``keep_malformed`` adds a column with the text of their records. A missing path fails here with Spark's own error, on
    every file system Spark can read.
    """
    if source_format != "csv":
        return spark.read.format(source_format).load(path)
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    reader = reader.option("enforceSchema", False)
    if keep_malformed:
        declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*declared, StructField(MALFORMED, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.schema(schema).csv(path)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet and read back.

    Later scans then prune columns, push filters down, decode in batches and
    need nothing of the input when an executor is lost.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_clustered(
    df: DataFrame, path: str, cluster: str = "transaction_type", lookup: str = "receiving_address", distinct: int = 1_000_000
) -> DataFrame:
    """``land``, with every file sorted by ``cluster`` and a bloom filter on ``lookup``.

    The statistics of row groups and pages then tell which hold a value of ``cluster``, and
    the filter which row groups may hold one of ``lookup``, so that scans for either skip the
    rest. Each task sorts what it writes and spills if it must; no row is shuffled, so a
    value that holds a third of the table stays spread over all files. ``distinct`` sizes the
    filter: expected different values in a row group; more make it less sharp, not wrong.
    """
    require_columns(df, (cluster, lookup))
    (
        df.sortWithinPartitions(field(cluster))
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{lookup}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{lookup}", distinct)
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)
