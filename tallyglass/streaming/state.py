"""State of scheduled runs: tables that grow by one part per batch of new files.

A batch writes its part to a folder of its own, named by the batch. Spark repeats a
batch that did not end with the same number and files, and the part is then
written anew, so nothing is counted twice. Parts hold sums or rows that merge, and
readers merge them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch"


class PartTable:
    """Parquet below ``path``, a folder ``batch=<number>`` for every batch."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def part(self, batch: int) -> str:
        return f"{self.path}/{BATCH}={batch}"

    def write(self, df: DataFrame, batch: int, by: str | None = None) -> DataFrame:
        """The part of a batch, written and read back; ``by`` is a column it is split by."""
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.part(batch))
        return df.sparkSession.read.schema(df.schema).option("basePath", self.part(batch)).parquet(self.part(batch))

    def read(self, spark: SparkSession, schema: StructType | str, before: int | None = None) -> DataFrame:
        """All parts, or those of batches before a given one."""
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if not self.exists(spark):
            return spark.createDataFrame([], kind)
        rows = spark.read.schema(StructType([*kind, *StructType.fromDDL(f"{BATCH} int")])).parquet(self.path)
        return (rows if before is None else rows.filter(F.col(BATCH) < before)).drop(BATCH)

    def exists(self, spark: SparkSession) -> bool:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
