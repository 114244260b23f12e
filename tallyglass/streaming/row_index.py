"""Exact duplicates over all batches without reading old rows again.

The index has one row per different row seen so far: which of the two tables it is
of (raw or cleaned), its hash, and where a copy of it lies (file and place in that
file). It is split into buckets by hash. The rows of a new batch first collapse
among themselves; their hashes are looked up in the buckets they fall into, and
only for hashes that are there the old rows are fetched, by file and place, to be
compared column by column. What equals none of them is a new different row, also if
it shares a hash with another one.

The number of duplicates is that of rows less that of different rows; both are
sums over batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.operators.cleaning import BothTables
from tallyglass.operators.duplicates import compared_columns, versions
from tallyglass.session import remove_folder, shared_folder
from tallyglass.streaming.state import PartTable

# A batch writes one file for each of its buckets, so large histories want more of them.
BUCKETS = 32
ENTRY = "side int, hash bigint, file string, place bigint, bucket int"
COUNTS = "side int, rows bigint, different bigint"
FILE, PLACE = "file of row", "place of row"

# Files that are read by name; more are all files of the table.
MOST_FILES = 10_000


class RowIndex:
    """``landed`` is the table that the batches were landed in, ``both`` makes of its rows
    the raw and the cleaned version; ``derived`` are columns left out as in
    ``duplicate_profile``."""

    def __init__(
        self,
        root: str,
        landed: str,
        both: Callable[[DataFrame], BothTables],
        derived: tuple[str, ...] = (),
        buckets: int = BUCKETS,
        hashed: str = "hash",
    ):
        self.entries, self.counts = PartTable(f"{root}/row_index"), PartTable(f"{root}/row_counts")
        self.landed, self.both, self.derived = landed.rstrip("/"), both, derived
        self.buckets, self.hashed = buckets, hashed

    def _versions(self, rows: DataFrame) -> DataFrame:
        """Both versions of rows that come from Parquet files, with file and place."""
        metadata = rows.metadataColumn("_metadata")
        placed = rows.withColumns({FILE: metadata["file_path"], PLACE: metadata["row_index"]})
        found = versions(self.both(placed), (*self.derived, FILE, PLACE), carried=(FILE, PLACE))
        return found.withColumn("hash", F.expr(self.hashed).cast("bigint")).withColumnsRenamed({FILE: "file", PLACE: "place"})

    def known(self, spark: SparkSession, batch: int, hashes: DataFrame) -> DataFrame:
        """Entries of earlier batches in the buckets of these hashes."""
        buckets = [r[0] for r in hashes.select("bucket").distinct().collect()]
        earlier = self.entries.read(spark, ENTRY, before=batch)
        return earlier.filter(F.col("bucket").isin(buckets))

    def add(self, rows: DataFrame, batch: int) -> None:
        """``rows`` are those of a landed batch. Runs jobs; may be repeated."""
        spark = rows.sparkSession
        folder = shared_folder(spark)
        pointer = F.min(F.struct("file", "place")).alias("at")
        found = self._versions(rows)
        compared = ["hash", *compared_columns(found)]
        counted = found.groupBy(*compared).agg(F.count(F.lit(1)).alias("copies"), pointer)
        bucket = F.expr(f"CAST(pmod(hash, {self.buckets}) AS INT)")
        counted = counted.withColumn("bucket", bucket)
        counted.write.parquet(f"{folder}/rows")
        different = spark.read.schema(counted.schema).parquet(f"{folder}/rows")

        hashes = different.select("side", "hash", "bucket").distinct()
        suspects = self.known(spark, batch, hashes).join(hashes.drop("bucket"), ["side", "hash"], "left_semi")
        suspects.write.parquet(f"{folder}/suspects")
        suspects = spark.read.schema(suspects.schema).parquet(f"{folder}/suspects")
        fresh = different
        if not suspects.isEmpty():
            old = self._fetched(rows, suspects)
            same = [different[c].eqNullSafe(old[c]) for c in compared]
            fresh = different.join(old, reduce(and_, same), "left_anti")
        entries = fresh.select("side", "hash", "at.file", "at.place", "bucket")
        # One file a bucket and batch.
        written = self.entries.write(entries.repartition("bucket"), batch, by="bucket")
        sums = different.groupBy("side").agg(F.sum("copies").alias("rows")).join(
            written.groupBy("side").agg(F.count(F.lit(1)).alias("different")), "side", "left"
        )
        self.counts.write(sums.select("side", "rows", F.coalesce("different", F.lit(0)).alias("different")), batch)
        remove_folder(spark, folder)

    def _fetched(self, rows: DataFrame, suspects: DataFrame) -> DataFrame:
        """The old rows that ``suspects`` point at, from the files these lie in."""
        spark = rows.sparkSession
        files = [r[0] for r in suspects.select("file").distinct().limit(MOST_FILES + 1).collect()]
        reader = spark.read.schema(rows.schema)
        old = reader.parquet(*files) if len(files) <= MOST_FILES else reader.parquet(f"{self.landed}/*")
        return self._versions(old).join(suspects.select("side", "file", "place"), ["side", "file", "place"], "left_semi")

    def surplus(self, spark: SparkSession) -> DataFrame:
        """One row: raw_surplus and cleaned_surplus over all batches."""
        sums = [f"coalesce(sum(rows - different) FILTER (WHERE side = {i}), 0)" for i in (0, 1)]
        return self.counts.read(spark, COUNTS).selectExpr(f"{sums[0]} AS raw_surplus", f"{sums[1]} AS cleaned_surplus")
