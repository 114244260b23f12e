"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions.columns import field, quoted, unused
from tallyglass.session import input_bytes, prepare, remove_folder, shared_folder

# Text that one step of a Python worker handles at once; the lists it makes of that
# take some thirty times as much.
BATCH_BYTES = 2 * 1024 * 1024
# Paths that go to every task as one small table, some megabytes.
MOST_FILES = 50_000

_made: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ready(spark, df)
    return df


def tokenizer_path(name: str) -> str:
    """Where an installed vocabulary file is; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ready(spark: SparkSession, docs: DataFrame) -> SparkSession:
    """Settings of the library, shuffles sized by the input, and Arrow batches of
    fewer rows, since one row is a whole text."""
    prepare(spark, input_bytes(docs))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add."""
    return df.drop(*names)


def landed(df: DataFrame, **options: str) -> DataFrame:
    """Write to a fresh shared folder and read back: later stages start from the
    files, so a lost executor costs only the stage that was running."""
    path = shared_folder(df.sparkSession)
    if _made:
        _made[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables landed inside are removed at the end, so whatever reads them has to be
    written by then."""
    made: list[str] = []
    _made.append(made)
    try:
        yield
    finally:
        _made.remove(made)
        for path in made:
            remove_folder(spark, path)


def numbered_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, and the name of that column. Ids may be
    null or repeat; this number is the same in every job. Rows of Parquet files
    have it from their file and place; others are landed first."""
    number = unused(docs, "row_number")
    placed = _rows_by_place(docs, number)
    if placed is None:
        placed = landed(docs.withColumn(number, F.monotonically_increasing_id()), compression="zstd")
    return placed, number


def _rows_by_place(docs: DataFrame, number: str) -> DataFrame | None:
    """None unless every row of ``docs`` is a row of a Parquet file of its own."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return None
    path, place, file = (unused(docs, n) for n in ("path_of_row", "place_of_row", "file_of_row"))
    try:
        metadata = docs.metadataColumn("_metadata")
        rows = docs.withColumns({path: metadata["file_path"], place: metadata["row_index"]})
        paths = rows.select(path).distinct().limit(MOST_FILES + 1).collect()
    except AnalysisException:  # files of another kind
        return None
    if len(paths) > MOST_FILES:
        return None
    files = [(name, i) for i, name in enumerate(sorted(r[0] for r in paths))]
    files = docs.sparkSession.createDataFrame(files, f"{quoted(path)} string, {quoted(file)} bigint")
    key = F.shiftleft(field(file), 40).bitwiseOR(field(place))
    return rows.join(F.broadcast(files), path).select(*map(field, docs.columns), key.alias(number))


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column`` each; a
    single longer value is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
