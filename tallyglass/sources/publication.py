"""Publication of results by manifest.

A run writes into a folder of its own, ``<root>/runs/<time>-<id>``. Nobody reads it
until a manifest names it, ``<root>/manifests/<number>.json``, and that small file
appears whole or not at all. Readers go by the manifest with the highest number, so a
run that dies between two results leaves the former ones as they were, and nobody
finds results of two runs side by side.

The manifest tells of every table how many rows, files and bytes it has and a checksum
that does not depend on the order of rows. The same per file is a table of the run
(``FILES``), which may be long; the manifest has one entry per table. Checksums are
computed from what was written, in one scan of it, so they also prove that it can be
read: rows of Parquet, lines of texts.

Cases: without a manifest nothing is published and reading raises ``LookupError``; a
table without rows has zeros; of two runs that commit at once the later rename takes
the next number, and its results are the current ones; a table that is in no manifest
is never read, whatever lies below ``runs``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyglass.functions.columns import field, quoted, unused
from tallyglass.operators.duplicates import comparable
from tallyglass.session import remove_folder
from tallyglass.sources.results import read_result, results_present

RUNS = "runs"
MANIFESTS = "manifests"
FILES = "files_parquet"
COMMITTED = "table_name string, `rows` bigint, files bigint, bytes bigint, checksum string"
_ATTEMPTS = 20


def publish(spark: SparkSession, root: str, write: Callable[[str], Sequence[str] | None]) -> dict[str, Any]:
    """Let ``write`` fill the folder of a new run, then commit the tables it names, all if
    none. If it fails, so does this, and what was published before stays current."""
    folder = new_run(root)
    return commit(spark, root, folder, write(folder))


def new_run(root: str) -> str:
    """Folder for one run; folders sort by the time the runs began."""
    return f"{root.rstrip('/')}/{RUNS}/{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, root: str, folder: str, tables: Sequence[str] | None = None) -> dict[str, Any]:
    """Make ``folder`` the current result; returns its manifest.

    ``tables`` are folders below it, all finished ones by default. What is not among
    them stays out of the manifest. One that is missing fails the commit.
    """
    names = sorted(written_tables(spark, folder) if tables is None else tables)
    file_sums(spark, folder, names).write.mode("overwrite").parquet(f"{folder}/{FILES}")
    sums = {r.table_name: r.asDict() for r in _per_table(spark.read.parquet(f"{folder}/{FILES}")).collect()}
    nothing = {"rows": 0, "files": 0, "bytes": 0, "checksum": "0"}
    entry = {"run": folder.rsplit("/", 1)[1], "tables": [{"table_name": n, **sums.get(n, nothing)} for n in names]}
    last = 0
    for _ in range(_ATTEMPTS):
        last = max([last, *_numbers(spark, root)]) + 1
        if _appear(spark, f"{root.rstrip('/')}/{MANIFESTS}/{last:010d}.json", json.dumps(entry, indent=1)):
            return {"number": last, **entry}
    raise RuntimeError(f"no free manifest number below {root}")


def manifest(spark: SparkSession, root: str) -> dict[str, Any]:
    """The current manifest: ``number``, ``run`` and ``tables``."""
    numbers = _numbers(spark, root)
    if not numbers:
        raise LookupError(f"nothing is published below {root}")
    return _read(spark, root, max(numbers))


def published_folder(spark: SparkSession, root: str) -> str:
    """The current run's folder, which stays as it is when a later run is published."""
    return f"{root.rstrip('/')}/{RUNS}/{manifest(spark, root)['run']}"


def published_tables(spark: SparkSession, root: str) -> DataFrame:
    """One row per table of the current manifest."""
    names = [c.split()[0].strip("`") for c in COMMITTED.split(", ")]
    rows = [tuple(t[c] for c in names) for t in manifest(spark, root)["tables"]]
    return spark.createDataFrame(rows, COMMITTED)


def read_published(
    spark: SparkSession,
    root: str,
    name: str,
    result_format: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """A result of the current run, as ``results.read_result`` reads it."""
    return read_result(spark, published_folder(spark, root), name, result_format, schema)


def published_present(
    spark: SparkSession, root: str, expected: Mapping[str, Sequence[str]], result_format: str = "parquet"
) -> DataFrame:
    """``results.results_present`` of the current run; without one, nothing is present."""
    current = _numbers(spark, root)
    folder = published_folder(spark, root) if current else f"{root.rstrip('/')}/{RUNS}/none"
    return results_present(spark, folder, expected, result_format)


def verified(spark: SparkSession, root: str) -> DataFrame:
    """The current run's tables read again: table_name, intact, and how many files are
    ``missing``, ``changed`` or ``added`` since the commit. One scan and a join by file."""
    folder, names = published_folder(spark, root), [t["table_name"] for t in manifest(spark, root)["tables"]]
    there = set(written_tables(spark, folder)) & set(names)
    now = file_sums(spark, folder, sorted(there)).alias("now")
    then = spark.read.parquet(f"{folder}/{FILES}").alias("then")
    both = then.join(now, ["table_name", "file"], "full_outer")
    judged = both.selectExpr(
        "table_name",
        "now.bytes IS NULL AS missing",
        "now.bytes <> then.bytes OR now.`rows` <> then.`rows` OR now.hashes <> then.hashes AS changed",
        "then.bytes IS NULL AS added",
    )
    counts = judged.groupBy("table_name").agg(*[F.count_if(c).alias(c) for c in ("missing", "changed", "added")])
    listed = spark.createDataFrame([(n, n in there) for n in names], "table_name string, there boolean")
    counted = listed.join(counts, "table_name", "left").na.fill(0)
    return counted.selectExpr(
        "table_name", "there AND missing + changed + added = 0 AS intact", "missing", "changed", "added"
    )


def remove_superseded(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders and manifests of all but the last ``keep`` published runs. Runs
    without a manifest stay: they may still be at work."""
    if keep < 1:
        raise ValueError("the current result is always kept")
    numbers = sorted(_numbers(spark, root))
    entries = {n: _read(spark, root, n)["run"] for n in numbers}
    stay = {entries[n] for n in numbers[-keep:]}
    for number in numbers[:-keep]:
        if entries[number] not in stay:
            remove_folder(spark, f"{root.rstrip('/')}/{RUNS}/{entries[number]}")
        remove_folder(spark, f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json")
    return sorted({entries[n] for n in numbers[:-keep]} - stay)


def file_sums(spark: SparkSession, folder: str, tables: Sequence[str]) -> DataFrame:
    """One row per file that has rows: table_name, file (below the table), bytes, rows and
    the sum of its rows' hashes. Rows collapse in the scanning tasks."""
    parts = spark.createDataFrame([], "table_name string, file string, bytes bigint, `rows` bigint, hashes decimal(38,0)")
    run = folder.rstrip("/").rsplit("/", 1)[1]
    for name in tables:
        path = f"{folder}/{name}"
        read = spark.read.parquet(path) if name.endswith("_parquet") else spark.read.text(path)
        file, size, number = (unused(read, c) for c in ("file of row", "size of file", "hash of row"))
        place = F.substring_index("_metadata.file_path", f"/{run}/{name}/", -1)
        rows = comparable(read.select("*", place.alias(file), F.col("_metadata.file_size").alias(size)))
        hashed = rows.select(file, size, F.xxhash64(*map(field, read.columns)).alias(number))
        parts = parts.unionByName(
            hashed.groupBy(F.col(quoted(file)).alias("file"), F.col(quoted(size)).alias("bytes"))
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(F.col(quoted(number)).cast("decimal(20,0)")).cast("decimal(38,0)").alias("hashes"),
            )
            .withColumn("table_name", F.lit(name))
        )
    return parts


def _per_table(files: DataFrame) -> DataFrame:
    return files.groupBy("table_name").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("hashes").cast("string").alias("checksum"),
    )


def written_tables(spark: SparkSession, folder: str) -> list[str]:
    """Finished tables below ``folder``, at any depth, by their path in it. Lists folders
    that hold no table only, so not the files of tables."""
    found, waiting = [], [""]
    while waiting:
        below = waiting.pop()
        for status in _list(spark, f"{folder}/{below}"):
            name = below + status.getPath().getName()
            if not status.isDirectory() or status.getPath().getName().startswith(("_", ".")):
                continue
            if _exists(spark, f"{folder}/{name}/_SUCCESS"):
                found.append(name)
            else:
                waiting.append(f"{name}/")
    return [n for n in found if n != FILES]


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _list(spark: SparkSession, path: str) -> list:
    place, system = _hadoop(spark, path)
    return list(system.listStatus(place)) if system.exists(place) else []


def _exists(spark: SparkSession, path: str) -> bool:
    place, system = _hadoop(spark, path)
    return system.exists(place)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [s.getPath().getName() for s in _list(spark, f"{root.rstrip('/')}/{MANIFESTS}")]
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def _read(spark: SparkSession, root: str, number: int) -> dict[str, Any]:
    path = f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json"
    return {"number": number, **json.loads(spark.read.text(path, wholetext=True).first().value)}


def _appear(spark: SparkSession, path: str, text: str) -> bool:
    """A whole file at ``path`` or nothing; false if there is one already."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    place, system = _hadoop(spark, path)
    passing = jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    out = system.create(passing, False)
    out.write(bytearray(text.encode()))
    out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    try:  # without the option to overwrite
        files.rename(system.makeQualified(passing), system.makeQualified(place), gateway.new_array(rename, 0))
    except Py4JJavaError as error:
        system.delete(passing, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True
