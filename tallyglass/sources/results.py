"""Writing results and reading them back. These functions run jobs.

Below one root folder a result has one folder per format:
``<name>_parquet``, ``<name>.csv`` and ``<name>.json``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tallyglass.fixed_values import CLEANED_TABLE
from tallyglass.functions.columns import field, quoted
from tallyglass.functions.rounding import round_scaled
from tallyglass.operators.quality import quality_summary
from tallyglass.schema import REPORT_STRUCT
from tallyglass.session import remove_folder, shared_folder

FORMATS = ("parquet", "csv", "json")
REPORT = "quality_report"
SUMMARY = "quality_summary"


def result_path(root: str, name: str, result_format: str) -> str:
    suffix = "_parquet" if result_format == "parquet" else f".{result_format}"
    return f"{root.rstrip('/')}/{name}{suffix}"


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace a Parquet table. ``single_file`` is for small results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)


# Quotes are doubled inside quotes, spaces stay, and an empty text is told from a
# missing value by its quotes.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CSV_WRITTEN = CSV_OPTIONS | {"nullValue": "", "emptyValue": '""'}
# The reader gives a missing cell this text, which no cell has, before it makes it null.
CSV_READ = CSV_OPTIONS | {"nullValue": "\x00missing\x00", "emptyValue": ""}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace a headered CSV table."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_WRITTEN).csv(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace a table of one JSON object per line; nulls are kept."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


WRITERS = {"parquet": write_parquet, "csv": write_csv, "json": write_json}


def write_result(
    df: DataFrame,
    root: str,
    name: str,
    formats: Sequence[str] = FORMATS,
    rounded: Mapping[str, int] | None = None,
    single_file: bool = False,
    nan_as_null: bool = False,
    order: Sequence[Column] = (),
    exact_path: str | None = None,
) -> None:
    """Write one result in several formats but compute it once.

    The first Parquet copy holds the exact values; CSV and JSON are written
    from it with the columns of ``rounded`` rounded to that many digits and,
    with ``nan_as_null``, without the word NaN, which JSON has no number for.
    Reading the copy back may interleave its files, so a result whose rows are
    ordered says how in ``order``. They are sorted by ranges, which numbered files keep;
    a small result is one range. Where Parquet is not asked for, the copy goes to
    ``exact_path`` and stays, or is removed in the end.
    """
    check_formats(formats)
    texts = [f for f in formats if f != "parquet"]
    source, exact, passing = df, exact_path, None
    if "parquet" in formats:
        exact = result_path(root, name, "parquet")
    elif exact is None and len(texts) > 1:
        exact = passing = shared_folder(df.sparkSession)
    if exact:
        write_parquet(df, exact, single_file)
        source = df.sparkSession.read.schema(df.schema).parquet(exact)
        if order:
            source = source.coalesce(1).sortWithinPartitions(*order) if single_file else source.orderBy(*order)
    shown = source.withColumns(
        {c: F.expr(round_scaled(quoted(c), digits)) for c, digits in (rounded or {}).items()}
    )
    if nan_as_null:
        fractions = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
        shown = shown.withColumns({c: F.nanvl(field(c), F.lit(None)) for c in fractions})
    for text_format in texts:
        WRITERS[text_format](shown, result_path(root, name, text_format), single_file)
    if passing:
        remove_folder(df.sparkSession, passing)


def check_formats(formats: Sequence[str]) -> None:
    unknown = [f for f in formats if f not in WRITERS]
    if unknown or not formats:
        raise ValueError(f"unknown format(s): {', '.join(unknown) or 'none given'}")


def read_result(
    spark: SparkSession,
    root: str,
    name: str,
    result_format: str = "parquet",
    schema: StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read back what ``write_result`` wrote.

    ``multi_line`` keeps line breaks inside CSV text together; each file is then
    read by one task, so a large table without such text should turn it off.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if result_format == "csv":
        reader = reader.options(**CSV_READ, multiLine=multi_line)
        if schema is None:
            reader = reader.option("inferSchema", True)
    return reader.format(result_format).load(result_path(root, name, result_format))


def results_present(
    spark: SparkSession,
    root: str,
    expected: Mapping[str, Sequence[str]],
    result_format: str = "parquet",
    strict: bool = False,
) -> DataFrame:
    """One row per expected result (result, present, rows, columns_ok).

    ``expected`` maps result names to their column names. With ``strict`` a
    result that cannot be read raises Spark's own error at once.
    """
    checks = None
    for name, columns in expected.items():
        try:
            written = read_result(spark, root, name, result_format)
            present, columns_ok = True, written.columns == list(columns)
            if result_format == "json":  # objects have no order
                columns_ok = sorted(written.columns) == sorted(columns)
            row = written.agg(F.count(F.lit(1)).alias("rows"))
        except AnalysisException:
            if strict:
                raise
            present, columns_ok = False, False
            row = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        check = row.select(
            F.lit(name).alias("result"),
            F.lit(present).alias("present"),
            "rows",
            F.lit(columns_ok).alias("columns_ok"),
        )
        checks = check if checks is None else checks.unionByName(check)
    return checks


def report_document(reports: DataFrame) -> DataFrame:
    """All reports as one JSON document keyed by table name (column ``value``).

    One row per profiled table goes in, so the document stays small.
    """
    body = F.struct(*[field(c) for c in reports.columns if c != "table_name"])
    entries = F.collect_list(F.struct(F.col("table_name"), body))
    options = {"pretty": "true", "ignoreNullFields": "false"}
    return reports.agg(F.to_json(F.map_from_entries(entries), options).alias("value"))


def write_quality_report(reports: DataFrame, root: str) -> None:
    """``quality_report.json``: the nested reports of all tables."""
    document = report_document(reports)
    document.coalesce(1).write.mode("overwrite").text(result_path(root, REPORT, "json"))


def read_quality_report(spark: SparkSession, root: str) -> DataFrame:
    """Reports written by ``write_quality_report``, one row per table, for
    alerts and gates that run later. A missing report raises Spark's error."""
    document = spark.read.text(result_path(root, REPORT, "json"), wholetext=True)
    tables = F.from_json("value", f"map<string,{REPORT_STRUCT}>")
    return document.select(F.explode(tables).alias("table_name", "report")).select(
        "table_name", "report.*"
    )


def write_quality_summary(
    reports: DataFrame, root: str, table_name: str = CLEANED_TABLE
) -> None:
    """``quality_summary.txt``: the text summary, its lines in order."""
    lines = quality_summary(reports, table_name)
    ordered = F.array_sort(F.collect_list(F.struct("line_number", "line")))
    text = lines.agg(F.array_join(ordered["line"], "\n").alias("value"))
    text.coalesce(1).write.mode("overwrite").text(result_path(root, SUMMARY, "txt"))
