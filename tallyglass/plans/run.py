"""The full batch run: load, profile, clean, profile, analyse, write, check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyglass.fixed_values import (
    CLEANED_TABLE,
    RAW_TABLE,
    REFERENCE_EPOCH,
    RISK_DIGITS,
    RISK_RESULT,
    RISK_RESULT_COLUMNS,
    SALES_RESULT,
    SALES_RESULT_COLUMNS,
    TOP_ADDRESSES,
)
from tallyglass.operators.analytics import (
    highest_risk_first,
    largest_sale_first,
    location_risk,
    top_sale_addresses,
)
from tallyglass.operators.cleaning import clean_audit, clean_transactions
from tallyglass.operators.profiling import transaction_anomaly_rules
from tallyglass.operators.quality import (
    Thresholds,
    execution_report,
    quality_alerts,
    quality_gate,
    threshold_rules,
)
from tallyglass.plans.report import READABLE, quality_report, quality_report_pair
from tallyglass.schema import MALFORMED, TXN_SCHEMA
from tallyglass.session import input_bytes, own_session, remove_folder, shared_folder
from tallyglass.sources.publication import publish, remove_superseded, written_tables
from tallyglass.sources.results import (
    FORMATS,
    REPORT,
    check_formats,
    result_path,
    results_present,
    write_json,
    write_quality_report,
    write_quality_summary,
    write_result,
)
from tallyglass.sources.transactions import land, land_clustered, load_transactions

AUDIT = "clean_audit"
PRESENT = "results_present"
RUNS = "execution_reports"

EXPECTED_RESULTS = {
    RISK_RESULT: RISK_RESULT_COLUMNS,
    SALES_RESULT: SALES_RESULT_COLUMNS,
}


@dataclass(frozen=True)
class RunOptions:
    """What a run reads, checks and writes."""

    schema: StructType | str | None = TXN_SCHEMA
    source_format: str = "csv"
    formats: Sequence[str] = FORMATS
    quality_checks: bool = True
    keep_cleaned: bool = False
    drop_nan: bool = False
    top: int = TOP_ADDRESSES
    reference_epoch: int = REFERENCE_EPOCH
    report_time: str | None = None
    duplicates: str = "auto"
    thresholds: Thresholds = Thresholds()
    strict_gate: bool = False
    cleanup: bool = False
    clustered: bool = False


@dataclass(frozen=True)
class RunResult:
    """Lazy views of what the run wrote."""

    cleaned: DataFrame
    location_risk: DataFrame
    top_sales: DataFrame
    present: DataFrame
    audit: DataFrame
    results_complete: bool
    reports: DataFrame | None = None
    alerts: DataFrame | None = None
    rules: DataFrame | None = None
    gate: DataFrame | None = None


def full_run(
    spark: SparkSession, path: str, root: str, options: RunOptions = RunOptions()
) -> RunResult:
    """Run everything and write it below ``root``. Runs jobs.

    The run has a session of its own, with shuffles sized by the input. A CSV
    input is landed as Parquet once; all later scans are columnar and read only
    the columns they need. Cleaning is row-wise and recomputed by each reader,
    which costs less than a second copy of the table; with ``clustered`` the landed
    files are sorted by type, so that sales are read without the rest. With ``keep_cleaned`` that
    copy is written and read instead. Results and reports are written once and
    everything derived from them starts from the written tables. Results are
    returned unrounded whatever the formats. With ``cleanup`` the landed input is
    removed in the end, and the cleaned table is read from the input again.
    """
    check_formats(options.formats)
    base = root.rstrip("/")
    columnar = options.source_format != "csv"
    declared = not columnar and options.schema is not None
    load = lambda s: load_transactions(s, path, options.schema, options.source_format, declared)
    spark = own_session(spark, input_bytes(load(spark)))
    if options.quality_checks and options.duplicates != "rows":
        shared_folder(spark)  # refused now rather than after the work
    landed = f"{base}/{RAW_TABLE}_parquet"
    received = load(spark) if columnar else (land_clustered if options.clustered else land)(load(spark), landed)
    raw = received.drop(MALFORMED)
    cleaned = clean_transactions(raw)
    if options.keep_cleaned:
        cleaned = land(cleaned, f"{base}/{CLEANED_TABLE}_parquet")
    audit = land(clean_audit(received), f"{base}/{AUDIT}_parquet")

    risk = location_risk(cleaned, drop_nan=options.drop_nan)
    sales = top_sale_addresses(cleaned, options.top)
    exact, present = write_analyses(spark, root, risk, sales, options)
    complete = present.filter("NOT (present AND columns_ok)").isEmpty()
    kept = cleaned
    if options.cleanup and not columnar and not options.keep_cleaned:
        kept = clean_transactions(load(spark).drop(MALFORMED))
    common = {
        "cleaned": kept,
        "location_risk": exact[RISK_RESULT],
        "top_sales": exact[SALES_RESULT],
        "present": present,
        "audit": audit,
        "results_complete": complete,
    }
    checked = {}
    if options.quality_checks:
        checked = write_reports(spark, root, _pair(raw, cleaned, options), options, complete)
    if options.cleanup and not columnar:
        remove_folder(spark, landed)
    return RunResult(**common, **checked)


def published_run(
    spark: SparkSession, path: str, root: str, options: RunOptions = RunOptions(), keep: int = 2
) -> RunResult:
    """``full_run`` into a folder of its own below ``root``, published by manifest when all of
    it is written. A run that dies leaves the former results current; one that succeeds
    replaces all of them at once and removes those before the last ``keep`` runs. The
    landed input, which is no result, is not in the manifest."""
    outcome = {}

    def write(folder: str) -> list[str]:
        outcome["run"] = full_run(spark, path, folder, options)
        return [t for t in written_tables(spark, folder) if t != f"{RAW_TABLE}_parquet"]

    publish(spark, root, write)
    remove_superseded(spark, root, keep)
    return outcome["run"]


def write_analyses(
    spark: SparkSession, root: str, risk: DataFrame, sales: DataFrame, options: RunOptions
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write both analyses; returns them as written, unrounded, and which are present."""
    base, exact = root.rstrip("/"), {}
    for name, result, digits, order in (
        (RISK_RESULT, risk, {"avg_risk_score": RISK_DIGITS}, highest_risk_first()),
        (SALES_RESULT, sales, None, largest_sale_first()),
    ):
        folder = result_path(root, name, "parquet") if "parquet" in options.formats else f"{base}/exact/{name}"
        write_result(
            result, root, name, options.formats, digits, nan_as_null=True, order=order, exact_path=folder
        )
        exact[name] = spark.read.schema(result.schema).parquet(folder)
    present = results_present(spark, root, EXPECTED_RESULTS, options.formats[0])
    return exact, land(present, f"{base}/{PRESENT}_parquet")


def _pair(raw: DataFrame, cleaned: DataFrame, options: RunOptions) -> DataFrame:
    rules = transaction_anomaly_rules(options.reference_epoch)
    common = {"report_time": options.report_time, "anomaly_rules": rules, "duplicates": options.duplicates}
    if not options.keep_cleaned:
        return quality_report_pair(raw, **common)
    cleaned_report = quality_report(cleaned, CLEANED_TABLE, derived=(READABLE,), **common)
    return quality_report(raw, RAW_TABLE, **common).unionByName(cleaned_report)


def write_reports(
    spark: SparkSession, root: str, reports: DataFrame, options: RunOptions, complete: bool
) -> dict[str, DataFrame]:
    """Write the reports of both tables, and what follows from them."""
    base = root.rstrip("/")
    reports = land(reports, f"{base}/{REPORT}_parquet")
    write_quality_report(reports, root)
    write_quality_summary(reports, root)
    run_report = land(
        execution_report(
            reports,
            options.report_time,
            gate_score=options.thresholds.gate_score,
            results_complete=complete,
        ),
        f"{base}/{RUNS}/{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}_parquet",
    )
    write_json(run_report, result_path(root, "execution_report", "json"), single_file=True)
    return {
        "reports": reports,
        "alerts": quality_alerts(reports, options.thresholds),
        "rules": threshold_rules(reports, options.thresholds),
        "gate": quality_gate(
            reports,
            threshold=options.thresholds.gate_score,
            strict=options.strict_gate,
        ),
    }


def run_history(spark: SparkSession, root: str) -> DataFrame:
    """The report of every run below ``root``; the column ``run`` orders them. Published
    runs that were kept are below ``<root>/runs/*``."""
    reports = spark.read.parquet(f"{root.rstrip('/')}/{RUNS}/*_parquet")
    run = F.regexp_extract(F.input_file_name(), r"([0-9T]+)_parquet", 1)
    return reports.withColumn("run", run)
