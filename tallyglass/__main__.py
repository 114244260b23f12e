"""Full batch run from the command line, for ``python -m`` or ``spark-submit``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tallyglass.plans.run import RunOptions, full_run, published_run
from tallyglass.schema import TXN_SCHEMA
from tallyglass.session import prepare
from tallyglass.sources.results import FORMATS


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyglass", description=__doc__)
    parser.add_argument("input", help="transactions: headered CSV or a columnar table")
    parser.add_argument("output", help="root folder of results and reports")
    parser.add_argument("--source-format", default="csv")
    parser.add_argument("--infer-schema", action="store_true")
    parser.add_argument("--formats", nargs="+", choices=FORMATS, default=list(FORMATS))
    parser.add_argument("--no-quality-checks", action="store_true")
    parser.add_argument("--keep-cleaned", action="store_true")
    parser.add_argument("--drop-nan", action="store_true")
    parser.add_argument("--duplicates", choices=("auto", "rows", "hash"), default="auto")
    parser.add_argument("--cleanup", action="store_true", help="remove the landed input in the end")
    parser.add_argument("--publish", action="store_true", help="replace all results at once, by manifest")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Run and show the outcome; 1 when a result or the report is missing or the
    cleaned table misses the gate."""
    args = arguments(argv)
    spark = prepare(SparkSession.builder.appName("tallyglass").getOrCreate())
    options = RunOptions(
        schema=None if args.infer_schema else TXN_SCHEMA,
        source_format=args.source_format,
        formats=args.formats,
        quality_checks=not args.no_quality_checks,
        keep_cleaned=args.keep_cleaned,
        drop_nan=args.drop_nan,
        duplicates=args.duplicates,
        cleanup=args.cleanup,
    )
    run = (published_run if args.publish else full_run)(spark, args.input, args.output, options)
    run.present.show(truncate=False)
    run.audit.show(truncate=False)
    if run.gate is None:
        return 0 if run.results_complete else 1
    run.alerts.show(truncate=False)
    run.gate.show(truncate=False)
    return 0 if run.results_complete and not run.gate.filter("passed").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
