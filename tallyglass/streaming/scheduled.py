"""The scheduled run: everything the full run gives, at the cost of the new files.

Each start takes the files that arrived since the last one as one batch or several. A
batch is landed as Parquet and adds a part to every state table: profile states
per input file (raw and cleaned), audit counts, the index of different rows, sums per
region, and the latest sale of every address it has. Results, report, gate and
history are then made from the states, which equal those of one run over all
files up to the last digits of means. A batch that is repeated replaces its parts.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyglass.fixed_values import RAW_TABLE, RISK_RESULT, SALES_RESULT
from tallyglass.functions.columns import quoted
from tallyglass.operators.analytics import (
    filter_valid_risk,
    highest_risk_first,
    latest_sale_per_address,
    top_sale_addresses,
)
from tallyglass.operators.cleaning import clean_audit, clean_transactions, raw_and_cleaned
from tallyglass.operators.profile_state import STATE, merge_states, states_by
from tallyglass.operators.profiling import transaction_anomaly_rules
from tallyglass.plans.report import READABLE, PairMeasures
from tallyglass.plans.run import RunOptions, RunResult, write_analyses, write_reports
from tallyglass.schema import MALFORMED, TXN_SCHEMA
from tallyglass.session import prepare
from tallyglass.streaming.row_index import RowIndex
from tallyglass.streaming.state import PartTable

INPUT_FILE = "input_file"
RISK_SUMS = "location_region string, total double, scores bigint, not_numbers bigint"
FILE_STATES = f"{INPUT_FILE} string, survives boolean, state {STATE}"


class RunState:
    """The state tables below ``root``."""

    def __init__(self, root: str, options: RunOptions = RunOptions()):
        base = root.rstrip("/")
        self.options = options
        self.schema = options.schema if isinstance(options.schema, StructType) else TXN_SCHEMA
        text = [StructField(c, StringType()) for c in (MALFORMED, INPUT_FILE)]
        self.received = StructType([*self.schema, *text])
        self.rows = PartTable(f"{base}/{RAW_TABLE}_parquet")
        self.profile, self.audit = PartTable(f"{base}/state/profile"), PartTable(f"{base}/state/audit")
        self.risk, self.sales = PartTable(f"{base}/state/risk"), PartTable(f"{base}/state/sales")
        self.index = RowIndex(f"{base}/state", self.rows.path, raw_and_cleaned, (READABLE, INPUT_FILE))

    def measures(self, raw: DataFrame) -> PairMeasures:
        rules = transaction_anomaly_rules(self.options.reference_epoch)
        return PairMeasures.of(raw, rules, carried=(INPUT_FILE,))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Land a batch and add its parts. Runs jobs; may be repeated."""
        landed = self.rows.write(rows, batch)
        received = landed.drop(INPUT_FILE)
        cleaned = clean_transactions(received)
        measures = self.measures(landed)
        states = states_by(measures.both.rows, measures.measured, INPUT_FILE, measures.both.survives)
        self.profile.write(states.withColumnRenamed(measures.both.survives, "survives"), batch)
        self.audit.write(clean_audit(received), batch)
        self.risk.write(risk_sums(cleaned), batch)
        self.sales.write(latest_sale_per_address(cleaned), batch)
        if self.options.quality_checks:
            self.index.add(landed, batch)

    # ---------------------------------------------------------- what states give

    def raw(self, spark: SparkSession) -> DataFrame:
        return self.rows.read(spark, self.received).drop(INPUT_FILE)

    def location_risk(self, spark: SparkSession) -> DataFrame:
        return merged_risk(self.risk.read(spark, RISK_SUMS), self.options.drop_nan)

    def latest_sales(self, spark: SparkSession) -> DataFrame:
        """The latest of the batches' latest sales is the latest of all."""
        kind = clean_transactions(spark.createDataFrame([], self.schema)).schema
        return latest_sale_per_address(self.sales.read(spark, kind))

    def clean_audit(self, spark: SparkSession) -> DataFrame:
        kind = clean_audit(spark.createDataFrame([], self.schema)).schema
        return self.audit.read(spark, kind).selectExpr(
            *[f"coalesce(sum({quoted(f.name)}), 0) AS {quoted(f.name)}" for f in kind]
        )

    def reports(self, spark: SparkSession) -> DataFrame:
        measures = self.measures(spark.createDataFrame([], self.schema))
        states = merge_states(self.profile.read(spark, FILE_STATES), ["state"], "survives")
        states = measures.of_tables(states.withColumnRenamed("survives", measures.both.survives))
        return measures.reports(states, self.index.surplus(spark), report_time=self.options.report_time)


def risk_sums(cleaned: DataFrame) -> DataFrame:
    """Per region what means of any union of tables can be made from."""
    number = "NOT isnan(risk_score)"
    return filter_valid_risk(cleaned).groupBy("location_region").agg(
        F.expr(f"sum(risk_score) FILTER (WHERE {number})").alias("total"),
        F.expr(f"count_if({number})").alias("scores"),
        F.expr("count_if(isnan(risk_score))").alias("not_numbers"),
    )


def merged_risk(sums: DataFrame, drop_nan: bool = False) -> DataFrame:
    """As ``location_risk`` over all rows that the sums are of."""
    merged = sums.groupBy("location_region").agg(*[F.sum(c).alias(c) for c in ("total", "scores", "not_numbers")])
    if drop_nan:
        merged = merged.filter("scores > 0")
    spoilt = "false" if drop_nan else "not_numbers > 0"
    mean = F.expr(f"IF({spoilt}, double('NaN'), total / scores)").alias("avg_risk_score")
    return merged.select("location_region", mean).orderBy(*highest_risk_first())


def scheduled_run(
    spark: SparkSession, folder: str, root: str, options: RunOptions = RunOptions()
) -> RunResult:
    """Take in the files below ``folder`` (a path or glob of headered CSV) that no earlier
    start has, and write all results anew. Runs jobs."""
    prepare(spark)
    options = replace(options, keep_cleaned=False)
    state = RunState(root, options)
    reader = spark.readStream.schema(StructType([*state.schema, StructField(MALFORMED, StringType())]))
    reader = reader.option("header", True).option("enforceSchema", False)
    arrived = reader.option("columnNameOfCorruptRecord", MALFORMED).csv(folder)
    arrived = arrived.withColumn(INPUT_FILE, arrived.metadataColumn("_metadata")["file_path"])
    query = (
        arrived.writeStream.foreachBatch(state.add)
        .option("checkpointLocation", f"{root.rstrip('/')}/_progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results_of_state(spark, root, state)


def results_of_state(spark: SparkSession, root: str, state: RunState) -> RunResult:
    """Everything a run returns, from the states."""
    options = state.options
    risk, sales = state.location_risk(spark), top_sale_addresses(state.latest_sales(spark), options.top)
    exact, present = write_analyses(spark, root, risk, sales, options)
    complete = present.filter("NOT (present AND columns_ok)").isEmpty()
    checked = {}
    if options.quality_checks:
        checked = write_reports(spark, root, state.reports(spark), options, complete)
    return RunResult(
        cleaned=clean_transactions(state.raw(spark)),
        location_risk=exact[RISK_RESULT],
        top_sales=exact[SALES_RESULT],
        present=present,
        audit=state.clean_audit(spark),
        results_complete=complete,
        **checked,
    )
