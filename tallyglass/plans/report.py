"""The nested quality report: one row per table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField

from tallyglass.fixed_values import CLEANED_TABLE, RAW_TABLE
from tallyglass.functions.columns import field, quoted, record, text
from tallyglass.functions.rounding import percentage
from tallyglass.functions.time import NOW
from tallyglass.operators.cleaning import BothTables, raw_and_cleaned
from tallyglass.operators.duplicates import (
    duplicate_profile,
    share,
    surplus_of_both,
    surplus_rows,
    uses_hash,
)
from tallyglass.operators.profile_state import COLUMN_STATE, Measured, merged, state_array, table_states
from tallyglass.operators.profiling import (
    AnomalyRule,
    applicable_rules,
    metrics_of_state,
    table_metrics,
    transaction_anomaly_rules,
    type_listing,
    violation,
)
from tallyglass.operators.quality import score
from tallyglass.schema import MALFORMED

# A function of the time, so equal rows agree in it anyway.
READABLE = "timestamp_readable"


def quality_report(
    df: DataFrame,
    table_name: str = "dataset",
    report_time: str | None = None,
    anomaly_rules: Sequence[AnomalyRule] | None = None,
    statistics: bool = True,
    duplicates: str = "auto",
    derived: Sequence[str] = (),
) -> DataFrame:
    """All checks of one table as one nested row.

    Two scans: one aggregate for everything that needs no shuffle of rows, one
    grouping for identical rows. Reports of several tables go together with
    ``unionByName``. ``report_time`` is the current time unless given;
    ``duplicates`` and ``derived`` are those of ``duplicate_profile``; counting by
    hash runs jobs, and the number of rows comes from the first scan.
    """
    rules = transaction_anomaly_rules() if anomaly_rules is None else anomaly_rules
    metrics = table_metrics(df, statistics=statistics, anomaly_rules=rules).selectExpr("struct(*) AS m")
    compared = df.drop(*derived)
    if uses_hash(compared, duplicates):
        row = metrics.selectExpr("m", f"{surplus_rows(compared)}L AS surplus")
    else:
        copies = duplicate_profile(compared, method="rows")
        row = _beside(metrics, copies.selectExpr("duplicate_count AS surplus"))
    return row.selectExpr(f"inline(array({_report_of('m', 'surplus', df.dtypes, table_name, report_time)}))")


def quality_report_pair(
    raw: DataFrame,
    names: tuple[str, str] = (RAW_TABLE, CLEANED_TABLE),
    report_time: str | None = None,
    anomaly_rules: Sequence[AnomalyRule] | None = None,
    statistics: bool = True,
    duplicates: str = "auto",
) -> DataFrame:
    """The reports of a raw table and of what cleaning keeps of it, two rows.

    Cleaning is row-wise, so one scan measures both: apart for rows that survive and
    rows that do not, the raw columns and those that cleaning changes. Both groups
    together are the raw table, the survivors the cleaned one. Identical rows of both
    tables are counted together as well.
    """
    measures = PairMeasures.of(raw, anomaly_rules, statistics)
    states = measures.of_tables(table_states(measures.both.rows, measures.measured, measures.both.survives))
    surplus = surplus_of_both(measures.both, (READABLE,), duplicates)
    return measures.reports(states, surplus, names, report_time)


@dataclass(frozen=True)
class PairMeasures:
    """What is measured of a raw table and of what cleaning keeps of it. ``measured`` is
    taken per value of ``both.survives``; ``picked`` says for each table which of its
    columns and rules the table's own are."""

    both: BothTables
    measured: dict[str, Measured]
    fields: dict[str, list[StructField]]
    rules: dict[str, list[AnomalyRule]]
    picked: dict[str, tuple[list[int], list[int]]]
    statistics: bool

    @classmethod
    def of(
        cls,
        raw: DataFrame,
        anomaly_rules: Sequence[AnomalyRule] | None = None,
        statistics: bool = True,
        carried: Sequence[str] = (),
    ) -> PairMeasures:
        """``carried`` names columns of ``raw`` that are no part of the tables."""
        rules = transaction_anomaly_rules() if anomaly_rules is None else anomaly_rules
        raw = raw.drop(MALFORMED)
        flags = {f"raw violates {i}": violation(raw, r) for i, r in enumerate(applicable_rules(raw, rules))}
        both = raw_and_cleaned(raw, flags, carried)
        schema = both.rows.schema
        cleaned = both.rows.select(*map(field, both.cleaned))
        applied = {"raw": applicable_rules(raw, rules), "cleaned": applicable_rules(cleaned, rules)}
        changed = [c for c in both.cleaned if c in both.changed]
        places = {c: i for i, c in enumerate(both.raw)}
        places_of_cleaned = {**places, **{c: len(places) + i for i, c in enumerate(changed)}}
        conditions = [*map(quoted, flags)]
        picked_rules = []
        for rule in applied["cleaned"]:
            if rule.column in changed:
                picked_rules.append(len(conditions))
                conditions.append(violation(cleaned, rule))
            else:
                picked_rules.append(applied["raw"].index(rule))
        names = [*both.raw.values(), *(both.cleaned[c] for c in changed)]
        measured = Measured([(n, schema[n].dataType) for n in names], conditions, statistics=statistics)
        fields = {
            side: [StructField(c, schema[new].dataType) for c, new in columns.items()]
            for side, columns in (("raw", both.raw), ("cleaned", both.cleaned))
        }
        picked = {
            "raw": (list(places.values()), list(range(len(flags)))),
            "cleaned": ([places_of_cleaned[c] for c in both.cleaned], picked_rules),
        }
        return cls(both, {"state": measured}, fields, applied, picked, statistics)

    def of_tables(self, states: DataFrame) -> DataFrame:
        """One row with the state of either table, from states per value of ``survives``."""
        sides = {}
        for side, (columns, rules) in self.picked.items():
            own = record(
                total="state.total",
                columns=state_array([f"state.columns[{i}]" for i in columns], COLUMN_STATE),
                anomalies=state_array([f"state.anomalies[{i}]" for i in rules], "bigint"),
            )
            sides[side] = own if side == "raw" else f"IF({quoted(self.both.survives)}, {own}, NULL)"
        return merged(states.selectExpr(*[f"{own} AS {side}" for side, own in sides.items()]), list(sides))

    def reports(
        self, states: DataFrame, surplus: DataFrame, names: tuple[str, str] = (RAW_TABLE, CLEANED_TABLE), report_time: str | None = None
    ) -> DataFrame:
        """The two reports from one row of states (raw, cleaned) and one of surplus rows
        (raw_surplus, cleaned_surplus)."""
        metrics = {
            side: metrics_of_state(side, list(enumerate(fields)), self.rules[side], statistics=self.statistics)
            for side, fields in self.fields.items()
        }
        row = _beside(
            states.selectExpr(*[f"struct({', '.join(m)}) AS m_{side}" for side, m in metrics.items()]), surplus
        )
        reports = [
            _report_of(
                f"m_{side}", f"{side}_surplus", [(f.name, f.dataType.simpleString()) for f in fields], name, report_time
            )
            for (side, fields), name in zip(self.fields.items(), names)
        ]
        return row.selectExpr(f"inline(array({', '.join(reports)}))")


def _beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two tables of one row as one row, without a join."""
    names = [*one.columns, *other.columns]
    rows = one.unionByName(other, allowMissingColumns=True)
    return rows.selectExpr(*[f"first({quoted(n)}, true) AS {quoted(n)}" for n in names])


def _report_of(
    m: str, surplus: str, dtypes: Sequence[tuple[str, str]], table_name: str, report_time: str | None
) -> str:
    """A report as an expression of the metrics ``m`` and the number of surplus rows."""
    copies = share(f"{m}.total_records", surplus)
    null_columns = f"size(filter({m}.missing, x -> x.missing > 0))"
    null_detail = record(
        column="x.column",
        null_count="x.missing",
        null_percentage=percentage("x.missing", f"{m}.total_records"),
    )
    statistic = record(**{n: f"x.{n}" for n in ("count", "mean", "stddev", "min", "max")})
    type_counts = ", ".join(f"{text(t)}, {n}" for t, n in Counter(t for _, t in dtypes).items())
    return record(
        table_name=text(table_name),
        timestamp=NOW if report_time is None else text(report_time),
        basic_metrics=record(total_records=f"{m}.total_records", total_columns=str(len(dtypes))),
        null_analysis=record(
            null_details=f"transform({m}.missing, x -> {null_detail})",
            columns_with_nulls=null_columns,
        ),
        duplicate_analysis=copies,
        data_types_analysis=record(
            data_types=type_listing(dtypes),
            type_distribution=f"CAST(map({type_counts}) AS map<string,int>)",
        ),
        statistical_analysis=record(
            numeric_columns=f"transform({m}.statistics, x -> x.column)",
            statistics=f"map_from_entries(transform({m}.statistics, x -> struct(x.column, {statistic})))",
        ),
        anomalies=f"{m}.anomalies",
        quality_score=score(null_columns, f"{copies}.duplicate_percentage", f"size({m}.anomalies)"),
    )


def report_details(reports: DataFrame) -> DataFrame:
    """The measured parts of nested reports as flat rows
    (table_name, section, item, measure, value), from one pass over them."""

    def entries(section: str, item: str, measures: dict[str, str]) -> str:
        rows = ", ".join(
            record(
                section=text(section), item=item, measure=text(m), value=f"CAST({v} AS DOUBLE)"
            )
            for m, v in measures.items()
        )
        return f"array({rows})"

    def fields_of(prefix: str, *names: str) -> dict[str, str]:
        return {name: f"{prefix}.{name}" for name in names}

    nulls = entries("nulls", "x.column", fields_of("x", "null_count", "null_percentage"))
    statistics = entries(
        "statistics", "x.key", fields_of("x.value", "count", "mean", "stddev", "min", "max")
    )
    anomalies = entries("anomalies", "x.type", {"count": "x.count"})
    copies = entries(
        "duplicates",
        "'rows'",
        fields_of(
            "duplicate_analysis",
            "total_records",
            "unique_records",
            "duplicate_count",
            "duplicate_percentage",
        ),
    )
    overall = entries(
        "overall",
        "'table'",
        {
            "total_columns": "basic_metrics.total_columns",
            "columns_with_nulls": "null_analysis.columns_with_nulls",
            "quality_score": "quality_score",
        },
    )
    return reports.selectExpr(
        "table_name",
        f"inline(concat(flatten(transform(null_analysis.null_details, x -> {nulls})), "
        f"flatten(transform(map_entries(statistical_analysis.statistics), x -> {statistics})), "
        f"flatten(transform(anomalies, x -> {anomalies})), {copies}, {overall}))",
    )
