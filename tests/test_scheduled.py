import pytest

from tallyglass.operators.analytics import latest_sale_per_address, location_risk
from tallyglass.operators.cleaning import clean_audit, clean_transactions, raw_and_cleaned
from tallyglass.plans.report import quality_report_pair, report_details
from tallyglass.plans.run import RunOptions
from tallyglass.schema import TXN_SCHEMA
from tallyglass.streaming.row_index import RowIndex
from tallyglass.streaming.scheduled import INPUT_FILE, MALFORMED, RunState, scheduled_run
from tallyglass.streaming.state import PartTable


def rounded(df):
    """Rows as text, doubles to nine digits."""
    return sorted(str([f"{v:.9g}" if isinstance(v, float) else v for v in row]) for row in df.collect())


def received(df):
    return df.selectExpr("*", f"CAST(NULL AS STRING) AS {MALFORMED}", f"'f' AS {INPUT_FILE}")


@pytest.fixture(scope="module")
def increments(sample, transactions):
    """Copies inside and across them, late and tied sales, nulls, NaN and dropped rows."""
    second = transactions(
        {"receiving_address": "0xcc", "timestamp": 1694024265, "amount": 99999.0},
        {"receiving_address": "0xcc", "timestamp": 1, "amount": 7.0},
        {"location_region": "Europe", "risk_score": "NaN", "transaction_type": "transfer"},
        {"location_region": None},
        {"amount": -1.0},
        {"amount": -1.0},
    )
    third = sample.limit(5).unionByName(second.limit(2)).unionByName(
        transactions({"risk_score": "none"}, {"risk_score": "bad"}, {"risk_score": None}, {"amount": None})
    )
    return [sample, second, third]


def all_of(increments):
    whole = increments[0]
    for part in increments[1:]:
        whole = whole.unionByName(part)
    return whole


def test_three_increments_give_the_batch_results(spark, increments, tmp_path):
    options = RunOptions(report_time="T0")
    state = RunState(str(tmp_path / "out"), options)
    # The second batch is repeated, as after a start that was killed.
    for batch in (0, 1, 1, 2):
        state.add(received(increments[batch]), batch)
    whole = all_of(increments)
    cleaned = clean_transactions(whole)
    assert rounded(state.location_risk(spark)) == rounded(location_risk(cleaned))
    assert rounded(state.latest_sales(spark)) == rounded(latest_sale_per_address(cleaned))
    assert rounded(state.clean_audit(spark)) == rounded(clean_audit(whole))
    expected = quality_report_pair(whole, report_time="T0", duplicates="rows")
    assert rounded(report_details(state.reports(spark))) == rounded(report_details(expected))
    dropped = RunState(str(tmp_path / "out"), RunOptions(drop_nan=True))
    assert rounded(dropped.location_risk(spark)) == rounded(location_risk(cleaned, drop_nan=True))


def test_starts_read_new_files_only_and_write_all_results(spark, increments, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    whole = None
    for part in increments[:2]:
        part.coalesce(1).write.mode("append").option("header", True).csv(folder)
        whole = part if whole is None else whole.unionByName(part)
        run = scheduled_run(spark, folder, root, RunOptions(report_time="T0"))
        assert run.results_complete
        assert rounded(run.audit) == rounded(clean_audit(whole))
        expected = quality_report_pair(whole, report_time="T0", duplicates="rows")
        assert rounded(report_details(run.reports)) == rounded(report_details(expected))
        assert rounded(run.location_risk) == rounded(location_risk(clean_transactions(whole)))
        assert run.cleaned.count() == clean_transactions(whole).count()
    again = scheduled_run(spark, folder, root, RunOptions(report_time="T0"))
    assert rounded(again.audit) == rounded(run.audit)
    assert len([p for p in (tmp_path / "out" / "raw_data_parquet").iterdir() if "batch=" in p.name]) == 2


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = scheduled_run(spark, str(tmp_path / "in"), str(tmp_path / "out"), RunOptions(report_time="T0"))
    assert run.location_risk.count() == run.top_sales.count() == 0
    assert [r.basic_metrics.total_records for r in run.reports.collect()] == [0, 0]
    assert run.audit.first().initial_records == 0


@pytest.mark.parametrize("hashed", ["hash", "0", "hash % 3"])
def test_different_rows_are_counted_whatever_the_hash(spark, increments, tmp_path, hashed):
    landed = PartTable(str(tmp_path / "rows"))
    index = RowIndex(str(tmp_path / "state"), landed.path, raw_and_cleaned, ("timestamp_readable",), 4, hashed)
    whole = None
    for batch in (0, 1, 1, 2):
        index.add(landed.write(increments[batch], batch), batch)
    for part in increments:
        whole = part if whole is None else whole.unionByName(part)
    surplus = index.surplus(spark).first()
    cleaned = clean_transactions(whole)
    assert surplus.raw_surplus == whole.count() - whole.distinct().count()
    assert surplus.cleaned_surplus == cleaned.count() - cleaned.distinct().count()


def test_look_ups_read_matching_buckets_and_files_of_suspects(spark, transactions, tmp_path):
    landed = PartTable(str(tmp_path / "rows"))
    index = RowIndex(str(tmp_path / "state"), landed.path, raw_and_cleaned, ("timestamp_readable",), 16)
    for batch in range(3):
        rows = transactions(*[{"timestamp": 1000 * batch + i} for i in range(60)])
        index.add(landed.write(rows.coalesce(1), batch), batch)
    one = landed.write(transactions({"timestamp": 2005}).coalesce(1), 3)
    hashes = index._versions(one).selectExpr("side", "hash", "CAST(pmod(hash, 16) AS INT) AS bucket")
    known = index.known(spark, 3, hashes)
    plan = known._jdf.queryExecution().executedPlan()
    plan.execute()
    assert "PartitionFilters: [" in plan.toString() and "bucket" in plan.toString().split("PartitionFilters")[1]
    buckets = {r.bucket for r in hashes.collect()}
    everything = index.entries.read(spark, "side int, hash bigint, file string, place bigint, bucket int")
    assert 0 < known.count() < everything.count() * (len(buckets) + 1) / 16
    suspects = known.join(hashes.select("side", "hash"), ["side", "hash"], "left_semi")
    old = index._fetched(one, suspects)
    assert old.count() == 2 and all("batch=2" in r.file for r in suspects.collect())
    scanned = [f for f in old.inputFiles() if "/rows/" in f and "batch=3" not in f]  # batch 3 is the new one
    assert len(scanned) == 1 and "batch=2" in scanned[0]
    index.add(one, 3)
    assert tuple(index.surplus(spark).first()) == (1, 1)


def test_parts_are_replaced_and_hidden_from_their_own_batch(spark, tmp_path):
    table = PartTable(str(tmp_path / "t"))
    kind = "id bigint"
    assert table.read(spark, kind).count() == 0
    for batch, n in ((0, 3), (1, 5), (1, 2)):
        table.write(spark.range(n), batch)
    assert table.read(spark, kind).count() == 5
    assert table.read(spark, kind, before=1).count() == 3


def test_columns_of_states_follow_the_declared_schema(spark, tmp_path):
    state = RunState(str(tmp_path), RunOptions())
    assert state.received.fieldNames() == [*TXN_SCHEMA.fieldNames(), MALFORMED, INPUT_FILE]
