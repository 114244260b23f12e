from tallyglass.operators.analytics import location_risk, top_sale_addresses
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.sources import results
from tallyglass.streaming.incremental import add_new_files, refresh_results


def drop(df, folder):
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_each_file_is_cleaned_once(spark, sample, transactions, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    drop(sample, folder)
    assert add_new_files(spark, folder, root).count() == 17
    assert add_new_files(spark, folder, root).count() == 17
    drop(transactions({"amount": 5.0}, {"amount": -5.0}, {"risk_score": "bad"}), folder)
    assert add_new_files(spark, folder, root).count() == 19


def test_increments_equal_one_batch(spark, sample, transactions, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    late = transactions(
        {"receiving_address": "0xcc", "timestamp": 1694024265, "amount": 99999.0},
        {"location_region": "Europe", "risk_score": "80", "transaction_type": "transfer"},
    )
    drop(sample, folder)
    refresh_results(spark, folder, root)
    drop(late, folder)
    cleaned = refresh_results(spark, folder, root)

    batch = clean_transactions(sample.unionByName(late))
    assert as_rows(cleaned) == as_rows(batch)
    for name, expected in (
        ("location_risk_analysis", location_risk(batch)),
        ("top_sale_addresses", top_sale_addresses(batch)),
    ):
        assert as_rows(results.read_result(spark, root, name)) == as_rows(expected)
