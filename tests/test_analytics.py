import math

from conftest import as_dicts
from pyspark.sql import functions as F

from tallyglass.operators import analytics
from tallyglass.operators.cleaning import clean_transactions


def test_known_sample(sample):
    cleaned = clean_transactions(sample)
    risk = [tuple(r) for r in analytics.location_risk_rounded(cleaned).collect()]
    assert risk == [
        ("North America", 52.5),
        ("Africa", 39.12),
        ("South America", 38.36),
        ("Asia", 31.25),
        ("Europe", 17.5),
    ]
    assert [tuple(r) for r in analytics.top_sale_addresses(cleaned).collect()] == [
        ("0xaa", 67617.0, 1629563063, "2021-08-21 16:24:23"),
        ("0xbb", 66002.0, 1611257295, "2021-01-21 19:28:15"),
        ("0xcc", 57325.0, 1694024264, "2023-09-06 18:17:44"),
    ]


def test_unrounded_mean_is_kept(sample):
    rows = {r.location_region: r.avg_risk_score for r in analytics.location_risk(clean_transactions(sample)).collect()}
    assert rows["Africa"] == 39.125


def test_region_without_valid_score_is_absent(transactions):
    df = clean_transactions(transactions({"risk_score": "none"}, {"location_region": "Europe"}))
    assert [r.location_region for r in analytics.location_risk(df).collect()] == ["Europe"]


def test_nan_scores_poison_their_region_unless_dropped(transactions):
    df = clean_transactions(
        transactions({"risk_score": "NaN"}, {}, {"location_region": "Europe", "risk_score": "90"})
    )
    kept = [tuple(r) for r in analytics.location_risk(df).collect()]
    assert kept[0][0] == "Asia" and math.isnan(kept[0][1]) and kept[1] == ("Europe", 90.0)
    dropped = [tuple(r) for r in analytics.location_risk(df, drop_nan=True).collect()]
    assert dropped == [("Europe", 90.0), ("Asia", 20.0)]


def test_equal_means_are_ordered_by_region(transactions):
    df = clean_transactions(transactions(*[{"location_region": r} for r in "cab"]))
    assert [r.location_region for r in analytics.location_risk(df).collect()] == ["a", "b", "c"]


def test_sale_filter_is_case_sensitive(transactions):
    df = transactions(*[{"transaction_type": t} for t in ("sale", "Sale", " sale", "purchase", None)])
    assert analytics.filter_sales(df).count() == 1


def test_latest_sale_breaks_ties(transactions):
    df = clean_transactions(
        transactions(
            {"timestamp": 5, "amount": 1.0, "sending_address": "z"},
            {"timestamp": 9, "amount": 3.0, "sending_address": "b"},
            {"timestamp": 9, "amount": 3.0, "sending_address": "a"},
            {"timestamp": 9, "amount": 2.0, "sending_address": "a"},
            {"timestamp": 7, "amount": 99.0, "receiving_address": "r2"},
        )
    )
    rows = {r.receiving_address: r for r in analytics.latest_sale_per_address(df).collect()}
    assert (rows["r1"].amount, rows["r1"].sending_address) == (3.0, "a")
    assert rows["r2"].amount == 99.0
    assert [r.receiving_address for r in analytics.top_sale_addresses(df).collect()] == ["r2", "r1"]


def test_top_ties_and_k(transactions):
    df = clean_transactions(transactions(*[{"receiving_address": f"r{i}"} for i in range(6)]))
    assert [r.receiving_address for r in analytics.top_sale_addresses(df, k=4).collect()] == [
        "r0", "r1", "r2", "r3",
    ]


def test_no_sales_gives_an_empty_table_with_the_same_columns(transactions):
    df = clean_transactions(transactions({"transaction_type": "transfer"}))
    top = analytics.top_sale_addresses(df)
    assert top.count() == 0
    assert top.columns == ["receiving_address", "amount", "timestamp", "timestamp_readable"]


def test_nan_amount_sorts_first(transactions):
    df = clean_transactions(transactions({"amount": math.nan}, {"receiving_address": "r2"}))
    assert analytics.top_sale_addresses(df, k=1).first().receiving_address == "r1"


def test_latest_of_a_hot_key_against_brute_force(spark):
    df = spark.range(5000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 101)) AS key", "(id * 7919) % 5003 AS t", "id AS v"
    )
    latest = analytics.latest_per_key(df, ["key"], [F.desc("t"), F.asc("v")])
    best = {}
    for r in df.collect():
        if r.key not in best or (-r.t, r.v) < best[r.key]:
            best[r.key] = (-r.t, r.v)
    assert {r["key"]: (-r["t"], r["v"]) for r in as_dicts(latest)} == best


def test_the_row_of_a_full_tie_does_not_depend_on_the_input_order(transactions):
    rows = [{"purchase_pattern": p, "age_group": a} for p in ("b", "a") for a in ("y", "x")]
    for order in (rows, rows[::-1]):
        latest = analytics.latest_sale_per_address(clean_transactions(transactions(*order))).collect()
        assert [(r.purchase_pattern, r.age_group) for r in latest] == [("a", "x")]


def test_columns_without_an_order_do_not_take_part(transactions):
    df = clean_transactions(transactions({}, {})).withColumn("m", F.expr("map('a', 1)"))
    assert analytics.latest_sale_per_address(df).count() == 1
