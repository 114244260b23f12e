import math

import pytest
from conftest import as_dicts

from tallyglass.operators.duplicates import distinct_rows, duplicate_profile

METHODS = ["rows", "hash", "auto"]


def profile(df, method, **options):
    row = as_dicts(duplicate_profile(df, method=method, **options))[0]
    return row["total_records"], row["unique_records"], row["duplicate_count"], row["duplicate_percentage"]


@pytest.mark.parametrize("method", METHODS)
def test_no_copies_and_then_all_doubled(transactions, method):
    df = transactions(*[{"timestamp": i} for i in range(40)])
    assert profile(df, method) == (40, 40, 0, 0.0)
    assert profile(df.union(df), method) == (80, 40, 40, 50.0)


@pytest.mark.parametrize("method", METHODS)
def test_empty(transactions, method):
    assert profile(transactions({}).limit(0), method) == (0, 0, 0, 0.0)


@pytest.mark.parametrize("method", METHODS)
def test_equality_of_special_values(spark, method):
    df = spark.createDataFrame(
        [(0.0, None), (-0.0, None), (math.nan, None), (-math.nan, None), (None, None), (None, None)],
        "d double, t string",
    )
    assert profile(df, method) == (6, 3, 3, 50.0)
    assert distinct_rows(df).count() == 3


def test_rows_that_share_a_hash_stay_apart(spark):
    # The hash skips nulls, so these two rows have the same one.
    df = spark.createDataFrame([(None, "a"), ("a", None), ("b", "b"), ("b", "b")], "x string, y string")
    assert df.selectExpr("count(DISTINCT xxhash64(x, y))").first()[0] == 2
    assert profile(df, "hash") == (4, 3, 1, 25.0)


def test_one_group_of_copies_holding_a_third(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, -1L, id) AS k", "IF(id % 3 = 0, 'hot', 'x') AS t")
    for method in METHODS:
        assert profile(df, method) == (3000, 2001, 999, 33.3)


@pytest.mark.parametrize("method", METHODS)
def test_maps_and_nested_columns(spark, method):
    df = spark.sql(
        "SELECT map('a', 1, 'b', 2) AS m, array(1) AS l, named_struct('x', 1) AS s "
        "UNION ALL SELECT map('b', 2, 'a', 1), array(1), named_struct('x', 1) "
        "UNION ALL SELECT map('a', 1), array(1), named_struct('x', 1)"
    )
    assert profile(df, method) == (3, 2, 1, 33.33)


@pytest.mark.parametrize("method", METHODS)
def test_maps_below_other_columns(spark, method):
    df = spark.sql(
        "SELECT named_struct('m', map('a', 1, 'b', 2)) AS s, array(map('k', array(1))) AS l "
        "UNION ALL SELECT named_struct('m', map('b', 2, 'a', 1)), array(map('k', array(1))) "
        "UNION ALL SELECT named_struct('m', map('a', 1)), array(map('k', array(2))) "
        "UNION ALL SELECT NULL, NULL"
    )
    assert profile(df, method) == (4, 3, 1, 25.0)
    assert distinct_rows(df).schema == df.schema and distinct_rows(df).count() == 3


def test_collated_text_is_grouped_not_hashed(spark):
    df = spark.sql("SELECT t COLLATE UTF8_LCASE AS t FROM VALUES ('a'), ('A'), ('b') AS v(t)")
    for nested in (df, df.selectExpr("named_struct('t', array(t)) AS s")):
        assert profile(nested, "rows") == profile(nested, "auto") == (3, 2, 1, 33.33)
        with pytest.raises(ValueError, match="rows"):
            duplicate_profile(nested, method="hash")


@pytest.mark.parametrize("method", METHODS)
def test_columns_named_like_the_helpers(spark, method):
    df = spark.sql("SELECT 1 AS hash_of_row, 2 AS copies_of_row UNION ALL SELECT 1, 2 UNION ALL SELECT 1, 3")
    assert profile(df, method) == (3, 2, 1, 33.33)


def test_auto_follows_schema_and_plan_not_the_size(spark, monkeypatch, tmp_path):
    from tallyglass.operators import duplicates

    used = []
    monkeypatch.setattr(duplicates, "_by_hash", lambda df, total: used.append("hash"))
    monkeypatch.setattr(duplicates, "_by_rows", lambda df: used.append("rows"))
    for rows in (1, 10, 10**4):
        spark.range(rows).write.parquet(f"{tmp_path}/{rows}")
        files = spark.read.parquet(f"{tmp_path}/{rows}")
        duplicates.duplicate_profile(files.filter("id > 3").selectExpr("id", "id % 3 AS k"))
        duplicates.duplicate_profile(files.join(files.distinct(), "id"))
        duplicates.duplicate_profile(files.selectExpr("explode(array(id, id)) AS id"))
    assert used == ["hash", "rows", "rows"] * 3


def test_listing_is_removed_and_total_taken(spark, tmp_path, monkeypatch):
    from tallyglass.operators import duplicates

    monkeypatch.setattr(duplicates, "shared_folder", lambda spark: str(tmp_path / "listing"))
    doubled = spark.range(5).union(spark.range(5))
    assert profile(doubled, "hash", total=10) == (10, 5, 5, 50.0)
    assert not (tmp_path / "listing").exists()


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="sideways"):
        duplicate_profile(spark.range(1), method="sideways")


def test_shuffles_are_sized_by_the_input_in_a_session_of_their_own(spark):
    from tallyglass.session import SHUFFLE_PARTITION_BYTES, input_bytes, own_session

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    large = spark.range(5000 * SHUFFLE_PARTITION_BYTES // 8)
    assert input_bytes(large) == 5000 * SHUFFLE_PARTITION_BYTES
    session = own_session(spark, input_bytes(large))
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"
    plan = session.range(10).selectExpr("id % 7 AS k").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "5000" in plan
    assert own_session(spark, 10).conf.get(key) == "8"
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("method", METHODS)
def test_derived_columns_change_nothing(transactions, method):
    df = transactions({}, {}, {"timestamp": 7}, {"timestamp": None}, {"timestamp": None})
    readable = df.selectExpr("*", "from_unixtime(`timestamp`) AS r")
    assert profile(readable, method, derived=["r"]) == profile(readable, method) == (5, 3, 2, 40.0)
