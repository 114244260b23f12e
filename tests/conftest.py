import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyglass.schema import TXN_SCHEMA  # noqa: E402
from tallyglass.session import prepare  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tallyglass-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


DEFAULTS = {
    "timestamp": 1_600_000_000,
    "sending_address": "s1",
    "receiving_address": "r1",
    "amount": 10.0,
    "transaction_type": "sale",
    "location_region": "Asia",
    "ip_prefix": 172.0,
    "login_frequency": 3,
    "session_duration": 40,
    "purchase_pattern": "focused",
    "age_group": "new",
    "risk_score": "20.0",
    "anomaly": "low_risk",
}


@pytest.fixture(scope="session")
def transactions(spark):
    """Table of transactions from partial rows."""

    def make(*rows):
        values = [tuple({**DEFAULTS, **row}[f.name] for f in TXN_SCHEMA) for row in rows]
        return spark.createDataFrame(values, TXN_SCHEMA)

    return make


@pytest.fixture(scope="session")
def sample(transactions):
    """17 rows whose results are known: 15 valid risk scores with mean 35.7,
    two sentinels, no missing value, no copy of a row, three largest latest sales."""
    scores = {
        "North America": [52.5, 52.5],
        "Africa": [31.25, 47.0],
        "South America": [15.0, 25.0, 31.25, 37.5, 47.25, 50.0, 62.5],
        "Asia": [31.25],
        "Europe": [15.0, 17.5, 20.0],
    }
    rows = [
        {"location_region": region, "risk_score": str(score)}
        for region, values in scores.items()
        for score in values
    ]
    rows += [{"location_region": "Asia", "risk_score": "none"}] * 2
    rows = [
        {
            **row,
            "timestamp": 1_590_044_893 + i,
            "transaction_type": "transfer",
            "receiving_address": f"0x{i:040x}",
            "amount": 100.0 + i,
        }
        for i, row in enumerate(rows)
    ]
    sales = [("0xaa", 67617.0, 1629563063), ("0xbb", 66002.0, 1611257295), ("0xcc", 57325.0, 1694024264)]
    for row, (address, amount, epoch) in zip(rows, sales):
        row.update(
            transaction_type="sale", receiving_address=address, amount=amount, timestamp=epoch
        )
    # An older, larger sale of a listed address must not count.
    rows[3].update(
        transaction_type="sale", receiving_address="0xcc", amount=70754.0, timestamp=1590044893
    )
    return transactions(*rows)


def as_dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
