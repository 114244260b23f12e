"""A dirty transaction table derived from the ``events`` table.

The supplied tables hold no null, no copy of a row and no non-positive value,
so dirt is added by integer arithmetic on the event id. All events take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyglass.schema import TXN_SCHEMA

COLUMNS = {
    "timestamp": """CASE
        WHEN event_id % 53 = 0 THEN NULL
        WHEN event_id % 71 = 0 THEN epoch - 400000000
        WHEN event_id % 73 = 0 THEN epoch + 100000000
        ELSE epoch END""",
    "sending_address": "'s' || user_id",
    "receiving_address": "CASE WHEN event_id % 59 != 0 THEN 'r' || (event_id * 7) % 97 END",
    "amount": """extra_amount + CASE
        WHEN event_id % 23 = 0 THEN -value
        WHEN event_id % 29 = 0 THEN 0D
        WHEN event_id % 61 = 0 THEN NULL
        ELSE value END""",
    "transaction_type": "CASE WHEN event_type = 'purchase' THEN 'sale' ELSE event_type END",
    "location_region": "r_name",
    "ip_prefix": "CAST(172 + event_id % 21 AS DOUBLE)",
    "login_frequency": "CAST(1 + event_id % 8 AS INT)",
    "session_duration": "CAST(20 + event_id % 140 AS INT)",
    "purchase_pattern": "element_at(array('focused', 'random', 'high_value'), CAST(event_id % 3 AS INT) + 1)",
    "age_group": "IF(event_id % 2 = 0, 'new', 'veteran')",
    "risk_score": """CASE
        WHEN event_id % 17 = 0 THEN 'none'
        WHEN event_id % 101 = 0 THEN 'bad'
        WHEN event_id % 211 = 0 AND r_name = 'ASIA' THEN 'NaN'
        ELSE (event_id * 13) % 100 || '.25' END""",
    "anomaly": "IF(event_id % 5 = 0, 'high_risk', 'low_risk')",
}

SOURCES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Every 50th event appears twice, and every 70th once more with a larger
# amount, which makes exact copies and real ties in time.
COPIES = """array_compact(array(
    0D, IF(event_id % 50 = 0, 0D, NULL), IF(event_id % 70 = 0, 1D, NULL)))"""


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of ``events``; the copies come from exploding a short array."""
    events, nation, region = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        for name, schema in SOURCES.items()
    )
    events = events.selectExpr(
        "event_id",
        "unix_timestamp(ts) AS epoch",
        "user_id",
        "event_type",
        "value",
        "CAST(user_id % 25 AS INT) AS n_nationkey",
        f"explode({COPIES}) AS extra_amount",
    )
    located = events.join(nation, "n_nationkey").join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    return located.selectExpr(*[f"{COLUMNS[f.name]} AS {f.name}" for f in TXN_SCHEMA])
