"""Layout of landed tables: what scans for one type or address read."""

from pyspark.sql import functions as F

from tallyglass.operators.analytics import top_sale_addresses
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.plans.run import RunOptions, full_run
from tallyglass.sources import results
from tallyglass.sources.transactions import land, land_clustered


def rows_read(df):
    """Rows that the file scans of ``df`` gave, after it has run."""
    df.collect()
    waiting, rows = [df._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec":
            rows += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return rows


def many(spark, transactions, n=40_000):
    base = transactions({}).drop("transaction_type", "receiving_address", "amount", "timestamp")
    types = F.expr("element_at(array('sale', 'transfer', 'purchase', 'phishing', 'scam'), CAST(id % 5 AS int) + 1)")
    rows = spark.range(0, n, 1, 4).crossJoin(F.broadcast(base))  # one row beside each
    return rows.select(
        F.expr("1600000000 + id").alias("timestamp"),
        "sending_address",
        F.expr("concat('0x', md5(CAST(id DIV 10 AS string)))").alias("receiving_address"),
        F.expr("CAST(1 + pmod(xxhash64(id), 1000003) AS double)").alias("amount"),
        types.alias("transaction_type"),
        *[c for c in base.columns if c != "sending_address"],
    )


def test_sales_are_read_without_the_rest(spark, transactions, tmp_path):
    rows = many(spark, transactions)
    with_small_groups = {"parquet.block.size": "65536", "parquet.page.size": "8192"}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in with_small_groups.items():
        conf.set(key, value)
    try:
        plain, clustered = land(rows, str(tmp_path / "plain")), land_clustered(rows, str(tmp_path / "clustered"))
    finally:
        for key in with_small_groups:
            conf.unset(key)
    before, after = (top_sale_addresses(clean_transactions(t)) for t in (plain, clustered))
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    assert rows_read(before) > 0.9 * rows.count()
    assert rows_read(after) < 0.4 * rows.count()  # a fifth are sales; row groups end where they end
    one = rows.filter("id = 123") if "id" in rows.columns else rows.limit(1)
    address = one.first().receiving_address
    found = clustered.filter(F.col("receiving_address") == address)
    assert found.count() == plain.filter(F.col("receiving_address") == address).count() == 10
    assert rows_read(found) < 0.5 * rows.count()


def test_a_clustered_run_gives_the_same(spark, sample, tmp_path):
    source = str(tmp_path / "in")
    results.write_csv(sample, source)
    runs = [
        full_run(spark, source, str(tmp_path / str(c)), RunOptions(clustered=c, quality_checks=False, formats=("parquet",)))
        for c in (False, True)
    ]
    for name in ("location_risk", "top_sales", "audit", "cleaned"):
        a, b = (sorted(map(str, getattr(r, name).collect())) for r in runs)
        assert a == b
