import os

import pytest
from conftest import as_dicts

from tallyglass.operators.analytics import highest_risk_first, location_risk
from tallyglass.operators.cleaning import clean_transactions
from tallyglass.plans import run as plans
from tallyglass.plans.run import EXPECTED_RESULTS, RunOptions, published_run, run_history
from tallyglass.sources import publication, results

QUICK = RunOptions(quality_checks=False, formats=("parquet", "csv"))


def table(spark, n, path, name="t_parquet"):
    spark.range(n).selectExpr("id", "CAST(id % 3 AS string) AS s", "map('k', id) AS m").write.parquet(f"{path}/{name}")


def test_nothing_published(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        publication.manifest(spark, root)
    assert [r.present for r in publication.published_present(spark, root, EXPECTED_RESULTS).collect()] == [False] * 2


def test_a_run_that_dies_leaves_the_former_results(spark, sample, tmp_path, monkeypatch):
    source, other, root = str(tmp_path / "in"), str(tmp_path / "in2"), str(tmp_path / "out")
    results.write_csv(sample, source)
    results.write_csv(sample.filter("location_region = 'Asia'"), other)
    published_run(spark, source, root, QUICK)
    before = publication.manifest(spark, root)
    risk = sorted(map(tuple, publication.read_published(spark, root, "location_risk_analysis").collect()))
    assert len(risk) == 5

    written = plans.write_result

    def dies(result, folder, name, *args, **options):
        if name == "top_sale_addresses":
            raise RuntimeError("lost between two results")
        written(result, folder, name, *args, **options)

    with monkeypatch.context() as broken:
        broken.setattr(plans, "write_result", dies)
        with pytest.raises(RuntimeError, match="lost"):
            published_run(spark, other, root, QUICK)
    assert len(os.listdir(f"{root}/runs")) == 2  # half a run is there, and nobody reads it
    assert publication.manifest(spark, root) == before
    assert sorted(map(tuple, publication.read_published(spark, root, "location_risk_analysis").collect())) == risk
    present = publication.published_present(spark, root, EXPECTED_RESULTS).collect()
    assert [(r.present, r.rows) for r in present] == [(True, 5), (True, 3)]

    published_run(spark, other, root, QUICK)
    assert publication.manifest(spark, root)["number"] == 2
    assert publication.read_published(spark, root, "location_risk_analysis", "csv").count() == 1


def test_manifest_counts_and_verifies(spark, tmp_path):
    root = str(tmp_path)
    folder = publication.new_run(root)
    table(spark, 1000, folder)
    table(spark, 0, folder, "inner/empty_parquet")
    spark.range(10).selectExpr("CAST(id AS string)").write.text(f"{folder}/lines.txt")
    os.makedirs(f"{folder}/unfinished_parquet")
    publication.commit(spark, root, folder)
    tables = {r["table_name"]: r for r in as_dicts(publication.published_tables(spark, root))}
    assert {n: t["rows"] for n, t in tables.items()} == {"t_parquet": 1000, "inner/empty_parquet": 0, "lines.txt": 10}
    files = [f for f in os.listdir(f"{folder}/t_parquet") if f.endswith(".parquet")]
    assert tables["t_parquet"]["files"] == len(files)
    assert tables["t_parquet"]["bytes"] == sum(os.path.getsize(f"{folder}/t_parquet/{f}") for f in files)
    assert all(r.intact for r in publication.verified(spark, root).collect())

    again = publication.new_run(root)  # the same rows in other files
    spark.read.parquet(f"{folder}/t_parquet").repartition(3).write.parquet(f"{again}/t_parquet")
    assert publication.commit(spark, root, again)["tables"][0]["checksum"] == tables["t_parquet"]["checksum"]


def test_damage_is_found(spark, tmp_path):
    root = str(tmp_path)
    folder = publication.new_run(root)
    for name in ("a_parquet", "b_parquet", "c_parquet"):
        table(spark, 100, folder, name)
    publication.commit(spark, root, folder)
    lost = sorted(f for f in os.listdir(f"{folder}/a_parquet") if f.startswith("part"))[0]
    os.rename(f"{folder}/a_parquet/{lost}", f"{tmp_path}/elsewhere")
    spark.range(5).selectExpr("id", "'x' AS s", "map('k', id) AS m").write.mode("append").parquet(f"{folder}/b_parquet")
    rows = {r.table_name: (r.intact, r.missing, r.changed, r.added > 0) for r in publication.verified(spark, root).collect()}
    assert rows == {"a_parquet": (False, 1, 0, False), "b_parquet": (False, 0, 0, True), "c_parquet": (True, 0, 0, False)}


def test_two_commits_at_once_take_two_numbers(spark, tmp_path, monkeypatch):
    root, folders = str(tmp_path), [publication.new_run(str(tmp_path)) for _ in range(2)]
    for i, folder in enumerate(folders):
        table(spark, i + 1, folder)
    publication.commit(spark, root, folders[0])
    seen = publication._numbers
    answers = [[]]  # listed before the other run committed
    monkeypatch.setattr(publication, "_numbers", lambda *a: answers.pop() if answers else seen(*a))
    assert publication.commit(spark, root, folders[1])["number"] == 2
    assert publication.read_published(spark, root, "t").count() == 2
    assert sorted(f for f in os.listdir(f"{root}/manifests") if f[0] not in "._") == ["0000000001.json", "0000000002.json"]


def test_superseded_runs_go_and_unfinished_ones_stay(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        folder = publication.new_run(root)
        table(spark, n, folder)
        publication.commit(spark, root, folder)
    table(spark, 9, publication.new_run(root))
    assert len(publication.remove_superseded(spark, root, keep=1)) == 2
    assert len(os.listdir(f"{root}/runs")) == 2
    assert publication.read_published(spark, root, "t").count() == 3
    with pytest.raises(ValueError):
        publication.remove_superseded(spark, root, keep=0)


def test_history_of_published_runs(spark, sample, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    results.write_csv(sample, source)
    run = published_run(spark, source, root, RunOptions(report_time="T0", formats=("json",)))
    assert run.gate.first().passed is True
    assert [r.status for r in run_history(spark, f"{root}/runs/*").collect()] == ["success"]
    names = {r.table_name for r in publication.published_tables(spark, root).collect()}
    assert {"quality_report.json", "quality_summary.txt", "location_risk_analysis.json"} <= names
    assert "raw_data_parquet" not in names


def test_ordered_results_are_sorted_by_ranges(spark, transactions, tmp_path):
    """No task takes a whole ordered result: with a small target its files are several, in order."""
    rows = [{"location_region": f"region {i:05d}", "risk_score": str(i % 97)} for i in range(3000)]
    risk = location_risk(clean_transactions(transactions(*rows)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        results.write_result(risk, str(tmp_path), "r", order=highest_risk_first())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(f for f in os.listdir(tmp_path / "r.csv") if f.endswith(".csv"))
    assert len(files) > 1
    scores = [float(line.rsplit(",", 1)[1]) for f in files for line in open(tmp_path / "r.csv" / f).read().splitlines()[1:]]
    assert scores == sorted(scores, reverse=True) and len(scores) == 3000
