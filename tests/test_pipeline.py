"""End to end: CSV → all layers → model versions → predictions, twice."""

from __future__ import annotations

import os
import tempfile

from daybook.config import FIXTURE_CUT_DATE
from daybook.plans.pipeline import run_pipeline, run_predictions, stored_scores
from daybook.sources.files import read_partitions, read_table, write_csv
from daybook.sources.fixtures import transactions_from_star


def test_pipeline_runs_twice(spark, sf_small):
    root = tempfile.mkdtemp(prefix="daybook-e2e-")
    src = write_csv(transactions_from_star(spark, sf_small), os.path.join(root, "raw"))
    out = os.path.join(root, "tables")

    first = run_pipeline(spark, src, out, FIXTURE_CUT_DATE, max_iter=3)
    m = first.measures
    assert m["bronze"] == {"source_rows": 6000, "table_rows": 6000}
    assert m["silver"]["rows"] == 4599 and m["silver"]["distinct_ids"] == 4599
    assert m["daily"]["total_transactions"] == 4599
    assert m["features"]["rows"] == 74064
    assert m["feature_nulls"] == {"null_demand_1": 30, "null_demand_7": 210,
                                  "null_rolling_7_day_avg": 30}
    assert (m["split"]["train_rows"], m["split"]["test_rows"]) == (59799, 14265)
    assert first.decision["decision"] == "promoted (first model)"
    assert first.decision["champion_r2"] is None
    assert m["predictions"]["rows"] == 14265 and m["predictions"]["missing_predictions"] == 0

    second = run_pipeline(spark, src, out, FIXTURE_CUT_DATE, max_iter=3)
    assert second.version == "2"
    # same data, same seed: equal R², so the champion stays (strict comparison)
    assert second.decision["decision"] == "kept champion"
    assert second.decision["champion_version"] == "1"
    versions = {r.version: r.alias for r in read_table(spark, second.paths["model_versions"]).collect()}
    assert versions == {"1": "Champion", "2": "Challenger"}
    runs = read_table(spark, second.paths["runs"])
    assert runs.count() == 2
    preds = read_table(spark, second.paths["predictions"])
    assert {r.model_version for r in preds.select("model_version").distinct().collect()} == {"1"}
    assert "predicted_at" in preds.columns

    # every version's scores stored once; the champion's rows are its partition
    scores = read_partitions(spark, second.paths["scores"], ["model_name", "model_version"])
    assert {(r.model_name, r.model_version): r["count"] for r in scores.groupBy(
        "model_name", "model_version").count().collect()} == {
            ("demand_model", "1"): 14265, ("demand_model", "2"): 14265}
    stored = stored_scores(spark, second.paths, "demand_model", ["1"])
    assert "PartitionFilters: [isnotnull(model_name" in stored._jdf.queryExecution().toString()
    assert preds.exceptAll(stored.select(*preds.columns)).count() == 0
    runs = read_partitions(spark, second.paths["runs"], ["model_name", "model_version"])
    assert sorted(r.model_version for r in runs.collect()) == ["1", "2"]
    folder = os.path.join(second.paths["artifacts"], "demand_model", "2")
    importance = spark.read.option("header", "true").csv(os.path.join(folder, "feature_importance")).collect()
    assert len(importance) == 7 and abs(sum(float(r.importance) for r in importance) - 100) < 1e-6
    exported = spark.read.option("header", "true").csv(os.path.join(folder, "test_predictions"))
    assert exported.count() == 14265 and exported.columns[-2:] == ["actual_demand", "predicted_demand"]
    grid = read_table(spark, os.path.join(folder, "actual_vs_predicted"))
    assert sum(r.rows for r in grid.collect()) == 14265 and grid.count() <= 10_000
    assert os.listdir(os.path.join(second.paths["fits"], "demand_model")) == []

    # nothing is scored again while the test rows are the same; another cut is
    before = scores.filter("model_version = '1'").agg({"predicted_at": "max"}).first()[0]
    m = {}
    run_predictions(spark, second.paths, m, FIXTURE_CUT_DATE)
    again = read_table(spark, second.paths["predictions"]).agg({"predicted_at": "max"}).first()[0]
    assert again == before
    run_predictions(spark, second.paths, m, "2000-09-30")
    later = read_table(spark, second.paths["predictions"])
    assert later.agg({"predicted_at": "max"}).first()[0] > before
    assert m["predictions"]["rows"] < 14265


def test_stages_from_the_command_line(spark, sf_small, capsys):
    import json

    from daybook.plans.pipeline import main

    root = tempfile.mkdtemp(prefix="daybook-cli-")
    src = write_csv(transactions_from_star(spark, sf_small), os.path.join(root, "raw"))
    out = os.path.join(root, "tables")
    for stage in ["bronze", "silver", "daily", "features"]:
        main([stage, "--source", src, "--out", out])
    measures = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert measures["features"]["rows"] == 74064 and measures["key"]["null_product_name"] == 0
    assert read_table(spark, os.path.join(out, "features")).count() == 74064
